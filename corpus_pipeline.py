"""The corpus pipeline: quality rules, near copies, benchmark passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.llm.common import small
from temblor.llm.decontamination import contamination
from temblor.llm.packing import pack
from temblor.llm.pii import mask_documents
from temblor.llm.quality import keep_good
from temblor.llm.simhash import keep_one_of_each

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at 4 or fewer differing bits, of 4-word shingles."""
    return keep_one_of_each(docs, words=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages that make up a twentieth of them or more."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = small(contamination(docs, benchmark).where("contaminated").select("doc_id", "text_hash").distinct())
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return mask_documents(docs).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_pii", mask_pii),
    ("packed", packed),
]
ORACLE_SQL = None  # no SQL for the tokenizer, the trees and the fingerprints


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
