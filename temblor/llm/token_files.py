"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

A file is one Spark partition of a Parquet dataset: documents in ascending `doc_id` order, cut into
blocks. Each file ranks its own ids by frequency (row `block` = -1 holds the ranked ids), and a
block stores ranks in one to four bytes each: two control bits per rank give its length, kept
apart from the data bytes so that numpy decodes a block by one table lookup and four gathers.

Defined results: a null text is empty and holds the end id alone. Documents with a null `doc_id`
come first; rows that share a `doc_id` follow one another, equal rows included. Further columns of
the input are ignored. An empty table gives an empty dataset.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.llm.common import small
from temblor.llm.tokens import encoder

FILE_SCHEMA = "file int, block long, doc_ids array<long>, lengths array<long>, control binary, data binary"
BLOCK_TOKENS = 1 << 17
FILE_TEXT_BYTES = 16 << 20
# Rank tables go to every executor up to this size together; beyond it they are joined by a shuffle.
RANK_TABLE_BYTES = 64 << 20

# For each control byte: the lengths of its four ranks.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    size = size.astype(np.uint8)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.sum(axis=1, dtype=np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The `n` ranks of one block."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    out = np.zeros((n, 4), np.uint8)
    out[used] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, files: int | None = None
) -> None:
    """Encode `docs` (doc_id, text) and write them, in order, to the dataset at `path`."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    if files is None:
        files = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_TEXT_BYTES)
    files = max(int(files), 1, spark.sparkContext.defaultParallelism)
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def encode(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        doc_ids, lengths, texts = [], [], []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            for text in batch.column(1):
                ids = np.frombuffer(coder.encode(text.as_py()) + end, "<u4")
                lengths.append(len(ids))
                texts.append(ids if ids.max() > 0xFFFF else ids.astype("<u2"))
        if not doc_ids:
            return
        counts = np.zeros(1 + max(int(x.max()) for x in texts), np.int64)
        blocks = list(_blocks(lengths))
        for at, to in blocks:
            counts += np.bincount(np.concatenate(texts[at:to]), minlength=len(counts))
        ids = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
        rank = np.zeros(len(counts), np.uint32)
        rank[ids] = np.arange(len(ids), dtype=np.uint32)
        yield _rows(part, -1, [], [], b"", ids.astype("<u4").tobytes())
        for block, (at, to) in enumerate(blocks):
            control, data = encode_ranks(rank[np.concatenate(texts[at:to])])
            yield _rows(part, block, doc_ids[at:to], lengths[at:to], control, data)

    dealt.mapInArrow(encode, FILE_SCHEMA).write.parquet(path)


def _blocks(lengths: list[int]):
    """Documents from `at` up to `to` of each block: BLOCK_TOKENS at most, or a single longer one."""
    at = 0
    while at < len(lengths):
        to, have = at, 0
        while to < len(lengths) and (to == at or have + lengths[to] <= BLOCK_TOKENS):
            have += lengths[to]
            to += 1
        yield at, to
        at = to


def _rows(part, block, doc_ids, lengths, control, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([block], pa.int64()),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([control], pa.binary()),
            pa.array([data], pa.binary()),
        ],
        ["file", "block", "doc_ids", "lengths", "control", "data"],
    )


def read_token_files(spark, path: str) -> DataFrame:
    """The documents of a dataset: file, block, place, doc_id, ids (little-endian 32-bit) and n_tokens."""
    return _read(spark, path, "file int, block long, place int, doc_id long, n_tokens long, ids binary", True)


def _read(spark, path: str, schema: str, whole: bool) -> DataFrame:
    stored = spark.read.schema(FILE_SCHEMA).parquet(path)
    tables = stored.where("block < 0").select("file", F.col("data").alias("ids_by_rank"))
    size = tables.agg(F.sum(F.octet_length("ids_by_rank"))).first()[0] or 0
    # Files and blocks spread over all tasks, so a merge join has no hot key: a file has a bounded text.
    tables = F.broadcast(tables) if size <= RANK_TABLE_BYTES else tables.hint("merge")
    blocks = stored.where("block >= 0").join(tables, "file")

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                by_rank = np.frombuffer(row["ids_by_rank"], "<u4")
                ids = by_rank[decode_ranks(row["control"], row["data"], sum(row["lengths"]))]
                ends = np.cumsum(row["lengths"])
                n = len(ends)
                each = [ids[e - k : e].tobytes() for e, k in zip(ends, row["lengths"])]
                last = each if whole else [zlib.crc32(x) for x in each]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * n, pa.int32()),
                        pa.array([row["block"]] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(last, pa.binary() if whole else pa.int64()),
                    ],
                    ["file", "block", "place", "doc_id", "n_tokens", "ids" if whole else "ids_crc32"],
                )

    return blocks.mapInArrow(decode, schema)


def token_file_digests(spark, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it: totals per block are added up in two levels,
    blocks within a file and files among each other, and never document by document in one task.
    """
    stored = spark.read.schema(FILE_SCHEMA).parquet(path).where("block >= 0")
    sized = stored.select(
        "file", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    within = sized.select("file", "block", F.coalesce(before, F.lit(0)).alias("in_file"))
    earlier = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = sized.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", F.coalesce(earlier, F.lit(0)).alias("before_file"))
    bases = within.join(files, "file").select("file", "block", (F.col("in_file") + F.col("before_file")).alias("base"))
    docs = _read(spark, path, "file int, block long, place int, doc_id long, n_tokens long, ids_crc32 long", False)
    docs = docs.join(small(bases), ["file", "block"])
    inside = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return docs.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document through the token files and back."""
    import public_tokenizers

    path = shared_dir(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_file_digests(spark, path)
