"""Toxicity: a linear classifier learned from confirmed toxic documents and unlabelled text.

Nothing is learned as clean: rows labelled 0 enter as unlabelled text, like rows without a label. The
risk that is minimised is that of non-negative positive-unlabelled learning: with the share of
toxic documents `prior`, the loss of calling unlabelled text toxic, less `prior` times that loss
on the confirmed examples, stands for the loss on clean text; it cannot be negative, so where
an update would push it below zero it is undone instead.

Features are whole words and beginnings of words (`BEGINNINGS` code points), hashed into `BUCKETS`
numbers, as the logarithm of how often they occur. Which of them are used is decided by their document
frequencies in all confirmed and all unlabelled documents of the training rows: of the `CANDIDATES` most
frequent in confirmed ones, the `FEATURES` that stand out most. Weights are fitted on at most
`SAMPLE_ROWS` documents of each kind, those with the smallest hash of their doc_id. Every document is
scored, in whole, by numpy within Spark's tasks.

Defined results: a null or empty text has no features and gets the bias as its score. Equal rows
get equal rows; a null `doc_id` stays null and is never learned from. Of several texts under one id, the
one with the smallest hash is learned from; of several labels of an id, one that says toxic is
enough. Without confirmed or without unlabelled rows, every score is 0. Empty tables give no rows.
Further columns are ignored. A very long text is read in whole; it is a slice of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import lower_bytes, mix, run_hashes, slices, small, text_bytes

BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7, 8)
CANDIDATES, FEATURES = 1 << 15, 1024
SAMPLE_ROWS = 20_000
DEFAULT_PRIOR = 0.1
SLICE_BYTES = 1 << 20


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and word beginning of texts given as UTF-8 bytes.

    Words are runs of ASCII letters and all non-ASCII characters, A-Z lower-cased.
    """
    data = lower_bytes(data)
    letter = (data >= 97) & (data <= 122) | (data >= 128)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[:-1] += letter
    edge[1:] -= letter
    starts, ends = edge == 1, edge == -1
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    joined = inner[letter[inner] & letter[inner - 1]]  # words of two texts that touch
    starts[joined] = ends[joined] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    first, last = np.searchsorted(chars, starts), np.searchsorted(chars, ends)
    keys, owners = [mix(run_hashes(data, starts, ends))], [rows]
    for k in BEGINNINGS:
        longer = np.flatnonzero(last - first > k)
        stop = chars[first[longer] + k]
        keys.append(mix(run_hashes(data, starts[longer], stop) + np.uint64(1)))
        owners.append(rows[longer])
    return np.concatenate(owners), (np.concatenate(keys) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and counts, each (row, bucket) once."""
    keys, counts = np.unique(rows * BUCKETS + buckets, return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, counts


@dataclass
class Classifier:
    """`place` has each bucket's feature or -1; weights of features' logarithmic counts, and a bias."""

    place: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, buckets = text_features(data, offsets)
        used = self.place[buckets] >= 0
        rows, buckets, counts = _counted(rows[used], buckets[used])
        total = np.bincount(rows, self.weights[self.place[buckets]] * np.log2(1 + counts), len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -500, 500)))


def fit_pu(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    toxic: np.ndarray,
    n_columns: int,
    prior: float,
    epochs: int = 300,
    rate: float = 0.05,
    decay: float = 2e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the sigmoid loss.

    The sample is sparse: `values` at (`rows`, `columns`); `toxic` marks confirmed rows, all others
    are unlabelled. Adam on the whole sample.
    """
    n_toxic, n_rest = int(toxic.sum()), int((~toxic).sum())
    x = np.zeros(n_columns + 1)
    x[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, epochs + 1):
        g = np.bincount(rows, x[columns] * values, len(toxic)) + x[-1]
        p = 1 / (1 + np.exp(-np.clip(g, -50, 50)))
        slope = p * (1 - p)  # of p, the loss of calling a row toxic
        clean = p[~toxic].mean() - prior * p[toxic].mean()
        per_row = np.empty(len(toxic))
        if clean >= 0:
            per_row[~toxic] = slope[~toxic] / n_rest
            per_row[toxic] = -2 * prior * slope[toxic] / n_toxic
        else:  # undo: the part that stands for clean text is raised again
            per_row[~toxic] = -slope[~toxic] / n_rest
            per_row[toxic] = prior * slope[toxic] / n_toxic
        grad = np.bincount(columns, per_row[rows] * values, n_columns + 1)
        grad[-1] = per_row.sum()
        grad[:-1] += decay * x[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return x[:-1], float(x[-1])


def document_frequencies(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """(bucket, n): the number of rows of `docs` (text) with each feature, of `wanted` ones or all.

    A task adds up its rows in one array and hands on what is not zero, once.
    """

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                rows, buckets = text_features(*text_bytes(part.column("text")))
                if wanted is not None:
                    rows, buckets = rows[wanted[buckets]], buckets[wanted[buckets]]
                total += np.bincount(_counted(rows, buckets)[1], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _sample(docs: DataFrame, ids: DataFrame, place: np.ndarray, rows: int) -> list:
    """Features and their counts of the documents of at most `rows` of `ids`, by smallest hash."""
    taken = F.broadcast(ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

    def sparse(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found, buckets = text_features(*text_bytes(part.column("text")))
                used = place[buckets] >= 0
                found, buckets, counts = _counted(found[used], buckets[used])
                ends = np.searchsorted(found, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int64))) for x in (place[buckets], counts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), *lists], names=["doc_id", "text_hash", "features", "counts"])

    chosen = docs.join(taken, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    vectors = chosen.mapInArrow(sparse, "doc_id long, text_hash long, features array<long>, counts array<long>")
    one = vectors.groupBy("doc_id").agg(F.min_by(F.struct("features", "counts"), "text_hash").alias("v"))
    return [r.v for r in one.orderBy("doc_id").collect()]


def _stand_out(toxic: np.ndarray, rest: np.ndarray, n_toxic: int, n_rest: int) -> np.ndarray:
    """How much more frequent features are in confirmed documents, in standard deviations."""
    p, u = (toxic + 0.5) / (n_toxic + 1), (rest + 0.5) / (n_rest + 1)
    least = np.maximum(u, 1 / n_toxic)
    return (p - u) / np.sqrt(least * np.maximum(1 - least, 1e-9) / n_toxic)


def learn(docs: DataFrame, labels: DataFrame, prior: float | None = None, sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """A classifier from the rows of `docs` (doc_id, text) and the labels (doc_id, toxic) given here.

    `prior`, the share of toxic documents, is by default that among the labelled ones, or
    `DEFAULT_PRIOR` if none is labelled clean.
    """
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
        prior = DEFAULT_PRIOR if share in (None, 1.0) else share
    prior = min(max(prior, 1e-3), 0.9)
    toxic_ids = small(known.where("toxic > 0").select("doc_id"))
    kinds = [docs.join(toxic_ids, "doc_id", how) for how in ("left_semi", "left_anti")]
    n_toxic, n_rest = (kind.count() for kind in kinds)
    if not n_toxic or not n_rest:
        return None
    frequent = document_frequencies(kinds[0]).where("n >= 2").orderBy(F.col("n").desc(), "bucket").limit(CANDIDATES)
    buckets, in_toxic = (np.array([r[k] for r in frequent.collect()], np.int64) for k in (0, 1))
    wanted = np.zeros(BUCKETS, bool)
    wanted[buckets] = True
    in_rest = np.zeros(BUCKETS, np.int64)
    for bucket, n in document_frequencies(kinds[1], wanted).collect():  # CANDIDATES rows at most
        in_rest[bucket] = n
    apart = _stand_out(in_toxic, in_rest[buckets], n_toxic, n_rest)
    chosen = np.lexsort([buckets, -apart])[:FEATURES]
    chosen = buckets[chosen[apart[chosen] > 2]]
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    vectors = [_sample(kind, kind.select("doc_id"), place, sample_rows) for kind in kinds]
    toxic = np.repeat([True, False], [len(v) for v in vectors])
    vectors = vectors[0] + vectors[1]
    rows = np.repeat(np.arange(len(vectors)), [len(v.features) for v in vectors])
    columns, counts = (np.fromiter((x for v in vectors for x in v[k]), np.int64) for k in ("features", "counts"))
    weights, bias = fit_pu(rows, columns, np.log2(1 + counts), toxic, len(chosen), prior)
    return Classifier(place, weights, bias)


def score_documents(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """(doc_id, score) for every row of `docs` (doc_id, text); the score is 0 without a classifier."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if classifier is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))

    def score(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                scores = classifier.score(*text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id long, score double")


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels and texts of four fifths of them."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    classifier = learn(docs.where(~held_out), labels.where(~held_out))
    scored = score_documents(docs, classifier)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
