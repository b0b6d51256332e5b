"""Quality rules: gradient-boosted trees over document statistics, flattened into node arrays.

Statistics of whole texts are computed once, in numpy, and written. The trees are fitted on a
bounded sample of labelled rows (`SAMPLE_ROWS`, the labels with the smallest hash of their doc_id)
and score all documents, as arrays of nodes walked level by level for a whole batch.

Some statistics may only lower the verdict as they grow (`FEATURES`: -1). A split on one of these
must give its upper side the lower value, and the middle between both bounds all leaves below.

Defined results: a null, empty or white-space text has no words, all zero, and fails the base
rules. Equal rows get equal rows; a null `doc_id` stays null. Labels with null values or unknown
ids are left out; several labels of one id count by their majority. Without labels of both
classes, the verdict is the base rules'. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import materialise, mix, run_hashes, slices, space_words, text_bytes

SAMPLE_ROWS = 20_000
SLICE_BYTES = 1 << 20
KEEP_FROM = 0.5
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistic: 1 raises, -1 lowers, 0 either way.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 1,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": -1,
    "pipe_share": -1,
    "words_per_line": 0,
    "letter_word_share": 0,
}
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{f} float" for f in FEATURES)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.r_[same, False] | np.r_[False, same] if len(keys) else False
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts and features of texts given as UTF-8 bytes and row offsets."""
    n = len(offsets) - 1
    starts, ends, rows = space_words(data, offsets)
    hashes = run_hashes(data, starts, ends)
    n_words = np.bincount(rows, minlength=n)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    chars = _per_row(((data & 0xC0) != 0x80) & ~gap, offsets)

    # Lines: each ends at a newline or at the row's end.
    newline = np.flatnonzero(data == 10)
    tails = np.sort(np.concatenate([newline, offsets[1:]]))
    heads = np.sort(np.concatenate([newline + 1, offsets[:-1]]))
    filled = np.concatenate([[0], np.cumsum(~gap, dtype=np.int64)])
    lines = filled[tails] > filled[heads]
    heads, tails = heads[lines], tails[lines]
    line_rows = np.searchsorted(offsets, heads, side="right") - 1
    line_keys = mix(run_hashes(data, heads, tails) + line_rows.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(line_keys, kind="stable")
    again = np.zeros(len(heads), bool)
    again[order[1:]] = line_keys[order][1:] == line_keys[order][:-1]
    n_lines = np.bincount(line_rows, minlength=n)
    dup_lines = np.bincount(line_rows[again], minlength=n)

    repeat_words = np.zeros(n, np.int64)
    if len(rows) >= WINDOW:
        last = len(rows) - WINDOW + 1
        key = np.zeros(last, np.uint64)
        for k in range(WINDOW):
            key = key * np.uint64(0xD1342543DE82EF95) + hashes[k : k + last]
        inside = np.flatnonzero(rows[:last] == rows[WINDOW - 1 :])
        key = mix(key[inside] ^ mix(rows[inside].astype(np.uint64) + np.uint64(1)))
        twice = inside[_repeats(key)]
        cover = np.zeros(len(rows) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
        repeat_words = np.bincount(rows[np.cumsum(cover[:-1]) > 0], minlength=n)

    word_keys = mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(7)))
    order = np.argsort(word_keys, kind="stable")
    first = np.ones(len(rows), bool)
    first[order[1:]] = word_keys[order][1:] != word_keys[order][:-1]
    symbols = np.zeros(256, bool)
    symbols[list(b"#*$%&|<>")] = True
    marks = np.zeros(256, bool)
    marks[list(b"!?#*$%&|<>=@^~{}[]")] = True
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    in_letters = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    plain = in_letters[ends] - in_letters[starts] >= (ends - starts) - 1
    some, some_lines, some_chars = np.maximum(n_words, 1), np.maximum(n_lines, 1), np.maximum(chars, 1)
    n_symbols = _per_row(symbols[data], offsets)
    return {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": n_symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "log_words": np.log1p(n_words),
        "word_length": chars / some,
        "symbol_share": n_symbols / some,
        "dup_line_share": dup_lines / some_lines,
        "repeat_share": repeat_words / some,
        "distinct_share": np.bincount(rows[first], minlength=n) / np.sqrt(some),
        "upper_share": _per_row((data >= 65) & (data <= 90), offsets) / some_chars,
        "digit_share": _per_row((data >= 48) & (data <= 57), offsets) / some_chars,
        "mark_share": _per_row(marks[data], offsets) / some,
        "pipe_share": _per_row(data == 124, offsets) / some,
        "words_per_line": n_words / some_lines,
        "letter_word_share": np.bincount(rows[plain], minlength=n) / some,
    }


def document_statistics(docs: DataFrame) -> DataFrame:
    """The counts and features of every row of `docs` (doc_id, text)."""

    def compute(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                stats = statistics(*text_bytes(part.column("text")))
                columns = [part.column("doc_id")]
                columns += [pa.array(stats[c].astype(np.int64)) for c in COUNTS]
                columns += [pa.array(stats[f].astype(np.float32)) for f in FEATURES]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, *FEATURES])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(compute, STATS)


@dataclass
class Trees:
    """Flattened trees: node k of tree t has a feature (-1: leaf), a threshold, children, a value."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the upper class for rows of features."""
        out = np.full(len(x), self.base)
        every = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            while True:
                feature = self.feature[t][node]
                if (feature < 0).all():
                    break
                down = np.where(x[every, feature] <= self.threshold[t][node], self.left[t][node], self.right[t][node])
                node = np.where(feature < 0, node, down)
            out += self.value[t][node]
        return 1 / (1 + np.exp(-out))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotonic: np.ndarray,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    penalty: float = 1.0,
    least: float = 1.0,
) -> Trees:
    """Boosted trees for the logistic loss, split on quantiles by second-order gain."""
    x = np.asarray(x, np.float64)
    n, m = x.shape
    size = 2 ** (depth + 1) - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)
    shape = (rounds, size)
    trees = Trees(base, np.full(shape, -1), np.zeros(shape), np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-9)
        todo = [(0, np.arange(n), -np.inf, np.inf, 0)]
        while todo:
            node, own, low, high, level = todo.pop()
            g, h = gradient[own].sum(), hessian[own].sum()
            value = float(np.clip(-g / (h + penalty), low, high))
            best = (1e-6, None)
            for f in range(m) if level < depth else ():
                k = len(edges[f]) + 1
                gl = np.cumsum(np.bincount(binned[own, f], gradient[own], k))[:-1]
                hl = np.cumsum(np.bincount(binned[own, f], hessian[own], k))[:-1]
                gr, hr = g - gl, h - hl
                vl = np.clip(-gl / (hl + penalty), low, high)
                vr = np.clip(-gr / (hr + penalty), low, high)

                def loss(s, c, v):
                    return s * v + 0.5 * (c + penalty) * v * v

                gain = loss(g, h, value) - loss(gl, hl, vl) - loss(gr, hr, vr)
                bad = (hl < least) | (hr < least) | ((vr - vl) * monotonic[f] < 0)
                gain = np.where(bad, -np.inf, gain)
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (gain[at], (f, at, vl[at], vr[at]))
            if best[1] is None:
                trees.value[t, node] = rate * value
                raw[own] += rate * value
                continue
            f, at, vl, vr = best[1]
            trees.feature[t, node], trees.threshold[t, node] = f, edges[f][at]
            trees.left[t, node], trees.right[t, node] = 2 * node + 1, 2 * node + 2
            middle = (vl + vr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
            side = binned[own, f] <= at
            for child, rows, (lo, hi) in zip((1, 2), (own[side], own[~side]), bounds[int(monotonic[f])]):
                todo.append((2 * node + child, rows, lo, hi, level + 1))
    return trees


def labelled_sample(stats: DataFrame, labels: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and classes of at most `rows` labelled documents."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = stats.join(F.broadcast(known), "doc_id").select("doc_id", *FEATURES, "good")
    pdf = found.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return pdf[list(FEATURES)].to_numpy(np.float64), pdf["good"].to_numpy(np.float64)


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees for the labelled rows of `stats`; None without labels of both classes."""
    x, y = labelled_sample(stats, labels, sample_rows)
    fitted = len(y) and 0 < y.mean() < 1
    return fit_trees(x, y, np.array(list(FEATURES.values()))) if fitted else None


def _verdict(features: np.ndarray, words, repeats, trees: Trees | None, keep_from: float):
    failed = (words < 20) | (100 * repeats > 30 * words)
    quality = trees.score(features) if trees is not None else np.ones(len(words))
    return failed, ~failed & (quality >= keep_from), quality


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of `docs`: the counts, base_failed, kept, and quality (the trees' probability)."""
    stats = materialise(document_statistics(docs), "document-statistics")
    trees = fit(stats, labels, sample_rows)

    def score(batches):
        for batch in batches:
            features = np.stack([batch.column(f).to_numpy().astype(np.float64) for f in FEATURES], axis=1)
            words, repeats = (batch.column(c).to_numpy() for c in ("n_words", "n_repeat_words"))
            columns = [batch.column(c) for c in ("doc_id", *COUNTS)]
            columns += map(pa.array, _verdict(features, words, repeats, trees, keep_from))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "base_failed", "kept", "quality"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, quality double"
    return stats.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of `docs` that pass, unchanged; texts are read once for the fit and once to decide."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id").distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    trees = fit(document_statistics(docs.join(F.broadcast(known), "doc_id", "left_semi")), labels, sample_rows)

    def decide(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                stats = statistics(*text_bytes(part.column("text")))
                # As document_statistics() stores them.
                features = np.stack([stats[f].astype(np.float32).astype(np.float64) for f in FEATURES], axis=1)
                kept = _verdict(features, stats["n_words"], stats["n_repeat_words"], trees, keep_from)[1]
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(decide, docs.schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels)
