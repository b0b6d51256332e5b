"""Exact repeats by a logarithmic family of suffix arrays.

A byte goes if it lies in a window of `LENGTH` bytes that also starts anywhere else. Windows that
are equal share the place of their smallest hash of `GRAM` bytes, their anchor; so windows with one
anchor, a region of text, need comparing only with regions whose anchors have the same hash.
Regions that are equal as a whole repeat each other and are counted before anything is shuffled by
anchor; one of each is left. Where several differ under one anchor, their bytes are fetched and
compared by suffix arrays: regions arrive in batches, each gets an array of its suffixes, sorted to
window depth, which is merge-scanned against the arrays kept so far; arrays of equal size merge, so
that a logarithmic number is kept. Anchors with very many different regions (a passage of which
every copy stands elsewhere) are taken apart into windows, which are counted by hash instead.

Defined results: a null or empty text has no bytes; its kept bytes have the checksum of nothing.
Equal rows repeat each other, as do texts under one `doc_id`; a null `doc_id` is a document like any
other. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import materialise, run_hashes, slices, small, text_bytes

LENGTH = 400
GRAM = 64
BATCH_WINDOWS = 1 << 15
TASK_WINDOWS = 1 << 17  # a task holds each of them as a key of 400 bytes, some three times
HOT_REGIONS = 512
SLICE_BYTES = 1 << 20
CUT_BYTES = 1 << 21
DOC = ["doc_id", "text_hash"]


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of window starts with one anchor: row, anchor, first and last start, and the gram's hash."""
    none = np.zeros(0, np.int64)
    span = length - gram + 1
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    place = np.arange(len(data) - gram + 1)
    hashes = run_hashes(data, place, place + gram)
    packed = hashes & ~np.uint64((1 << 24) - 1) | place.astype(np.uint64)
    full = np.full(-(-len(packed) // span) * span, np.iinfo(np.uint64).max)
    full[: len(packed)] = packed
    ahead = np.minimum.accumulate(full.reshape(-1, span), axis=1).reshape(-1)
    behind = np.minimum.accumulate(full.reshape(-1, span)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - length + 1
    least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
    row = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    start = np.arange(len(row)) + np.repeat(
        offsets[:-1] - np.r_[0, np.cumsum(np.maximum(np.diff(offsets) - length + 1, 0))][:-1],
        np.maximum(np.diff(offsets) - length + 1, 0),
    )
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    anchor = (least[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    last = np.r_[first[1:], len(start)] - 1
    return row[first], anchor[first], start[first], start[last], hashes[anchor[first]]


def regions(docs: DataFrame) -> DataFrame:
    """anchor_hash, region_hash, doc_id, text_hash, first, last: of every row of `docs`."""

    def compute(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                yield from _regions(part)

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(
        compute, "anchor_hash long, region_hash long, doc_id long, text_hash long, first long, last long"
    )


def _regions(part):
    data, offsets = text_bytes(part.column("text"))
    # Longer texts than the packed place can tell go in overlapping cuts; windows are met once.
    step = CUT_BYTES
    for row in range(part.num_rows) if len(data) > step else [None]:
        lo, hi = (0, part.num_rows) if row is None else (row, row + 1)
        begin, end = offsets[lo], offsets[hi]
        for at in range(begin, max(end, begin + 1), step):
            to = min(at + step + LENGTH - 1, end)
            own = offsets[lo : hi + 1] - begin if row is None else np.array([0, to - at])
            cut = data[begin:end] if row is None else data[at:to]
            rows, anchor, first, last, key = window_anchors(cut, own)
            digest = run_hashes(cut, first, last + LENGTH) + (anchor - first).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
            shift = (at - begin) - own[:-1][rows] if len(rows) else rows
            who = rows + lo
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(digest.view(np.int64)),
                    part.column("doc_id").take(pa.array(who)),
                    part.column("text_hash").take(pa.array(who)),
                    pa.array(first + shift),
                    pa.array(last + shift),
                ],
                ["anchor_hash", "region_hash", "doc_id", "text_hash", "first", "last"],
            )
            if row is None:
                break


class SuffixLevel:
    """Suffixes of some text in order, as far as `length` bytes."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, names: np.ndarray, length: int):
        self.text, self.length = text, length
        keys = self._keys(starts)
        order = np.argsort(keys, kind="stable")
        self.starts, self.names, self.keys = starts[order], names[order], keys[order]

    def _keys(self, starts: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(self.text, self.length)[starts]
        return np.ascontiguousarray(windows).view(f"S{self.length}").reshape(-1)

    def merged(self, other: "SuffixLevel") -> "SuffixLevel":
        text = np.concatenate([self.text, other.text])
        starts = np.concatenate([self.starts, other.starts + len(self.text)])
        return SuffixLevel(text, starts, np.concatenate([self.names, other.names]), self.length)


class IndexFamily:
    """Suffix arrays of geometrically growing size; finds windows that occur twice.

    Names are the places in `found` that a window's verdict goes to.
    """

    def __init__(self, length: int, windows: int):
        self.length, self.levels = length, []
        self.found = np.zeros(windows, bool)

    def add(self, text: np.ndarray, starts: np.ndarray, names: np.ndarray) -> None:
        new = SuffixLevel(text, starts, names, self.length)
        twice = new.keys[1:] == new.keys[:-1]
        self.found[new.names] |= np.r_[twice, False] | np.r_[False, twice]
        for level in self.levels:
            low = np.searchsorted(level.keys, new.keys, side="left")
            hit = low < len(level.keys)
            hit[hit] = level.keys[low[hit]] == new.keys[hit]
            self.found[new.names] |= hit
            # One of equal neighbours in an older level is marked by its own level already.
            self.found[level.names[low[hit]]] = True
        while self.levels and len(self.levels[-1].starts) <= len(new.starts):
            new = self.levels.pop().merged(new)
        self.levels.append(new)


def _compare(batches):
    """Repeated windows among the regions of a task; rows of regions with `alone` are answered."""
    columns = {k: [] for k in ("doc_id", "text_hash", "first", "alone", "bytes")}
    for batch in batches:
        for k, have in columns.items():
            have += batch.column(k).to_pylist()
    if not columns["bytes"]:
        return
    sizes = np.array([len(b) - LENGTH + 1 for b in columns["bytes"]])
    base = np.cumsum(sizes) - sizes
    family = IndexFamily(LENGTH, int(sizes.sum()))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(base + sizes, base[at] + BATCH_WINDOWS, side="right")))
        text = np.frombuffer(b"".join(columns["bytes"][at:to]), np.uint8)
        whole = sizes[at:to] + LENGTH - 1
        begin = np.repeat(np.cumsum(whole) - whole, sizes[at:to])
        inside = np.arange(len(begin)) - np.repeat(base[at:to] - base[at], sizes[at:to])
        family.add(text, begin + inside, np.arange(base[at], base[at] + len(begin)))
        at = to
    for k in range(len(sizes)):
        if not columns["alone"][k]:
            continue
        found = np.r_[False, family.found[base[k] : base[k] + sizes[k]], False]
        edges = np.flatnonzero(found[1:] != found[:-1])
        begin, end = edges[0::2], edges[1::2]
        if len(begin):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([columns["doc_id"][k]] * len(begin), pa.int64()),
                    pa.array([columns["text_hash"][k]] * len(begin), pa.int64()),
                    pa.array(columns["first"][k] + begin),
                    pa.array(columns["first"][k] + end - 1 + LENGTH),
                ],
                ["doc_id", "text_hash", "begin", "end"],
            )


def _window_hashes(batches):
    """The windows of regions, by two hashes."""
    for batch in batches:
        for row in batch.to_pylist():
            data = np.frombuffer(row["bytes"], np.uint8)
            start = np.arange(len(data) - LENGTH + 1)
            half = LENGTH // 2
            columns = [run_hashes(data, start, start + half), run_hashes(data, start + half, start + LENGTH)]
            n = len(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64)) for c in columns]
                + [pa.array([row["doc_id"]] * n, pa.int64()), pa.array([row["text_hash"]] * n, pa.int64()), pa.array(row["first"] + start), pa.array([row["alone"]] * n)],
                ["left", "right", "doc_id", "text_hash", "first", "alone"],
            )


def _same_doc(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def repeated_spans(docs: DataFrame, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """doc_id, text_hash, begin, end: bytes of `docs` in repeated windows; spans may overlap."""
    found = materialise(regions(docs), "regions")
    region = ["anchor_hash", "region_hash"]
    one = F.min(F.struct("doc_id", "text_hash", "first", "last")).alias("one")
    kinds = materialise(found.groupBy(*region).agg(F.count("*").alias("n"), one), "region-kinds")
    many = kinds.where("n > 1").select(*region)
    whole = found.join(many, region, "left_semi").select(*DOC, F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end"))

    keys = kinds.groupBy("anchor_hash").agg(F.count("*").alias("different")).where("different > 1")
    left = kinds.join(keys, "anchor_hash").select("anchor_hash", "one.*", (F.col("n") == 1).alias("alone"), (F.col("different") > hot_regions).alias("hot"))
    left = materialise(left, "different-regions")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    needed = small(left.select(*DOC).distinct(), 1_000_000)
    # Equal rows fetch their regions more than once. None of these stands alone, so no verdict changes.
    rows = rows.join(needed, _same_doc(rows, needed), "left_semi")
    bytes_ = F.substring("text", (F.col("first") + 1).cast("int"), (F.col("last") - F.col("first") + LENGTH).cast("int"))
    fetched = left.join(rows, _same_doc(left, rows)).select("anchor_hash", left["doc_id"], left["text_hash"], "first", "alone", "hot", bytes_.alias("bytes"))

    windows = left.where(~F.col("hot")).agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-windows // TASK_WINDOWS))
    spans = "doc_id long, text_hash long, begin long, end long"
    compared = fetched.where(~F.col("hot")).repartition(int(tasks), "anchor_hash").mapInArrow(_compare, spans)

    hashed = fetched.where("hot").mapInArrow(
        _window_hashes, "left long, right long, doc_id long, text_hash long, first long, alone boolean"
    )
    again = hashed.groupBy("left", "right").count().where("count > 1").select("left", "right")
    apart = hashed.where("alone").join(again, ["left", "right"], "left_semi").select(
        *DOC, F.col("first").alias("begin"), (F.col("first") + LENGTH).alias("end")
    )
    return whole.unionByName(compared).unionByName(apart)


def remove_repeats(docs: DataFrame, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    spans = repeated_spans(docs, hot_regions).groupBy(*DOC).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    both = rows.join(spans, _same_doc(rows, spans), "left").select(rows["doc_id"], "text", F.sort_array("spans").alias("spans"))

    def cut(batches):
        for batch in batches:
            kept, removed, runs, sums = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                text, out, at, n, gone = text.as_py(), [], 0, 0, 0
                open_to = -1
                for s in spans or ():
                    begin, end = max(s["begin"], at), s["end"]
                    n += s["begin"] > open_to
                    open_to = max(open_to, end)
                    if end <= at:
                        continue
                    out.append(text[at:begin])
                    gone += end - begin
                    at = end
                out.append(text[at:])
                kept.append(b"".join(out))
                removed.append(gone)
                runs.append(n)
                sums.append(hashlib.sha256(kept[-1]).hexdigest())
            sizes = [k + r for k, r in zip(map(len, kept), removed)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op8_repeats(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents, and what is left of each.

    A cut may fall inside a character; `kept_text` has U+FFFD there, the checksum is of the bytes.
    """
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    left = found.withColumn("n_kept", F.octet_length("kept").cast("long"))
    return left.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")
