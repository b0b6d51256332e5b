"""SimHash near-duplicate groups, found over the anchors of covering codes.

A fingerprint's 64 bits are cut into blocks, and each block gets a threshold so that two
fingerprints at `distance` or fewer differing bits agree, within its threshold, in one block at
least (the thresholds plus one each add up to more than `distance`). The anchors of a block are the
words of a covering code of that length: the perfect binary Golay code with covering radius 3,
or the Hamming code with radius 1, lengthened by free bits; or all words (radius 0). Every fingerprint has a home, the anchor within
the radius; it is replicated to every anchor within radius plus threshold. Two fingerprints that
agree within the threshold then meet at the home of either, where full distances are compared.

Only distinct fingerprints are compared. Wider fingerprints take several words of 64 bits. Anchors with many rows are cut into tiles (homes x
replicas), so that no task holds more of one than a tile; the number of anchors, and with it of
tables about them, is fixed by the code. A task emits, for what it finds linked, a spanning forest
and never all pairs; the forests are joined up by alternating star contraction.

Defined results: a null or empty text, or one of white space, has no words and fingerprint zero,
which links like any other. Rows with a null `doc_id` take part; the smallest of a group's ids is
that of the others, or null. Equal rows are rows of one group. Further columns are ignored, and
`keep_one_of_each` returns them whatever their names. Very long texts are read whole, in one row; a
shingle list takes eight bytes a word. Empty tables give empty results.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import lower_bytes, materialise, mix, slices, text_bytes

# Length, generator polynomial and covering radius of perfect cyclic codes.
CODES = ((23, 0b110001110101, 3), (15, 0b10011, 1))  # Golay, Hamming
# Per block: word of the fingerprint, first bit, number of bits, threshold.
BLOCKS = ((0, 0, 26, 1), (0, 26, 26, 1), (0, 52, 12, 0))
TILE_ROWS = 4096
SLICE_BYTES = 2 << 20


def fingerprint_bits(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row: the bits that are set in over half of its hashes; `rows` ascends."""
    out = np.zeros(n_rows, np.uint64)
    if not len(hashes):
        return out
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    ends = np.r_[starts[1:], len(rows)]
    for at in range(0, len(starts), 512):
        lo, hi = starts[at], ends[min(at + 512, len(starts)) - 1]
        for s in range(at, min(at + 512, len(starts))) if hi - lo > 1 << 20 else [None]:
            cut = starts[at : at + 512] if s is None else starts[s : s + 1]
            a, b = (lo, hi) if s is None else (starts[s], ends[s])
            bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, cut - a, axis=0, dtype=np.int64)
            each = np.diff(np.r_[cut, b])
            packed = np.packbits(2 * ones > each[:, None], axis=1, bitorder="little")
            out[rows[cut]] = packed.view(np.uint64).reshape(-1)
    return out


def _words(n: int) -> list[str]:
    return [f"bits_{k}" for k in range(n)]


def _shingles(text: bytes, words: int) -> np.ndarray:
    """A hash for each shingle of a lower-cased text; one of the whole if it has no more words."""
    from xxhash import xxh64_intdigest

    found = text.split()
    if not found:
        return np.zeros(0, np.uint64)
    whole = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(whole, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    first = [0, *(ends[: len(found) - words] + 1).tolist()]
    return np.array([xxh64_intdigest(whole[a:b], 42) for a, b in zip(first, ends[words - 1 :].tolist())], np.uint64)


def fingerprints(docs: DataFrame, words: int = 4, width: int = 1) -> DataFrame:
    """`docs` with its fingerprint for (doc_id, text), as signed longs bits_0, bits_1 and so on.

    The first is made of the shingles' hashes, further ones of these hashes mixed again.
    """

    def compute(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                data, offsets = text_bytes(part.column("text"))
                raw = lower_bytes(data).tobytes()
                hashes, counts = [], np.zeros(part.num_rows, np.int64)
                for k in range(part.num_rows):
                    got = _shingles(raw[offsets[k] : offsets[k + 1]], words)
                    counts[k] = len(got)
                    hashes.append(got)
                rows = np.repeat(np.arange(part.num_rows), counts)
                all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
                columns = [part.column("doc_id"), part.column("text_hash")]
                for k in range(width):
                    again = mix(all_hashes + np.uint64(k)) if k else all_hashes
                    columns.append(pa.array(fingerprint_bits(again, rows, part.num_rows).view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", *_words(width)])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(compute, "doc_id long, text_hash long, " + ", ".join(f"{w} long" for w in _words(width)))


@lru_cache
def _code(length: int, generator: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high bits; per remainder, where its errors start; the errors.

    An error is a word of at most `radius` bits; in a perfect code, one within the covering radius
    exists for each remainder.
    """
    degree = generator.bit_length() - 1

    def remainder(x: int) -> int:
        for bit in range(length - 1, degree - 1, -1):
            if x >> bit & 1:
                x ^= generator << (bit - degree)
        return x

    low = np.array([remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << (length - 12))], np.int64)
    errors = [np.zeros(1, np.int64)]
    for _ in range(radius):
        more = (errors[-1][:, None] ^ (1 << np.arange(length))).reshape(-1)
        errors.append(np.unique(more[np.bitwise_count(more) == np.bitwise_count(errors[-1][0]) + 1]))
    every = np.concatenate(errors)
    of = low[every & 0xFFF] ^ high[every >> 12]
    order = np.lexsort((np.bitwise_count(every), of))
    starts = np.searchsorted(of[order], np.arange((1 << degree) + 1))
    return low, high, starts, every[order]


def anchors(values: np.ndarray, bits: int, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (index of value, anchor) within radius plus threshold, and whether it is the home."""
    n = len(values)
    code = next((c for c in CODES if c[0] <= bits), None)
    if code is None:
        flips = np.array([f for f in range(1 << bits) if f.bit_count() <= threshold], np.int64)
        who, flip = np.repeat(np.arange(n), len(flips)), np.tile(flips, n)
        return who, values[who] ^ flip, flip == 0
    length, generator, radius = code
    out = []
    for free in range(1 << (bits - length)):
        if free.bit_count() > threshold:
            continue
        low, high, starts, errors = _code(length, generator, radius + threshold - free.bit_count())
        word = values & ((1 << length) - 1)
        of = low[word & 0xFFF] ^ high[word >> 12]
        count = starts[of + 1] - starts[of]
        who = np.repeat(np.arange(n), count)
        place = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        error = errors[starts[of[who]] + place]
        home = (np.bitwise_count(error) <= radius) & (free == 0)
        out.append((who, values[who] ^ error ^ (free << length), home))
    return tuple(np.concatenate(x) for x in zip(*out))


def replicas(prints: DataFrame, blocks=BLOCKS) -> DataFrame:
    """anchor, node, bits, home: one row per anchor that a fingerprint goes to."""
    names = prints.columns[1:]

    def spread(batches):
        for batch in batches:
            node = batch.column(0).to_numpy(zero_copy_only=False)
            values = [batch.column(w).to_numpy(zero_copy_only=False).view(np.uint64) for w in names]
            for number, (word, shift, bits, threshold) in enumerate(blocks):
                cut = ((values[word] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                for at in range(0, len(cut), 4096):
                    who, anchor, home = anchors(cut[at : at + 4096], bits, threshold)
                    who = who + at
                    columns = [pa.array(number << 32 | anchor), pa.array(node[who])]
                    columns += [pa.array(v[who].view(np.int64)) for v in values] + [pa.array(home)]
                    yield pa.RecordBatch.from_arrays(columns, ["anchor", "node", *names, "home"])

    longs = ", ".join(f"{w} long" for w in names)
    return prints.mapInArrow(spread, f"anchor long, node long, {longs}, home boolean")


class _Forest:
    """Disjoint sets over 0..n-1, kept as arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        root = self.parent[of]
        while True:
            above = self.parent[root]
            if (above == root).all():
                self.parent[of] = root
                return root
            root = above

    def join(self, members: np.ndarray) -> None:
        roots = self.roots(members)
        self.parent[roots] = roots.min()


def _tiles(rows: DataFrame, names: list[str], tile_rows: int) -> DataFrame:
    """anchor, x, y, node, `names`, home: the rows of `replicas`, as homes and as others of each tile."""
    counts = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    hot = counts.where(F.col("n") > tile_rows).select(
        "anchor",
        F.greatest(F.ceil(F.col("homes") / tile_rows), F.lit(1)).cast("int").alias("across"),
        F.ceil(F.col("n") / tile_rows).cast("int").alias("down"),
    )
    # As many rows as the blocks' codes have words, at most.
    cut = rows.join(F.broadcast(hot), "anchor", "left").fillna(1, ["across", "down"])
    x = F.pmod(F.xxhash64("node"), F.col("across")).cast("int").alias("x")
    y = F.pmod(F.xxhash64("node", F.lit(1)), F.col("down")).cast("int").alias("y")
    every_x = F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("x")
    every_y = F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("y")
    as_home = cut.where("home").select("anchor", x, every_y, "node", *names, F.lit(True).alias("home"))
    as_other = cut.select("anchor", every_x, y, "node", *names, F.lit(False).alias("home"))
    return as_home.unionByName(as_other)


def links(prints: DataFrame, distance: int, blocks=BLOCKS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """A forest over the nodes of `prints` (node, bits_0, ...): rows (upper, lower) of linked ones."""
    names = prints.columns[1:]
    tiles = _tiles(materialise(replicas(prints, blocks), "anchors"), names, tile_rows)

    def compare(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables)
        key, x, y, node, home = (table.column(k).to_numpy() for k in ("anchor", "x", "y", "node", "home"))
        values = [table.column(w).to_numpy().view(np.uint64) for w in names]
        nodes, index = np.unique(node, return_inverse=True)
        order = np.lexsort((~home, y, x, key))
        key, x, y, home, index, *values = (v[order] for v in (key, x, y, home, index, *values))
        edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        forest = _Forest(len(nodes))
        for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(key)]):
            mid = lo + int(home[lo:hi].sum())
            if mid == lo or mid == hi:
                continue
            others = index[mid:hi]
            for at in range(lo, mid, step := max(1, (1 << 20) // (hi - mid))):
                to = min(at + step, mid)
                apart = sum(np.bitwise_count(v[at:to, None] ^ v[None, mid:hi]).astype(np.uint16) for v in values)
                near = (apart <= distance) & (index[at:to, None] != others[None, :])
                for k in np.flatnonzero(near.any(axis=1)).tolist():
                    forest.join(np.r_[index[at + k], others[near[k]]])
        roots = forest.roots(np.arange(len(nodes)))
        out = np.flatnonzero(roots != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[roots[out]])], ["upper", "lower"])

    return tiles.repartition("anchor", "x", "y").mapInArrow(compare, "upper long, lower long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node reachable, for every node with an edge (a, b).

    Alternating large-star and small-star contraction; each round is written to the shared folder.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = materialise(edges, "star"), None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialise(small.where("u <> v").distinct(), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"not joined up after {most_rounds} rounds")


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, blocks=BLOCKS, width: int = 1
) -> DataFrame:
    """Per row of `docs`: doc_id, text_hash, bits_0 and so on, component, component_id (smallest doc_id).

    The blocks' thresholds must add up so that no pair within `distance` misses all of them.
    """
    names = _words(width)
    node = F.col("bits_0") if width == 1 else F.xxhash64(*names)
    prints = materialise(fingerprints(docs, words, width).withColumn("node", node), "fingerprints")
    least = prints.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.min(w).alias(w) for w in names))
    roots = components(links(least.select("node", *names), distance, blocks))
    rooted = least.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("node", "root").join(smallest, "root").select("node", F.col("root").alias("component"), "component_id")
    return prints.join(named, "node").select("doc_id", "text_hash", *names, "component", "component_id")


def keep_one_of_each(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """`docs` with one row of each group of `near_duplicates`: that with the smallest doc_id, null last.

    Rows without a word are one group, too. Of equal rows one stays.
    """
    found = near_duplicates(docs, words, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    chosen = found.groupBy("component").agg(first).select("first.doc_id", "first.text_hash")
    names, own = docs.columns, "text_hash"
    while own in names:
        own += "_"
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].cast("long").eqNullSafe(chosen["doc_id"]) & (keyed[own] == chosen["text_hash"])
    return keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", own]).select(*names)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("bits_0"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
