"""Fill-in-middle: documents cut in three at two places and written with the middle last.

A text's places are counted in units (code points, words or lines). The texts of a slice lie in one
buffer of UTF-8 bytes, which fixed blocks of `BLOCK` bytes divide. Two Fenwick trees over the blocks
hold how many units and how many code points start in each. The block of a cut is found by binary
lifting in the tree of units, for all cuts of the slice at once; the cut's byte is then located
within that one block, and the tree of code points says how many stand before it.

Where a document is cut, and which form it takes, follows from hashes of its id alone, so a task
that runs again gives the same rows.

Defined results: a null or empty text is plain and empty. A text that holds one of the markers is
plain, because it could not be told apart. A null `doc_id` is hashed as an empty string and stays
null. Equal rows get equal rows; an empty table gives none. Further columns are ignored. A text of
any length is taken whole: it is a slice of its own, and memory is a few bytes for each of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import slices, space_words, text_bytes

BLOCK = 256
SLICE_BYTES = 2 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPANS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Mix:
    """The share of documents that are left plain, and the share of the others with the suffix first."""

    seed: int = 1
    plain_percent: int = 10
    spm_percent: int = 20


class Fenwick:
    """Counts per block; node k holds the sum of the k & -k blocks that end with block k - 1."""

    def __init__(self, counts: np.ndarray):
        total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        node = np.arange(len(total))
        self.nodes = total - total[node - (node & -node)]
        self.top = 1 << max(len(counts), 1).bit_length() - 1

    def before(self, block: np.ndarray) -> np.ndarray:
        """Sum of the blocks before each of `block`."""
        out, at = np.zeros(len(block), np.int64), block.astype(np.int64)
        while at.any():
            out += self.nodes[at]
            at = at & (at - 1)
        return out

    def find(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that holds item number `rank`, and the item's number within the block."""
        at, left, step = np.zeros(len(rank), np.int64), rank.astype(np.int64), self.top
        while step:
            to = at + step
            there = np.minimum(to, len(self.nodes) - 1)
            go = (to < len(self.nodes)) & (self.nodes[there] <= left)
            left = np.where(go, left - self.nodes[there], left)
            at = np.where(go, to, at)
            step >>= 1
        return at, left


class Places:
    """Unit and code-point counts of a buffer of texts, and the bytes at which its units start."""

    def __init__(self, units: np.ndarray, chars: np.ndarray):
        self.size, blocks = len(units), -(-len(units) // BLOCK)
        self.unit_rows, self.char_rows = (np.zeros((blocks, BLOCK), bool) for _ in range(2))
        self.unit_rows.reshape(-1)[: self.size] = units
        self.char_rows.reshape(-1)[: self.size] = chars
        self.units, self.chars = (Fenwick(rows.sum(1)) for rows in (self.unit_rows, self.char_rows))

    def byte_of(self, unit: np.ndarray) -> np.ndarray:
        """Where each unit starts; past the last one it is the end of the buffer."""
        block, rank = self.units.find(unit)
        out = np.full(len(unit), self.size)
        inside = np.flatnonzero(block < len(self.unit_rows))
        seen = np.cumsum(self.unit_rows[block[inside]], axis=1, dtype=np.int16)
        out[inside] = block[inside] * BLOCK + (seen > rank[inside, None]).argmax(1)
        return out

    def units_before(self, byte: np.ndarray) -> np.ndarray:
        return self._before(self.units, self.unit_rows, byte)

    def chars_before(self, byte: np.ndarray) -> np.ndarray:
        return self._before(self.chars, self.char_rows, byte)

    def _before(self, tree: Fenwick, rows: np.ndarray, byte: np.ndarray) -> np.ndarray:
        block, rest = np.divmod(byte, BLOCK)
        out = tree.before(block)
        inside = np.flatnonzero(rest)
        near = rows[block[inside]] & (np.arange(BLOCK) < rest[inside, None])
        out[inside] += near.sum(1)
        return out


def unit_starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Mask of the bytes at which a unit starts; the first unit of a text starts with it.

    A word takes the white space after it, a line its newline.
    """
    if unit == "char":
        return (data & 0xC0) != 0x80
    starts = np.zeros(len(data), bool)
    first = offsets[:-1][offsets[1:] > offsets[:-1]]
    if unit == "line":
        starts[1:] = data[:-1] == 10
    elif unit == "word":
        begin, _, rows = space_words(data, offsets)
        later = np.ones(len(rows), bool)
        later[np.searchsorted(rows, np.unique(rows))] = False
        starts[begin[later]] = True
    else:
        raise ValueError(f"unit must be char, word or line, not {unit!r}")
    starts[first] = True
    return starts


def _cut_batch(batch, unit: str):
    """Pieces of the texts of one slice, put together in the order of their form."""
    data, offsets = text_bytes(batch.column("text"))
    places = Places(unit_starts(data, offsets, unit), (data & 0xC0) != 0x80)
    first = places.units_before(offsets)
    n, first = np.diff(first), first[:-1]
    h1, h2 = (batch.column(h).to_numpy() % (n + 1) for h in ("h1", "h2"))
    low, high = np.minimum(h1, h2), np.maximum(h1, h2)
    # A cut after a text's last unit lies at its end, where the next text may be empty.
    cut, end = (np.where(k < n, places.byte_of(first + k), offsets[1:]) for k in (low, high))
    head, a, b = (places.chars_before(x) for x in (offsets[:-1], cut, end))
    form = np.array(batch.column("form").to_pylist(), object)
    form[np.diff(offsets) == 0] = "plain"
    raw, out = data.tobytes(), []
    for kind, start, p, q, stop in zip(form, offsets[:-1].tolist(), cut.tolist(), end.tolist(), offsets[1:].tolist()):
        if kind == "plain":
            out.append(raw[start:stop])
        elif kind == "psm":
            out.append(b"<P>" + raw[start:p] + b"<S>" + raw[q:stop] + b"<M>" + raw[p:q])
        else:
            out.append(b"<S>" + raw[q:stop] + b"<P>" + raw[start:p] + b"<M>" + raw[p:q])
    plain = form == "plain"
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(n),
            pa.array(form, pa.string()),
            pa.array(a - head, mask=plain),
            pa.array(b - a, mask=plain),
            pa.array(out, pa.binary()).view(pa.string()),
        ],
        names=[part.split()[0] for part in SPANS.split(", ")],
    )


def fill_in_middle(docs: DataFrame, unit: str = "char", mix: Mix = Mix()) -> DataFrame:
    """Every row of `docs` (doc_id, text) as its output text, with its form and the cuts.

    `n` counts the units of the text; `prefix_chars` and `middle_chars` are code points, null for
    plain texts. Forms: plain, psm (prefix, suffix, middle) and spm (suffix, prefix, middle).
    """
    text = F.coalesce("text", F.lit(""))
    key = F.sha2(F.concat(F.lit(f"{mix.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), key.alias("key"))
    h1, h2, h3, h4 = (F.conv(F.substring("key", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (
        F.when(marked | (h3 % 100 >= 100 - mix.plain_percent), "plain")
        .when(h4 % 100 < mix.spm_percent, "spm")
        .otherwise("psm")
    )

    def cut(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                yield _cut_batch(part, unit)

    return rows.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"), form.alias("form")).mapInArrow(cut, SPANS)


def restored(output: Column, form: Column) -> Column:
    """The text that `fill_in_middle` made an output from; markers only stand where it put them."""
    parts = F.split(output, "<[PSM]>", -1)
    second, third, last = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(second, last, third)).when(form == "spm", F.concat(third, last, second)).otherwise(output)


def op11_middle(spark, sf_dir: str) -> DataFrame:
    """Cuts and checksums of every document, by code points."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    again = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(again, 256).alias("restored_sha256"),
    )


OP11_SQL = """
with d as (
  select doc_id, coalesce(text, '') as t, cast(length(coalesce(text, '')) as bigint) as n,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as key
  from documents
),
h as (
  select *, cast('0x' || substr(key, 1, 8) as bigint) % (n + 1) as c1, cast('0x' || substr(key, 9, 8) as bigint) % (n + 1) as c2,
    cast('0x' || substr(key, 17, 8) as bigint) % 100 as r3, cast('0x' || substr(key, 25, 8) as bigint) % 100 as r4
  from d
),
f as (
  select *, least(c1, c2) as a, greatest(c1, c2) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r3 >= 90 then 'plain'
      when r4 < 20 then 'spm' else 'psm' end as form
  from h
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end) as output_sha256,
  sha256(t) as restored_sha256
from f
"""
