"""Best-fit packing of token pieces into sequences, with a bounded number of open sequences.

Every task packs its own partition online: a piece goes to the open sequence with the least space
that still holds it, found in a bitset keyed by free space; when too many are open, the fullest
closes. Sequences still open at a task's end are packed again, whole, among those of a fixed number
of tasks, by the same method. Nothing else is shuffled.

Defined results: a null or empty text is one piece, its end id alone. Equal rows are packed each.
A null `doc_id` stays null. Further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import materialise, slices
from temblor.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_STATE = ", task long, fill long"
OPEN_SEQUENCES = 256
TASKS_AGAIN = 64
REMEMBERED = 150_000  # words per generation, within a task


class BestFit:
    """Bounded-space best fit; `close` is called with each sequence that is full or pushed out."""

    def __init__(self, capacity: int, most_open: int, close):
        self.capacity, self.most_open, self.close = capacity, most_open, close
        self.free: dict[int, list] = defaultdict(list)
        self.bits = self.open = 0

    def _take(self, space: int):
        stack = self.free[space]
        sequence = stack.pop()
        self.open -= 1
        if not stack:
            self.bits ^= 1 << space
        return sequence

    def add(self, size: int, item) -> None:
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            sequence = self._take(space)
        else:
            space, sequence = self.capacity, []
        sequence.append((self.capacity - space, item))
        self._put(space - size, sequence)

    def _put(self, space: int, sequence) -> None:
        if not space:
            self.close(0, sequence)
            return
        self.free[space].append(sequence)
        self.bits |= 1 << space
        self.open += 1
        if self.open > self.most_open:
            fullest = (self.bits & -self.bits).bit_length() - 1
            self.close(fullest, self._take(fullest))

    def rest(self):
        """The sequences still open, with their free space, fullest first."""
        for space in sorted(self.free):
            for sequence in self.free[space]:
                yield space, sequence


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    most_open: int = OPEN_SEQUENCES,
    tasks_again: int = TASKS_AGAIN,
) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): where it starts, how long it is, and its place."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def first(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        coder, end = encoder(tokenizer, REMEMBERED), np.array([end_id], "<u4").tobytes()
        out, number = [], 0

        def close(space, sequence, again=-1):
            nonlocal number
            name = task << 32 | number
            number += 1
            out.extend((*item, name, offset, again, capacity - space) for offset, item in sequence)

        bins = BestFit(capacity, most_open, close)
        for batch in batches:
            for part in slices(batch):
                pieces = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = coder.encode(text.as_py()) + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at : at + 4 * capacity]
                        pieces.append((len(cut) // 4, (doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut))))
                pieces.sort(key=lambda p: -p[0])  # the longest of a slice are placed first
                for size, piece in pieces:
                    bins.add(size, piece)
                yield _batch(out)
                out.clear()
        for space, sequence in bins.rest():
            close(space, sequence, again=task)
        yield _batch(out)
        coder.forget()

    packed = materialise(rows.mapInArrow(first, PIECES + _STATE), "packed")

    def second(pdf):
        group = pdf.sort_values(["sequence_id", "offset"], kind="stable")
        named = {}
        old, fill = group["sequence_id"].to_numpy(), group["fill"].to_numpy()
        base, name = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        edges = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
        spans = list(zip(edges, np.r_[edges[1:], len(old)], fill[edges]))

        def close(_, sequence):
            for offset, (lo, hi) in sequence:
                base[lo:hi], name[lo:hi] = offset, old[sequence[0][1][0]]

        bins = BestFit(capacity, most_open, close)
        for lo, hi, size in sorted(spans, key=lambda s: (-s[2], s[0])):
            bins.add(int(size), (lo, hi))
        for space, sequence in bins.rest():
            close(space, sequence)
        return group.assign(offset=group["offset"] + base, sequence_id=name)[list(group.columns)]

    again = (
        packed.where("task >= 0")
        .groupBy((F.col("task") / tasks_again).cast("long").alias("tasks"))
        .applyInPandas(lambda key, pdf: second(pdf), packed.schema)
    )
    return packed.where("task < 0").unionByName(again).drop("task", "fill")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 7
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "task", "fill"]
    columns = list(zip(*rows)) or [()] * 9
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
