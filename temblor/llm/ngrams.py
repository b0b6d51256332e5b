"""Language-model scores from an n-gram trie with Elias-Fano coded levels.

The model is a bigram model with absolute discounting that backs off to unigrams; words not met in
training are one class. Every token of the corpus is a record (context, successor); a text's end is
a boundary symbol that is also the context of its first word. Records are dealt out by context, in
blocks of numpy arrays, so that whoever holds a context's trie also gets all questions to it:

1. every task cuts texts into records and sorts them into buckets;
2. a bucket's task counts the training records, builds the trie of its contexts (sorted contexts,
   monotone pointers, successors relative to their context, quantised probabilities), writes it to
   a file that it maps into memory, and answers all records, training and held out;
3. what has to back off is asked of the successor's bucket, where its unigram count lies;
4. sums per document come together by slice.

Contexts with a large share of all tokens are dealt out by context and successor; how many there
can be is bounded by that share. Rows reach a task sorted by bucket (by slice in 4) and it holds one
of them at a time, about BUCKET_TEXT_BYTES / BUCKETS_PER_TASK of text, however many fall to it.

Contexts and the base score use 64-bit word hashes; successors within a context are told apart by
40 bits. Defined results: a null or empty text is its end alone. Rows are scored each, equal rows
too. A null `doc_id` counts as one that is not held out. Without training rows, all counts are 0
and `score` is that of unknown words. Further columns are ignored.
"""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import lower_bytes, materialise, mix, run_hashes, slices, space_words, text_bytes

BOUNDARY = np.uint64(0x5BD1E995B0D4A1C3)
CODE_BITS = 40
CODE = np.uint64((1 << CODE_BITS) - 1)
DISCOUNT = 0.75
SLICE_BYTES = 4 << 20
BUCKET_TEXT_BYTES = 12 << 20
BUCKETS_PER_TASK = 4
HOT_SHARE = 1000  # a word with 1/500 of all tokens is certainly dealt out by successor
DOCS = 1 << 15  # rows of a slice; the bit above marks held-out rows
RECORDS, HOT_COUNTS, ROWS, SUMS, UNIGRAMS, ASKED, TOTALS = range(7)
FLOW = "kind int, bucket long, slice long, body binary"


class EliasFano:
    """A monotone sequence of integers: low bits packed, high bits in unary, selected by counts."""

    def __init__(self, values: np.ndarray | None = None, parts: dict | None = None):
        if parts is not None:
            self.n, self.low_bits = (int(x) for x in parts["shape"])
            self.low, self.high, self.ones = parts["low"], parts["high"], parts["ones"]
            return
        values = np.asarray(values, np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.low_bits = min(max(0, (top // max(self.n, 1)).bit_length() - 1), 56)  # with a shift of 7 at most, in 64
        shifts, step, low = np.arange(self.low_bits, dtype=np.uint64), 1 << 15, []
        for at in range(0, self.n, step):  # whole bytes each
            bits = (values[at : at + step, None] >> shifts).astype(np.uint8) & 1
            low.append(np.packbits(bits.reshape(-1), bitorder="little"))
        self.low = np.concatenate([*low, np.zeros(8, np.uint8)])
        places = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(self.n)
        high = np.zeros((int(places[-1]) // 64 + 1) * 8 if self.n else 8, np.uint8)
        np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
        self.high = high
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high.view(np.uint64)), dtype=np.int64)])

    def parts(self) -> dict:
        return {"shape": np.array([self.n, self.low_bits]), "low": self.low, "high": self.high, "ones": self.ones}

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at any places, each found by select."""
        at = np.asarray(at, np.int64)
        word = np.searchsorted(self.ones, at, side="right") - 1
        rest = at - self.ones[word]
        chunk = self.high.view(np.uint64)[word].copy()
        place = np.zeros(len(at), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            inside = np.bitwise_count(chunk & np.uint64((1 << width) - 1)).astype(np.int64)
            up = rest >= inside
            rest = np.where(up, rest - inside, rest)
            place = np.where(up, place + width, place)
            chunk = np.where(up, chunk >> np.uint64(width), chunk)
        upper = (word * 64 + place - at).astype(np.uint64)
        bit = at * self.low_bits
        window = np.ndarray(len(self.low) - 7, "<u8", self.low, strides=(1,))  # eight bytes from any place on
        low = window[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        return upper << np.uint64(self.low_bits) | low

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        out = np.empty(self.n, np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.asarray(self.high), bitorder="little"))[: self.n]
        step = 1 << 15
        for at in range(0, self.n, step):
            k = np.arange(at, min(at + step, self.n))
            upper = (ones[at : at + step] - k).astype(np.uint64)
            bits = np.unpackbits(self.low[at * self.low_bits // 8 : -(-(k[-1] + 1) * self.low_bits // 8)], bitorder="little")
            skip = at * self.low_bits % 8
            bits = bits[skip : skip + len(k) * self.low_bits].reshape(len(k), self.low_bits).astype(np.uint64)
            low = (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            out[at : at + step] = upper << np.uint64(self.low_bits) | low
        return out


class Trie:
    """Contexts, pointers, successors and 8-bit probabilities of one bucket."""

    def __init__(self, parts: dict):
        self.contexts, self.levels = parts["contexts"], parts["levels"]
        self.quantised = parts["quantised"]
        self.pointers = EliasFano(parts={k[8:]: v for k, v in parts.items() if k.startswith("pointer_")})
        self.successors = EliasFano(parts={k[10:]: v for k, v in parts.items() if k.startswith("successor_")})

    @staticmethod
    def build(contexts: np.ndarray, starts: np.ndarray, codes: np.ndarray, values: np.ndarray, uses: np.ndarray) -> dict:
        """Parts from sorted contexts, where their successors start, sorted codes, values and uses."""
        owner = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(np.r_[starts, len(codes)]))
        pointers = EliasFano(np.r_[starts, len(codes)]).parts()
        successors = EliasFano(owner << np.uint64(CODE_BITS) | codes).parts()
        levels, quantised = quantise(values, uses)
        out = {"contexts": contexts, "levels": levels, "quantised": quantised}
        out |= {f"pointer_{k}": v for k, v in pointers.items()}
        return out | {f"successor_{k}": v for k, v in successors.items()}

    def context(self, contexts: np.ndarray) -> np.ndarray:
        """Place of each context, or -1."""
        return _find(self.contexts, contexts)

    def find(self, contexts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Value of each pair, or nan: by halving the context's own range of successors."""
        at = self.context(contexts)
        known = np.flatnonzero(at >= 0)
        low, end = self.successors_of(at[known])
        high, want = end.copy(), at[known].astype(np.uint64) << np.uint64(CODE_BITS) | codes[known]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            below = self.successors.get(middle) < want[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
            open_ = open_[low[open_] < high[open_]]
        hit = low < end
        hit[hit] = self.successors.get(low[hit]) == want[hit]
        out = np.full(len(contexts), np.nan)
        out[known[hit]] = self.levels[self.quantised[low[hit]]]
        return out

    def successors_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the successors of contexts at these places start and end, by the pointers."""
        return self.pointers.get(places).astype(np.int64), self.pointers.get(places + 1).astype(np.int64)


def _find(sorted_values: np.ndarray, want: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.full(len(want), -1)
    at = np.minimum(np.searchsorted(sorted_values, want), len(sorted_values) - 1)
    return np.where(sorted_values[at] == want, at, -1)


def quantise(values: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most 256 levels and the level of each value: the means of bins that are used alike."""
    distinct, inverse = np.unique(values, return_inverse=True)
    if len(distinct) <= 256:
        return distinct, inverse.astype(np.uint8)
    n = np.bincount(inverse, uses)
    bin_of = np.minimum((np.cumsum(n) - n / 2) * 256 / n.sum(), 255).astype(np.int64)
    weight = np.bincount(bin_of, n, 256)
    levels = np.bincount(bin_of, n * distinct, 256) / np.maximum(weight, 1)
    return levels, bin_of[inverse].astype(np.uint8)


def mapped(parts: dict) -> dict:
    """The arrays, written to a file of this task and mapped from it; the file has no name left."""
    out = {}
    with tempfile.TemporaryFile() as file:
        places = {}
        for name, array in parts.items():
            file.write(b"\0" * (-file.tell() % 8))
            places[name] = file.tell()
            file.write(np.ascontiguousarray(array).tobytes())
        file.flush()
        size = file.tell()
        whole = np.memmap(file, np.uint8, "r", shape=(size,)) if size else np.zeros(0, np.uint8)
        for name, array in parts.items():
            cut = whole[places[name] : places[name] + array.nbytes]
            out[name] = cut.view(array.dtype)
    return out


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.uint32)
    return sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(body: bytes, *kinds) -> list[np.ndarray]:
    at, out = 4 * len(kinds), []
    for size, kind in zip(np.frombuffer(body, np.uint32, len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(body[at : at + size], kind))
        at += size
    return out


def _flow(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "bucket", "slice", "body"])


def _by_key(batches, key: str):
    """(key, its rows of kind, slice and body) of rows that come sorted by the key, one key at a time."""
    at, rows = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in (key, "kind", "slice", "body"))
        for now, *row in zip(*columns):
            if now != at and rows:
                yield at, rows
                rows = []
            at = now
            rows.append(row)
    if rows:
        yield at, rows


def _tokens(part) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, successors, row of each, and the number of tokens of each row of a slice."""
    data, offsets = text_bytes(part.column("text"))
    data = lower_bytes(data)
    starts, ends, rows = space_words(data, offsets)
    words = run_hashes(data, starts, ends)
    words[words == BOUNDARY] += np.uint64(1)
    n = np.bincount(rows, minlength=part.num_rows)
    end = np.cumsum(n)
    return (
        np.insert(words, end - n, BOUNDARY),
        np.insert(words, end, BOUNDARY),
        np.repeat(np.arange(part.num_rows), n + 1),
        n + 1,
    )


def _cut(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            yield from slices(batch.slice(at, DOCS), SLICE_BYTES)


def hot_words(docs: DataFrame, share: int = HOT_SHARE) -> np.ndarray:
    """Hashes of the words that make up a large share of all tokens: at most 2 x `share`."""

    def count(batches):
        total, found = 0, {}
        for part in _cut(batches):
            contexts, _, _, _ = _tokens(part)
            words, n = np.unique(contexts, return_counts=True)
            total += len(contexts)
            for k in np.flatnonzero(n * share >= len(contexts)).tolist():
                found[int(words[k])] = found.get(int(words[k]), 0) + int(n[k])
        words = np.array([*found], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([True, *[False] * len(words)]), pa.array([0, *words.tolist()], pa.int64()), pa.array([total, *found.values()], pa.int64())],
            ["every", "word", "n"],
        )

    rows = docs.mapInArrow(count, "every boolean, word long, n long").groupBy("every", "word").agg(F.sum("n").alias("n"))
    rows = materialise(rows, "frequent-words")
    total = rows.where("every").agg(F.sum("n")).first()[0] or 0
    hot = rows.where(~F.col("every") & (F.col("n") * 2 * share >= total)).select("word").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))


def _sums(slice_of: np.ndarray, doc: np.ndarray, base, score, known) -> list[tuple]:
    """SUMS rows: totals per document, a body per slice."""
    key, inverse = np.unique(slice_of * DOCS + doc, return_inverse=True)
    totals = [np.bincount(inverse, w, len(key)) for w in (base, score, known)]
    own = key // DOCS
    edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(key) else []
    out = []
    for lo, hi in zip(edge, [*edge[1:], len(key)]):
        body = _pack((key[lo:hi] % DOCS).astype("<u2"), totals[0][lo:hi], totals[1][lo:hi].astype("<f4"), totals[2][lo:hi].astype("<u4"))
        out.append((own[lo], body))
    return out


def score_corpus(docs: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    hot = hot_words(rows)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_TEXT_BYTES))
    buckets = np.uint64(BUCKETS_PER_TASK * tasks)

    def bucket(codes):
        return (mix(codes) % buckets).astype(np.int64)

    def deal(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for part in _cut(batches):
            contexts, successors, row, n_tokens = _tokens(part)
            doc_ids = part.column("doc_id").to_pylist()
            held = np.array([d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d in doc_ids])
            marked = (row | held[row] * DOCS).astype("<u2")
            spread = _find(hot, contexts) >= 0
            codes = successors & CODE
            to = bucket(contexts & CODE)
            to[spread] = bucket(contexts[spread] + codes[spread] * np.uint64(0x9E3779B97F4A7C15))
            order = np.lexsort((contexts, to))
            contexts, codes, marked, to, spread = (x[order] for x in (contexts, codes, marked, to, spread))
            out = []
            edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(to)]):
                own = contexts[lo:hi]
                runs = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                lengths = np.diff(np.r_[runs, hi - lo]).astype("<u4")
                code = codes[lo:hi]
                body = _pack(own[runs], lengths, (code & np.uint64(0xFFFFFFFF)).astype("<u4"), (code >> np.uint64(32)).astype("u1"), marked[lo:hi])
                out.append((RECORDS, to[lo], number, body))
            if spread.any():
                pair, n = np.unique(np.stack([contexts[spread], marked[spread].astype(np.uint64)]), axis=1, return_counts=True)
                home = bucket(pair[0] & CODE)
                for b in np.unique(home):
                    own = home == b
                    out.append((HOT_COUNTS, b, number, _pack(pair[0][own], pair[1][own].astype("<u2"), n[own].astype("<u4"))))
            body = _pack(np.array([d or 0 for d in doc_ids], np.int64), np.array([d is None for d in doc_ids]), held, n_tokens)
            out.append((ROWS, number % int(buckets), number, body))
            yield _flow(out)
            number += 1

    def answer(batches):
        for _, rows in _by_key(batches, "bucket"):
            records, counts = [], []
            for kind, slice_, body in rows:
                if kind == ROWS:
                    yield _flow([(ROWS, 0, slice_, body)])
                elif kind == HOT_COUNTS:
                    counts.append((slice_, *_unpack(body, "<u8", "<u2", "<u4")))
                else:
                    own, lengths, low, high, marked = _unpack(body, "<u8", "<u4", "<u4", "u1", "<u2")
                    code = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
                    records.append((slice_, np.repeat(own, lengths), code, marked))
            rows.clear()
            if records:
                yield from _answer_records(records)
            if counts:
                yield from _answer_counts(counts)

    def _answer_counts(counts):
        slice_of = np.repeat([c[0] for c in counts], [len(c[1]) for c in counts])
        context, marked, n = (np.concatenate([c[k] for c in counts]) for k in (1, 2, 3))
        n = n.astype(np.int64)
        names, inverse = np.unique(context, return_inverse=True)
        c = np.bincount(inverse, n * (marked < DOCS), len(names))
        yield _flow(_unigrams(names, c))
        c = c[inverse]
        sums = _sums(slice_of, marked % DOCS, n * np.log10(c + 0.5), -n * np.log10(np.maximum(c, 1)), n * (c > 0))
        yield _flow([(SUMS, 0, s, body) for s, body in sums])

    def _unigrams(contexts, c):
        seen = c > 0
        code, to = contexts[seen] & CODE, bucket(contexts[seen] & CODE)
        n = c[seen].astype(np.int64)
        out = [(UNIGRAMS, b, 0, _pack(code[to == b], n[to == b])) for b in np.unique(to)]
        return [*out, (TOTALS, 0, 0, _pack(np.array([n.sum(), seen.sum()], np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)))]

    def _answer_records(records):
        slice_of = np.repeat([r[0] for r in records], [len(r[1]) for r in records])
        context, code, marked = (np.concatenate([r[k] for r in records]) for k in (1, 2, 3))
        records.clear()
        order = np.lexsort((code, context))
        slice_of, context, code, marked = (x[order] for x in (slice_of, context, code, marked))
        training = marked < DOCS
        new_context = np.r_[True, context[1:] != context[:-1]]
        new_pair = new_context | np.r_[True, code[1:] != code[:-1]]
        names = context[new_context]
        of_context, of_pair = np.cumsum(new_context) - 1, np.cumsum(new_pair) - 1
        c = np.bincount(of_context, training, len(names))
        c2 = np.bincount(of_pair, training, of_pair[-1] + 1)
        is_hot = _find(hot, names) >= 0

        # The trie of the training pairs.
        first = np.flatnonzero(new_pair)[c2 > 0]
        owner, n2 = of_context[first], c2[c2 > 0]
        values = np.log10(n2 - discount) - np.where(is_hot[owner], 0, np.log10(np.maximum(c[owner], 1)))
        edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        trie = Trie(mapped(Trie.build(context[first][edge], edge, code[first], values, n2)))

        pairs = np.flatnonzero(new_pair)
        score = trie.find(context[pairs], code[pairs])[of_pair]
        unseen = np.isnan(score)
        at = trie.context(names)
        kinds = np.zeros(len(names), np.int64)
        start, end = trie.successors_of(at[at >= 0])
        kinds[at >= 0] = end - start
        with np.errstate(divide="ignore"):
            back = np.where((c > 0) & ~is_hot, np.log10(discount * np.maximum(kinds, 1)) - np.log10(np.maximum(c, 1)), 0)
        score[unseen] = back[of_context[unseen]]
        plain = ~is_hot[of_context]
        base = np.where(plain, np.log10(c[of_context] + 0.5), 0)
        known = plain & (c[of_context] > 0)
        yield _flow([(SUMS, 0, s, body) for s, body in _sums(slice_of, marked % DOCS, base, score, known)])
        yield _flow(_unigrams(names[~is_hot], c[~is_hot]))
        if is_hot.any():
            own = np.flatnonzero(is_hot)
            body = _pack(np.zeros(2, np.int64), names[own], kinds[own].astype(np.int64))
            yield _flow([(TOTALS, 0, 0, body)])

        hot_at = _find(hot, context[unseen]) + 1
        asked, doc, slice_of, to = code[unseen], (marked[unseen] % DOCS).astype("<u2"), slice_of[unseen], bucket(code[unseen])
        order = np.lexsort((slice_of, to))
        asked, doc, slice_of, to, hot_at = (x[order] for x in (asked, doc, slice_of, to, hot_at))
        edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
        out = []
        for lo, hi in zip(edge, [*edge[1:], len(to)]):
            cut, own = asked[lo:hi], slice_of[lo:hi]
            runs = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            low, high = (cut & np.uint64(0xFFFFFFFF)).astype("<u4"), (cut >> np.uint64(32)).astype("u1")
            body = _pack(low, high, doc[lo:hi], hot_at[lo:hi].astype("<u2"), own[runs], np.diff(np.r_[runs, hi - lo]).astype("<u4"))
            out.append((ASKED, to[lo], 0, body))
        yield _flow(out)

    def dealt_out(flow, key, *then):
        return flow.repartition(int(tasks), key).sortWithinPartitions(key, *then)

    dealt = dealt_out(rows.mapInArrow(deal, FLOW), "bucket")
    answered = materialise(dealt.mapInArrow(answer, FLOW), "ngram-answers")

    def totals(batches):
        for batch in batches:
            for body in batch.column("body").to_pylist():
                two, names, successors = _unpack(body, "<i8", "<u8", "<i8")
                what = ["tokens", "words", *["successors"] * len(names)]
                word = np.r_[np.zeros(2, np.int64), names.view(np.int64)]
                columns = [pa.array(what), pa.array(word), pa.array(np.r_[two, successors])]
                yield pa.RecordBatch.from_arrays(columns, ["what", "word", "n"])

    # Two numbers, and one for each hot word.
    summed = answered.where(F.col("kind") == TOTALS).mapInArrow(totals, "what string, word long, n long")
    total = {(r["what"], r["word"]): r["n"] for r in summed.groupBy("what", "word").agg(F.sum("n").alias("n")).collect()}
    n_tokens, n_words = total.get(("tokens", 0), 0), total.get(("words", 0), 0)
    kinds = np.array([0, *(total.get(("successors", w), 0) for w in hot.view(np.int64).tolist())])
    hot_back = np.where(kinds > 0, np.log10(discount * np.maximum(kinds, 1)), 0.0)

    def back_off(batches):
        for _, rows in _by_key(batches, "bucket"):
            asked, codes, counts = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for kind, _, body in rows:
                if kind == UNIGRAMS:
                    code, c = _unpack(body, "<u8", "<i8")
                    codes.append(code)
                    counts.append(c)
                else:
                    low, high, doc, hot_at, slices_, lengths = _unpack(body, "<u4", "u1", "<u2", "<u2", "<i8", "<u4")
                    want = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
                    asked.append((want, doc, hot_at, np.repeat(slices_, lengths)))
            rows.clear()
            if not asked:
                continue
            code, c = np.concatenate(codes), np.concatenate(counts)
            order = np.argsort(code)
            code, c = code[order], c[order]
            want, doc, hot_at, slice_of = (np.concatenate([a[k] for a in asked]) for k in range(4))
            at = _find(code, want)
            mass = np.where(at >= 0, c[np.maximum(at, 0)] - discount if len(c) else 1.0, discount * max(n_words, 1))
            score = np.log10(mass) - np.log10(max(n_tokens, 1)) + hot_back[hot_at]
            none = np.zeros(len(score))
            yield _flow([(SUMS, 0, s, body) for s, body in _sums(slice_of, doc.astype(np.int64), none, score, none)])

    unknown = dealt_out(answered.where(F.col("kind").isin(UNIGRAMS, ASKED)), "bucket")
    more = unknown.mapInArrow(back_off, FLOW)
    less = np.log10(n_tokens + 0.5 * (n_words + 1))

    def add_up(batches):
        for _, rows in _by_key(batches, "slice"):
            doc_id, none, held, n = _unpack(rows[0][2], "<i8", "?", "?", "<i8")  # ROWS sorts before SUMS
            total = np.zeros((3, len(doc_id)))
            for _, _, body in rows[1:]:
                doc, *sums = _unpack(body, "<u2", "<f8", "<f4", "<u4")
                for k in range(3):
                    total[k, doc] += sums[k]
            base, score, known = total
            columns = [pa.array(doc_id, mask=none), pa.array(held), pa.array(n), pa.array(known.astype(np.int64))]
            columns += [pa.array(np.full(len(doc_id), n_tokens, np.int64)), pa.array(base - n * less), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    parts = dealt_out(answered.where(F.col("kind").isin(ROWS, SUMS)).unionByName(more), "slice", "kind")
    return parts.mapInArrow(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op5_language_model(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from those that aren't held out."""
    return score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"))
