import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from temblor.llm.packing import BestFit, pack
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_and_sequences(documents, spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [*ODD, *((r.doc_id + 100, r.text) for r in real)]
    whole = Tokenizer.from_file(PATH)
    want, total = [], 0
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at : at + 4096]
            want.append((doc_id, k, at, len(cut), zlib.crc32(cut.tobytes())))
    got = pack(documents(*rows), PATH).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.02 * -(-total // 4096) + 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200), st.integers(1, 8))
def test_best_fit_keeps_its_bounds(sizes, most_open):
    closed = []
    bins = BestFit(40, most_open, lambda space, sequence: closed.append((space, sequence)))
    for k, size in enumerate(sizes):
        bins.add(size, k)
        assert bins.open <= most_open and bins.bits.bit_count() <= most_open
    every = [*closed, *bins.rest()]
    assert sorted(k for _, s in every for _, k in s) == list(range(len(sizes)))
    assert all(space + sum(sizes[k] for _, k in s) == 40 for space, s in every)


def test_empty_table(documents):
    assert pack(documents((1, "x")).where("false"), PATH).count() == 0
