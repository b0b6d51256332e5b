import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from temblor.config import shared_dir
from temblor.llm import token_files
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ranks_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 200, 70_000, 2**32 - 1):
        for n in (0, 1, 3, 4, 1001):
            ranks = rng.integers(0, top, n).astype(np.uint32)
            control, data = token_files.encode_ranks(ranks)
            assert len(control) == -(-n // 4)
            assert (token_files.decode_ranks(control, data, n) == ranks).all()


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_files_round_trip(documents, spark, monkeypatch, limit):
    monkeypatch.setattr(token_files, "RANK_TABLE_BYTES", limit)
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 50)
    path = shared_dir(spark, "test")
    token_files.write_token_files(documents(*ODD), path, PATH, files=3)
    whole = Tokenizer.from_file(PATH)
    want = {}
    for doc_id, text in ODD:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
    rows = token_files.token_file_digests(spark, path).collect()
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d))
    for doc_id, each in want.items():
        assert sorted((r.n_tokens, r.ids_crc32) for r in rows if r.doc_id == doc_id) == sorted(w[:2] for w in each)
    whole_rows = token_files.read_token_files(spark, path).collect()
    assert sorted(bytes(r.ids) for r in whole_rows) == sorted(w[2] for each in want.values() for w in each)


def test_empty_table(documents, spark):
    path = shared_dir(spark, "test")
    token_files.write_token_files(documents((1, "x")).where("false"), path, PATH)
    assert token_files.token_file_digests(spark, path).count() == 0
