import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from temblor.llm import ngrams
from tests.llm.conftest import ODD


def brute(rows, d=ngrams.DISCOUNT):
    def cut(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]

    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c, after = Counter(), defaultdict(Counter)
    for (_, text), h in zip(rows, held):
        if not h:
            tokens = cut(text)
            c.update(tokens)
            for a, b in zip([None, *tokens], tokens):
                after[a][b] += 1
    n, v = sum(c.values()), len(c)

    def uni(w):
        return math.log10((c[w] - d if c[w] else d * max(v, 1)) / max(n, 1))

    out = []
    for (i, text), h in zip(rows, held):
        tokens = cut(text)
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        score = 0.0
        for a, b in zip([None, *tokens], tokens):
            if not c[a]:
                score += uni(b)
            elif after[a][b]:
                score += math.log10((after[a][b] - d) / c[a])
            else:
                score += math.log10(d * len(after[a]) / c[a]) + uni(b)
        out.append((i, h, len(tokens), sum(c[t] > 0 for t in tokens), n, base, score))
    return out


@pytest.mark.parametrize("share", [1000, 20])  # 20: several words are dealt out by successor
def test_against_brute_force(documents, spark, monkeypatch, share):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).collect()
    rows = [*ODD, *((r.doc_id + 100, r.text) for r in real)]
    monkeypatch.setattr(ngrams.hot_words, "__defaults__", (share,))
    got = sorted(map(tuple, ngrams.score_corpus(documents(*rows)).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=0.02, abs=0.05)  # probabilities are quantised


def test_held_out_documents_score_better_than_by_the_base(spark):
    got = ngrams.op5_language_model(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum() and (got.score < 0).all()


def test_elias_fano_and_trie():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (5, 3), (3000, 2**45), (3000, 100), (70000, 10**6), (1, 2**63), (3, 2**63)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        coded = ngrams.EliasFano(values)
        assert (coded.decode() == values).all()
        at = rng.integers(0, n, 500) if n else np.zeros(0, int)
        assert (coded.get(at) == values[at]).all()
    contexts = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sizes = rng.integers(1, 40, len(contexts))
    codes = np.concatenate([np.sort(rng.choice(2**40, s, replace=False)) for s in sizes]).astype(np.uint64)
    values = rng.random(len(codes)).round(1)
    parts = ngrams.mapped(ngrams.Trie.build(contexts, np.cumsum(sizes) - sizes, codes, values, np.ones(len(codes))))
    assert isinstance(parts["contexts"].base, (np.memmap, np.ndarray))
    trie = ngrams.Trie(parts)
    owner = np.repeat(contexts, sizes)
    assert trie.find(owner, codes) == pytest.approx(values)
    assert np.isnan(trie.find(owner, codes + np.uint64(1))).mean() > 0.99
    assert np.isnan(trie.find(owner + np.uint64(1), codes)).mean() > 0.99
    start, end = trie.successors_of(np.arange(len(contexts)))
    assert (end - start).tolist() == sizes.tolist()


def test_without_training_rows_and_empty(documents):
    assert ngrams.score_corpus(documents((1, "x")).where("false")).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = ngrams.score_corpus(documents((held, "a b"))).collect()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0
    assert row.base_score == pytest.approx(0.0) and math.isfinite(row.score)
