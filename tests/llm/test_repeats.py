import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from temblor.llm import repeats
from tests.llm.conftest import ODD


def brute(rows, length=repeats.LENGTH):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_with_repeats():
    random.seed(6)

    def text(n):
        return "".join(random.choice("abc déf\n") for _ in range(n))

    passage, line = text(700), text(395)
    rows = [*ODD, (20, passage), (21, text(300) + passage + text(300)), (22, passage[100:480] + text(50)), (23, passage[90:600])]
    rows += [(30 + k, text(random.randint(0, 60)) + passage[k:] + text(random.randint(0, 300))) for k in range(30)]
    rows += [(70 + k, text(20) + line + text(20)) for k in range(5)] + [(80, (line + "x") * 5), (81, "ab" * 900), (82, "z" * 399), (83, "z" * 400)]
    rows += [(90, text(200) + passage[:420] + text(100) + passage[300:] + passage[:410])]
    return rows


@pytest.mark.parametrize("hot", [2048, 3])
def test_against_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "BATCH_WINDOWS", 500)
    monkeypatch.setattr(repeats, "TASK_WINDOWS", 3000)
    rows = rows_with_repeats()
    got = repeats.remove_repeats(documents(*rows), hot_regions=hot).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_real_documents(documents, spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in real]
    got = repeats.remove_repeats(documents(*rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_long_texts_are_cut_with_overlap(monkeypatch):
    import pyarrow as pa

    random.seed(3)
    text = "".join(random.choice("abcd ") for _ in range(9000))
    table = pa.RecordBatch.from_pydict({"doc_id": [7], "text_hash": [1], "text": [text]})
    monkeypatch.setattr(repeats, "CUT_BYTES", 1500)
    cut = pa.Table.from_batches(repeats._regions(table)).to_pydict()
    starts = sorted(s for a, b in zip(cut["first"], cut["last"]) for s in range(a, b + 1))
    assert starts == list(range(9000 - 400 + 1))
    monkeypatch.setattr(repeats, "CUT_BYTES", 1 << 20)
    whole = pa.Table.from_batches(repeats._regions(table)).to_pydict()
    inner = set(zip(whole["anchor_hash"], whole["region_hash"])) & set(zip(cut["anchor_hash"], cut["region_hash"]))
    assert len(inner) > 0.7 * len(whole["first"])


def test_family_finds_all_and_stays_logarithmic():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 6000).astype(np.uint8)
    family = repeats.IndexFamily(8, 6000)
    for at in range(0, 5800, 58):
        own = np.arange(58)
        family.add(data[at : at + 58 + 7], own, at + own)
        assert len(family.levels) <= 8
    words = [bytes(data[k : k + 8]) for k in range(5800)]
    n = Counter(words)
    assert family.found[:5800].tolist() == [n[w] > 1 for w in words]


def test_empty_table(documents):
    assert repeats.remove_repeats(documents((1, "x")).where("false")).count() == 0


def test_query_returns_what_is_left(spark):
    got = repeats.op8_repeats(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r.n_kept == r.n_bytes - r.n_removed for r in got)
    untouched = [r for r in got if not r.n_removed]
    assert untouched and all(r.kept_text == texts[r.doc_id] for r in untouched)
    assert all(len(r.kept_text) < len(texts[r.doc_id]) for r in got if r.n_removed)
