import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from temblor.llm import toxicity
from temblor.llm.common import text_bytes
from tests.llm.conftest import ODD


def brute_features(text):
    """Words and beginnings, told apart by their length in a tuple."""
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    out = Counter()
    for word in re.findall(r"[a-z\x80-\U0010ffff]+", lower):
        out[(word,)] += 1
        out.update((word[:k], "") for k in toxicity.BEGINNINGS if len(word) > k)
    return out


def features(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    return toxicity._counted(*toxicity.text_features(data, offsets))


def test_features_against_brute_force():
    texts = [t for _, t in ODD] + ["touching", "Words", "ÀÉÎÕÜ wörter🙂🙂🙂🙂 x-ray", "", "Worthlessly worthless"]
    rows, buckets, counts = features(texts)
    names = {}
    for k, text in enumerate(texts):
        want = brute_features(text)
        got = dict(zip(buckets[rows == k].tolist(), counts[rows == k].tolist()))
        assert sorted(got.values()) == sorted(want.values())
        for name in want:
            [row], [bucket], _ = features([name[0]]) if len(name) == 1 and len(name[0]) <= 4 else ([0], [None], None)
            if bucket is not None:
                assert got[bucket] == want[name]
                assert names.setdefault(name, bucket) == bucket


def test_risk_learns_from_positive_and_unlabelled_rows_only():
    rng = np.random.default_rng(2)
    truth = rng.random(6000) < 0.2
    dense = rng.poisson(np.where(truth[:, None], [2.0, 0.3, 1.0], [0.1, 0.3, 1.0]))
    confirmed = truth & (rng.random(6000) < 0.25)
    rows, columns = np.nonzero(dense)
    share = (truth & ~confirmed).sum() / (~confirmed).sum()
    weights, bias = toxicity.fit_pu(rows, columns, np.log2(1 + dense[rows, columns]), confirmed, 3, share)
    g = np.log2(1 + dense) @ weights + bias
    assert ((g > 0) == truth).mean() > 0.9
    assert weights[0] > 5 * abs(weights[1])


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op12_toxicity(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    labelled = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = labelled[labelled.held_out]
    assert held[held.toxic == 1].predicted.mean() >= 0.6 and held[held.toxic == 0].predicted.mean() < 0.05
    order = held.score.rank()
    n1, n0 = (held.toxic == 1).sum(), (held.toxic == 0).sum()
    assert (order[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.9


def test_planted_words_in_odd_rows(documents, spark):
    clean = [(100 + k, f"a quiet sentence about number{k} and more") for k in range(300)]
    bad = [(1000 + k, f"you awful{k % 7} gruntling fool, gruntling{k} so") for k in range(60)]
    labels = spark.createDataFrame([(i, 0, 1) for i, _ in bad[:30]] + [(i, 1, 0) for i, _ in clean[:150]] + [(None, 0, 1), (5, 0, None), (7777, 0, 1)], "doc_id long, quality int, toxic int")
    table = documents(*ODD, *clean, *bad, *[(1000, "another text of one id, gruntling")] * 3, (900, "calm words " * 50_000))
    classifier = toxicity.learn(table, labels)
    scores = toxicity.score_documents(table, classifier).collect()
    assert len(scores) == len(ODD) + 364
    assert all((r.score >= 0.5) == (r.doc_id is not None and r.doc_id >= 1000) for r in scores)
    again = toxicity.learn(table.repartition(7), labels)
    assert np.allclose(again.weights, classifier.weights) and (again.place == classifier.place).all()


def test_without_examples(documents, spark):
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    table = documents(*ODD)
    assert toxicity.learn(table, labels) is None
    assert toxicity.learn(table.where("false"), labels) is None
    assert {r.score for r in toxicity.score_documents(table, None).collect()} == {0.0}
