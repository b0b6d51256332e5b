import re
from collections import Counter

import numpy as np

from temblor.llm import quality
from tests.llm.conftest import ODD


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    n = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit), failed


def test_counts_against_brute_force(documents, spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [*ODD, (30, "a\n\na\n a\na"), (31, "x #*$ <> | " * 9), *((r.doc_id + 100, r.text) for r in real.collect())]
    labels = spark.createDataFrame([(30, 1, 0), (None, 0, 0), (31, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.judge(documents(*rows), labels).collect()
    want = [(i, *brute(t), not brute(t)[-1]) for i, t in rows]  # one class only: the base rules decide
    assert sorted((tuple(r)[:8] for r in got), key=str) == sorted(want, key=str)


def test_trees_learn_and_keep_their_direction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 4))
    p = 1 / (1 + np.exp(-(4 - 9 * x[:, 0] + 3 * np.sin(9 * x[:, 1]))))
    y = (rng.random(4000) < p).astype(float)
    direction = np.array([-1, 0, 1, 0])
    trees = quality.fit_trees(x[:3000], y[:3000], direction)
    right = ((trees.score(x[3000:]) > 0.5) == (p[3000:] > 0.5)).mean()
    assert right > 0.93
    for f in (0, 2):
        grid = np.repeat(rng.random((50, 1, 4)), 101, axis=1)
        grid[:, :, f] = np.linspace(0, 1, 101)
        step = np.diff(trees.score(grid.reshape(-1, 4)).reshape(50, 101), axis=1)
        assert (step * direction[f] >= -1e-12).all()


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1").selectExpr("doc_id", "quality AS good"), "doc_id").toPandas()
    clean = got[~got.base_failed]
    assert (clean.kept == (clean.good == 1)).mean() > 0.95


def test_empty_tables(documents, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(documents((1, "x")).where("false"), labels).count() == 0
