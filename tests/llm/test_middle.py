import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from temblor.llm import middle
from tests.llm.conftest import ODD

LONG = "Überlänge 🙂 mit Wörtern\n" * 30_000
ROWS = [
    *ODD,
    (12, "holds <S> itself"),
    (13, "<"),
    (14, "<S"),
    (15, "ends with < and >P>M>"),
    (16, "🙂é" * 700),
    (17, LONG),
    (18, " leading\n\n\nlines \n"),
]
UNITS = {"char": r"[\s\S]", "word": r"^[\x20\x09-\x0D]+$|^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "line": r"[^\n]*\n|[^\n]+"}


def brute(doc_id, text, unit):
    text = text or ""
    units = re.findall(UNITS[unit], text)
    assert "".join(units) == text
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", list(UNITS))
def test_outputs_against_brute_force_and_back(documents, spark, unit):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = ROWS + [(r.doc_id + 100, r.text) for r in real]
    made = middle.fill_in_middle(documents(*rows), unit)
    back = made.withColumn("again", middle.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((tuple(r)[:6] for r in back), key=str)
    assert got == sorted((brute(i, t, unit) for i, t in rows), key=str)
    assert sorted(r.again for r in back) == sorted(t or "" for _, t in rows)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_tree_counts_and_finds_like_sums():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 57, 256, 1000):
        counts = rng.integers(0, 4, n)
        tree, total = middle.Fenwick(counts), np.concatenate([[0], np.cumsum(counts)])
        assert (tree.before(np.arange(n + 1)) == total).all()
        block, rest = tree.find(np.arange(total[-1]))
        owner = np.repeat(np.arange(n), counts)
        assert (block == owner).all() and (rest == np.arange(total[-1]) - total[owner]).all()
        assert tree.find(total[-1:])[0] == n


def test_shares_of_the_forms(documents):
    rows = [(k, "some text") for k in range(2000)]
    count = {r.form: r["count"] for r in middle.fill_in_middle(documents(*rows), mix=middle.Mix(7, 50, 50)).groupBy("form").count().collect()}
    assert abs(count["plain"] - 1000) < 120 and abs(count["spm"] - 500) < 100


def test_empty_table(documents):
    assert middle.fill_in_middle(documents((1, "x")).where("false")).count() == 0


def test_unknown_unit():
    with pytest.raises(ValueError):
        middle.unit_starts(np.zeros(3, np.uint8), np.array([0, 3]), "page")
