import hashlib
import re

from temblor.llm import decontamination as d
from tests.llm.conftest import ODD


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, window=13):
    out = []
    for doc_id, text in rows:
        own, hit, ids = words(text), set(), set()
        for item_id, item in items:
            cut = words(item)
            span = min(window, len(cut))
            for s in range(len(cut) - span + 1 if cut else 0):
                for at in range(len(own) - span + 1):
                    if own[at : at + span] == cut[s : s + span]:
                        hit.update(range(at, at + span))
                        ids |= {str(item_id)} if item_id is not None else set()
        listed = ",".join(sorted(ids))
        out.append((doc_id, len(own), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


PASSAGE = " ".join(f"w{k} the" for k in range(20))
ITEMS = [
    (1, PASSAGE), (2, "Of the Of the of the of the of the of the of the of the"), (3, "short one"), (3, "other under three"),
    (None, "nameless item words"), (11, "never seen anywhere"), (12, None), (13, " ,.; "), (14, "short one"), (15, "solo"),
]
ROWS = [
    *ODD,
    (40, "before " + PASSAGE.upper() + " after"), (40, "again " + PASSAGE), (41, " ".join(PASSAGE.split()[3:16])),
    (42, " ".join(PASSAGE.split()[3:15])), (43, "of the " * 30), (44, "a short, ONE! short one short"), (45, "x " * 300 + "short one"),
    (46, "nameless-item.words other under three"), (47, PASSAGE.replace("w7", "zz")), (48, "solo, Solo"), (48, "solo, Solo"),
]


def test_against_brute_force(documents, spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("item_id", "text", "1 AS span", "2 AS term")
    got = d.contamination(documents(*ROWS), benchmark).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, ITEMS)


def test_without_benchmark_or_documents(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted(map(tuple, d.contamination(documents(*ROWS), none).drop("text_hash").collect()), key=str) == brute(ROWS, [])
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.contamination(documents((1, "x")).where("false"), some).count() == 0


def test_proximity(documents, spark):
    docs = documents((1, "red x x x blue"), (2, "red x blue"), (3, "blue red"), (4, "red"), (5, "blue x x green x red"))
    vocab = d.vocabulary(spark.createDataFrame([("red",), ("blue",), ("green",)], "word string"))
    postings = d.index(docs, vocab)
    assert {r.doc_id for r in d.proximity_matches(postings, vocab, ["red", "blue"], 2).collect()} == {2, 3}
    assert {r.doc_id for r in d.proximity_matches(postings, vocab, ["red", "blue", "green"], 3).collect()} == {5}
    assert d.proximity_matches(postings, vocab, ["red", "absent"], 3).count() == 0
