import random
import re
import zlib
from collections import Counter

import pytest

from temblor.llm import variants
from tests.llm.conftest import ODD


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :]
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def brute_groups(counts):
    near = {w: [u for u in counts if one_edit(w, u)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return sorted(out, key=str)


def brute_counts(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def groups(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").selectExpr("*", "1 AS node", "2 AS depth")
    return sorted((tuple(r) for r in variants.variant_groups(words, **options).collect()), key=str)


def test_counts_of_words_with_typing_errors(documents, spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [*ODD, (20, "Ærøskøbing ÆRØSKØBING æRØSKØBING ×÷×÷× ¿qué?"), *((r.doc_id + 100, r.text) for r in real)]
    got = {r.word: r.n for r in variants.word_counts(documents(*rows), typo_every=97).collect()}
    assert got == brute_counts(rows)


def test_groups_against_brute_force(spark):
    rng = random.Random(7)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 9))) for _ in range(500)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa"}
    for _ in range(30):  # around the length at which words leave the trie
        long = "".join(rng.choices("abcdefgh", k=rng.randint(variants.LONG - 3, variants.LONG + 3)))
        words.add(long)
        for _ in range(4):
            k = rng.randrange(len(long) + 1)
            words |= {long[:k] + "z" + long[k:], long[:k] + "y" + long[k + 1 :], long[:k] + long[k + 1 :]}
    words |= {"b" * k for k in range(variants.LONG - 2, variants.LONG + 4)}
    counts = {w: int(2 ** rng.uniform(2, 12)) for w in words}
    assert groups(spark, counts) == brute_groups(counts)


def test_hot_nodes_are_cut(spark):
    rng = random.Random(8)
    counts = {"pre" + "".join(rng.choices("abcdef", k=3)): rng.randint(3, 90) for _ in range(150)}
    assert groups(spark, counts, hot_rows=8) == brute_groups(counts)


def test_very_long_words(spark):
    word = "abcdefghij" * 20_000
    counts = {word: 9, word[:70_000] + word[70_001:]: 4, word + "x": 3, word[:-1] + "y": 3, "xy" + word: 3}
    assert groups(spark, counts) == brute_groups(counts)


def test_ties_go_to_the_smaller_word_and_forms_are_followed(spark):
    counts = {"colour": 10, "colours": 10, "coloursa": 4, "coloursz": 2, "éclair": 5, "eclair": 5}
    rows = {r[0]: r for r in groups(spark, counts)}
    assert rows["coloursa"][1:3] == ("colours", "colours") and rows["coloursz"][1] == "colours"
    assert rows["éclair"][1] is None and rows["éclair"][4] == 1
    assert groups(spark, counts) == brute_groups(counts)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "few words here, each once")]])
def test_no_words(documents, rows):
    table = documents(*rows, (9, "x")).where("doc_id < 9")
    assert variants.variant_groups(variants.word_counts(table)).count() == 0
