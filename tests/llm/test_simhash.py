from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from temblor.llm import simhash
from tests.llm.conftest import ODD


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    ones = Counter()
    for s in shingles:
        h = xxh64_intdigest(s, 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_groups(prints, distance=4):
    """prints: list of (id, print) -> list of smallest ids."""
    group = list(range(len(prints)))

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                group[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(prints):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [least[find(k)] for k in range(len(prints))]


def test_documents_against_brute_force(documents, spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3
    rows = [*ODD, (20, base), (21, base + "nu"), (22, "xi " + base), (23, "entirely different words stand in here now")]
    got = [(r.doc_id, f"{r.bits_0 & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(documents(*rows)).collect()]
    got.sort(key=str)
    prints = [(i, brute_print(t)) for i, t in rows]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_groups(prints))]
    assert got == sorted(want, key=str)


def test_every_close_pair_meets_at_a_home():
    rng = np.random.default_rng(5)
    for _, _, bits, threshold in (*simhash.BLOCKS, (0, 0, 15, 1), (0, 0, 18, 2)):
        x = rng.integers(0, 1 << bits, 3000)
        y = x.copy()
        for _ in range(threshold):
            y ^= 1 << rng.integers(0, bits, 3000)
        who, anchor, home = simhash.anchors(x, bits, threshold)
        homes = dict(zip(who[home].tolist(), anchor[home].tolist()))
        assert len(homes) == 3000 == home.sum()
        who, anchor, _ = simhash.anchors(y, bits, threshold)
        at = set(zip(who.tolist(), anchor.tolist()))
        assert all(pair in at for pair in homes.items())


@pytest.mark.parametrize("tile_rows", [4096, 7])
def test_links_against_brute_force_with_and_without_tiles(spark, tile_rows):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 60)
    values = set(seeds.tolist())
    for s in seeds[:20].tolist():
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                s ^= 1 << b
            values.add(s)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame([s * 2 for s in signed], "node long, bits_0 long")
    edges = simhash.links(prints, 4, tile_rows=tile_rows)
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    got = Counter(frozenset(g) for g in _classes({s[0]: root.get(s[0], s[0]) for s in signed}))
    want = brute_groups(list(enumerate(values)))
    assert got == Counter(frozenset(g) for g in _classes({s[0]: w for s, w in zip(signed, want)}))


def _classes(root):
    out = {}
    for k, r in root.items():
        out.setdefault(r, set()).add(k)
    return out.values()


def test_chain_and_star_components(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 201)} | {k: 1000 for k in range(1001, 1300)}


def test_one_of_each_group_stays_against_brute_force(documents):
    import random

    random.seed(8)
    rows = [*ODD, (9000, None), (9001, ""), (9100, "x y z"), (9100, "x y z")]
    for g in range(60):
        own = [random.choice("the of and".split()) if random.random() < 0.4 else f"w{random.randrange(9**6)}" for _ in range(random.choice([60, 200, 900]))]
        rows.append((100 * g + 50, " ".join(own)))
        for k in range(1, 4):
            changed = list(own)
            for at in random.sample(range(len(own)), max(1, len(own) // 100)):
                changed[at] = f"new{random.randrange(9**6)}"
            rows.append((100 * g + 50 + k, " ".join(changed)))
    docs = documents(*rows).withColumnRenamed("anchor", "text_hash").withColumn("component", F.lit(7))
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    least = set(brute_groups([(i, brute_print(t)) for i, t in rows]))
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == least and len(ids) == len(least) and len(least) < len(rows) - 60


def test_a_chain_of_copies_is_one_group(documents):
    """Each text is near the next; the ends are not near each other."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join([*words[:k], *(f"x{j}" for j in range(k, 2 * k)), *words[2 * k :]])) for k in range(0, 40)]
    prints = [(i, brute_print(t)) for i, t in rows]
    assert (prints[0][1] ^ prints[-1][1]).bit_count() > 4
    got = sorted(r.doc_id for r in simhash.keep_one_of_each(documents(*rows)).collect())
    assert got == sorted(set(brute_groups(prints)))


def test_empty_table(documents):
    assert simhash.near_duplicates(documents((1, "x")).where("false")).count() == 0
