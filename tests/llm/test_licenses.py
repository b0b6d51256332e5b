import math

from temblor.llm import licenses
from tests.llm.conftest import ODD
from tests.llm.test_decontamination import words


def brute(rows):
    out = []
    for doc_id, text in rows:
        own, base = words(text), []
        for phrase, label in licenses.PHRASES.items():
            cut = phrase.split()
            base += [(k, label) for k in range(len(own)) if own[k : k + len(cut)] == cut]
        more, score = set(), 0.0
        for line in (text or "").split("\n"):
            for label, notice in licenses.NOTICES:
                t = set(licenses.notice_words(notice))
                share = len(t & set(words(line)))
                if share >= math.ceil(0.8 * len(t) - 1e-9):
                    more.add(label)
                    score = max(score, share / len(t))
        labels = sorted({v for _, v in base})
        at = [k for k, _ in base]
        out.append((doc_id, len(own), len(base), min(at, default=None), max(at, default=None), ",".join(labels),
                    ",".join(sorted(set(labels) | more)), 1.0 if base else score))
    return sorted(out, key=str)


def test_against_brute_force(documents):
    rows = [
        *ODD, (60, "Under the MIT license. under THE mit License"), (61, "CC BY-NC cc by nc cc-by-nc 4.0"), (62, "apache license\nversion 2"),
        (63, "licensed under the Apache License"), (64, "general GNU public, this work under license 3 version the is"),
        (65, "cc by"), (66, licenses.NOTICES[1][1]), (67, licenses.NOTICES[1][1][:150]), (68, "reserved rights all copyright " * 3000), (68, "x"),
        *((70 + k, t.replace("under", "by", 1)) for k, (_, t) in enumerate(licenses.NOTICES)),
        *((90 + k, t.replace(" ", "\n", 2)) for k, (_, t) in enumerate(licenses.NOTICES)),
    ]
    assert sorted(map(tuple, licenses.scan(documents(*rows)).collect()), key=str) == brute(rows)


def test_every_prefix_finds_what_comparing_all_finds(documents):
    import random

    random.seed(4)
    every = sorted({w for _, t in licenses.NOTICES for w in licenses.notice_words(t)})
    rows = [(k, " ".join(random.sample(every, random.randint(3, 60)))) for k in range(300)]
    got = licenses.scan(documents(*rows), threshold=0.8)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_all_rights_reserved_as_it_stands_in_the_tables(documents):
    rows = [(1, "some prose\nAll rights reserved.\nmore prose"), (2, "Copyright 2020 X. All rights reserved."), (3, "all rights here")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(documents(*rows)).collect()}
    assert got == {1: ("all-rights-reserved", 1.0), 2: ("all-rights-reserved", 1.0), 3: ("", 0.0)}


def test_empty_table(documents):
    assert licenses.scan(documents((1, "x")).where("false")).count() == 0
