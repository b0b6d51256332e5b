import re

from temblor.llm import quotes


def brute(rows):
    """The same by comparing every message with every other. rows: (conv, turn, role, text)."""
    seen = {}
    for conv, turn, role, text in rows:
        key = (conv, turn, text or "")
        seen[key] = min((r for r in (seen.get(key), role) if r is not None), default=None)
    out, parent = {}, {}
    order = lambda k: tuple((x is not None, x) for x in k[:2])  # noqa: E731  texts differ in these tests by conv and turn

    def lines(text):
        for x in re.split(r"\r?\n", text):
            if not re.search(quotes.ATTRIBUTION, re.sub(quotes.MARK, "", x)):
                mark = re.match(quotes.MARK, x)
                yield mark.group().count(">") if mark else 0, re.sub(quotes.MARK, "", x)

    normal = lambda x: re.sub(r"[\s>]+", " ", x.lower()).strip(" ")
    original = {}
    for k in seen:
        for level, x in lines(k[2]):
            if level == 0 and len(normal(x)) >= 8:
                original.setdefault(normal(x), []).append(k)
    for k in seen:
        votes, quoted, linked = {}, 0, 0
        for level, x in lines(k[2]):
            if level and len(normal(x)) >= 8:
                quoted += 1
                have = original.get(normal(x), [])
                near = min((h for h in have if h[0] == k[0]), key=order, default=None)
                far = min(have, key=order, default=None)
                to = next((t for t in (near, far) if t and order(t) < order(k)), None)
                if to:
                    linked += 1
                    low, n = votes.get(to, (level, 0))
                    votes[to] = (min(low, level), n + 1)
        to = min(votes, key=lambda t: (votes[t][0], -votes[t][1], order(t)), default=None)
        if to is None and k[1] is not None:
            to = next((h for h in seen if h[0] == k[0] and h[1] == k[1] - 1), None)
        parent[k] = to
        out[k] = (quoted, linked)
    found = []
    for k, role in seen.items():
        depth, at = 0, k
        while parent[at]:
            depth, at = depth + 1, parent[at]
        own = "\n".join(x for level, x in lines(k[2]) if level == 0).strip(" ")
        to = parent[k] or (None, None)
        found.append((k[0], k[1], role, own, *out[k], to[0], to[1], at[:2], depth))
    return found


ROWS = [
    (1, 0, "user", "How do I sort a table?\nIt has many rows."),
    (1, 1, "assistant", "On Monday A wrote:\n> How do I sort a table?\nUse an ordering."),
    (1, 2, "user", "> > How do I sort a table?\n> Use an   ORDERING.\nThank you very much"),
    (1, 3, "user", "no quote here at all"),
    (1, 5, "user", "> it has many rows.\nlate answer to the first"),
    (2, 0, "user", "> use an ordering.\n> unknown quoted line\nfrom another conversation"),
    (2, 1, None, None),
    (2, 2, "user", ""),
    (2, 2, "user", ""),
    (None, 0, "user", "message without conversation"),
    (3, None, "user", "> message without conversation\n>short"),
    (4, 0, "user", ">only a quote of nothing"),
    (5, 0, "user", ">>> Thank you very much\r\n>> it has many rows.\r\nbye bye"),
    *((6, k, "user", f"> line number {k - 1} of the chain\nline number {k} of the chain") for k in range(40)),
]


def test_against_brute_force(spark):
    table = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS level", "'x' AS passage")
    got = quotes.link_quotations(table).collect()
    thread = {r.thread: (r.conv_id, r.turn) for r in got if r.depth == 0}
    rows = [(*tuple(r)[:8], thread[r.thread], r.depth) for r in got]
    assert sorted(rows, key=str) == sorted(brute(ROWS), key=str)


def test_a_line_that_all_share_meets_each_once(spark):
    rows = [(k, 0, "user", "> the very same line\nthe very same line") for k in range(400)]
    got = quotes.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 400 and {(r.to_conv, r.depth) for r in got if r.conv_id} == {(0, 1)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link_quotations(none).count() == 0
