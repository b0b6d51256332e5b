"""Spelling variants: words one edit apart, found by pushing a frontier down a relational trie.

The trie is a table: a row per node with its children, nodes being hashes of what has been spelled
so far. A state is (word, position, node, edits). At each level the states whose node has that
depth are joined with the nodes of that depth; a state without an edit goes on along its own letters
and also leaves them once, by a replaced or an inserted letter; one with an edit has to agree with the
rest. A state that has used up its word with one edit, at a node where a word ends, is a neighbour.

An edit lies in one half of a word, so the other half agrees. Words are spelled forwards and
backwards, and each state starts at the node of its first half: edits in the second half are found
forwards, the others backwards, and no state has to try all letters at the trie's root. A removed
letter is an inserted one seen from the other word, and of two words that differ by a replaced
letter the one with the smaller letter finds the other; each pair arises once.

Words of more than `LONG` code points would need as many levels. They have an exact way of their
own: hashes of a word without each of its letters meet hashes of whole words and of such remains.

Candidates are compared exactly, so equal hashes of different prefixes cost time and no more. The
levels are tables in the shared folder; a lost executor repeats one level at most.

Defined results: a null or empty text has no words; a null `doc_id` counts as an empty string where
it enters a hash. Equal rows count once each. Of near words with the same count the smaller in
code-point order is the form. An empty table, or one without words that are common enough, gives no
rows. Further columns are ignored. Texts and words of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temblor.config import shared_dir
from temblor.llm.common import ascii_lower, materialise, mix
from temblor.operators.skew import TILES, tile_hot_keys

LEAST_LENGTH, LEAST_COUNT = 5, 3
LONG = 48
HOT_ROWS = 20_000
TYPO_EVERY = 97


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typo_every: int | None = None) -> DataFrame:
    """Words of `docs` (doc_id, text) with their number of occurrences, n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered. With `typo_every`, a run loses
    one code point where that number divides the CRC-32 of `<doc_id>:<run>`.
    """
    # A word is never longer than its run, so shorter runs are not even extracted.
    runs = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"[a-zÀ-ÿ]{{{max(least_length, 1)},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word"))
    if typo_every:
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word"))).selectExpr(
            f"""CASE WHEN h % {typo_every} <> 0 THEN word ELSE
            concat(substring(word, 1, CAST(h % length(word) AS INT)), substring(word, CAST(h % length(word) AS INT) + 2)) END AS word"""
        )
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _spelled(words: DataFrame) -> DataFrame:
    """Every word in both directions: `s` as it is spelled, and the depth at which it may differ."""
    both = words.selectExpr("n", "inline(array(struct(0 AS dir, word AS s), struct(1 AS dir, reverse(word) AS s)))")
    return both.selectExpr("*", "CAST((length(s) + dir) DIV 2 AS INT) AS half")


def _node(prefix: str) -> str:
    return f"xxhash64(dir, {prefix})"


def trie(words: DataFrame) -> DataFrame:
    """The edges (depth, dir, node, letter, child), once for each letter `below` the child.

    `below` is '' where a word ends at the child. Edges of a word are made from the depth on at
    which words that may meet it start; nothing looks at those above.
    """
    steps = "explode(sequence(CAST((length(s) - 1 + dir) DIV 2 AS INT), length(s) - 1)) AS depth"
    edges = _spelled(words).selectExpr("dir", "s", steps).selectExpr(
        "depth",
        "dir",
        f"{_node('substring(s, 1, depth)')} AS node",
        "substring(s, depth + 1, 1) AS letter",
        f"{_node('substring(s, 1, depth + 1)')} AS child",
        "substring(s, depth + 2, 1) AS below",
    )
    return edges.distinct()


# What a state may do at a node: the letter below the child that it asks for, and the child's letter.
MOVES = """inline(CASE
    WHEN e = 1 THEN array(struct(0 AS move, next AS below))
    WHEN own = '' THEN array(struct(2 AS move, own AS below))
    ELSE array(struct(1 AS move, next AS below), struct(2 AS move, own AS below)) END)"""
ALLOWED = "CASE move WHEN 0 THEN letter = own WHEN 1 THEN letter > own ELSE letter <> own END"


def _moves(states: DataFrame, edges: DataFrame, hot_rows: int) -> DataFrame:
    """States with an edit, one level deeper: the same letter, a replaced or an inserted one.

    A move is made only where the child goes on as the word does.
    """
    asked = states.selectExpr("*", "substring(s, i + 1, 1) AS own", "substring(s, i + 2, 1) AS next")
    asked = asked.selectExpr("dir", "node", "s", "n", "i", "own", MOVES)
    keys = ["dir", "node", "below"]
    if not states.groupBy("dir", "node").count().where(F.col("count") * 2 > hot_rows).isEmpty():
        asked, edges = tile_hot_keys(asked, edges, keys, hot_rows)
        keys += TILES
    moved = asked.join(edges, keys).where(ALLOWED)
    return moved.selectExpr("dir", "s", "n", "child AS node", "IF(move = 2, i, i + 1) AS i", "1 AS e")


def _trie_pairs(words: DataFrame, hot_rows: int) -> DataFrame:
    """Pairs of words of up to `LONG` code points that one edit tells apart, each once."""
    spark = words.sparkSession
    short = words.where(F.length("word") <= LONG)
    path = shared_dir(spark, "trie")
    trie(short).hint("rebalance", "depth").write.partitionBy("depth").parquet(path)
    edges = spark.read.schema("dir int, node long, letter string, child long, below string, depth int").parquet(path)
    spelled = _spelled(short)
    low, high = short.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    states, ended = None, []
    for depth in range(low // 2, high + 1) if low else ():
        # Without an edit a state is on its word's own path, so its node needs no looking up.
        here = spelled.where(f"half <= {depth} AND length(s) >= {depth}")
        here = here.selectExpr("dir", "s", "n", f"{_node(f'substring(s, 1, {depth})')} AS node", f"{depth} AS i", "0 AS e")
        if states is not None:
            here = here.unionByName(states.where("i < length(s)"))
        states = materialise(_moves(here, edges.where(F.col("depth") == depth).drop("depth"), hot_rows), "frontier")
        ended.append(states.where("i = length(s)"))
    if not ended:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    found = ended[0]
    for level in ended[1:]:
        found = found.unionByName(level)
    ends = spelled.selectExpr("dir", f"{_node('s')} AS node", "s AS other", "n AS near_n")
    pairs = found.join(ends, ["dir", "node"]).where("levenshtein(s, other, 1) = 1")
    straight = "CASE dir WHEN 0 THEN {0} ELSE reverse({0}) END"
    pairs = pairs.selectExpr("dir", f"{straight.format('s')} AS word", "n", f"{straight.format('other')} AS near", "near_n")
    # Letters inserted among equal ones can be found from both ends.
    first_half = "substring({}, 1, CAST(length(word) DIV 2 AS INT))"
    return pairs.where(f"(dir = 0) = ({first_half.format('word')} = {first_half.format('near')})").drop("dir")


def _remains(batches):
    """(id, length, i, key): hashes of each word without its letter i, and of the whole with i = -1."""
    base = 0x9E3779B97F4A7C15
    back = np.uint64(pow(base, -1, 1 << 64))
    for batch in batches:
        for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
            letters = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
            power = np.cumprod(np.r_[np.uint64(1), np.full(len(letters) - 1, base, np.uint64)])
            total = np.r_[np.uint64(0), np.cumsum(letters * power)]
            without = total[:-1] + (total[-1] - total[1:]) * back
            hashes = np.r_[without, total[-1:]].view(np.int64)
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key)), pa.array(np.full(n, n - 1)), pa.array(np.r_[np.arange(n - 1), -1]), pa.array(hashes)],
                names=["id", "length", "i", "key"],
            )


def _long_pairs(words: DataFrame) -> DataFrame:
    """The same for pairs in which a word has more than `LONG` code points.

    Words alike but for the letter at one place are at most as many as there are letters.
    """
    long = words.where(F.length("word") >= LONG).selectExpr("xxhash64(word) AS id", "word", "n")
    remains = materialise(long.select("id", "word").mapInArrow(_remains, "id long, length long, i long, key long"), "remains")
    a, b = (remains.selectExpr(f"id AS id{k}", f"length AS length{k}", f"i AS i{k}", "key") for k in (1, 2))
    replaced = a.join(b, "key").where("i1 >= 0 AND i1 = i2 AND length1 = length2 AND id1 < id2")
    # Of equal letters in a row, any may be the inserted one.
    inserted = a.where("i1 < 0").join(b.where("i2 >= 0"), "key").where("length2 = length1 + 1")
    kinds = [replaced.selectExpr("id1", "id2", "i1 AS i", "1 AS skip"), inserted.groupBy("id1", "id2").agg(F.min("i2").alias("i"), F.lit(0).alias("skip"))]
    places = kinds[0].union(kinds[1])
    pairs = places.join(long.toDF("id1", "word", "n"), "id1").join(long.toDF("id2", "near", "near_n"), "id2")
    exact = f"""greatest(length(word), length(near)) > {LONG} AND word <> near
        AND substring(word, 1, CAST(i AS INT)) = substring(near, 1, CAST(i AS INT))
        AND substring(word, CAST(i + 1 + skip AS INT)) = substring(near, CAST(i + 2 AS INT))"""
    return pairs.where(exact).select("word", "n", "near", "near_n")


def near_words(words: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs (word, n, near, near_n) of the words in `words` (word, n) one edit apart, each once."""
    pairs = _trie_pairs(words, hot_rows)
    if words.where(F.length("word") > LONG).isEmpty():
        return pairs
    return pairs.unionByName(_long_pairs(words))


def variant_groups(words: DataFrame, ratio: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """For each word of `words` (word, n): the number of near words, its form and the root of its forms.

    The form is the most frequent near word, if it is at least `ratio` times as frequent.
    """
    words = materialise(words.select("word", "n"), "words")
    pairs = materialise(near_words(words, hot_rows), "near-words")
    sides = pairs.selectExpr("inline(array(struct(word, near, near_n), struct(near AS word, word AS near, n AS near_n)))")
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.expr("min(struct(-near_n AS m, near)) AS best"))
    formed = words.join(best, "word", "left").selectExpr(
        "word",
        "n",
        "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN -best.m >= {int(ratio)} * n THEN best.near END AS form",
        f"CASE WHEN -best.m >= {int(ratio)} * n THEN -best.m END AS form_n",
    )
    formed = materialise(formed, "forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), hot_rows)
    result = formed.join(roots, "word", "left")
    return result.selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


def _roots(links: DataFrame, hot_rows: int) -> DataFrame:
    """Follow links to their ends, doubling the distance in each round.

    Counts grow along links, so there is no circle, and the number of rounds is the logarithm of
    the longest chain, itself at most the logarithm of the largest count.
    """
    while True:
        onwards = links.toDF("root", "further")
        left, right = tile_hot_keys(links, onwards, ["root"], hot_rows)
        stepped = left.join(right, ["root", *TILES], "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved")
        stepped = materialise(stepped, "roots")
        links = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return links


def op13_variants(spark, sf_dir: str) -> DataFrame:
    """Forms and roots of the common words of all documents, with the typing errors of the contract."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variant_groups(word_counts(docs, typo_every=TYPO_EVERY))


OP13_SQL = """
with recursive crc as (
  select list(v order by i) as tab from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) t(i)) t
),
runs as (
  select id, run, count(*) as c from (
    select coalesce(cast(doc_id as varchar), '') as id,
      translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents) t
  where length(run) >= 5 group by all
),
hexed as (select run, c, hex(encode(id || ':' || run)) as x from runs),
hashed as (
  select run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda k: cast('0x' || substr(x, 2 * k + 1, 2) as bigint))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) as h
  from hexed, crc
),
v as (
  select word, cast(sum(c) as bigint) as n from (
    select c, case when h % 97 <> 0 then run else substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) end as word
    from hashed) t
  where length(word) >= 5 group by word having sum(c) >= 3
),
cut as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word))) as i from v) t),
links as (
  select a.word, b.word as near, b.n as m from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cut a join v b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join v b on a.rest = b.word
),
best as (select word, count(*) as n_near, max(m) as m from links group by word),
tops as (select l.word, min(l.near) as near from links l join best b on l.word = b.word and l.m = b.m group by l.word),
formed as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when m >= 2 * v.n then near end as form, case when m >= 2 * v.n then m end as form_n
  from v left join best on v.word = best.word left join tops on v.word = tops.word
),
chain as (
  select word, word as root, 0 as steps from formed
  union all select c.word, f.form, c.steps + 1 from chain c join formed f on c.root = f.word where f.form is not null
)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from formed f join (select word, arg_max(root, steps) as root from chain group by word) r on f.word = r.word
"""
