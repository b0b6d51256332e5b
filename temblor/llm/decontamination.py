"""Benchmark decontamination over a positional index of the documents' words.

The index stores a posting (term, document, position) for every occurrence of a word that the
benchmark uses; it is written once, document by document, so that the texts are read and cut into
words a single time. A window of consecutive benchmark words is looked up by its rarest terms:
their lists, each shifted by the term's place in its item, meet in (document, item, shift). Where
all rare terms of a window agree on a shift, the lists of the other words are intersected at that
shift alone. Everything is DataFrame functions.

Defined results: a null or empty text has no words, and so has one without letters or digits; its
document is not contaminated. Equal rows get equal rows; a null `doc_id` is a document like any
other, and rows that share a `doc_id` are told apart by their texts. Benchmark rows without words
are left out; those without an `item_id` mark words but are neither counted nor listed; items with
the same words are listed each. An empty benchmark finds nothing. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import alnum_words, materialise, small

WINDOW = 13
RARE_TERMS = 2
DOC = ["doc_id", "text_hash"]
END = 0  # the term that stands behind a document's last word; its position is the number of words


def items(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, item_ids, words, span (the window's length) of the different benchmark texts."""
    cut = benchmark.select("item_id", alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    return cut.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids")).select(
        F.xxhash64("words").alias("item"),
        "item_ids",
        "words",
        F.least(F.lit(window), F.size("words")).alias("span"),
    )


def vocabulary(words: DataFrame) -> DataFrame:
    """term, word: a number for each different `word`, and the end mark under the empty word."""
    own = words.select("word").distinct().select(F.monotonically_increasing_id().cast("long") + 1, "word")
    end = words.sparkSession.createDataFrame([(END, "")], "term long, word string")
    return materialise(own.toDF("term", "word").unionByName(end), "vocabulary")


def index(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """doc_id, text_hash, term, position: the postings of `docs` (doc_id, text) for `vocab`."""
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.concat(alnum_words(F.col("text")), F.array(F.lit(""))).alias("words"),
    )
    placed = cut.select(*DOC, F.posexplode("words").alias("position", "word"))
    found = placed.join(small(vocab), "word").select(*DOC, "term", F.col("position").cast("long").alias("position"))
    return materialise(found, "postings")


def document_sizes(postings: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words of every row that was indexed."""
    return postings.where(F.col("term") == END).select(*DOC, F.col("position").alias("n_words"))


def _same_doc(left: DataFrame, right: DataFrame, *more: str) -> Column:
    same = left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])
    for name in more:
        same &= left[name] == right[name]
    return same


def phrase_matches(postings: DataFrame, vocab: DataFrame, phrases: DataFrame, rare_terms: int = RARE_TERMS) -> DataFrame:
    """doc_id, text_hash, item, shift, starts: the windows of `phrases` (item, words, span) that occur.

    A window that starts at word s of its item stands in the document at word shift + s.
    """
    placed = phrases.select("item", "span", F.posexplode("words").alias("place", "word"))
    lists = postings.groupBy("term").agg(F.count("*").alias("length"))
    lists = vocab.join(small(lists), "term", "left").select("term", "word", F.coalesce("length", F.lit(0)).alias("length"))
    placed = materialise(placed.join(small(lists), "word").select("item", "span", "place", "term", "length"), "phrases")

    by_item = placed.groupBy("item", "span").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "length"))), lambda x: F.struct(x["length"], x["place"])
        ).alias("at")
    )
    windows = by_item.select(
        "item",
        F.explode(F.transform(F.sequence(F.lit(1), F.size("at") - F.col("span") + 1), lambda s: F.slice("at", s, F.col("span")))).alias("at"),
    )
    rare = F.slice(F.sort_array("at"), 1, rare_terms)
    windows = windows.select("item", rare.alias("rare")).where("rare[0].length > 0")
    probes = windows.select("item", F.transform("rare", lambda x: x["place"]).alias("probes")).distinct()

    asked = probes.select("item", F.explode("probes").alias("place")).distinct()
    asked = asked.join(placed.select("item", "place", "term"), ["item", "place"])
    found = postings.join(small(asked), "term").select(
        *DOC, "item", (F.col("position") - F.col("place")).alias("shift"), "place"
    )
    shifts = found.groupBy(*DOC, "item", "shift").agg(F.collect_set("place").alias("places"))
    shifts = shifts.where(F.size("places") > 1) if rare_terms > 1 and _spans_above_one(phrases) else shifts
    agreed = shifts.join(small(probes), "item").where(F.size(F.array_except("probes", "places")) == 0)
    agreed = materialise(agreed.select(*DOC, "item", "shift").distinct(), "agreed")

    in_docs = small(agreed.select(*DOC).distinct(), 1_000_000)
    near = postings.join(in_docs, _same_doc(postings, in_docs), "left_semi")
    words = agreed.join(small(placed.select("item", "place", "term", "span")), "item").withColumn(
        "position", F.col("shift") + F.col("place")
    )
    matched = words.join(near, _same_doc(words, near, "position", "term"), "left_semi")
    run = matched.groupBy(*DOC, "item", "shift", "span").agg(F.sort_array(F.collect_set("place")).alias("p"))
    run = run.where(F.size("p") >= F.col("span"))
    # In ascending places a whole window ends `span` - 1 entries and as many words on.
    starts = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("p") - F.col("span")),
            lambda k: F.when(
                F.get("p", k + F.col("span") - 1) == F.get("p", k) + F.col("span") - 1, F.get("p", k)
            ),
        ),
        lambda x: x.isNotNull(),
    )
    return run.select(*DOC, "item", "shift", "span", starts.alias("starts")).where(F.size("starts") > 0)


def _spans_above_one(phrases: DataFrame) -> bool:
    """Whether every window has two words or more."""
    return phrases.where("span < 2").isEmpty()


def proximity_matches(postings: DataFrame, vocab: DataFrame, words: list[str], reach: int) -> DataFrame:
    """doc_id, text_hash, position: postings of the rarest word with all others within `reach` words."""
    terms = vocab.where(F.col("word").isin(words) & (F.col("term") != END))
    lists = postings.join(F.broadcast(terms), "term").groupBy("term").count().orderBy("count", "term").collect()
    if len(lists) < len(set(words)):
        return postings.select(*DOC, "position").where("false")
    rarest, others = lists[0]["term"], [r["term"] for r in lists[1:]]
    cell = F.floor(F.col("position") / (reach + 1))
    at = postings.where(F.col("term") == rarest).select(*DOC, "position", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    beside = postings.where(F.col("term").isin(others)).select(*DOC, "term", F.col("position").alias("other"), cell.alias("cell"))
    met = at.join(beside, _same_doc(at, beside, "cell")).where(F.abs(at["position"] - F.col("other")) <= reach)
    met = met.groupBy(at["doc_id"], at["text_hash"], "position").agg(F.count_distinct("term").alias("met"))
    return met.where(F.col("met") == len(others)).drop("met") if others else at.select(*DOC, "position").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Per row of `docs`: n_words, n_hit, n_items, items_sha256, contaminated (and text_hash).

    A document is contaminated if it has hit words, and `share` times as many reach its length.
    """
    phrases = materialise(items(benchmark, window), "phrases")
    vocab = vocabulary(phrases.select(F.explode("words").alias("word")))
    postings = index(docs, vocab)
    matches = materialise(phrase_matches(postings, vocab, phrases), "matches")

    at = F.flatten(F.transform("starts", lambda s: F.sequence(F.col("shift") + s, F.col("shift") + s + F.col("span") - 1)))
    hit = matches.select(*DOC, F.explode(F.array_distinct(at)).alias("position")).distinct().groupBy(*DOC).agg(F.count("*").alias("n_hit"))
    named = matches.join(small(phrases.select("item", "item_ids")), "item").select(*DOC, F.explode("item_ids").alias("item_id"))
    listed = named.distinct().groupBy(*DOC).agg(F.sort_array(F.collect_set("item_id")).alias("ids"))

    sizes = document_sizes(postings)
    both = hit.join(listed, _same_doc(hit, listed), "left").select(hit["doc_id"], hit["text_hash"], "n_hit", "ids")
    out = sizes.join(both, _same_doc(sizes, both), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        sizes["doc_id"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        sizes["text_hash"],
    )


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, benchmark).drop("text_hash")


# The same in SQL: every window of every item against every window of every document.
OP1_SQL = r"""
WITH w AS (SELECT rowid_ AS r, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM (SELECT row_number() OVER () AS rowid_, * FROM documents)),
b AS (SELECT item_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(words)) AS span,
        list_aggregate(list_slice(words, s, s + least(13, len(words)) - 1), 'string_agg', ' ') AS phrase
    FROM b, LATERAL (SELECT unnest(range(1, len(words) - least(13, len(words)) + 2)) AS s) WHERE len(words) > 0),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT r, s, span, list_aggregate(list_slice(words, s, s + span - 1), 'string_agg', ' ') AS phrase
    FROM (SELECT r, words, span, unnest(range(1, len(words) - span + 2)) AS s FROM w, spans WHERE len(words) >= span)),
m AS (SELECT r, s, dw.span, item_id FROM dw JOIN bw USING (span, phrase)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + span)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words)) AS contaminated
FROM w LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""
