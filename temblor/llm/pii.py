"""Personal data: labelers vote on candidate spans, and a classifier learns from their agreement.

Candidates are found by patterns, in DataFrame functions. Four labelers (form, check, gazetteer,
context) vote for, against or not at all on each. The counts of vote patterns, a table of bounded
size, are all that the driver sees: expectation-maximisation estimates from them how reliable each
labeler is, and a logistic classifier over the span's discrete features is fitted to the resulting
probabilities. It decides on the kinds that have no base rule (secrets); base spans always stay, and
matches that fail a base rule only teach the labelers' reliability.

Positions are code points, ends exclusive. Defined results: a null text is empty; empty texts have
no spans, and the checksum of the empty string. Equal rows get equal rows; a null `doc_id` stays
null. An empty table fits nothing and returns nothing. Further columns are ignored or, by
`mask_documents`, kept.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELERS = ("form", "check", "gazetteer", "context")

# The base patterns, written so that Java matches them without recursion or repeated starts:
# possessive loops, and starts only where a run starts or the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9]{16,}+",
}
# What a text must hold for its pattern to be tried.
FORESEEN = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(PATTERNS["card"])),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "secret": lambda t: F.rlike(t, F.lit(r"[0-9]")),
}
FORMS = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]*+)(?:\.(?:0|[1-9][0-9]*+)){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})$",
    "phone": r"^\+[0-9]{1,3}[\x20-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,4}$",
    "secret": r"^(?:[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z0-9]{16,}|(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).{20,})$",
}
GAZETTEERS = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk)$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6[0-9])",
    "phone": r"^\+(?:1|7|2[0-9]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-58])",
    "secret": r"^(?:AKIA|ASIA|ghp|gho|xox|sk)",
}
CUES = {
    "email": r"(?:mail|contact|write|from|to)\W*$",
    "ip": r"(?:ip|host|address|server|from|at)\W*$",
    "card": r"(?:card|visa|pay|number|account)\W*$",
    "phone": r"(?:tel|phone|call|mobile|fax)\W*$",
    "secret": r"(?:token|key|secret|passw(?:or)?d|pwd|auth|bearer)\W*$",
}
AGAINST = {
    "email": r"(?:package|sha)\W*$",
    "ip": r"(?:version|release|section|chapter)\W*$",
    "card": r"(?:isbn|order|invoice|sha|serial)\W*$",
    "phone": r"(?:version|score|range)\W*$",
    "secret": r"(?:commit|sha|md5|digest|hash)\W*$",
}
BEFORE = 24


def _spans(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, found, before) of the pattern's matches."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.slice(F.split(text, PATTERNS[kind], -1), 1, F.size(found))
    pairs = F.zip_with(between, found, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    kinds = "array<struct<kind:string,start:long,end:long,found:string,before:string>>"
    none = F.array().cast(kinds)

    def step(acc, x):
        start = acc["at"] + F.char_length(x["p"])
        end = start + F.char_length(x["m"])
        one = F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            x["m"].alias("found"),
            F.lower(F.right(x["p"], F.lit(BEFORE))).alias("before"),
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    folded = F.aggregate(pairs, first, step, lambda acc: acc["out"])
    return F.when(FORESEEN[kind](text), folded).otherwise(none)


def _count(found: Column, characters: str) -> Column:
    return F.char_length(F.regexp_replace(found, f"[^{characters}]", ""))


def _luhn(found: Column) -> Column:
    digits = F.reverse(F.regexp_replace(found, "[^0-9]", ""))

    def add(total, k):
        d = F.substring(digits, k, F.lit(1)).cast("int")
        d = F.when(k % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return total + d

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _checks(span: Column, kind: str) -> Column:
    """Whether a match passes the base rule of its kind; for secrets, whether it mixes characters."""
    found = span["found"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return F.rlike(found, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return _luhn(found)
    if kind == "phone":
        return _count(found, "0-9").between(9, 15)
    return (_count(found, "0-9") >= 2) & (_count(found, "A-Za-z") >= 2)


def candidates(text: Column) -> Column:
    """All candidate spans of a text with their votes and features, by kind and then start."""

    def described(span, kind):
        found, before = span["found"], span["before"]
        vote = {
            "form": F.when(F.rlike(found, F.lit(FORMS[kind])), 1).otherwise(-1),
            "check": F.when(_checks(span, kind), 1).otherwise(-1),
            "gazetteer": F.when(F.rlike(found, F.lit(GAZETTEERS[kind])), 1).otherwise(0),
            "context": F.when(F.rlike(before, F.lit(CUES[kind])), 1).when(F.rlike(before, F.lit(AGAINST[kind])), -1).otherwise(0),
        }
        n = F.char_length(found)
        return F.struct(
            *(span[c].alias(c) for c in ("kind", "start", "end")),
            *(vote[v].cast("int").alias(v) for v in LABELERS),
            F.least(F.floor(n / 8), F.lit(4)).cast("int").alias("size"),
            F.floor(4 * _count(found, "0-9") / n).cast("int").alias("digits"),
        )

    text = F.coalesce(text, F.lit(""))

    def of(kind):
        return F.transform(_spans(text, kind), lambda s: described(s, kind))

    return F.concat(*map(of, KINDS))


FEATURES = ("kind", *LABELERS, "size", "digits")


def reliabilities(votes: np.ndarray, kinds: np.ndarray, counts: np.ndarray, rounds: int = 100):
    """Expectation-maximisation over vote patterns: P(true) per pattern, and P(vote | class).

    votes: patterns x labelers in -1, 0, 1. Labelers count as independent given kind and class.
    """
    share = np.clip(0.5 + votes.sum(axis=1) / (2 * votes.shape[1] + 1), 0.05, 0.95)
    names, kind = np.unique(kinds, return_inverse=True)
    for _ in range(rounds):
        logs = np.zeros((2, len(counts)))
        table = np.zeros((2, len(names), votes.shape[1], 3))
        for c, weight in enumerate((counts * (1 - share), counts * share)):
            for k in range(len(names)):
                own = kind == k
                # One pseudo-vote in three each way; labelers are held to be right more than wrong.
                logs[c, own] = np.log(weight[own].sum() + 1)
                for v in range(votes.shape[1]):
                    seen = np.array([weight[own & (votes[:, v] == x)].sum() for x in (-1, 0, 1)])
                    seen += (2, 1, 1) if c == 0 else (1, 1, 2)
                    table[c, k, v] = seen / seen.sum()
                    logs[c, own] += np.log(table[c, k, v][votes[own, v] + 1])
        share = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return share, table


def _encode(rows: list[tuple]) -> tuple[np.ndarray, list]:
    """One-hot columns for the values of each feature, and (feature, value) of each column."""
    columns = sorted({(f, r[k]) for r in rows for k, f in enumerate(FEATURES)}, key=str)
    place = {c: k for k, c in enumerate(columns)}
    x = np.zeros((len(rows), len(columns)))
    for at, r in enumerate(rows):
        x[at, [place[f, r[k]] for k, f in enumerate(FEATURES)]] = 1
    return x, columns


def fit_classifier(docs: DataFrame, rounds: int = 400, penalty: float = 0.01) -> list[tuple[str, object, float]]:
    """(feature, value, weight) of the span classifier, from the patterns of all candidates."""
    spans = docs.select(F.explode(candidates(F.col("text"))).alias("s")).select(*(F.col(f"s.{f}") for f in FEATURES))
    patterns = spans.groupBy(*FEATURES).count().collect()  # at most 5 x 3^4 x 5 x 5 rows
    if not patterns:
        return []
    patterns.sort(key=str)
    rows = [tuple(p[f] for f in FEATURES) for p in patterns]
    counts = np.array([p["count"] for p in patterns], float)
    votes = np.array([[r[1 + k] for k in range(len(LABELERS))] for r in rows])
    share, _ = reliabilities(votes, np.array([r[0] for r in rows]), counts)
    x, columns = _encode(rows)
    weights, rate = np.zeros(len(columns)), counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weights))
        gradient = x.T @ (rate * (p - share)) + penalty * weights / len(columns)
        curve = (x.T * (rate * np.maximum(p * (1 - p), 1e-6))) @ x + np.eye(len(columns)) * (penalty / len(columns))
        step = np.linalg.solve(curve, gradient)
        weights -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return [(f, v, round(float(w), 6)) for (f, v), w in zip(columns, weights)]


def spans(text: Column, classifier: list[tuple[str, object, float]]) -> Column:
    """The spans that stay: those of the base rules, and what the classifier takes on top."""

    def taken(s):
        logit = reduce(
            lambda a, b: a + b,
            (F.when(s[f] == F.lit(v), F.lit(w)).otherwise(F.lit(0.0)) for f, v, w in classifier),
            F.lit(0.0),
        )
        more = ~s["kind"].isin(*BASE_KINDS) & (s["check"] == 1) & (logit > 0)
        return _is_base(s) | more if classifier else _is_base(s)

    return F.filter(candidates(text), taken)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is_base(s: Column) -> Column:
    return s["kind"].isin(*BASE_KINDS) & (s["check"] == 1)


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): counts of the base kinds, base_sha256, spans."""
    model = fit_classifier(docs)
    found = docs.select("doc_id", spans(F.col("text"), model).alias("s"))
    base = F.filter("s", _is_base)

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, BASE_KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("s")).alias("spans"),
    )


def mask_documents(docs: DataFrame) -> DataFrame:
    """`docs` with every span of personal data in `text` replaced by its kind, as [EMAIL]."""
    text = F.coalesce("text", F.lit(""))
    found = F.array_sort(
        F.transform(spans(text, fit_classifier(docs)), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )

    def step(acc, s):
        start = F.greatest(s["start"], acc["at"])
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        inside = s["start"] < acc["at"]
        out = F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, tag))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text)))
    masked = F.when(F.size(found) > 0, F.aggregate(found, first, step, rest)).otherwise(F.col("text"))
    return docs.withColumn("text", masked)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
