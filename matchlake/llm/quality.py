"""Weak supervision of document quality: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at a few counts of a whole text and votes good (1), bad (-1) or abstains (0). A rule has two accuracies:
how often its vote is right on good and on bad documents. Expectation-maximisation estimates them and the share of
good documents without labels, and a document's quality is the posterior probability that it is good. A document passes
if that is at least the threshold, so one odd count does not reject it, as all-must-pass filters would.

The votes of all documents are counted per vote pattern first. There are at most 3 ** (number of rules) patterns
however large the corpus is, and every iteration is one aggregate over that table. All of it is DataFrame functions.

Defined cases: a null or blank text has no words and fails the base rules; a null doc_id is kept as null; repeated
rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import words
from matchlake.operators.common import settle

# Fixed value: characters of plain prose.
ORDINARY = r"[\p{L}\p{N}\x20\x09-\x0D.,;:'\"()-]+"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
ITERATIONS = 12
# Before the first iteration: how often a vote on a good document says good, a vote on a bad one says bad, and the
# share of good documents.
START = (0.95, 0.5, 0.75)
LEAST, MOST = 0.02, 0.98  # rates stay in here: no rule is ever certain
THRESHOLD = 0.5

# name: (SQL condition for a good vote, SQL condition for a bad vote); counts are those of `counts`.
RULES = {
    "length": ("n_words >= 80", "n_words < 20"),
    "word_length": ("word_chars >= 3 * n_words AND word_chars <= 9 * n_words",
                    "word_chars < 2 * n_words OR word_chars > 13 * n_words"),
    "symbols": ("100 * n_symbols <= word_chars", "100 * n_symbols > 4 * word_chars"),
    "digits": ("100 * n_digits <= 10 * word_chars", "100 * n_digits > 30 * word_chars"),
    "capitals": ("100 * n_capitals <= 15 * word_chars", "100 * n_capitals > 40 * word_chars"),
    "marks": ("50 * n_marks <= n_words", "10 * n_marks > n_words"),
    "lines": ("20 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "odd": ("50 * n_odd <= word_chars", "50 * n_odd > 2 * word_chars"),
    "repeats": ("10 * n_repeat_words <= 2 * n_words", "10 * n_repeat_words > 4 * n_words"),
}


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window that is found at least twice in the array.

    Windows are compared by a 64-bit hash. Sorting (hash, place) puts equal windows side by side; the places of
    repeated ones, sorted, cover `window` words each, less what the next one covers."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window),
                         lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(window)]))
    # A one-element array binds a value that is used several times, so that it is computed once.
    bound = lambda value, f: F.transform(F.array(value), f)[0]

    def twins(a: Column) -> Column:
        twin = lambda x, j: F.coalesce(F.get(a, j)["h"] == x["h"], F.lit(False))
        return F.filter(a, lambda x, i: twin(x, i - 1) | twin(x, i + 1))

    def total(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")), lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(window), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = bound(placed, lambda a: F.sort_array(F.transform(twins(a), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(total(places))

    return F.when(F.size(w) < window + 1, 0).otherwise(bound(hashes, covered)).cast("long")


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts that the rules use, from whole texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = lambda c: F.length(c).cast("long")
    kept = lambda pattern: size(F.regexp_replace(t, pattern, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # A generator's output is computed once; a plain column would be inlined into every use.
    base = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t"),
                       F.explode(F.array(F.struct(words(t).alias("w"), lines.alias("l")))).alias("x"))
    t = F.col("t")
    w, l = F.col("x.w"), F.col("x.l")
    return base.select(
        "doc_id", F.size(w).cast("long").alias("n_words"), size(F.array_join(w, "")).alias("word_chars"),
        kept("[^#*$%&|<>]+").alias("n_symbols"), kept("[^0-9]+").alias("n_digits"), kept("[^A-Z]+").alias("n_capitals"),
        kept(r"[^!|]+").alias("n_marks"),
        kept(ORDINARY).alias("n_odd"), F.size(l).cast("long").alias("n_lines"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"))


def vote(rule: str) -> str:
    good, bad = RULES[rule]
    return f"CASE WHEN n_words = 0 THEN 0 WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END"


def weights(on_good: float, on_bad: float) -> tuple[float, float]:
    """What a good and a bad vote of a rule add to the log-odds."""
    return math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)


def _posterior(rates: list[tuple[float, float]], good: float) -> Column:
    odds = F.lit(math.log(good / (1 - good)))
    for i, (yes, no) in enumerate(weights(*r) for r in rates):
        odds = odds + F.when(F.col(f"v{i}") == 1, yes).when(F.col(f"v{i}") == -1, no).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, iterations: int = ITERATIONS) -> tuple[list[tuple[float, float]], float]:
    """Per rule the rates of right votes on good and on bad documents, and the share of good documents, from vote
    patterns v0.. and their number n. Two pseudo-votes keep a rate defined where a rule never votes."""
    rates, good = [START[:2]] * len(RULES), START[2]
    inside = lambda x: min(max(x, LEAST), MOST)
    for _ in range(iterations):
        p, n = F.col("p"), F.col("n")
        sums = {"total": F.sum(n), "good": F.sum(n * p)}
        for i in range(len(RULES)):
            v = F.col(f"v{i}")
            sums |= {f"g{i}": F.sum(n * F.when(v != 0, p).otherwise(0.0)), f"gg{i}": F.sum(n * F.when(v == 1, p).otherwise(0.0)),
                     f"b{i}": F.sum(n * F.when(v != 0, 1 - p).otherwise(0.0)), f"bb{i}": F.sum(n * F.when(v == -1, 1 - p).otherwise(0.0))}
        row = patterns.withColumn("p", _posterior(rates, good)).agg(*[s.alias(k) for k, s in sums.items()]).first()
        if not row["total"]:
            break
        good = inside(row["good"] / row["total"])
        rates = [(inside((row[f"gg{i}"] + 1) / (row[f"g{i}"] + 2)), inside((row[f"bb{i}"] + 1) / (row[f"b{i}"] + 2)))
                 for i in range(len(RULES))]
    return rates, good


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", iterations: int = ITERATIONS,
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the counts, base_failed, quality (posterior) and kept."""
    counted = settle(counts(docs, doc_id, text), "quality-counts")
    votes = {f"v{i}": F.expr(vote(r)) for i, r in enumerate(RULES)}
    voted = counted.withColumns(votes)
    patterns = settle(voted.groupBy(*votes).agg(F.count("*").alias("n")), "quality-patterns").coalesce(1)  # 3 ** 9 rows at most
    quality = F.round(_posterior(*estimate(patterns, iterations)), 6)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return voted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), quality.alias("quality"),
                        (~failed & (quality >= threshold)).alias("kept"))
