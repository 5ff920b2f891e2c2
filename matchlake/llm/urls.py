"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for all other URLs.

URLs that a rule decides are the labelled ones. Trees of depth two are grown on a bounded sample of them: features are
cut into bins, every level of a tree is one aggregate of gradients per node, feature and bin, and the trees become one
Column expression that is evaluated inside Spark's generated code. Suffix statistics are the smoothed share of blocked
URLs per host suffix, ending of the path and first folder, over all labelled URLs: one aggregate per kind, joined to
the rows. A value that no labelled URL has gets the overall share.

Defined cases: a URL that is null or has no `://` has an empty host and path, fits no rule and is judged by the trees
on empty features; a null page_id is kept; repeated rows are judged alike; an empty table gives an empty result; with
labelled URLs of one kind only, or none, the trees are constant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import bounded_sample, lower_ascii
from matchlake.operators.common import hint_small, is_at_most, settle

# The rules as (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
SAMPLE_ROWS = 10_000  # labelled URLs that the trees are fitted on, at most
ROUNDS, RATE, BINS, SMOOTH = 12, 0.4, 12, 4.0
FEATURES = ("url_length", "host_length", "path_length", "depth", "dots", "hyphens", "digit_ratio", "entropy",
            "n_params", "query_length", "has_fragment", "suffix_rate", "ending_rate", "folder_rate")
BROADCAST_VALUES = 100_000  # values with a share that are broadcast, at most
STATISTICS = ("suffix", "ending", "folder")  # columns with the share of blocked URLs per value


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows the path."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return lower_ascii(host), path, F.substring(tail, F.length(path) + 1, F.length(tail))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. Of equally long ones the later in code-point order wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        on, _, under = text.partition("/")
        fits = ((host == on) | host.endswith("." + on)) & path.startswith("/" + under)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, page_id: str, url: str, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, said and the plain features."""
    host, path, tail = split_url(F.col(url))
    base = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("u"),
                        F.explode(F.array(F.struct(host.alias("host"), path.alias("path"), tail.alias("tail")))).alias("x"))
    base = base.select("page_id", "u", "x.*")
    rule, said = matched_rule(F.col("host"), F.col("path"), rules)
    n = lambda c: F.length(c).cast("double")
    whole = F.concat("host", "path", "tail")
    size = F.greatest(n(whole), F.lit(1.0))
    only = lambda c, pattern: n(F.regexp_replace(c, pattern, ""))
    text = lower_ascii(whole)
    # Each distinct character's share of the URL.
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda x: (n(text) - n(F.replace(text, x, F.lit("")))) / size)
    bits = F.aggregate(shares, F.lit(0.0), lambda sum, p: sum - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    params = F.filter(F.split(F.regexp_extract(F.col("tail"), r"^\?([^#]*)", 1), "&"), lambda x: x != "")
    return base.select(
        "page_id", "host", "path", rule.alias("rule"), said.alias("said"), n(F.col("u")).alias("url_length"),
        n(F.col("host")).alias("host_length"), n(F.col("path")).alias("path_length"),
        only(F.col("path"), "[^/]+").alias("depth"), only(F.col("host"), "[^.]+").alias("dots"),
        only(whole, "[^-]+").alias("hyphens"), (only(whole, "[^0-9]+") / size).alias("digit_ratio"),
        F.round(bits, 6).alias("entropy"), F.size(params).cast("double").alias("n_params"),
        n(F.col("tail")).alias("query_length"), F.col("tail").contains("#").cast("double").alias("has_fragment"),
        F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"),
        F.regexp_extract(F.col("path"), r"(\.[A-Za-z0-9]+|/)?$", 0).alias("ending"),
        F.regexp_extract(F.col("path"), r"^/([^/]*)/", 1).alias("folder"))


def with_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rows with the smoothed share of blocked ones among all labelled rows that have the same value. Blocked rows of
    a frequent value are summed up before they are joined; where values are too many to broadcast, Spark's adaptive
    join splits a hot one."""
    share = labelled.agg(F.coalesce(F.avg("y"), F.lit(0.0))).first()[0]
    for c in STATISTICS:
        sums = labelled.filter(F.col(c) != "").groupBy(c).agg(F.sum("y").alias("_y"), F.count("*").alias("_n"))
        rates = settle(sums.select(c, ((F.col("_y") + SMOOTH * share) / (F.col("_n") + SMOOTH)).alias(f"{c}_rate")), "url-rates")
        rows = rows.join(hint_small(rates, is_at_most(rates, BROADCAST_VALUES)), c, "left").fillna(share, subset=[f"{c}_rate"])
    return rows


def _tree(node: tuple) -> Column:
    """(feature, edge, left, right) or a number: a CASE expression."""
    if not isinstance(node, tuple):
        return F.lit(float(node))
    feature, edge, left, right = node
    return F.when(F.col(feature) <= F.lit(edge), _tree(left)).otherwise(_tree(right))


def score(trees: list, bias: float) -> Column:
    total = F.lit(bias)
    for t in trees:
        total = total + F.lit(RATE) * _tree(t)
    return total


def _split(cells: dict, edges: list[list[float]]):
    """The best cut of a node whose gradient and weight sums per (feature, bin) are given: gain, feature, bin."""
    best = (1e-9, None, None)
    for f, cuts in enumerate(edges):
        own = [cells.get((f, b), (0.0, 0.0)) for b in range(len(cuts) + 1)]
        g_all, h_all = sum(c[0] for c in own), sum(c[1] for c in own)
        g = h = 0.0
        for b in range(len(cuts)):
            g, h = g + own[b][0], h + own[b][1]
            gain = g * g / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all * g_all / (h_all + 1)
            if gain > best[0] + 1e-9:
                best = (gain, f, b)
    return best


def fit(sample: DataFrame, features=FEATURES, rounds: int = ROUNDS) -> tuple[list, float]:
    """Boosted trees of depth two for the log-odds of `y` (1: block)."""
    total = sample.agg(F.count("*"), F.sum("y"), *[F.percentile_approx(
        f, [i / BINS for i in range(1, BINS)], 10_000) for f in features]).first()
    n, blocked = total[0], total[1] or 0.0
    if n == 0:
        return [], 0.0
    bias = math.log((blocked + 1) / (n - blocked + 1))
    if blocked in (0, n):
        return [], bias
    edges = [sorted(set(total[2 + i])) for i in range(len(features))]
    bins = F.array(*[F.struct(F.lit(i).alias("f"), sum([(F.col(f) > F.lit(e)).cast("int") for e in edges[i]], F.lit(0)).alias("b"))
                     for i, f in enumerate(features)])
    binned = settle(sample.select("y", *features, bins.alias("bins")).coalesce(2), "url-sample")

    def sums(trees: list, node: Column) -> dict:
        p = 1 / (1 + F.exp(-score(trees, bias)))
        rows = binned.select(node.alias("node"), (F.col("y") - p).alias("g"), (p * (1 - p)).alias("h"),
                             F.explode("bins").alias("x")).groupBy("node", "x.f", "x.b").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")).collect()  # nodes x features x bins rows at most
        found: dict = {0: {}, 1: {}}
        for r in sorted(rows, key=lambda r: (r.node, r.f, r.b)):
            found[r.node][(r.f, r.b)] = (r.g, r.h)
        return found

    def value(cells: dict) -> float:
        own = [v for (f, _), v in cells.items() if f == 0]
        return sum(v[0] for v in own) / (sum(v[1] for v in own) + 1)

    def leaves(cells: dict, f: int, b: int) -> list[float]:
        sides = []
        for keep in (lambda x: x <= b, lambda x: x > b):
            own = [v for (g, x), v in cells.items() if g == f and keep(x)]
            sides.append(sum(v[0] for v in own) / (sum(v[1] for v in own) + 1))
        return sides

    trees: list = []
    for _ in range(rounds):
        _, f, b = _split(sums(trees, F.lit(0))[0], edges)
        if f is None:
            break
        cut, kids = edges[f][b], []
        level = sums(trees, (F.col(features[f]) > F.lit(cut)).cast("int"))
        for side in (0, 1):
            _, g, c = _split(level[side], edges)
            kids.append(value(level[side]) if g is None else (features[g], edges[g][c], *leaves(level[side], g, c)))
        trees.append((features[f], cut, *kids))
    return trees, bias


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_score (probability that the trees give)."""
    rows = settle(parsed(pages, page_id, url, rules), "url-features")
    labelled = rows.filter(F.col("said").isNotNull()).withColumn("y", (F.col("said") == "block").cast("double"))
    sample = settle(bounded_sample(labelled, sample_rows, "page_id", "host", "path").coalesce(2), "url-labels")
    p = F.round(1 / (1 + F.exp(-score(*fit(with_rates(sample, labelled))))), 6)
    out = with_rates(rows, labelled).withColumn("block_score", p)
    verdict = F.coalesce("said", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
