"""Exact random samples in a reproducible hash order.

Every row gets its place in the order of md5(seed:id) from two small steps: a count per hash
prefix, then a row number inside the prefix. Both spread evenly whatever the data, so taking n rows,
n per category, or a run of places per query is a filter or an equi-join on the place; no task sorts
the table and no query meets every row. The places of a query are its own: k distinct numbers below the
number of rows, every set of k equally likely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.labels import hash_order, wide_number
from matchlake.operators.common import BROADCAST_ROWS, hint_small
from matchlake.sources.rank_store import RankDirectory, fetch

PREFIX = 4  # hex digits: at most 65,536 prefixes


def places(df: DataFrame, order: Column, id_col: str, keys: tuple[str, ...] = (), first: int | Column | None = None,
           prefix: int = PREFIX, beside: DataFrame | None = None) -> DataFrame:
    """Adds `place` (0.. per key, by `order`) and `places` (rows of the key), and the columns of
    `beside`, one row per key, which joins the small table of prefixes rather than the rows.

    `first` asks for places below it only: prefixes that start later are dropped before the sort."""
    cut = df.withColumn("_order", order).withColumn("_prefix", F.substring("_order", 1, prefix))
    counts = cut.groupBy(*keys, "_prefix").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, "_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(W.partitionBy(*keys)).alias("places"))
    if beside is not None:
        starts = starts.join(beside, list(keys))
    if first is not None:
        starts = starts.filter(F.col("_start") < first)
    # Without keys the table of starts has at most 16 ** prefix rows.
    bounded = not keys and 16 ** prefix <= BROADCAST_ROWS
    inside = W.partitionBy(*keys, "_prefix").orderBy("_order", id_col)
    out = (cut.join(hint_small(starts, bounded), [*keys, "_prefix"])
           .withColumn("place", F.col("_start") + F.row_number().over(inside) - 1).drop("_prefix", "_start"))
    return (out if first is None else out.filter(F.col("place") < first)).drop("_order")


def simple_sample(df: DataFrame, id_col: str, n: int, seed: int = fixed.SEED) -> DataFrame:
    """n random rows, or all of a smaller table."""
    return places(df, hash_order(seed, F.col(id_col)), id_col, first=n).drop("place", "places")


def _n_categories(df: DataFrame, category: str) -> Column:
    return df.agg(F.count_distinct(category).alias("n")).scalar()


def _fetch(df: DataFrame, ids: DataFrame, id_col: str, at_most: int) -> DataFrame:
    """Whole rows of sampled ids; ids are sampled from narrow columns so that text is never shuffled."""
    return df.join(hint_small(ids.select(id_col), at_most <= BROADCAST_ROWS), id_col, "left_semi")


def stratified_queries(df: DataFrame, id_col: str, category: str, n: int, seed: int = fixed.SEED) -> DataFrame:
    """max(2, n div categories) random rows of each category, shuffled and cut to n. Rows without a category are not
    drawn, but count as one category in the share."""
    unnamed = df.agg(F.coalesce(F.max(F.col(category).isNull().cast("int")), F.lit(0)).alias("n")).scalar()
    per = F.greatest(F.lit(2), F.floor(F.lit(n) / F.greatest(_n_categories(df, category) + unnamed, F.lit(1))))
    named = df.select(id_col, category).filter(F.col(category).isNotNull())
    picked = places(named, hash_order(seed, F.col(id_col)), id_col, (category,), first=per)
    return _fetch(df, simple_sample(picked.select(id_col), id_col, n, seed), id_col, n)


def stratified_sample(df: DataFrame, id_col: str, category: str | None, n: int, seed: int = fixed.SEED) -> DataFrame:
    """max(1, n div categories) random rows of each category, topped up from the rest and cut to n.
    Rows without a category only serve as top-up."""
    if category is None or category not in df.columns:
        return simple_sample(df, id_col, n, seed)
    order = hash_order(seed, F.col(id_col))
    per = F.greatest(F.lit(1), F.floor(F.lit(n) / F.greatest(_n_categories(df, category), F.lit(1))))
    key = F.coalesce(F.concat(F.lit("c"), F.col(category)), F.lit("none"))
    ranked = places(df.select(id_col, key.alias("_key")), order, id_col, ("_key",))
    tier = F.when((F.col("_key") != "none") & (F.col("place") < per), F.lit("0")).otherwise(F.lit("1"))
    tiered = ranked.select(id_col, tier.alias("_tier"))
    return _fetch(df, places(tiered, F.concat("_tier", order), id_col, first=n, prefix=PREFIX + 1), id_col, n)


def chosen(seed: int, use: str, query_id: Column, k: Column, n: Column) -> Column:
    """k distinct numbers of 0..n-1 for a query, by Floyd's method: step i draws one of the first n - k + i + 1
    numbers, and takes the last of these if the drawn one is there already."""
    def step(taken: Column, i: Column) -> Column:
        last = n - k + i
        drawn = F.pmod(wide_number(hash_order(seed, F.lit(use), query_id, i)), last + 1)
        return F.array_append(taken, F.when(F.array_contains(taken, drawn), last).otherwise(drawn))

    none = F.array().cast("array<bigint>")
    return F.when(k > 0, F.aggregate(F.sequence(F.lit(0), k.cast("int") - 1), none, step)).otherwise(none)


def random_candidates(queries: DataFrame, docs: DataFrame, k: int, seed: int = fixed.SEED,
                      few: bool = False, directory: RankDirectory | None = None) -> DataFrame:
    """(query_id, doc_id, draw): k random documents per query, drawn for each query on its own."""
    return draw(queries.withColumn("_k", F.lit(k)), docs, seed, few, directory).select("query_id", "doc_id", "draw")


def draw(queries: DataFrame, docs: DataFrame, seed: int, few: bool = False,
         directory: RankDirectory | None = None) -> DataFrame:
    """As `random_candidates` with a number of draws `_k` per query; all documents when fewer. With a stored `directory`
    of the documents only the places drawn are read."""
    if directory is not None and directory.seed != seed:
        raise ValueError(f"the directory is in the order of seed {directory.seed}, not {seed}")
    total = docs.agg(F.count("*").alias("n")).scalar() if directory is None else F.lit(directory.n).cast("long")
    wanted = queries.withColumn("_n", total).filter("_n > 0 and _k > 0")
    q = F.col("query_id")
    picked = chosen(seed, "draw", q, F.least(F.col("_k").cast("long"), F.col("_n")), F.col("_n"))
    ordered = F.sort_array(F.transform(picked, lambda p: F.struct(
        hash_order(seed, F.lit("order"), q, p).alias("order"), p.alias("place"))))
    wanted = wanted.withColumn("_all", ordered).select(
        *[c for c in queries.columns if c != "_k"], F.posexplode("_all").alias("draw", "_p"))
    wanted = wanted.withColumn("place", F.col("_p.place")).drop("_p")
    if directory is not None:
        return fetch(directory, wanted, few).drop("place")
    placed = places(docs.select("doc_id"), hash_order(seed, F.col("doc_id")), "doc_id")
    return placed.drop("places").join(hint_small(wanted, few), "place").drop("place")


def random_negatives(queries: DataFrame, docs: DataFrame, pool: DataFrame, n: int, seed: int = fixed.SEED,
                     few: bool = False, directory: RankDirectory | None = None) -> DataFrame:
    """(query_id, doc_id): n random documents outside each query's pool. Drawing n more than the
    pool holds always leaves n outside it, or every document there is."""
    sizes = pool.groupBy("query_id").agg(F.count("*").alias("_size"))
    asked = queries.select("query_id").join(sizes, "query_id", "left")
    asked = asked.select("query_id", (F.coalesce("_size", F.lit(0)) + n).alias("_k"))
    outside = draw(asked, docs, seed, few, directory).join(pool.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    order = W.partitionBy("query_id").orderBy("draw")
    return outside.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).select("query_id", "doc_id")


def half_and_half(queries: DataFrame, docs: DataFrame, k: int, seed: int = fixed.SEED,
                  few: bool = False) -> DataFrame:
    """(query_id, doc_id, same): up to k div 2 random documents of the query's `category`, the rest of
    the k from other categories. Documents are laid out category by category in random order; the
    other categories are what remains when the query's own stretch is cut out."""
    order = hash_order(seed, F.col("doc_id"))
    named = docs.select("doc_id", F.coalesce("category", F.lit("")).alias("category"))
    sizes = named.groupBy("category").agg(F.count("*").alias("_size"))
    # One row per category: the running sum is over a small aggregate.
    before = W.orderBy("category").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    placed = places(named, order, "doc_id", ("category",), beside=sizes)
    laid = placed.select("doc_id", (F.col("_offset") + F.col("place")).alias("place"))
    total = docs.agg(F.count("*").alias("n")).scalar()
    q = (queries.select("query_id", F.coalesce("category", F.lit("")).alias("category"))
         .join(sizes, "category", "left").fillna(0, subset=["_size", "_offset"]).withColumn("_total", total))
    n_same = F.least(F.lit(k // 2), F.col("_size"))
    rest = F.col("_total") - F.col("_size")
    n_other = F.least(F.lit(k) - n_same, rest)
    q = q.select("query_id", "_size", "_offset", n_same.alias("_same"), rest.alias("_rest"), n_other.alias("_other"))
    near = F.transform(chosen(seed, "same", F.col("query_id"), F.col("_same").cast("long"), F.col("_size")),
                       lambda p: F.struct((F.col("_offset") + p).alias("place"), F.lit(True).alias("same")))
    far = F.transform(chosen(seed, "other", F.col("query_id"), F.col("_other").cast("long"), F.col("_rest")),
                      lambda p: F.struct(F.when(p < F.col("_offset"), p).otherwise(p + F.col("_size")).alias("place"),
                                         F.lit(False).alias("same")))
    wanted = q.select("query_id", F.inline(F.concat(near, far)))
    return laid.join(hint_small(wanted, few), "place").select("query_id", "doc_id", "same")
