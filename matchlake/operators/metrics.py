"""Ranking quality: P@k, NDCG@k, average precision, their means and deviations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed

RANK_BLOCK = 65_536
Retriever = Callable[[DataFrame], DataFrame]


def gain(relevance: Column, rank: Column) -> Column:
    return (F.pow(F.lit(2.0), relevance) - 1.0) / F.log2(rank + 1.0)


def _at(k: int, value: Column, rank: str = "rank") -> Column:
    return F.sum(F.when(F.col(rank) <= k, value))


def _found(seen: DataFrame, keys: list[str], relevant: Column, k_values: tuple[int, ...]) -> DataFrame:
    """Sums over the judged documents a ranking found. Hits are numbered inside blocks of ranks and
    the blocks' own counts added afterwards, so one very long ranking spreads over many tasks."""
    rank, is_hit = F.col("rank"), relevant.cast("int")
    blocks = seen.withColumn("_block", F.floor(rank / RANK_BLOCK))
    inside = W.partitionBy(*keys, "_block").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = blocks.withColumn("_i", F.sum(is_hit).over(inside))
    sums = {f"_hits_{k}": F.sum(F.when(relevant & (rank <= k), 1)) for k in k_values}
    sums |= {f"_dcg_{k}": _at(k, gain(F.col("relevance"), rank)) for k in k_values}
    per_block = blocks.groupBy(*keys, "_block").agg(
        *[c.alias(n) for n, c in sums.items()], F.sum(is_hit).alias("_n"),
        F.sum(F.when(relevant, 1.0 / rank)).alias("_inverse"), F.sum(F.when(relevant, F.col("_i") / rank)).alias("_own"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    per_block = per_block.withColumn("_earlier", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return per_block.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], F.sum(F.col("_earlier") * F.col("_inverse") + F.col("_own")).alias("_precision"))


def per_query(judgments: DataFrame, ranked: DataFrame, known: DataFrame | None = None,
              k_values: tuple[int, ...] = fixed.K_VALUES, threshold: int = fixed.RELEVANCE_THRESHOLD,
              modes: tuple[str, ...] | None = None) -> DataFrame:
    """Metrics of every judged (and known) query, in one pass for all k.

    `judgments(query_id, doc_id, relevance)` has one row per pair; `ranked` has ranks from 1. With
    `modes`, `ranked` has a `mode` column and every query gets a row per mode. A query without
    results scores 0."""
    judged = judgments.select("query_id", "doc_id", "relevance")
    if known is not None:
        judged = judged.join(known.select("query_id").distinct(), "query_id", "left_semi")
    keys = ["query_id"] if modes is None else ["mode", "query_id"]
    relevant = F.col("relevance") >= threshold
    deepest = max([*k_values, 1])
    # Only the best grades of a query can enter an ideal list: each task cuts to them first.
    ideal_order = W.partitionBy("query_id").orderBy(F.col("relevance").desc(), "doc_id")
    ideal = judged.withColumn("_i", F.row_number().over(ideal_order)).filter(F.col("_i") <= deepest)
    ideal = ideal.groupBy("query_id").agg(
        *[_at(k, gain(F.col("relevance"), F.col("_i")), "_i").alias(f"_ideal_{k}") for k in k_values])
    base = judged.groupBy("query_id").agg(F.count_if(relevant).alias("_n_relevant")).join(ideal, "query_id")
    if modes is not None:
        base = base.withColumn("mode", F.explode(F.array(*[F.lit(m) for m in modes])))
    found = _found(ranked.select(*keys, "doc_id", "rank").join(judged, ["query_id", "doc_id"]), keys, relevant, k_values)
    rows = base.join(found, keys, "left")
    zero = F.lit(0.0)
    metrics = []
    for k in k_values:
        metrics.append((F.coalesce(F.col(f"_hits_{k}"), F.lit(0)) / F.nullif(F.lit(k), F.lit(0))).alias(f"p_at_{k}"))
        metrics.append(F.coalesce(F.col(f"_dcg_{k}") / F.nullif(F.col(f"_ideal_{k}"), zero), zero)
                       .alias(f"ndcg_at_{k}"))
    average = F.coalesce(F.col("_precision") / F.nullif(F.col("_n_relevant"), F.lit(0)), zero)
    return rows.select(*keys, *metrics, average.alias("ap")).fillna(0.0)


def metric_names(metrics: DataFrame) -> list[str]:
    return [c for c in metrics.columns if c not in ("mode", "query_id")]


def aggregate(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean and population deviation per metric, MAP and the number of queries."""
    stats = [c for m in metric_names(metrics) for c in (
        F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}"))]
    return metrics.groupBy(*by).agg(F.count("*").alias("num_queries"),
                                    F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map"), *stats)


def _label(metric: str) -> str:
    return "AP" if metric == "ap" else metric.replace("_at_", "@").upper()


def report(aggregated: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per metric, by name and MAP last: (position, metric, mean, std)."""
    names = sorted((c.removeprefix("mean_") for c in aggregated.columns if c.startswith("mean_")), key=_label)
    lines = [F.struct(F.lit(i).alias("position"), F.lit(_label(n)).alias("metric"),
                      F.col(f"mean_{n}").alias("mean"), F.col(f"std_{n}").alias("std")) for i, n in enumerate(names, 1)]
    lines.append(F.struct(F.lit(len(names) + 1).alias("position"), F.lit("MAP").alias("metric"),
                          F.col("map").alias("mean"), F.lit(None).cast("double").alias("std")))
    return aggregated.select(*by, F.inline(F.array(*lines)))


def evaluate(judgments: DataFrame, retriever: Retriever, queries: DataFrame, **options) -> DataFrame:
    """Per-query metrics of a retriever, which gets all judged queries at once."""
    asked = queries.join(judgments.select("query_id").distinct(), "query_id", "left_semi")
    return per_query(judgments, retriever(asked), queries, **options)


def compare(judgments: DataFrame, retrievers: dict[str, Retriever], queries: DataFrame,
            k_values: tuple[int, ...] = (5, 10)) -> DataFrame:
    """(metric, one column per retriever) of means, side by side."""
    asked = queries.join(judgments.select("query_id").distinct(), "query_id", "left_semi")
    parts = [r(asked).select(F.lit(name).alias("mode"), "query_id", "doc_id", "rank") for name, r in retrievers.items()]
    ranked = parts[0]
    for p in parts[1:]:
        ranked = ranked.unionByName(p)
    modes = tuple(retrievers)
    means = report(aggregate(per_query(judgments, ranked, queries, k_values, modes=modes), ("mode",)), ("mode",))
    return means.filter("metric <> 'AP'").groupBy("metric").pivot("mode", list(modes)).agg(F.first("mean"))
