"""Corpus profiles: sizes, length distributions and value counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions.text import strip_ends, strip_tags, word_count


def corpus_sizes(datasets: list[tuple[str, str, DataFrame | None]]) -> DataFrame:
    """Rows per (kind, dataset) with a total per kind and overall; an absent table counts 0."""
    spark = next((df.sparkSession for _, _, df in datasets if df is not None), None) or SparkSession.active()
    parts = []
    for kind, name, df in datasets:
        n = F.lit(0).cast("bigint") if df is None else F.count("*")
        source = spark.range(1) if df is None else df.agg(n.alias("n"))
        parts.append(source.select(F.lit(kind).alias("kind"), F.lit(name).alias("dataset"),
                                   (n if df is None else F.col("n")).alias("n")))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.rollup("kind", "dataset").agg(F.sum("n").alias("n")) \
        .select(F.coalesce("kind", F.lit("all")).alias("kind"), F.coalesce("dataset", F.lit("all")).alias("dataset"), "n")


def job_lengths(jobs: DataFrame) -> DataFrame:
    """Postings with `word_count`; 0 when the table has no description."""
    words = word_count(F.col("description")) if "description" in jobs.columns else F.lit(0)
    return jobs.withColumn("word_count", words)


def resume_lengths(resumes: DataFrame) -> DataFrame:
    """Profiles with `word_count`, of the text or else of the HTML without tags."""
    if "Resume_str" in resumes.columns:
        return resumes.withColumn("word_count", word_count(F.col("Resume_str")))
    if "Resume_html" in resumes.columns:
        return resumes.withColumn("word_count", word_count(strip_tags(F.col("Resume_html"))))
    return resumes


def length_histogram(df: DataFrame, bins: int, column: str = "word_count") -> DataFrame:
    """(bin, low, high, n) over equal bins from the least to the greatest positive count, the last
    closed. A single value sits in the middle of a range one wide."""
    values = df.filter(F.col(column) > 0).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    # One row per distinct length from here on, and at most `bins` after the next count.
    whole = W.partitionBy()
    ends = values.withColumn("_min", F.min("v").over(whole)).withColumn("_max", F.max("v").over(whole))
    half = F.when(F.col("_min") == F.col("_max"), 0.5).otherwise(0.0)
    ends = ends.select("v", "n", (F.col("_min") - half).alias("_lo"), (F.col("_max") + half).alias("_hi"))
    at = F.least(F.floor((F.col("v") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1))
    filled = ends.groupBy("_lo", "_hi", at.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    table = filled.agg(F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
                       F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    rows = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return rows.select("bin", (F.col("_lo") + F.col("bin") * width).alias("low"),
                       (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"),
                       F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).alias("n"))


def length_stats(df: DataFrame, column: str = "word_count") -> DataFrame:
    """Number, median and mean of positive counts, cut to whole numbers. Equal counts merge first, so
    the exact median sees one row per distinct length."""
    values = df.filter(F.col(column) > 0).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    return values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      F.floor(F.percentile("v", F.lit(0.5), F.col("n"))).cast("bigint").alias("median"),
                      F.floor(F.sum(F.col("v") * F.col("n")) / F.sum("n")).cast("bigint").alias("mean"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their count, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def split_values(c: Column, sep: str = ",") -> Column:
    return F.filter(F.transform(F.split(c, sep), strip_ends), lambda x: x != "")


def top_values(df: DataFrame, *columns: str, n: int = 20) -> DataFrame | None:
    """The n most frequent entries of a comma-separated column, the first one the table has."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return None
    rows = df.select(F.explode_outer(split_values(F.col(present[0]))).alias("value")).filter("value is not null")
    return value_counts(rows, "value").limit(n)
