"""Words, null-safe keys and the package for executors, which several operators use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: white space that separates words; a word is a run of other characters.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a whole text as an array; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_total(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(c: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keyed(c: Column) -> Column:
    """A string key that is never null: null becomes '', any other value gets a mark in front."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with the least hash of the keys, or some fewer of a table above 2 * n rows: only rows below a hash
    that about 1.5 * n rows stay under are sorted, so what is gathered does not grow with the table."""
    rows, order = df.count(), F.xxhash64(*keys)
    if rows > 2 * n:
        df = df.filter(order < F.lit(-(1 << 63) + int((1 << 64) * (1.5 * n + 50) / rows)))
    return df.orderBy(order, *keys).limit(n)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that tasks can import it."""
    _shipped(spark.sparkContext.applicationId, spark)


@cache
def _shipped(app: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="matchlake-"), f"{package.name}-package.zip")  # Spark sends it from here
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
