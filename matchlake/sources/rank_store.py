"""A stored directory of places in a random order: which row has place p, without sorting the table for it.

Rows are in the order of md5(seed:id). The directory keeps, per prefix of that hash, the ids in order as one packed row,
and two levels of counts: rows before each coarse prefix, and rows before each fine prefix inside a coarse one. A place is
looked up in the at most 256 coarse counts, then in the counts of its coarse prefix, and only the packed rows of prefixes that are
hit are opened. So a draw costs what it draws, where `sampling.places` hashes, shuffles and sorts the whole table for it.

Packed rows are stored by coarse prefix, in a folder each: folders that no place falls in are pruned at run time, in the
others the packed ids of prefixes without a hit are dropped before they are opened. A directory stands for the ids that it
was built from; after a change of the table it is built anew.

Ids are unique. A null id has the hash of the seed alone and takes part; an empty table has no places.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.labels import hash_order
from matchlake.operators.common import hint_small

FOLDER_ROWS = 1_000_000  # tables of fewer rows have 16 folders, others 256
SETTINGS = "seed int, id_type string, digits int"
PREFIX_ROWS = 64   # ids of a packed row, on average
MAX_DIGITS = 5     # of the whole prefix: at most 2 ** 20 prefixes, 2 ** 12 to a coarse one, whatever the table's size


@dataclass(frozen=True)
class RankDirectory:
    spark: SparkSession
    path: str
    seed: int
    id_type: str
    digits: int              # hex digits of a coarse prefix
    n: int
    starts: tuple[int, ...]  # rows before each coarse prefix

    @property
    def packed(self) -> DataFrame:
        """coarse, fine, ids in order"""
        return self.spark.read.schema(_packed(self.id_type)).parquet(f"{self.path}/packed")

    @property
    def counts(self) -> DataFrame:
        """coarse, fines and the rows before each of them inside the coarse prefix"""
        return self.spark.read.parquet(f"{self.path}/counts")


def _packed(id_type: str) -> str:
    return f"fine int, ids array<{id_type}>, coarse int"


def _digits(n: int) -> tuple[int, int]:
    """Hex digits of a coarse prefix and of a fine one inside it."""
    coarse = 1 if n < FOLDER_ROWS else 2
    whole = math.ceil(math.log(max(n / PREFIX_ROWS, 1), 16))
    return coarse, min(max(whole, coarse + 1), MAX_DIGITS) - coarse


def build(ids: DataFrame, path: str, id_col: str = "doc_id", seed: int = fixed.SEED) -> RankDirectory:
    """Writes the directory of a table's ids. One exchange by prefix; a hash spreads ids evenly whatever they are."""
    digits, finer = _digits(ids.count())
    order = hash_order(seed, F.col(id_col))
    cut = ids.select(F.col(id_col).alias("id"), order.alias("order"))
    cut = cut.select("id", "order", F.conv(F.substring("order", 1, digits), 16, 10).cast("int").alias("coarse"),
                     F.conv(F.substring("order", digits + 1, finer), 16, 10).cast("int").alias("fine"))
    ordered = F.sort_array(F.collect_list(F.struct("order", "id")))
    packed = cut.groupBy("coarse", "fine").agg(F.transform(ordered, lambda x: x["id"]).alias("ids"))
    packed = packed.repartition("coarse").sortWithinPartitions("coarse", "fine")
    packed.write.mode("overwrite").partitionBy("coarse").parquet(f"{path}/packed")
    spark, id_type = ids.sparkSession, ids.schema[id_col].dataType.simpleString()
    written = spark.read.schema(_packed(id_type)).parquet(f"{path}/packed")
    sizes = written.select("coarse", "fine", F.size("ids").cast("long").alias("n"))
    upto = W.partitionBy("coarse").orderBy("fine").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    cells = F.sort_array(F.collect_list(F.struct("fine", "before")))
    levels = sizes.groupBy("coarse").agg(F.sum("n").alias("n"), cells.alias("cells"))
    levels.select("coarse", "n", F.col("cells.fine").alias("fines"), F.col("cells.before").alias("before")) \
        .write.mode("overwrite").parquet(f"{path}/counts")
    spark.createDataFrame([(seed, id_type, digits)], SETTINGS).coalesce(1).write.mode("overwrite").json(f"{path}/settings")
    return open_directory(spark, path)


def open_directory(spark: SparkSession, path: str) -> RankDirectory:
    conf = spark.read.schema(SETTINGS).json(f"{path}/settings").first()
    held = {r["coarse"]: r["n"] for r in spark.read.parquet(f"{path}/counts").select("coarse", "n").collect()}  # 256 rows at most
    starts, n = [], 0
    for c in range(16 ** conf["digits"]):
        starts.append(n)
        n += held.get(c, 0)
    return RankDirectory(spark, path, conf["seed"], conf["id_type"], conf["digits"], n, tuple(starts))


def _last_at_most(starts: Column, place: Column) -> Column:
    """Number, from 0, of the last of the rising `starts` that is not above `place`, by bisection: 13 steps do for
    2 ** 12 of them, the most that a coarse prefix has."""
    first = F.struct(F.lit(0).alias("low"), (F.size(starts) - 1).alias("high"))

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"] + 1) / 2).cast("int")
        fits = F.get(starts, middle) <= place
        return F.struct(F.when(fits, middle).otherwise(a["low"]).alias("low"),
                        F.when(fits, a["high"]).otherwise(F.greatest(middle - 1, F.lit(0))).alias("high"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(12)), first, halve)["low"]


def located(directory: RankDirectory, wanted: DataFrame) -> DataFrame:
    """`wanted` with a column `place` -> the same rows with coarse, fine and `inside`, the place in the packed row.
    Places outside 0..n-1 have no row."""
    starts = F.array(*[F.lit(s).cast("long") for s in directory.starts])
    inside = wanted.filter((F.col("place") >= 0) & (F.col("place") < directory.n))
    at = inside.withColumn("coarse", _last_at_most(starts, F.col("place")))
    at = at.withColumn("_rest", F.col("place") - F.get(starts, F.col("coarse")))
    cell = at.join(F.broadcast(directory.counts.drop("n")), "coarse")  # 256 rows, 2 ** 20 numbers at most
    cell = cell.withColumn("_i", _last_at_most(F.col("before"), F.col("_rest")))
    return cell.select(*wanted.columns, "coarse", F.get("fines", F.col("_i")).alias("fine"),
                       (F.col("_rest") - F.get("before", F.col("_i"))).cast("int").alias("inside"))


def fetch(directory: RankDirectory, wanted: DataFrame, few: bool = False) -> DataFrame:
    """The rows of `wanted` with the `doc_id` of their `place`. `few` says that they are within the broadcast bound."""
    at = located(directory, wanted)
    found = directory.packed.join(hint_small(at, few), ["coarse", "fine"])
    return found.select(*[c for c in wanted.columns if c != "place"], F.get("ids", F.col("inside")).alias("doc_id"), "place")
