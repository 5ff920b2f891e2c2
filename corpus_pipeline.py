"""A training corpus from `documents`: quality, near-duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of `documents`.

Null ids and repeated ids are safe. Where a verdict is a row's own (quality, mixing), rows are told apart by a digest
of doc_id and text, and rows that are equal in both share it. Where rows meet each other (near-duplicates, passages),
every row gets a number of its own, in the order of doc_id, rows without one last; of equal ids the order is that of a
hash of the text. Defined cases: a null text counts as empty; extra columns are dropped; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import mixing, packing, quality, simhash, suffixes
from matchlake.operators.common import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(*COLUMNS).withColumn("row_key", F.md5(F.concat(text("doc_id"), F.lit(":"), text("text"))))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    docs = _keyed(docs)
    rejected = quality.judge(docs, "row_key").filter(~F.col("kept")).select(F.col("doc_id").alias("row_key")).distinct()
    return docs.join(rejected, "row_key", "left_anti").select(*COLUMNS)


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with `row`, and a narrow table of `row` and `row_key`, a number that rises in the order above.

    A stage's docs are a written table, whose rows have the same `row` each time it is read. Only ids and hashes are
    sorted, by ranges of that order, so no id or text gathers in one task, however often it occurs."""
    rows = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_last(), "hash", "row"]
    keys = rows.select("row", "doc_id", F.xxhash64("text").alias("hash")).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows, settle(keys.select("row", F.monotonically_increasing_id().alias("row_key")), "numbered")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the first row."""
    rows, keys = _numbered(docs)
    found = simhash.near_duplicates(rows.select("row", "text").join(keys, "row"), "row_key").filter("doc_id = component_id")
    first = found.select(F.col("doc_id").alias("row_key")).join(keys, "row_key").select("row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier row holds. A character whose bytes are left in part goes with the
    passage, and so does a document of which nothing is left."""
    rows, keys = _numbered(docs)
    found = suffixes.dedup(rows.select("row", "text").join(keys, "row"), "row_key").filter("n_removed > 0")
    changed = found.select(F.col("doc_id").alias("row_key"), F.col("kept").alias("new")).join(keys, "row_key").drop("row_key")
    out = rows.join(changed, "row", "left")
    return out.filter("new is null or new <> ''").select(
        "doc_id", F.coalesce("new", "text").alias("text"), "lang", "source",
        F.when(F.col("new").isNull(), F.col("n_chars")).otherwise(F.length("new")).cast("long").alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: whole epochs, and the one that the cut falls into if at least half
    of it is taken. A document without words is taken 0 times."""
    docs = _keyed(docs)
    taken = mixing.mix(docs, "row_key").filter("size > 0").groupBy(F.col("doc_id").alias("row_key")).agg(
        F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("copies")).filter("copies > 0")
    found = docs.join(taken, "row_key")
    return found.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of tokens."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", simhash_near_dedup),
          ("suffix-array dedup", suffix_array_dedup), ("mixing sources to target weights", source_mixing),
          ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None  # fingerprints, suffix order and tokenizers are beyond SQL; tests hold a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
