"""Index tables on shared storage.

Everything a search joins on documents is bucketed by document. Postings are also partitioned, on
request, by a hash of the term: a search reads only the term partitions its queries touch (dynamic
partition pruning) and adds scores up inside a bucket without a shuffle. A term held by a third of
all documents is spread over every bucket.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.lexical import LexicalIndex, term_counts, term_part, totals
from matchlake.operators.vectors import VectorIndex

SETTINGS = ("position int, field string, weight double, b double, k1 double, stemmed boolean, "
            "buckets int, term_parts int, meta string")


def _name(path: str, *layout) -> str:
    """A table's name in the catalog. It holds the layout, so a session that knows an older one does not read a
    rebuilt folder by it."""
    return "matchlake_" + hashlib.md5(repr((path, *layout)).encode()).hexdigest()


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _write_bucketed(df: DataFrame, path: str, buckets: int, sort: str, part: str | None = None) -> None:
    name = _name(path, _columns(df), buckets, sort, part)
    df.sparkSession.sql(f"drop table if exists {name}")
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer = writer if part is None else writer.partitionBy(part)
    writer.bucketBy(buckets, "doc_id").sortBy(sort).saveAsTable(name)
    df.sparkSession.sql(f"drop table {name}")


def _open_bucketed(spark: SparkSession, path: str, columns: str, buckets: int, sort: str,
                   part: str | None = None) -> DataFrame:
    """The table below a path, declared anew: another session may have rebuilt it since."""
    name = _name(path, columns, buckets, sort, part)
    spark.sql(f"drop table if exists {name}")
    by = f"partitioned by ({part})" if part else ""
    spark.sql(f"create table {name} ({columns}) using parquet options (path '{path}') {by} "
              f"clustered by (doc_id) sorted by ({sort}) into {buckets} buckets")
    if part:
        spark.sql(f"alter table {name} recover partitions")
    return spark.table(name)


def _postings(fields: list[str], term_parts: int) -> list[str]:
    return (["doc_id bigint"] + [f"dl_{f} int" for f in fields] + ["term string"] + [f"tf_{f} int" for f in fields]
            + (["term_part int"] if term_parts else []))


def save_lexical(index: LexicalIndex, path: str, buckets: int | None = None, term_parts: int = 0) -> LexicalIndex:
    """Writes the index and returns it reading from storage. Lengths and statistics are derived from
    the written rows, so documents are tokenised once.

    At 100 TB build with as many partitions as buckets, so that a bucket of one term partition is a
    few hundred MB (for example 4096 buckets and 32 term partitions)."""
    spark, fields = index.rows.sparkSession, list(index.fields)
    buckets = buckets or index.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = index.rows.drop("term_part")
    if index.partitions != buckets:
        rows = rows.repartition(buckets, "doc_id")
    if term_parts:
        rows = rows.withColumn("term_part", term_part(F.col("term"), term_parts))
    _write_bucketed(rows, f"{path}/postings", buckets, "term", "term_part" if term_parts else None)
    _write_bucketed(index.meta.repartition(buckets, "doc_id"), f"{path}/meta", buckets, "doc_id")
    stored = _open_bucketed(spark, f"{path}/postings", ", ".join(_postings(fields, term_parts)), buckets, "term",
                            "term_part" if term_parts else None)
    # Bucketed by document: this aggregate needs no shuffle.
    lengths = stored.groupBy("doc_id").agg(*[F.first(f"dl_{f}").alias(f"dl_{f}") for f in fields])
    lengths.write.mode("overwrite").parquet(f"{path}/lengths")
    term_counts(stored).write.mode("overwrite").parquet(f"{path}/term_counts")
    totals(spark.read.parquet(f"{path}/lengths"), fields).write.mode("overwrite").parquet(f"{path}/totals")
    conf = [(i, f, w, b, index.k1, index.stemmed, buckets, term_parts, _columns(index.meta))
            for i, (f, (w, b)) in enumerate(index.fields.items())]
    spark.createDataFrame(conf, SETTINGS).coalesce(1).write.mode("overwrite").json(f"{path}/settings")
    return open_lexical(spark, path)


def open_lexical(spark: SparkSession, path: str) -> LexicalIndex:
    conf = spark.read.schema(SETTINGS).json(f"{path}/settings").orderBy("position").collect()  # a row per field
    one = conf[0]
    columns = ", ".join(_postings([r.field for r in conf], one.term_parts))
    rows = _open_bucketed(spark, f"{path}/postings", columns, one.buckets, "term",
                          "term_part" if one.term_parts else None)
    meta = _open_bucketed(spark, f"{path}/meta", one.meta, one.buckets, "doc_id")
    read = spark.read.parquet
    return LexicalIndex(rows, read(f"{path}/lengths"), read(f"{path}/totals"), read(f"{path}/term_counts"), meta,
                        {r.field: (r.weight, r.b) for r in conf}, one.k1, one.stemmed, one.term_parts, one.buckets)


def save_vectors(index: VectorIndex, path: str, buckets: int | None = None) -> VectorIndex:
    """Vectors with the encoder's name in every row (one dictionary entry in Parquet), and their metadata."""
    spark = index.vectors.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index.vectors.withColumn("model", F.lit(index.model)).write.mode("overwrite").parquet(f"{path}/vectors")
    _write_bucketed(index.meta.repartition(buckets, "doc_id"), f"{path}/meta", buckets, "doc_id")
    conf = spark.createDataFrame([(buckets, _columns(index.meta))], "buckets int, meta string")
    conf.coalesce(1).write.mode("overwrite").json(f"{path}/settings")
    return open_vectors(spark, path, index.encoder)


def open_vectors(spark: SparkSession, path: str, encoder=None) -> VectorIndex:
    conf = spark.read.schema("buckets int, meta string").json(f"{path}/settings").first()
    meta = _open_bucketed(spark, f"{path}/meta", conf.meta, conf.buckets, "doc_id")
    return VectorIndex(spark.read.parquet(f"{path}/vectors").select("doc_id", "embedding"), meta, encoder)
