"""Readers and writers for the raw and derived tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.text import strip_ends, strip_tags, word_count

POSTINGS = ["job_id", "title", "description", "company_name", "location", "max_salary", "min_salary",
            "formatted_experience_level", "formatted_work_type", "applies", "views"]
LARGE_POSTINGS = ["job_link", "job_title", "company", "job_location", "job_level", "job_type"]
JUDGMENT_SCHEMA = ("query_id bigint, query_category string, doc_id string, doc_category string, "
                   "doc_title string, relevance int")


def read_if_exists(read, *paths: str) -> DataFrame | None:
    """The first readable path, or None when every path is missing."""
    for path in paths:
        try:
            return read(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return None


def pick(df: DataFrame, *names: str, default: str | None = "") -> Column:
    """The first of the named columns the table has, else a constant."""
    for n in names:
        if n in df.columns:
            return F.col(n)
    return F.lit(default)


def keep_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def blank_missing(df: DataFrame) -> DataFrame:
    """String cells holding a missing-value marker become null."""
    return df.select(*[F.when(F.trim(c).isin(*fixed.NA_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if t == "string" else F.col(c) for c, t in df.dtypes])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted multi-line CSV with a header; every column is read as text, then blanks are nulled."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return blank_missing(raw)


def read_postings(spark: SparkSession, *paths: str) -> DataFrame | None:
    """Raw postings from the first path that exists."""
    df = read_if_exists(lambda p: read_csv(spark, p), *paths)
    return df if df is None else keep_present(df, POSTINGS).withColumn("job_id", F.col("job_id").try_cast("bigint"))


def read_resumes(spark: SparkSession, *paths: str) -> DataFrame | None:
    df = read_if_exists(lambda p: read_csv(spark, p), *paths)
    return df if df is None else df.withColumn("ID", F.col("ID").try_cast("bigint"))


def read_large_postings(spark: SparkSession, path: str, skills_path: str | None = None):
    """Only the wanted columns a file has, with its skills table when there is one."""
    jobs = keep_present(read_csv(spark, path), LARGE_POSTINGS)
    skills = read_if_exists(lambda p: read_csv(spark, p), skills_path) if skills_path else None
    return jobs, skills


def parse_delimited(lines: DataFrame) -> DataFrame:
    """`id:::label;label:::text` lines in column `value`; lines of another shape are dropped."""
    parts = lines.select(F.split(strip_ends(F.col("value")), ":::").alias("p")).filter(F.size("p") >= 3)
    labels = F.filter(F.transform(F.split(F.get("p", F.lit(1)), ";"), strip_ends), lambda x: x != "")
    return parts.select(
        strip_ends(F.get("p", F.lit(0))).alias("id"),
        labels.alias("occupations"),
        strip_ends(F.get("p", F.lit(1))).alias("occupation_str"),
        strip_tags(strip_ends(F.get("p", F.lit(2)))).alias("text"),
    ).withColumns({"word_count": word_count(F.col("text")), "num_labels": F.size("occupations")})


def read_delimited(spark: SparkSession, path: str) -> DataFrame | None:
    df = read_if_exists(lambda p: spark.read.text(p), path)
    return df if df is None else parse_delimited(df)


def first_rows(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """The first n rows in id order; a distributed table has no file order."""
    return df.orderBy(id_col).limit(n)


def category_map(spark: SparkSession, pairs: dict[str, str] | None = None) -> DataFrame:
    pairs = fixed.CATEGORY_MAP if pairs is None else pairs
    return spark.createDataFrame(sorted(pairs.items()), "raw string, mapped string")


def write_category_map(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_category_map(spark: SparkSession, path: str) -> DataFrame:
    """An empty map when none was written: every category then stands for itself."""
    found = read_if_exists(lambda p: spark.read.schema("raw string, mapped string").json(p), path)
    return category_map(spark, {}) if found is None else found


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":  # blanks around a cell are part of it
        writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        writer.parquet(path)


def judgments(df: DataFrame) -> DataFrame:
    """One typed row per (query, doc): ids that are not numbers are hashed, the best grade wins."""
    doc = F.trim(F.col("doc_id").cast("string"))
    typed = df.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        F.coalesce(F.when(doc.rlike("^[0-9]+$"), doc.try_cast("bigint")), F.xxhash64(doc)).alias("doc_id"),
        F.col("relevance").cast("int").alias("relevance"))
    return typed.groupBy("query_id", "doc_id").agg(F.max("relevance").alias("relevance"))


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """Judgments from a CSV with a header."""
    raw = spark.read.schema(JUDGMENT_SCHEMA).option("header", True).option("multiLine", True) \
        .option("escape", '"').csv(path)
    return judgments(raw)
