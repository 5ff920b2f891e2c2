"""Cleaning of raw postings and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.bind import let, with_once
from matchlake.functions.labels import title_category
from matchlake.functions.text import clean_html, clean_text, clean_word_count, strip_ends
from matchlake.sources.readers import POSTINGS, keep_present

NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))$"
NUMBERS = ["max_salary", "min_salary", "applies", "views"]


def fill_blank(df: DataFrame, names: list[str]) -> DataFrame:
    return df.fillna("", subset=[n for n in names if n in df.columns])


def lenient_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    """Cells that are no number become null instead of failing the job. Spark's cast alone would also take
    a letter for the type after the digits (`12d`) and hexadecimal floats."""
    def number(name: str) -> Column:
        plain = F.trim(F.col(name).cast("string")).rlike(NUMBER)
        return F.when(plain, F.col(name).try_cast("double"))

    return df.withColumns({n: number(n) for n in names if n in df.columns})


def level_or_unknown(c: Column) -> Column:
    return strip_ends(F.coalesce(c, F.lit("Unknown")))


def keep_first(df: DataFrame, content: Column, id_col: str) -> DataFrame:
    """One row per distinct content, the lowest id. Each map task already keeps one row per
    content (window group limit), so a content shared by a third of all rows stays cheap."""
    order = W.partitionBy("_content").orderBy(id_col)
    return (df.withColumn("_content", F.sha2(content, 256))
            .withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_content", "_n"))


def measured_jobs(raw: DataFrame) -> DataFrame:
    """Postings that have a description, with the cleaned text and its word count."""
    df = keep_present(raw, POSTINGS).dropna(subset=["description"])
    df = with_once(df, "description_clean", clean_html(F.col("description")))
    return with_once(df, "desc_word_count", clean_word_count(F.col("description_clean")))


def clean_jobs(raw: DataFrame, min_words: int = fixed.MIN_JOB_WORDS) -> DataFrame:
    """Null drop, cleaning, length filter, category and dedup on the cleaned description."""
    df = measured_jobs(raw).filter(F.col("desc_word_count") >= min_words)
    df = df.withColumn("title_clean", clean_text(F.col("title")))
    if "formatted_experience_level" in df.columns:
        df = df.withColumn("experience_level", level_or_unknown(F.col("formatted_experience_level")))
    df = lenient_numbers(fill_blank(df, ["company_name", "location"]), NUMBERS)
    df = df.withColumn("job_category", title_category(F.col("title_clean")))
    return keep_first(df, F.col("description_clean"), "job_id")


def resume_text(df: DataFrame) -> Column:
    """The cleaned text, or the cleaned HTML where the text is too short to use."""
    text = clean_text(F.col("Resume_str"))
    if "Resume_html" not in df.columns:
        return text
    html = clean_html(F.col("Resume_html"))
    return let(text, lambda t: F.when(clean_word_count(t) < fixed.FALLBACK_WORDS, html).otherwise(t))


def clean_resumes(raw: DataFrame, min_words: int = fixed.MIN_RESUME_WORDS) -> DataFrame:
    df = with_once(raw, "resume_clean", resume_text(raw))
    df = with_once(df, "resume_word_count", clean_word_count(F.col("resume_clean")))
    return df.filter(F.col("resume_word_count") >= min_words).withColumn("Category", strip_ends(F.col("Category")))


def normalise_category(df: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
    """Mapped value, or the value itself when the map has none. The map holds one short row per
    raw label; Spark broadcasts it by its measured size."""
    m = mapping.select(F.col("raw").alias("_raw"), F.col("mapped").alias("_mapped"))
    return (df.join(m, F.col(column) == F.col("_raw"), "left")
            .withColumn(out, F.coalesce("_mapped", column)).drop("_raw", "_mapped"))


def cleaning_funnel(raw: DataFrame, min_words: int = fixed.MIN_JOB_WORDS) -> DataFrame:
    """Rows left after each cleaning step, in one pass over the raw table."""
    seen = raw.select(F.col("description").isNotNull().alias("has"), "description")
    seen = with_once(seen, "clean", clean_html(F.col("description")))
    seen = seen.select("has", F.sha2("clean", 256).alias("h"), (clean_word_count(F.col("clean")) >= min_words).alias("long"))
    # Equal rows merge before the shuffle, so the distinct count needs no second expansion.
    merged = seen.groupBy("has", "h", "long").agg(F.count("*").alias("n"))
    long_enough = F.col("has") & F.col("long")
    total = merged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("has"), F.col("n"))), F.lit(0)).alias("described"),
        F.coalesce(F.sum(F.when(long_enough, F.col("n"))), F.lit(0)).alias("long_enough"),
        F.count_if(long_enough).alias("kept"))
    return total.withColumn("removed", F.col("long_enough") - F.col("kept"))


def distinct_categories(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("category")).distinct().orderBy("category")
