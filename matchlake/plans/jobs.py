"""The pipeline steps: clean, index, judge, evaluate. Every step reads and overwrites tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators import lexical, metrics
from matchlake.operators.cleaning import clean_jobs, clean_resumes
from matchlake.operators.common import settle
from matchlake.operators.judging import judge_pooled
from matchlake.operators.lexical import build_job_index, build_resume_index
from matchlake.operators.sampling import stratified_queries, stratified_sample
from matchlake.operators.vectors import Encoder, HashingEncoder, build_job_vectors, build_resume_vectors
from matchlake.sources import index_store, rank_store, readers


@dataclass(frozen=True)
class Layout:
    """Where the steps keep their tables, below one folder."""
    root: str

    def __getattr__(self, table: str) -> str:
        if table.startswith("__"):
            raise AttributeError(table)
        return f"{self.root}/{table}"


def clean(jobs: DataFrame | None, resumes: DataFrame | None, out: Layout) -> bool:
    """Cleaned tables and the category map; nothing is written when an input is missing."""
    if jobs is None or resumes is None:
        return False
    readers.write_table(clean_jobs(jobs), out.jobs)
    readers.write_table(clean_resumes(resumes), out.resumes)
    readers.write_category_map(readers.category_map(jobs.sparkSession), out.category_map)
    return True


def build_indexes(spark: SparkSession, out: Layout, encoder: Encoder | None = None, n_jobs: int | None = None,
                  partitions: int | None = None, term_parts: int = 16, with_vectors: bool = True) -> bool:
    """Lexical and, if wanted, vector indexes of both tables, of a stratified sample of jobs when `n_jobs` is given."""
    jobs = readers.read_if_exists(spark.read.parquet, out.jobs)
    resumes = readers.read_if_exists(spark.read.parquet, out.resumes)
    if jobs is None or resumes is None:
        return False
    encoder = encoder or HashingEncoder()
    rank_store.build(jobs.select("job_id"), out.jobs_ranks, "job_id")
    if n_jobs:
        jobs = stratified_sample(jobs, "job_id", "job_category", n_jobs)
    store = index_store
    store.save_lexical(build_job_index(jobs, partitions=partitions), out.jobs_lexical, term_parts=term_parts)
    store.save_lexical(build_resume_index(resumes, partitions=partitions), out.resumes_lexical, term_parts=term_parts)
    if with_vectors:
        store.save_vectors(build_job_vectors(jobs, encoder), out.jobs_vectors)
        store.save_vectors(build_resume_vectors(resumes, encoder), out.resumes_vectors)
    return True


def resume_queries(resumes: DataFrame) -> DataFrame:
    return resumes.select(F.col("ID").alias("query_id"), F.col("Category").alias("category"),
                          F.col("resume_clean").alias("text"))


def job_docs(jobs: DataFrame) -> DataFrame:
    return jobs.select(F.col("job_id").alias("doc_id"), "title", F.col("job_category").alias("category"))


def judge(spark: SparkSession, out: Layout, num_queries: int = 50, k: int = 20, encoder: Encoder | None = None) -> None:
    """Pooled judgments for a stratified sample of profiles; pools are lexical alone where there are no vectors."""
    resumes, jobs = spark.read.parquet(out.resumes), spark.read.parquet(out.jobs)
    queries = settle(resume_queries(stratified_queries(resumes, "ID", "Category", num_queries)), "queries")
    vectors = readers.read_if_exists(lambda p: index_store.open_vectors(spark, p, encoder or HashingEncoder()), out.jobs_vectors)
    rows = judge_pooled(queries, job_docs(jobs), index_store.open_lexical(spark, out.jobs_lexical),
                        vectors, k,
                        mapping=readers.read_category_map(spark, out.category_map),
                        directory=rank_store.open_directory(spark, out.jobs_ranks))
    readers.write_table(rows, out.judgments)


def evaluate(spark: SparkSession, out: Layout, k: int = 50, encoder: Encoder | None = None) -> DataFrame:
    """The report of the lexical ranking at depth k; judgments are made first when there are none."""
    if readers.read_if_exists(spark.read.parquet, out.judgments) is None:
        judge(spark, out, encoder=encoder)
    judgments = readers.judgments(spark.read.parquet(out.judgments))
    index = index_store.open_lexical(spark, out.jobs_lexical)
    queries = resume_queries(spark.read.parquet(out.resumes))
    rows = metrics.evaluate(judgments, lambda q: lexical.search(index, q, k), queries)
    return metrics.report(metrics.aggregate(rows))


def run_all(spark: SparkSession, jobs: DataFrame | None, resumes: DataFrame | None, out: Layout,
            encoder: Encoder | None = None, **index_options) -> DataFrame | None:
    """All steps in a row; further options are those of `build_indexes`."""
    if not (clean(jobs, resumes, out) and build_indexes(spark, out, encoder, **index_options)):
        return None
    judge(spark, out, encoder=encoder)
    return evaluate(spark, out, encoder=encoder)
