"""Relevance judgments by category, by pooling, or by a grader column."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.labels import judge_prompt
from matchlake.operators import lexical, vectors as vector_ops
from matchlake.operators.cleaning import normalise_category
from matchlake.operators.common import settle
from matchlake.operators.lexical import LexicalIndex, few_queries, with_meta
from matchlake.operators.sampling import half_and_half, random_candidates, random_negatives
from matchlake.operators.vectors import VectorIndex, encode_queries
from matchlake.sources.rank_store import RankDirectory

# Task functions travel by value: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
COLUMNS = ["query_id", "query_category", "doc_id", "doc_category", "doc_title", "relevance"]


def related_pairs(spark, pairs=None) -> DataFrame:
    pairs = fixed.RELATED_PAIRS if pairs is None else pairs
    return spark.createDataFrame([tuple(sorted(p)) for p in pairs], "_low string, _high string")


def mapped_queries(queries: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """Queries with `mapped`, their category in the documents' vocabulary."""
    if mapping is None:
        return queries.withColumn("mapped", F.col("category"))
    return normalise_category(queries, mapping, "category", "mapped")


def _attach(pairs: DataFrame, queries: DataFrame, docs: DataFrame, few: bool) -> DataFrame:
    """Both sides' category and title for each pair."""
    q = queries.select("query_id", F.col("category").alias("query_category"), "mapped")
    d = docs.select("doc_id", F.col("category").alias("doc_category"), F.col("title").alias("doc_title"))
    return with_meta(pairs, d, few).fillna("", subset=["doc_category", "doc_title"]).join(q, "query_id")


def judge_by_category(queries: DataFrame, docs: DataFrame, k: int = 20, seed: int = fixed.SEED,
                      mapping: DataFrame | None = None, pairs=None) -> DataFrame:
    """k random documents per query: 3 for the same category, 1 for a related one, else 0."""
    few = few_queries(queries, k)
    queries = mapped_queries(queries, mapping)
    drawn = random_candidates(queries.select("query_id"), docs, k, seed, few).select("query_id", "doc_id")
    rows = _attach(drawn, queries, docs, few)
    related = related_pairs(docs.sparkSession, pairs).withColumn("_related", F.lit(True))
    low, high = F.least("mapped", "doc_category"), F.greatest("mapped", "doc_category")
    rows = rows.join(related, (low == F.col("_low")) & (high == F.col("_high")), "left")
    grade = F.when(F.col("doc_category") == F.col("mapped"), 3).when(F.col("_related"), 1).otherwise(0)
    return rows.withColumn("relevance", grade).select(*COLUMNS)


def judge_pooled(queries: DataFrame, docs: DataFrame, index: LexicalIndex, vectors: VectorIndex | None = None,
                 k: int = 20, n_negatives: int = 5, seed: int = fixed.SEED, mapping: DataFrame | None = None,
                 query_vectors: DataFrame | None = None, directory: RankDirectory | None = None) -> DataFrame:
    """Both rankings' top k and a few random negatives per query: 3 for the same category, else 0. With a stored
    `directory` of the documents the negatives are looked up, not sorted out of the whole table."""
    few = few_queries(queries, max(2 * k + n_negatives, fixed.MAX_QUERY_TERMS))
    queries = mapped_queries(queries, mapping)
    pool = lexical.search(index, queries, k, few=few).select("query_id", "doc_id")
    if vectors is not None:
        asked = encode_queries(queries, vectors.encoder) if query_vectors is None else query_vectors
        pool = pool.union(vector_ops.search_vectors(asked, vectors.vectors, k).select("query_id", "doc_id")).distinct()
    pool = settle(pool, "pool")
    negatives = random_negatives(queries, docs, pool, n_negatives, seed, few, directory)
    rows = _attach(pool.unionByName(negatives), queries, docs, few)
    grade = F.when(F.col("doc_category") == F.col("mapped"), 3).otherwise(0)
    return rows.withColumn("relevance", grade).select(*COLUMNS)


def candidate_pairs(queries: DataFrame, docs: DataFrame, k: int = 20, seed: int = fixed.SEED,
                    mapping: DataFrame | None = None) -> DataFrame:
    """Half same-category, half other documents per query, with the prompt for an outside judge."""
    few = few_queries(queries, k)
    queries = mapped_queries(queries, mapping)
    asked = queries.select("query_id", F.col("mapped").alias("category"))
    drawn = half_and_half(asked, docs, k, seed, few).select("query_id", "doc_id")
    rows = _attach(drawn, queries, docs, few)
    wide = with_meta(rows, docs.select("doc_id", "description"), few).join(queries.select("query_id", "text"), "query_id")
    return wide.withColumn("prompt", judge_prompt(F.col("text"), F.col("doc_title"), F.col("description")))


Grader = Callable[[Column, Column, Column], Column]


def row_grader(score: Callable[[str, str, str], int]) -> Grader:
    """A grader from a plain function, called in Arrow batches; a pair it fails on gets 0."""
    def one(text: str, title: str, description: str) -> int:
        try:
            return int(score(text, title, description))
        except Exception:
            return 0

    @F.pandas_udf("int")
    def graded(text: pd.Series, title: pd.Series, description: pd.Series) -> pd.Series:
        return pd.Series([one(*row) for row in zip(text, title, description)], dtype="int32")

    return graded


def judge_with(pairs: DataFrame, grader: Grader) -> DataFrame:
    """Grades from `grader(text, title, description)`, a column or a pandas UDF; no answer is 0."""
    grade = F.coalesce(grader(F.col("text"), F.col("doc_title"), F.col("description")).try_cast("int"), F.lit(0))
    return pairs.withColumn("relevance", grade).select(*COLUMNS)


def grade_distribution(judgments: DataFrame) -> DataFrame:
    """Rows and percentage per grade 0..3, absent grades as 0."""
    counts = judgments.groupBy("relevance").agg(F.count("*").alias("n"))
    grades = judgments.sparkSession.range(4).select(F.col("id").cast("int").alias("relevance"))
    rows = grades.join(counts, "relevance", "left").fillna(0, subset=["n"])
    total = F.nullif(judgments.agg(F.count("*").alias("n")).scalar(), F.lit(0))
    return rows.withColumn("percent", F.coalesce(F.col("n") * 100.0 / total, F.lit(0.0)))


def relevant_share(judgments: DataFrame, threshold: int = fixed.RELEVANCE_THRESHOLD) -> DataFrame:
    hit = F.count_if(F.col("relevance") >= threshold)
    return judgments.agg(F.count("*").alias("total"), hit.alias("relevant"),
                         (hit * 100.0 / F.nullif(F.count("*"), F.lit(0))).alias("percent"))
