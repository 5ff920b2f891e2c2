"""Blending lexical and vector rankings; matching whole query batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.labels import display_score, search_link
from matchlake.functions.text import NS, text_or_empty
from matchlake.operators import lexical
from matchlake.operators.common import settle, top_k
from matchlake.operators.lexical import LexicalIndex, few_queries, with_meta
from matchlake.operators.vectors import VectorIndex, encode_queries, search_vectors

MODES = ("bm25f", "semantic", "hybrid")


def min_max(score: str) -> Column:
    """Score scaled to 0..1 inside its query's pool; equal scores all become 1."""
    pool = W.partitionBy("query_id")
    low, high = F.min(score).over(pool), F.max(score).over(pool)
    return F.when(high == low, F.lit(1.0)).otherwise((F.col(score) - low) / F.nullif(high - low, F.lit(0.0)))


def fuse(lexical_pool: DataFrame, vector_pool: DataFrame, alpha: float = fixed.ALPHA) -> DataFrame:
    """(query_id, doc_id, score, bm25f_score, semantic_score) over the union of both pools."""
    a = lexical_pool.select("query_id", "doc_id", F.col("score").alias("bm25f_score"))
    b = vector_pool.select("query_id", "doc_id", F.col("score").alias("semantic_score"))
    a, b = a.withColumn("_a", min_max("bm25f_score")), b.withColumn("_b", min_max("semantic_score"))
    zero = F.lit(0.0)
    both = a.join(b, ["query_id", "doc_id"], "full_outer")
    return both.select("query_id", "doc_id",
                       (alpha * F.coalesce("_a", zero) + (1.0 - alpha) * F.coalesce("_b", zero)).alias("score"),
                       F.coalesce("bm25f_score", zero).alias("bm25f_score"),
                       F.coalesce("semantic_score", zero).alias("semantic_score"))


def not_blank(queries: DataFrame) -> DataFrame:
    return queries.filter(F.col("text").rlike(NS))


def search(queries: DataFrame, index: LexicalIndex, vectors: VectorIndex | None = None, k: int = 10,
           mode: str = "hybrid", alpha: float = fixed.ALPHA, pool: int = fixed.CANDIDATE_POOL,
           query_vectors: DataFrame | None = None, few: bool | None = None,
           max_terms: int = fixed.MAX_QUERY_TERMS) -> DataFrame:
    """Ranked rows for `queries(query_id, text)`. Without vectors every mode is the lexical one."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    queries = not_blank(queries)
    if vectors is None or mode == "bm25f":
        return lexical.search(index, queries, k, max_terms, few)
    asked = encode_queries(queries, vectors.encoder) if query_vectors is None else query_vectors
    if mode == "semantic":
        return search_vectors(asked, vectors.vectors, k)
    found = fuse(lexical.search(index, queries, pool, max_terms, few),
                 search_vectors(asked, vectors.vectors, pool), alpha)
    return top_k(found, k)


def enrich(ranked: DataFrame, index: LexicalIndex, vectors: VectorIndex | None = None, few: bool = False) -> DataFrame:
    """Document columns from the lexical side, or from the vector side where that has none."""
    out = with_meta(ranked, index.meta, few)
    if vectors is None:
        return out
    shared = [c for c in vectors.meta.columns if c != "doc_id" and c in index.meta.columns]
    other = vectors.meta.select("doc_id", *[F.col(c).alias(f"_{c}") for c in shared])
    out = with_meta(out, other, few)
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in shared}).drop(*[f"_{c}" for c in shared])


def compare_modes(queries: DataFrame, index: LexicalIndex, vectors: VectorIndex, k: int = 5,
                  alpha: float = fixed.ALPHA, pool: int = fixed.CANDIDATE_POOL,
                  max_terms: int = fixed.MAX_QUERY_TERMS) -> DataFrame:
    """The best k of every mode, side by side. Each ranking runs once: its pool serves the single mode and the fusion."""
    queries = not_blank(queries)
    deep = max(k, pool)
    lex = settle(lexical.search(index, queries, deep, max_terms), "lexical")
    sem = settle(search_vectors(encode_queries(queries, vectors.encoder), vectors.vectors, deep), "semantic")
    fused = top_k(fuse(lex.filter(F.col("rank") <= pool), sem.filter(F.col("rank") <= pool), alpha), k)
    parts = {"bm25f": lex.filter(F.col("rank") <= k), "semantic": sem.filter(F.col("rank") <= k), "hybrid": fused}
    return reduce(DataFrame.unionByName, [df.select(F.lit(mode).alias("mode"), "query_id", "doc_id", "score", "rank")
                                          for mode, df in parts.items()])


def _match(queries: DataFrame, index: LexicalIndex, vectors: VectorIndex | None, k: int, **options) -> DataFrame:
    few = few_queries(queries, max(options.get("max_terms", fixed.MAX_QUERY_TERMS), k))
    return enrich(search(queries, index, vectors, k, few=few, **options), index, vectors, few)


def match_jobs(queries: DataFrame, index: LexicalIndex, vectors: VectorIndex | None = None, k: int = 10,
               **options) -> DataFrame:
    """Jobs for each profile, with the columns a result list shows. Options are those of `search`."""
    found = _match(queries, index, vectors, k, **options)
    return found.select("query_id", "rank", "doc_id", *[text_or_empty(F.col(c)).alias(c) for c in
                                                        ("title", "company", "location", "category")],
                        display_score(F.col("score")).alias("score"),
                        search_link(F.col("title"), F.col("company")).alias("url"))


def match_resumes(queries: DataFrame, index: LexicalIndex, vectors: VectorIndex | None = None,
                  k: int = 10, **options) -> DataFrame:
    """Profiles for each job. Options are those of `search`."""
    found = _match(queries, index, vectors, k, **options)
    return found.select("query_id", "rank", "doc_id", text_or_empty(F.col("category")).alias("category"),
                        text_or_empty(F.col("text")).alias("text"), display_score(F.col("score")).alias("score"))
