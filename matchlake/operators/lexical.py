"""Field-weighted lexical index (BM25F) and search over batches of queries.

The index is a set of tables. `postings` holds one row per (term, document) with the term's
frequency in every field and the document's field lengths, so the weighted frequency is plain
arithmetic inside one row. Counts that change when documents are added (`totals`, `term_counts`)
are kept as sums and the statistics derive from them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.functions.text import resume_snippet, text_or_empty, tokens
from matchlake.operators.block_search import best_of_blocks
from matchlake.operators.common import BROADCAST_CHARS, BROADCAST_ROWS, build_left, hint_small, is_at_most, settle, top_k
from matchlake.sources.readers import pick


# Characters of text in one partition of an index, which bound the postings that a task counts, sorts or searches.
PARTITION_CHARS = 16_000_000

# So many queries are joined with the postings, which bounds a task's sums: one per query and document. More of them meet
# blocks of documents.
QUERY_ROUND = 1_024


@dataclass(frozen=True)
class LexicalIndex:
    rows: DataFrame         # doc_id, term, tf_<field>…, dl_<field>…; term is null for an empty field
    lengths: DataFrame      # doc_id, dl_<field>…
    totals: DataFrame       # one row: n_docs, total_<field>…
    term_counts: DataFrame  # term, df
    meta: DataFrame         # doc_id and the columns shown with a result
    fields: Mapping[str, tuple[float, float]]
    k1: float = fixed.K1
    stemmed: bool = False
    term_parts: int = 0     # > 0 when rows are stored in that many term partitions
    partitions: int = 0     # > 0 when rows are hash-partitioned by doc_id into that many partitions
    derived: bool = False   # rows are cut out of texts whenever they are read

    @property
    def postings(self) -> DataFrame:
        return self.rows.filter("term is not null")


def term_part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def _tokenised(docs: DataFrame, fields, stemmed: bool, partitions: int) -> DataFrame:
    """doc_id, field lengths and one token array per field. The exchange on doc_id is the only one
    the postings need: counting below it needs none, and tokens are cut on all tasks evenly."""
    texts = docs.select("doc_id", *fields).repartition(partitions, "doc_id")
    cut = texts.select("doc_id", F.array(*[tokens(F.col(f), stemmed) for f in fields]).alias("tokens"))
    return cut.select("doc_id", *[F.size(F.get("tokens", F.lit(i))).alias(f"dl_{f}") for i, f in enumerate(fields)],
                      "tokens")


def _rows(tokenised: DataFrame, fields) -> DataFrame:
    # The outer generators keep Spark from inferring a filter that would tokenise a second time.
    lengths = [f"dl_{f}" for f in fields]
    by_field = tokenised.select("doc_id", *lengths, F.posexplode_outer("tokens").alias("field", "t"))
    terms = by_field.select("doc_id", *lengths, "field", F.explode_outer("t").alias("term"))
    counts = [F.count_if(F.col("field") == i).cast("int").alias(f"tf_{f}") for i, f in enumerate(fields)]
    return terms.groupBy("doc_id", *lengths, "term").agg(*counts)


def totals(lengths: DataFrame, fields) -> DataFrame:
    sums = [F.coalesce(F.sum(f"dl_{f}"), F.lit(0)).alias(f"total_{f}") for f in fields]
    return lengths.agg(F.count("*").alias("n_docs"), *sums)


def term_counts(rows: DataFrame) -> DataFrame:
    """A row per (term, document) already stands for one document, in whichever fields it holds the term."""
    return rows.filter("term is not null").groupBy("term").agg(F.count("*").alias("df"))


def partitions_for(docs: DataFrame, fields) -> int:
    """As many partitions as the texts need to hold about PARTITION_CHARS each, and one per core at least."""
    chars = reduce(add, [F.coalesce(F.length(f), F.lit(0)).cast("long") for f in fields])
    size = docs.agg(F.coalesce(F.sum(chars), F.lit(0)).alias("n")).first()["n"]
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PARTITION_CHARS))


def build_index(docs: DataFrame, fields: Mapping[str, tuple[float, float]], meta: DataFrame | None = None,
                k1: float = fixed.K1, stemmed: bool = False, partitions: int | None = None) -> LexicalIndex:
    """Index of `docs(doc_id, <field>…)` with unique ids; null text counts as empty. Without a given number of
    partitions it follows from the size of the texts."""
    partitions = partitions or partitions_for(docs, list(fields))
    tokenised = _tokenised(docs, list(fields), stemmed, partitions)
    rows, lengths = _rows(tokenised, list(fields)), tokenised.drop("tokens")
    return LexicalIndex(rows, lengths, totals(lengths, fields), term_counts(rows),
                        docs.select("doc_id") if meta is None else meta, dict(fields), k1, stemmed,
                        partitions=partitions, derived=True)


def build_job_index(jobs: DataFrame, fields=None, partitions: int | None = None) -> LexicalIndex:
    docs = jobs.select(F.col("job_id").alias("doc_id"), pick(jobs, "title_clean", "title").alias("title"),
                       pick(jobs, "description_clean", "description").alias("description"))
    return build_index(docs, fields or fixed.JOB_FIELDS, job_meta(jobs), partitions=partitions)


def job_meta(jobs: DataFrame) -> DataFrame:
    return jobs.select(F.col("job_id").alias("doc_id"), text_or_empty(pick(jobs, "title")).alias("title"),
                       text_or_empty(pick(jobs, "company_name")).alias("company"),
                       text_or_empty(pick(jobs, "location")).alias("location"),
                       text_or_empty(pick(jobs, "job_category")).alias("category"))


def build_resume_index(resumes: DataFrame, fields=None, partitions: int | None = None) -> LexicalIndex:
    docs = resumes.select(F.col("ID").alias("doc_id"), pick(resumes, "resume_clean", "Resume_str").alias("resume_text"))
    return build_index(docs, fields or fixed.RESUME_FIELDS, resume_meta(resumes), partitions=partitions)


def resume_meta(resumes: DataFrame) -> DataFrame:
    return resumes.select(F.col("ID").alias("doc_id"), text_or_empty(pick(resumes, "Category")).alias("category"),
                          resume_snippet(pick(resumes, "resume_clean", "Resume_str")).alias("text"))


def field_postings(index: LexicalIndex) -> DataFrame:
    """One row per (term, field, document) with a hit."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"tf_{f}").alias("tf")) for f in index.fields])
    return index.postings.select("term", "doc_id", F.inline(pairs)).filter("tf > 0")


def doc_lengths(index: LexicalIndex) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"dl_{f}").alias("dl")) for f in index.fields])
    return index.lengths.select("doc_id", F.inline(pairs))


def _mean_length(field: str) -> Column:
    """Mean over all documents, empty fields included; 1.0 for an empty corpus."""
    return F.coalesce(F.col(f"total_{field}") / F.nullif(F.col("n_docs"), F.lit(0)), F.lit(1.0))


def field_stats(index: LexicalIndex) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col("n_docs"), _mean_length(f).alias("avgdl"))
                     for f in index.fields])
    return index.totals.select(F.inline(rows))


def term_stats(index: LexicalIndex) -> DataFrame:
    """Document frequency and inverse document frequency per term."""
    n = index.totals.select("n_docs").scalar()
    return index.term_counts.withColumn("idf", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0))


def weighted_tf(index: LexicalIndex) -> Column:
    """Field-weighted, length-normalised frequency of a postings row."""
    def part(field: str) -> Column:
        weight, b = index.fields[field]
        mean = index.totals.select(_mean_length(field)).scalar()
        norm = 1.0 + b * (F.col(f"dl_{field}") / F.nullif(mean, F.lit(0.0)) - 1.0)
        return F.when(F.col(f"tf_{field}") > 0, weight * F.col(f"tf_{field}") / norm).otherwise(0.0)

    return reduce(add, [part(f) for f in index.fields])


def saturation(index: LexicalIndex) -> DataFrame:
    """(doc_id, term, saturation): the part of the score that needs no term statistics."""
    keep = ["doc_id", "term"] + (["term_part"] if index.term_parts else [])
    tf = index.postings.select(*keep, weighted_tf(index).alias("tf_hat"))
    return tf.withColumn("saturation", F.col("tf_hat") / (index.k1 + F.col("tf_hat")))


def _least_frequent(stats: DataFrame, most: int) -> int:
    """The smallest power of two such that at most `most` terms are in so many documents."""
    level = F.floor(F.log2("df")).cast("int").alias("level")
    found = stats.groupBy(level).agg(F.count("*").alias("n")).orderBy(F.col("level").desc()).collect()  # 63 at most
    least, n = 63, 0
    for r in found:
        n += r["n"]
        if n > most:
            break
        least = r["level"]
    return 2 ** least if least < 63 else 2 ** 63 - 1


def impacts(index: LexicalIndex) -> DataFrame:
    """What a (term, document) pair adds to the score of any query holding the term.

    The statistics of the most frequent terms, as many as may be broadcast, go to the postings. Only rows of rarer
    terms are shuffled: these are few, and a term has few of them."""
    if index.derived:
        rows = settle(index.rows, "rows")
        index = replace(index, rows=rows, term_counts=term_counts(rows), derived=False)
    stats = settle(term_stats(index), "term_stats")
    least = _least_frequent(stats, BROADCAST_ROWS)
    parts = saturation(index).select("doc_id", "term", "tf_hat", "saturation")
    frequent, rare = stats.filter(F.col("df") >= least), stats.filter(F.col("df") < least)
    found = parts.join(F.broadcast(frequent), "term")
    if least > 1:
        others = parts.join(F.broadcast(frequent.select("term")), "term", "left_anti")
        found = found.unionByName(others.join(rare, "term"))
    return found.select("term", "doc_id", "tf_hat", (F.col("idf") * F.col("saturation")).alias("impact"))


def index_summary(index: LexicalIndex) -> DataFrame:
    terms = index.term_counts.agg(F.count("*").alias("n_terms"))
    return index.totals.select("n_docs", terms.scalar().alias("n_terms"))


def _query_terms(index: LexicalIndex, queries: DataFrame, cap: int) -> DataFrame:
    """Distinct known terms of each query, at most `cap` of them: the rarest. Unknown terms rank
    last and score nothing, so dropping them first changes no result."""
    cut = queries.select("query_id", F.array_distinct(tokens(F.col("text"), index.stemmed)).alias("t"))
    terms = cut.select("query_id", F.explode_outer("t").alias("term")).filter("term is not null")
    order = W.partitionBy("query_id").orderBy("df", "term")
    return (terms.join(term_stats(index), "term")
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= cap)
            .select("query_id", "term", "idf"))


def few_queries(queries: DataFrame, rows_per_query: int) -> bool:
    """True when `rows_per_query` rows for each query, and the queries' whole text, stay within the
    broadcast bounds. Reads no more than one query beyond the bound."""
    most = BROADCAST_ROWS // rows_per_query
    size = queries.select(F.length("text").alias("chars")).limit(most + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first()
    return size["n"] <= most and size["chars"] <= BROADCAST_CHARS


def search(index: LexicalIndex, queries: DataFrame, k: int = 10, max_terms: int = fixed.MAX_QUERY_TERMS,
           few: bool | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best documents sharing a term with each query.

    The capped query terms travel to the postings, which stay where they are: their rows of a
    document sit in one bucket, so scores add up and are cut to k before anything is shuffled.
    More than QUERY_ROUND queries stream in blocks past blocks of documents (`block_search`): nothing is broadcast, no
    hit is a row, and a block hands on k rows per query. A term's hash stands for it, where no two terms share one.
    """
    few = few_queries(queries, max_terms) if few is None else few
    if is_at_most(queries, QUERY_ROUND):
        return top_k(_scores(index, _query_terms(index, queries, max_terms), few), k)
    if index.derived:
        rows = settle(index.rows, "rows")
        index = replace(index, rows=rows, term_counts=term_counts(rows), derived=False)
    known = index.term_counts.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("postings"), F.count("*").alias("terms"),
                                  F.countDistinct(F.xxhash64("term")).alias("keys")).first()
    if known["keys"] < known["terms"]:  # two terms have one hash, which can stand for neither
        return settle(top_k(_scores(index, settle(_query_terms(index, queries, max_terms), "asked"), False), k), "found")
    key = F.xxhash64("term").alias("key")
    postings = saturation(index).select("doc_id", key, F.col("saturation").alias("part"))
    terms = _query_terms(index, queries, max_terms).select("query_id", key, F.col("idf").alias("weight"))
    found = best_of_blocks(postings, terms, k, known["postings"], queries.count())
    return settle(top_k(found, k), "found")


def _scores(index: LexicalIndex, terms: DataFrame, few: bool) -> DataFrame:
    """(query_id, doc_id, score) of all documents sharing a term with a query."""
    on = ["term"]
    if index.term_parts:
        terms, on = terms.withColumn("term_part", term_part(F.col("term"), index.term_parts)), ["term_part", "term"]
    hits = saturation(index).join(hint_small(terms, few), on)
    return hits.groupBy("query_id", "doc_id").agg(F.sum(F.col("idf") * F.col("saturation")).alias("score"))


def score_pairs(index: LexicalIndex, queries: DataFrame, pairs: DataFrame, few: bool | None = None) -> DataFrame:
    """Score of given (query_id, doc_id) pairs; a repeated query term counts each time, no hit is 0.

    Few pairs are hashed and meet the postings of the queries' terms bucket by bucket; the terms, whose text is
    within the broadcast bound, prune term partitions."""
    few = is_at_most(pairs, BROADCAST_ROWS) if few is None else few
    cut = queries.select("query_id", F.explode_outer(tokens(F.col("text"), index.stemmed)).alias("term"))
    terms = cut.filter("term is not null").groupBy("query_id", "term").agg(F.count("*").alias("times"))
    weighed = terms.join(term_stats(index), "term").select(
        "query_id", "term", (F.col("idf") * F.col("times")).alias("weight"))
    asked = pairs.select("query_id", "doc_id").distinct()
    keys = ["query_id", "doc_id"]
    if few and few_queries(queries, fixed.MAX_QUERY_TERMS):
        known, on = weighed.select("term").distinct(), ["term"]
        if index.term_parts:
            known, on = known.withColumn("term_part", term_part(F.col("term"), index.term_parts)), ["term_part", "term"]
        held = build_left(asked, few).join(saturation(index).join(F.broadcast(known), on, "left_semi"), "doc_id")
        hits = held.join(weighed, ["query_id", "term"])
        sums = hits.groupBy(*keys).agg(F.sum(F.col("weight") * F.col("saturation")).alias("score"))
        return asked.join(sums, keys, "left").fillna(0.0, subset=["score"])
    # Many pairs meet on (document, term), which spreads a document or query most pairs share.
    asked = settle(asked, "pairs")
    held = saturation(index).join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    hits = asked.join(weighed, "query_id").join(held, ["doc_id", "term"])
    sums = hits.groupBy(*keys).agg(F.sum(F.col("weight") * F.col("saturation")).alias("score"))
    return asked.join(sums, keys, "left").fillna(0.0, subset=["score"])


def with_meta(ranked: DataFrame, meta: DataFrame, few: bool) -> DataFrame:
    """Ranked rows with their document's columns.

    `few` says the ranked rows are within the broadcast bound: they are hashed and the wide table
    streams past them; stored metadata is bucketed by document and then needs no shuffle. Otherwise
    only ranked documents leave the wide table, once each, and Spark's adaptive join splits the ranked
    rows of a document that most queries found."""
    if few:
        return build_left(ranked, few).join(meta, "doc_id", "left")
    ranked = settle(ranked, "ranked")
    held = meta.join(ranked.select("doc_id").distinct(), "doc_id", "left_semi")
    return ranked.join(held, "doc_id", "left")


def add_documents(index: LexicalIndex, docs: DataFrame, meta: DataFrame | None = None) -> LexicalIndex:
    """The index with new documents; an id that is already there is replaced, not counted twice.
    Sums are carried forward, so only the new and the replaced documents are read for statistics."""
    new = build_index(docs, index.fields, meta, index.k1, index.stemmed)
    ids = docs.select("doc_id").distinct()
    gone_rows = index.rows.join(ids, "doc_id", "left_semi")
    gone_lengths = index.lengths.join(ids, "doc_id", "left_semi")
    sums = [c for c in index.totals.columns]
    parts = index.totals.unionByName(new.totals).unionByName(
        totals(gone_lengths, index.fields).select(*[(-F.col(c)).alias(c) for c in sums]))
    lost = term_counts(gone_rows).select("term", (-F.col("df")).alias("df"))
    counts = index.term_counts.unionByName(new.term_counts).unionByName(lost)
    rows = new.rows
    if index.term_parts:
        rows = rows.withColumn("term_part", term_part(F.col("term"), index.term_parts))
    return replace(
        index,
        partitions=0,
        derived=True,
        rows=index.rows.join(ids, "doc_id", "left_anti").unionByName(rows),
        lengths=index.lengths.join(ids, "doc_id", "left_anti").unionByName(new.lengths),
        totals=parts.agg(*[F.sum(c).alias(c) for c in sums]),
        term_counts=counts.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0"),
        meta=index.meta.join(ids, "doc_id", "left_anti").unionByName(new.meta, allowMissingColumns=True))
