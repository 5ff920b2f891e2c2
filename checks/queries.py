"""Named queries over the given tables; documents stand in for jobs, benchmark items for profiles."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import labels, text
from matchlake.operators import cleaning, fusion, judging, lexical, metrics, profiling, sampling, vectors
from matchlake.operators.common import scratch_dir
from matchlake.plans import jobs as plans
from matchlake.sources import grade_ledger, index_store, rank_store, readers, segments
from matchlake.streaming.matching import match_stream

RELATED = [("en", "de"), ("fr", "es")]
MAPPING = {"es": "fr"}
LANGUAGES = {"EN": "English", "DE": "German", "FR": "French"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def jobs(spark, sf) -> DataFrame:
    """A document's first line is its title."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("job_id"), F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"), F.col("source").alias("company_name"),
        F.lit(None).cast("string").alias("location"), F.col("lang").alias("job_category"))


def docs(spark, sf) -> DataFrame:
    return jobs(spark, sf).select(F.col("job_id").alias("doc_id"), "title", "description",
                                  F.col("job_category").alias("category"))


def resumes(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("ID"), F.col("text").alias("Resume_str"), F.col("lang").alias("Category"))


def items(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def sampled_queries(spark, sf) -> DataFrame:
    """50 whole documents, spread over the languages."""
    picked = sampling.stratified_queries(table(spark, sf, "documents"), "doc_id", "lang", 50)
    return picked.select(F.col("doc_id").alias("query_id"), F.col("lang").alias("category"), "text")


def stored(spark, sf, name: str, build) -> DataFrame:
    """A derived table, written once per session and read from storage afterwards."""
    return spark.read.parquet(_written(spark.sparkContext.applicationId, spark, sf, name, build))


@cache
def _written(app: str, spark: SparkSession, sf: str, name: str, build) -> str:
    path = scratch_dir(spark, name)
    readers.write_table(build(spark, sf), path)
    return path


def picked_queries(spark, sf) -> DataFrame:
    return stored(spark, sf, "queries", sampled_queries)


@cache
def _lexical(app: str, spark: SparkSession, sf: str):
    return index_store.save_lexical(index(spark, sf), scratch_dir(spark, "lexical"), term_parts=2)


@cache
def _vectors(app: str, spark: SparkSession, sf: str):
    built = vectors.build_job_vectors(jobs(spark, sf))
    return index_store.save_vectors(built, scratch_dir(spark, "vectors"), spark.sparkContext.defaultParallelism)


@cache
def _ranks(app: str, spark: SparkSession, sf: str):
    return rank_store.build(docs(spark, sf), scratch_dir(spark, "ranks"))


def saved_ranks(spark, sf) -> rank_store.RankDirectory:
    return _ranks(spark.sparkContext.applicationId, spark, sf)


def saved_lexical(spark, sf) -> lexical.LexicalIndex:
    """The job index, built and written once per session, then read from storage."""
    return _lexical(spark.sparkContext.applicationId, spark, sf)


def saved_vectors(spark, sf) -> vectors.VectorIndex:
    return _vectors(spark.sparkContext.applicationId, spark, sf)


def saved(spark, sf):
    return saved_lexical(spark, sf), saved_vectors(spark, sf)


def r6(c: str):
    return F.round(c, 6).alias(c)


# Cleaning and text ------------------------------------------------------------------------------

def strip_html_pages(spark, sf):
    p = table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("text"))
    return p.withColumn("words", text.word_count(F.col("text")))


def strip_tags_pages(spark, sf):
    p = table(spark, sf, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))
    return p.withColumn("words", text.word_count(F.col("text")))


def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("text"))


def clean_documents(spark, sf):
    out = cleaning.clean_jobs(jobs(spark, sf))
    return out.select("job_id", "title_clean", "description_clean", "desc_word_count", "company_name",
                      "location", "job_category")


def clean_funnel(spark, sf):
    return cleaning.cleaning_funnel(jobs(spark, sf))


def dedup_documents(spark, sf):
    return cleaning.keep_first(table(spark, sf, "documents"), F.col("text"), "doc_id").select("doc_id", "lang")


def lenient_cast(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "P", F.col("o_orderpriority")).when(
        F.col("o_orderkey") % 7 == 0, F.concat("o_orderkey", F.lit("d"))).when(
        F.col("o_orderkey") % 7 == 1, F.concat(F.lit(" 1"), "o_orderkey", F.lit(".5e1 "))).otherwise(
        F.col("o_orderkey").cast("string")).alias("max_salary"))
    return cleaning.lenient_numbers(raw, ["max_salary"])


def level_default(spark, sf):
    level = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return table(spark, sf, "orders").select("o_orderkey", cleaning.level_or_unknown(
        F.concat(F.lit(" "), level, F.lit("\t"))).alias("experience_level"))


def fallback_text(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("ID"), F.col("html").alias("Resume_html"))
    raw = resumes(spark, sf).join(pages, "ID", "left")
    raw = raw.withColumn("Category", F.concat(F.lit(" "), F.upper("Category"), F.lit("\n")))
    return cleaning.clean_resumes(raw).select("ID", "resume_clean", "resume_word_count", "Category")


def category_normalise(spark, sf):
    raw = table(spark, sf, "documents").select("doc_id", F.upper("lang").alias("raw_category"))
    mapping = readers.category_map(spark, LANGUAGES)
    return cleaning.normalise_category(raw, mapping, "raw_category", "category")


def classify_title(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(
        " ", "p_name", "p_type").alias("title"))
    titles = jobs(spark, sf).select(F.col("job_id").alias("id"), "title")
    both = parts.withColumn("kind", F.lit("part")).unionByName(titles.withColumn("kind", F.lit("job")))
    return both.select("kind", "id", labels.title_category(F.col("title")).alias("category"))


def search_link(spark, sf):
    company = F.when(F.col("job_category") != "fr", F.col("company_name"))
    return jobs(spark, sf).select("job_id", labels.search_link(F.col("title"), company).alias("url"))


def match_label(spark, sf):
    score = labels.display_score(F.col("o_totalprice") / 250000.0)
    return table(spark, sf, "orders").select(
        "o_orderkey", labels.match_label(score).alias("label"),
        labels.category_label(F.nullif("o_orderstatus", F.lit("P"))).alias("category"),
        labels.file_label(F.concat(F.col("o_orderpriority"), F.lit(" Co., Ltd."))).alias("file"))


def judge_parse(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", labels.parse_grade(
        F.concat(F.lit(" "), F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))).alias("grade"))


def _joined(tokens):
    return F.concat_ws(" ", tokens)


def tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", _joined(text.tokens(F.col("text"))).alias("tokens"))


def tokens_stemmed(spark, sf):
    return table(spark, sf, "documents").select("doc_id", _joined(text.tokens(F.col("text"), True)).alias("tokens"))


def delimited_parse(spark, sf):
    given = table(spark, sf, "documents")
    lines = given.select(F.concat_ws(
        ":::", F.concat(F.lit(" "), F.col("doc_id"), F.lit(" ")),
        F.concat("source", F.lit("; ;"), "lang", F.lit(" ; ")), "text").alias("value"))
    short = given.filter("lang = 'es'").select(F.concat_ws(":::", "doc_id", "source").alias("value"))
    lines = lines.union(short)
    return readers.parse_delimited(lines).withColumn("occupations", F.concat_ws("|", "occupations"))


def embed_text(spark, sf):
    d = jobs(spark, sf)
    return d.select("job_id", text.job_embed_text(F.col("title"), F.col("description")).alias("job_text"),
                    text.resume_embed_text(F.col("description")).alias("profile_text"),
                    text.resume_snippet(F.col("description")).alias("snippet"))


# Lexical index ----------------------------------------------------------------------------------

def index(spark, sf):
    return lexical.build_job_index(jobs(spark, sf))


def postings(spark, sf):
    return lexical.field_postings(index(spark, sf))


def doc_lengths(spark, sf):
    return lexical.doc_lengths(index(spark, sf))


def term_stats(spark, sf):
    return lexical.term_stats(index(spark, sf)).select("term", "df", r6("idf"))


def field_stats(spark, sf):
    return lexical.field_stats(index(spark, sf)).select("field", "n_docs", r6("avgdl"))


def impacts(spark, sf):
    return lexical.impacts(index(spark, sf)).select("term", "doc_id", r6("tf_hat"), r6("impact"))


def index_summary(spark, sf):
    return lexical.index_summary(index(spark, sf))


def index_jobs(spark, sf):
    built = index(spark, sf)
    per_doc = built.rows.groupBy("doc_id").agg(F.count("term").alias("n_terms"))
    return per_doc.join(built.meta, "doc_id").join(built.lengths, "doc_id")


def index_resumes(spark, sf):
    built = lexical.build_resume_index(resumes(spark, sf))
    per_doc = lexical.impacts(built).groupBy("doc_id").agg(F.round(F.sum("impact"), 6).alias("weight"))
    return built.meta.join(per_doc, "doc_id", "left")


def index_incremental(spark, sf):
    """An index of English documents with other texts, then all documents: the overlap is replaced."""
    every = docs(spark, sf)
    first = every.filter("category = 'en'").withColumn("description", F.concat_ws(" ", "title", "category"))
    built = lexical.add_documents(lexical.build_index(first, lexical.fixed.JOB_FIELDS), every)
    return lexical.impacts(built).select("term", "doc_id", r6("tf_hat"), r6("impact"))


def index_segments(spark, sf):
    """As `index_incremental`, in a stored index of segments: three additions that replace documents, then a merge."""
    every = docs(spark, sf)
    first = every.filter("category = 'en'").withColumn("description", F.concat_ws(" ", "title", "category"))
    built = segments.create(spark, scratch_dir(spark, "segments"), lexical.fixed.JOB_FIELDS, term_parts=2)
    for part in (first, every.filter("doc_id % 3 > 0"), every.filter("doc_id % 3 < 2")):
        built = segments.add(built, part, fanout=None)
    out = lexical.impacts(segments.lexical_index(segments.merge(built)))
    return out.select("term", "doc_id", r6("tf_hat"), r6("impact"))


def index_roundtrip(spark, sf):
    path = scratch_dir(spark, "roundtrip")
    index_store.save_lexical(index(spark, sf), path, term_parts=2)
    return lexical.impacts(index_store.open_lexical(spark, path)).select("term", "doc_id", r6("tf_hat"), r6("impact"))


# Search -----------------------------------------------------------------------------------------

def _ranked(df):
    return df.select("query_id", "doc_id", "rank", r6("score"))


def search_lexical(spark, sf):
    built = saved_lexical(spark, sf)
    found = lexical.search(built, items(spark, sf), 10)
    few = lexical.few_queries(items(spark, sf), 10)
    return lexical.with_meta(found, built.meta, few).select("query_id", "doc_id", "rank", r6("score"), "title",
                                                             "category")


def search_lexical_fresh(spark, sf):
    return _ranked(lexical.search(index(spark, sf), items(spark, sf), 10))


def search_term_cap(spark, sf):
    return _ranked(lexical.search(saved_lexical(spark, sf), items(spark, sf), 10, max_terms=8))


def search_long_queries(spark, sf):
    """Every conversation turn is a query."""
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    return _ranked(lexical.search(saved_lexical(spark, sf), turns, 5))


def score_pairs(spark, sf):
    asked = stored(spark, sf, "asked", candidates_random)
    return lexical.score_pairs(saved_lexical(spark, sf), items(spark, sf), asked).select("query_id", "doc_id", r6("score"))


def search_vectors(spark, sf):
    given = table(spark, sf, "embeddings")
    q = given.select(F.col("vec_id").alias("query_id"), "embedding")
    return _ranked(vectors.search_vectors(q, given.select(F.col("vec_id").alias("doc_id"), "embedding"), 10))


def search_vectors_grid(spark, sf):
    given = table(spark, sf, "embeddings")
    q = given.select(F.col("vec_id").alias("query_id"), "embedding")
    d = given.select(F.col("vec_id").alias("doc_id"), "embedding")
    return _ranked(vectors.search_vectors(q, d, 10, broadcast_values=0, query_block=256, doc_block=256))


def hashed_vectors(spark, sf):
    coded = vectors.encode(table(spark, sf, "documents"), "doc_id", F.col("text"), vectors.HashingEncoder())
    return coded.select("doc_id", F.posexplode("embedding").alias("i", "v")).select(
        "doc_id", "i", F.round(F.col("v").cast("double"), 6).alias("v"))


def search_hybrid(spark, sf):
    lex, vec = saved(spark, sf)
    few = lexical.few_queries(items(spark, sf), 10)
    found = fusion.enrich(fusion.search(items(spark, sf), lex, vec, 10), lex, vec, few)
    return found.select("query_id", "doc_id", "rank", r6("score"), r6("bm25f_score"), r6("semantic_score"),
                        "title", "company", "category")


def compare_modes(spark, sf):
    lex, vec = saved(spark, sf)
    found = fusion.compare_modes(items(spark, sf), lex, vec, 5)
    return found.select("mode", "query_id", "doc_id", "rank", r6("score"))


def match_jobs(spark, sf):
    return fusion.match_jobs(items(spark, sf), *saved(spark, sf))


def match_resumes(spark, sf):
    return fusion.match_resumes(items(spark, sf), lexical.build_resume_index(resumes(spark, sf)))


def match_streamed(spark, sf):
    folder = scratch_dir(spark, "stream")
    lex = saved_lexical(spark, sf)
    arriving = spark.readStream.schema("item_id bigint, text string") \
        .option("pathGlobFilter", "benchmark.parquet").parquet(sf)
    arriving = arriving.select(F.col("item_id").alias("query_id"), "text")
    query = match_stream(arriving, lambda batch: lexical.search(lex, batch, 10), f"{folder}/out", f"{folder}/state", True)
    query.awaitTermination()
    return _ranked(spark.read.parquet(f"{folder}/out"))


# Sampling and judgments -------------------------------------------------------------------------

def sample_simple(spark, sf):
    return sampling.simple_sample(table(spark, sf, "documents"), "doc_id", 100).select("doc_id", "lang")


def sample_stratified(spark, sf):
    return sampled_queries(spark, sf).select("query_id", "category")


def sample_topup(spark, sf):
    d = table(spark, sf, "documents").withColumn("lang", F.nullif("lang", F.lit("de")))
    return sampling.stratified_sample(d, "doc_id", "lang", 500).select("doc_id", "lang")


def candidates_random(spark, sf):
    return sampling.random_candidates(items(spark, sf).select("query_id"), docs(spark, sf), 20)


def candidates_looked_up(spark, sf):
    """As `candidates_random`, from a stored directory of places."""
    few = lexical.few_queries(items(spark, sf), 20)
    return sampling.random_candidates(items(spark, sf).select("query_id"), docs(spark, sf), 20, few=few,
                                      directory=saved_ranks(spark, sf))


def candidates_half(spark, sf):
    q = picked_queries(spark, sf).select("query_id", "category")
    return sampling.half_and_half(q, docs(spark, sf), 20)


def judge_prompts(spark, sf):
    rows = judging.candidate_pairs(picked_queries(spark, sf), docs(spark, sf), 6)
    return rows.select("query_id", "doc_id", "prompt")


def judgments_graded(spark, sf):
    """A grader column stands in for an outside judge: how many words of the title match."""
    rows = judging.candidate_pairs(picked_queries(spark, sf), docs(spark, sf), 6)
    same = lambda t, title, d: F.when(F.contains(t, title), F.lit("3")).otherwise(F.lit("n/a"))
    return judging.judge_with(rows, same)


def judgments_ledger(spark, sf):
    """The same grades from a plain function, read from a ledger: the second run must ask nothing."""
    rows, root = judging.candidate_pairs(picked_queries(spark, sf), docs(spark, sf), 6), scratch_dir(spark, "ledger")

    def never(text, title, description):
        raise RuntimeError("asked again")

    same = lambda text, title, d: 3 if title in text else 0
    grade_ledger.grade(rows, grade_ledger.asked(same), root)
    return grade_ledger.grade(rows, grade_ledger.asked(never), root)


def judgments_category(spark, sf):
    return judging.judge_by_category(picked_queries(spark, sf), docs(spark, sf), 20,
                                     mapping=readers.category_map(spark, MAPPING), pairs=RELATED)


def judgments_pooled(spark, sf):
    lex, vec = saved(spark, sf)
    return judging.judge_pooled(picked_queries(spark, sf), docs(spark, sf), lex, vec,
                                mapping=readers.category_map(spark, MAPPING), directory=saved_ranks(spark, sf))


def grade_distribution(spark, sf):
    return judging.grade_distribution(judgments_category(spark, sf)).select("relevance", "n", r6("percent"))


def judgments_roundtrip(spark, sf):
    path = scratch_dir(spark, "judgments")
    readers.write_table(judgments_category(spark, sf), path, "csv")
    return readers.read_judgments(spark, path)


# Evaluation -------------------------------------------------------------------------------------

def _unique_pooled(spark, sf):
    return readers.judgments(judgments_pooled(spark, sf))


def _pooled(spark, sf):
    return stored(spark, sf, "pooled", _unique_pooled)


def _per_query(spark, sf):
    lex = saved_lexical(spark, sf)
    return metrics.evaluate(_pooled(spark, sf), lambda q: lexical.search(lex, q, 50), picked_queries(spark, sf))


def eval_per_query(spark, sf):
    out = _per_query(spark, sf)
    return out.select("query_id", *[r6(m) for m in metrics.metric_names(out)])


def eval_aggregate(spark, sf):
    out = metrics.aggregate(_per_query(spark, sf))
    return out.select(*[c if c == "num_queries" else r6(c) for c in out.columns])


def eval_report(spark, sf):
    return metrics.report(metrics.aggregate(_per_query(spark, sf))).select("position", "metric", r6("mean"), r6("std"))


def eval_compare(spark, sf):
    lex, vec = saved(spark, sf)
    ways = {name: (lambda q, m=mode: fusion.search(q, lex, vec, 10, m))
            for name, mode in [("bm25f", "bm25f"), ("semantic", "semantic"), ("hybrid", "hybrid")]}
    out = metrics.compare(_pooled(spark, sf), ways, picked_queries(spark, sf))
    return out.select("metric", *[r6(n) for n in ways])


# Profiles ---------------------------------------------------------------------------------------

def corpus_sizes(spark, sf):
    t = lambda name: readers.read_if_exists(spark.read.parquet, f"{sf}/{name}.parquet")
    return profiling.corpus_sizes([("jobs", "documents", t("documents")), ("jobs", "pages", t("pages")),
                                   ("resumes", "conversations", t("conversations")), ("resumes", "absent", t("absent"))])


def _lengths(spark, sf):
    return profiling.job_lengths(jobs(spark, sf))


def length_histogram(spark, sf):
    return profiling.length_histogram(_lengths(spark, sf), 60).select("bin", r6("low"), r6("high"), "n")


def length_stats(spark, sf):
    return profiling.length_stats(_lengths(spark, sf))


def html_lengths(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("Resume_html"))
    return profiling.resume_lengths(pages).select("page_id", "word_count")


def category_counts(spark, sf):
    return profiling.value_counts(table(spark, sf, "documents"), "lang")


def top_terms(spark, sf):
    return profiling.top_values(table(spark, sf, "documents").withColumnRenamed("text", "skills"),
                                "job_skills", "skill", "skills")


def level_counts(spark, sf):
    level = table(spark, sf, "orders").select(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("job_level"))
    return profiling.value_counts(level, "job_level")


def distinct_categories(spark, sf):
    return cleaning.distinct_categories(table(spark, sf, "documents"), "lang")


# Files, defaults and whole runs ------------------------------------------------------------------

def csv_postings(spark, sf):
    """Documents written as a postings CSV, then read by the first of two paths that exists."""
    path = scratch_dir(spark, "postings")
    readers.write_table(jobs(spark, sf).withColumn("extra", F.lit("x")), path, "csv")
    return readers.read_postings(spark, path + "-absent", path).select("job_id", "title", "description", "company_name")


def csv_resumes(spark, sf):
    path = scratch_dir(spark, "resumes")
    readers.write_table(resumes(spark, sf), path, "csv")
    return readers.read_resumes(spark, path).select("ID", "Resume_str", "Category")


def csv_large_postings(spark, sf):
    """Only the wanted columns of a wide table, beside its skills."""
    path = scratch_dir(spark, "large")
    pages = table(spark, sf, "pages").select(F.col("url").alias("job_link"), F.col("html").alias("job_title"),
                                             F.lit("N/A").alias("company"), F.col("page_id").alias("not_wanted"), F.lit(1).alias("other"))
    readers.write_table(pages, path, "csv")
    skills = table(spark, sf, "pages").select(F.col("url").alias("job_link"), F.substring_index("url", "/", 3).alias("job_skills"))
    readers.write_table(skills, path + "-skills", "csv")
    large, companion = readers.read_large_postings(spark, path, path + "-skills")
    counted = companion.groupBy("job_link").agg(F.max("job_skills").alias("skills"), F.count("*").alias("n"))
    return large.join(counted, "job_link").select("job_link", "job_title", "company", "skills", "n")


def category_map_roundtrip(spark, sf):
    path = scratch_dir(spark, "map")
    pairs = table(spark, sf, "documents").select(F.col("source").alias("raw"), F.upper("source").alias("mapped")).distinct()
    readers.write_category_map(pairs, path)
    return readers.read_category_map(spark, path)


def first_rows(spark, sf):
    return readers.first_rows(table(spark, sf, "documents"), "doc_id", 100).select("doc_id", "text")


def blank_queries(spark, sf):
    """Conversation turns with blank ones beside them; only those with a text are asked."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    blanks = turns.select("conv_id", (F.col("turn") + 1000).alias("turn"),
                          F.element_at(F.array(F.lit(None).cast("string"), F.lit(""), F.lit(" \t\n"), F.lit("\u00a0")),
                                       (F.col("turn") % 4 + 1).cast("int")).alias("text"))
    return fusion.not_blank(turns.union(blanks))


def _letters():
    """A model of three numbers per text: characters, and the letters e and n."""
    def predict(texts):
        import numpy as np

        return np.array([[len(t), t.count("e"), t.count("n")] for t in texts], dtype="float32").reshape(len(texts), 3)

    return predict


def model_encoder(spark, sf):
    coded = vectors.encode(table(spark, sf, "documents"), "doc_id", F.col("text"), vectors.ModelEncoder(_letters))
    return coded.select("doc_id", F.posexplode("embedding").alias("i", "v")).select(
        "doc_id", "i", F.round(F.col("v").cast("double"), 5).alias("v"))


def match_resumes_hybrid(spark, sf):
    lex = lexical.build_resume_index(resumes(spark, sf))
    vec = vectors.build_resume_vectors(resumes(spark, sf))
    return fusion.match_resumes(items(spark, sf), lex, vec)


def pipeline_report(spark, sf):
    """Clean, index, judge and evaluate, with documents on both sides."""
    return plans.run_all(spark, jobs(spark, sf), resumes(spark, sf), plans.Layout(scratch_dir(spark, "run")),
                         term_parts=2)


QUERIES = {f.__name__: f for f in (
    strip_html_pages, strip_tags_pages, clean_pages, clean_documents, clean_funnel, dedup_documents, lenient_cast,
    level_default, fallback_text, category_normalise, classify_title, search_link, match_label, judge_parse, tokens,
    tokens_stemmed, delimited_parse, embed_text, postings, doc_lengths, term_stats, field_stats, impacts, index_summary,
    index_jobs, index_resumes, index_incremental, index_segments, index_roundtrip, search_lexical, search_lexical_fresh,
    search_term_cap, search_long_queries, score_pairs, search_vectors, search_vectors_grid, hashed_vectors,
    search_hybrid, compare_modes, match_jobs, match_resumes, match_streamed, sample_simple, sample_stratified,
    sample_topup, candidates_random, candidates_looked_up, candidates_half, judge_prompts, judgments_graded, judgments_ledger,
    judgments_category,
    judgments_pooled, grade_distribution, judgments_roundtrip, eval_per_query, eval_aggregate, eval_report,
    eval_compare, corpus_sizes, length_histogram, length_stats, html_lengths, category_counts, top_terms,
    level_counts, distinct_categories, csv_postings, csv_resumes, csv_large_postings, category_map_roundtrip,
    first_rows, blank_queries, model_encoder, match_resumes_hybrid, pipeline_report)}
