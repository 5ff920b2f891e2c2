import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchlake.functions.fixed import JOB_FIELDS
from matchlake.operators import block_search, lexical
from matchlake.sources import index_store


def top(found, q):
    rows = found.filter(F.col("query_id") == q).orderBy("rank").collect()
    return [(r["doc_id"], round(r["score"], 6)) for r in rows]


GOLDEN = {1: [(3, 1.982888), (0, 1.289229), (1, 0.809304)], 2: [(2, 2.349529), (4, 0.3858)], 3: [(4, 1.832728)],
          4: [(1, 0.809304), (0, 0.623324), (3, 0.237524)], 5: [], 6: [], 7: []}


def test_golden_search(five_index, sample_queries):
    found = lexical.search(five_index, sample_queries, 3).cache()
    for q, wanted in GOLDEN.items():
        assert top(found, q) == wanted


def test_golden_statistics(five_index):
    stats = {r["field"]: r for r in lexical.field_stats(five_index).collect()}
    assert (stats["title"]["n_docs"], stats["title"]["avgdl"], stats["description"]["avgdl"]) == (5, 2.6, 13.0)
    assert lexical.index_summary(five_index).first().asDict() == {"n_docs": 5, "n_terms": 60}
    assert lexical.doc_lengths(five_index).count() == 10
    assert lexical.field_postings(five_index).filter("term = 'bread' and field = 'description'").count() == 3


def test_pair_scores_count_repeated_terms(spark, five_index, sample_queries):
    pairs = spark.createDataFrame([(4, 0), (4, 2), (4, 0), (7, 1)], "query_id bigint, doc_id bigint")
    for few in (True, False, None):
        got = {(r[0], r[1]): round(r[2], 6) for r in lexical.score_pairs(five_index, sample_queries, pairs, few).collect()}
        assert got == {(4, 0): 0.860848, (4, 2): 0.0, (7, 1): 0.0}


def test_saved_index_reopens_without_a_catalog_entry(spark, five_index, sample_queries, tmp_path):
    for parts in (0, 3):
        path = str(tmp_path / f"ix{parts}")
        stored = index_store.save_lexical(five_index, path, buckets=3, term_parts=parts)
        assert top(lexical.search(stored, sample_queries, 3), 1) == GOLDEN[1]
        for t in spark.catalog.listTables():
            if t.name.startswith("matchlake_"):
                spark.sql(f"drop table {t.name}")
        again = index_store.open_lexical(spark, path)
        found = lexical.search(again, sample_queries, 3)
        assert top(found, 4) == GOLDEN[4]
        titles = lexical.with_meta(found, again.meta, True).filter("query_id = 2 and rank = 1")
        assert titles.first()["title"] == "Harbour Crane Operator"
        assert again.fields == JOB_FIELDS and again.term_parts == parts


def test_stored_search_shuffles_only_k_rows(spark, five_index, sample_queries, tmp_path):
    stored = index_store.save_lexical(five_index, str(tmp_path / "ix"), buckets=4, term_parts=2)
    plan = lexical.search(stored, sample_queries, 3, few=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" in plan and "doc_id" not in "".join(
        line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "dynamicpruning" in plan


def test_term_cap_keeps_the_rarest(spark, five_index):
    q = spark.createDataFrame([(1, "bread shifts galley")], "query_id bigint, text string")
    assert [d for d, _ in top(lexical.search(five_index, q, 5, max_terms=1), 1)] == [4]


def test_adding_documents_equals_one_build(spark, five, five_index, sample_queries):
    half = five.filter("doc_id < 3").withColumn("title", F.lit("old words"))
    built = lexical.add_documents(lexical.build_index(half, JOB_FIELDS, half.select("doc_id", "title")), five,
                                  five.select("doc_id", "title"))
    assert top(lexical.search(built, sample_queries, 3), 1) == GOLDEN[1]
    a = {(r[0], r[1]) for r in lexical.term_stats(built).select("term", "df").collect()}
    assert a == {(r[0], r[1]) for r in lexical.term_stats(five_index).select("term", "df").collect()}
    assert built.meta.filter("title = 'old words'").count() == 0


def test_adding_to_a_stored_index(spark, five, sample_queries, tmp_path):
    part = lexical.build_index(five.filter("doc_id < 3"), JOB_FIELDS)
    stored = index_store.save_lexical(part, str(tmp_path / "a"), buckets=2, term_parts=2)
    grown = lexical.add_documents(stored, five.filter("doc_id >= 2"))
    assert top(lexical.search(grown, sample_queries, 3), 1) == GOLDEN[1]
    again = index_store.save_lexical(grown, str(tmp_path / "b"), buckets=2, term_parts=2)
    assert top(lexical.search(again, sample_queries, 3), 2) == GOLDEN[2]


def brute_force(docs, query, fields, cap, k):
    n = len(docs)
    lens = {d: {f: len(t) for f, t in fs.items()} for d, fs in docs.items()}
    mean = {f: sum(v[f] for v in lens.values()) / n for f in fields}
    df = Counter(t for fs in docs.values() for t in {t for ts in fs.values() for t in ts})
    known = sorted((t for t in set(query) if t in df), key=lambda t: (df[t], t))[:cap]
    scores = {}
    for d, fs in docs.items():
        total = 0.0
        for t in known:
            hat = sum(w * fs[f].count(t) / (1 + b * (lens[d][f] / mean[f] - 1)) for f, (w, b) in fields.items() if t in fs[f])
            if hat:
                total += math.log((n - df[t] + 0.5) / (df[t] + 0.5) + 1) * hat / (1.2 + hat)
        if total:
            scores[d] = total
    return sorted(((round(s, 9), d) for d, s in scores.items()), key=lambda x: (-x[0], x[1]))[:k]


@pytest.mark.parametrize("few", [True, False])
def test_against_brute_force_with_a_hot_term(spark, few):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = {d: {"title": rng.choices(vocabulary, k=rng.randint(0, 3)),
                "description": rng.choices(vocabulary, k=rng.randint(0, 25)) + (["hot"] * 4 if d % 3 else [])}
            for d in range(300)}
    rows = [(d, " ".join(f["title"]), " ".join(f["description"])) for d, f in docs.items()]
    index = lexical.build_index(spark.createDataFrame(rows, "doc_id bigint, title string, description string"), JOB_FIELDS)
    queries = {q: rng.choices(vocabulary, k=12) + ["hot", "unknown"] for q in range(12)}
    frame = spark.createDataFrame([(q, " ".join(t)) for q, t in queries.items()], "query_id bigint, text string")
    found = lexical.search(index, frame, 10, max_terms=6, few=few).collect()
    for q, terms in queries.items():
        got = [(round(r["score"], 9), r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        wanted = brute_force(docs, terms, JOB_FIELDS, 6, 10)
        assert [d for _, d in got] == [d for _, d in wanted]
        assert all(abs(a[0] - b[0]) < 1e-8 for a, b in zip(got, wanted))


def test_empty_corpus(spark, sample_queries):
    none = spark.createDataFrame([], "doc_id bigint, title string, description string")
    index = lexical.build_index(none, JOB_FIELDS)
    assert lexical.search(index, sample_queries, 3).count() == 0
    assert {r["avgdl"] for r in lexical.field_stats(index).collect()} == {1.0}


def test_stemming_and_default_builders(spark, five, sample_queries):
    stemmed = lexical.build_index(five, JOB_FIELDS, stemmed=True)
    q = spark.createDataFrame([(1, "ordering ovens")], "query_id bigint, text string")
    assert {d for d, _ in top(lexical.search(stemmed, q, 5), 1)} == {0, 1, 3}
    jobs = five.withColumnRenamed("doc_id", "job_id")
    assert top(lexical.search(lexical.build_job_index(jobs), sample_queries, 3), 1) == GOLDEN[1]
    resumes = five.select(F.col("doc_id").alias("ID"), F.col("description").alias("Resume_str"))
    index = lexical.build_resume_index(resumes)
    assert index.meta.columns == ["doc_id", "category", "text"]
    assert top(lexical.search(index, sample_queries, 1), 2)[0][0] == 2


@pytest.mark.parametrize("few", [True, False])
def test_metadata_keeps_every_ranked_row(spark, five, few):
    rows = [(q, 3, 1) for q in range(200)] + [(1, 99, 2)]
    ranked = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, rank int")
    got = lexical.with_meta(ranked, five.select("doc_id", "title"), few).collect()
    assert len(got) == 201
    assert {(r["doc_id"], r["title"]) for r in got} == {(3, "Sourdough Baker"), (99, None)}


def test_rebuilt_index_with_another_layout(spark, five, sample_queries, tmp_path):
    """A session that has an older layout open finds all documents after the folder was rebuilt."""
    path = str(tmp_path / "ix")
    index_store.save_lexical(lexical.build_index(five.filter("doc_id < 2"), JOB_FIELDS), path, buckets=2, term_parts=3)
    assert index_store.open_lexical(spark, path).totals.first()["n_docs"] == 2
    other = spark.newSession()
    index_store.save_lexical(lexical.build_index(other.createDataFrame(five.collect(), five.schema), JOB_FIELDS), path, buckets=5, term_parts=6)
    again = index_store.open_lexical(spark, path)
    assert again.totals.first()["n_docs"] == 5 == again.postings.select("doc_id").distinct().count()
    assert top(lexical.search(again, sample_queries, 3), 1) == GOLDEN[1]


def test_partitions_follow_the_size_of_the_texts(spark, five, monkeypatch):
    monkeypatch.setattr(lexical, "PARTITION_CHARS", 20)
    chars = sum(len(r["title"]) + len(r["description"]) for r in five.collect())
    index = lexical.build_index(five, JOB_FIELDS)
    assert index.partitions == math.ceil(chars / 20) > spark.sparkContext.defaultParallelism
    blank = five.withColumn("title", F.lit(None).cast("string")).withColumn("description", F.lit(None).cast("string"))
    assert lexical.build_index(blank, JOB_FIELDS).partitions == spark.sparkContext.defaultParallelism


def test_impacts_shuffle_rows_of_rare_terms_only(spark, five_index, monkeypatch):
    every = {(r["term"], r["doc_id"]): r["impact"] for r in lexical.impacts(five_index).collect()}
    assert len(every) == five_index.postings.count()
    plan = lexical.impacts(five_index)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(term" not in plan
    df = {r["term"]: r["df"] for r in five_index.term_counts.collect()}
    for most, least in ((sum(n >= 2 for n in df.values()), 2), (0, 2 ** 63 - 1)):
        assert lexical._least_frequent(five_index.term_counts, most) == least
        monkeypatch.setattr(lexical, "BROADCAST_ROWS", most)
        assert {(r["term"], r["doc_id"]): r["impact"] for r in lexical.impacts(five_index).collect()} == every


@pytest.mark.parametrize("kept", [True, False])
def test_many_queries_take_turns(spark, five_index, sample_queries, tmp_path, monkeypatch, kept):
    """Queries beyond a round shuffle no hits: what is returned reads the rounds' results, and these are the same."""
    monkeypatch.setattr(lexical, "QUERY_ROUND", 2)
    index = index_store.save_lexical(five_index, str(tmp_path / "ix"), buckets=2, term_parts=2) if kept else five_index
    asked = sample_queries.union(spark.createDataFrame([(None, "sourdough baker bread ovens")], sample_queries.schema))
    found = lexical.search(index, asked, 3)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    for q, wanted in GOLDEN.items():
        assert top(found, q) == wanted
    assert [r["doc_id"] for r in found.filter("query_id is null").orderBy("rank").collect()] == [3, 0, 1]


def test_many_queries_over_blocks_equal_the_join(spark, monkeypatch):
    """Far more queries than a round, null ids, repeated ids, a term that most documents have, ties and few hits."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(80)]
    rows = [(d, " ".join(rng.choices(vocabulary, k=rng.randint(0, 3))),
             " ".join(rng.choices(vocabulary, k=rng.randint(0, 25)) + (["hot"] * 2 if d % 3 else []))) for d in range(700)]
    rows += [(None, "w1 w2", "hot lone"), (900, "w5", "w6 w7"), (901, "w5", "w6 w7")]
    index = lexical.build_index(spark.createDataFrame(rows, "doc_id bigint, title string, description string"), JOB_FIELDS)
    asked = [(q, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)) + ["hot"] * (q % 2))) for q in range(60)]
    asked += [(None, "w1 hot"), (3, "w9 lone"), (70, "lone"), (71, "unknown"), (72, ""), (73, "w5 w6 w7")]
    queries = spark.createDataFrame(asked, "query_id bigint, text string")
    found = lambda: {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 8)) for r in lexical.search(index, queries, 4, max_terms=6).collect()}  # noqa: E731, E501
    joined = found()
    monkeypatch.setattr(lexical, "QUERY_ROUND", 2)
    monkeypatch.setattr(block_search, "POSTINGS", 900)
    monkeypatch.setattr(block_search, "QUERIES", 7)
    monkeypatch.setattr(block_search, "STRETCH", 8)
    joins = []
    monkeypatch.setattr(lexical, "_scores", lambda *a: joins.append(a))
    assert found() == joined and (None, 1) in joined and len(joined) > 200
    assert joins == []  # no hit is a row of a join any more
