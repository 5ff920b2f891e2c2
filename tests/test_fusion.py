import pytest

from matchlake.operators import fusion, vectors
from matchlake.operators.common import top_k


@pytest.fixture(scope="module")
def pools(spark):
    schema = "query_id bigint, doc_id bigint, score double"
    lex = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0), (1, 3, 2.0), (2, 9, 5.0)], schema)
    sem = spark.createDataFrame([(1, 1, 0.2), (1, 2, 0.8), (1, 4, 0.5)], schema)
    return lex, sem


def test_golden_fusion(pools):
    rows = {(r["query_id"], r["doc_id"]): r for r in fusion.fuse(*pools).collect()}
    assert {k: round(r["score"], 9) for k, r in rows.items()} == {(1, 1): 0.5, (1, 2): 0.75, (1, 3): 0.0, (1, 4): 0.25, (2, 9): 0.5}
    assert (rows[(1, 4)]["bm25f_score"], rows[(1, 4)]["semantic_score"]) == (0.0, 0.5)


@pytest.mark.parametrize("alpha, order", [(0.0, [2, 4, 1, 3]), (1.0, [1, 2, 3, 4])])
def test_alpha_at_its_ends(pools, alpha, order):
    found = top_k(fusion.fuse(*pools, alpha), 10).filter("query_id = 1").orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == order


@pytest.fixture(scope="module")
def both(five, five_index):
    jobs = five.withColumnRenamed("doc_id", "job_id")
    return five_index, vectors.build_job_vectors(jobs)


def test_modes(both, sample_queries):
    modes = {r["mode"]: r["n"] for r in fusion.compare_modes(sample_queries, *both, k=2).groupBy("mode").count()
             .withColumnRenamed("count", "n").collect()}
    # Four queries have known terms; every query but the blank one has a vector.
    assert modes == {"bm25f": 7, "semantic": 12, "hybrid": 12}
    with pytest.raises(ValueError):
        fusion.search(sample_queries, *both, mode="other")


def test_blank_queries_are_dropped(spark):
    rows = [(1, " \t\u00a0\n"), (2, None), (3, ""), (4, " x ")]
    kept = fusion.not_blank(spark.createDataFrame(rows, "query_id bigint, text string")).collect()
    assert [r["query_id"] for r in kept] == [4]


def test_without_vectors_only_terms_count(five_index, sample_queries):
    rows = fusion.match_jobs(sample_queries, *[_job_index(five_index)], k=1).orderBy("query_id").collect()
    assert [(r["query_id"], r["doc_id"], r["score"]) for r in rows] == [
        (1, 3, 1.9829), (2, 2, 2.3495), (3, 4, 1.8327), (4, 1, 0.8093)]
    assert rows[0]["url"].endswith("keywords=Sourdough+Baker") and rows[0]["company"] == ""


def _job_index(index):
    from dataclasses import replace

    from pyspark.sql import functions as F

    blank = F.lit("")
    return replace(index, meta=index.meta.withColumns({"company": blank, "location": blank, "category": blank}))


def test_match_resumes(spark, five, sample_queries):
    from matchlake.operators.lexical import build_resume_index

    resumes = five.selectExpr("doc_id as ID", "description as Resume_str", "'HR' as Category")
    built = build_resume_index(resumes), vectors.build_resume_vectors(resumes)
    rows = fusion.match_resumes(sample_queries, *built, k=3)
    assert rows.columns == ["query_id", "rank", "doc_id", "category", "text", "score"]
    assert rows.filter("query_id = 6").count() == 0 and rows.filter("query_id = 1").count() == 3
    assert rows.filter("text = '' or category <> 'HR'").count() == 0
