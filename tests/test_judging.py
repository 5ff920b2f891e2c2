import pytest
from pyspark.sql import functions as F

from matchlake.operators import judging, vectors
from matchlake.operators.lexical import build_index
from matchlake.functions.fixed import JOB_FIELDS
from matchlake.sources import readers


@pytest.fixture(scope="module")
def docs(spark, five):
    category = F.element_at(F.array(*[F.lit(c) for c in ("Sales", "Marketing", "Legal", "Sales", "Design")]),
                            (F.col("doc_id") + 1).cast("int"))
    return five.withColumn("category", category)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(7, "BANKING", "flour"), (8, "SALES", "sourdough bread")],
                                 "query_id bigint, category string, text string")


def test_category_grades(docs, queries, spark):
    got = judging.judge_by_category(queries, docs, mapping=readers.category_map(spark)).collect()
    assert len(got) == 10 and set(got[0].asDict()) == set(judging.COLUMNS)
    sales = {r["doc_category"]: r["relevance"] for r in got if r["query_id"] == 8}
    assert sales == {"Sales": 3, "Marketing": 1, "Legal": 0, "Design": 0}
    assert {r["relevance"] for r in got if r["query_id"] == 7} == {0}


def test_pooled_grades(docs, queries, spark):
    index = build_index(docs, JOB_FIELDS, docs.select("doc_id", "title"))
    vec = vectors.build_job_vectors(docs.withColumnRenamed("doc_id", "job_id"))
    got = judging.judge_pooled(queries, docs, index, None, 2, 1, mapping=readers.category_map(spark)).collect()
    assert {(r["query_id"], r["doc_id"]) for r in got} >= {(7, 0), (8, 0), (8, 3)} and len(got) == 6
    assert {r["relevance"] for r in got if r["doc_category"] == "Marketing"} <= {0}
    both = judging.judge_pooled(queries, docs, index, vec, 5, 5)
    assert both.count() == both.select("query_id", "doc_id").distinct().count() == 10


def test_graders(docs, queries):
    pairs = judging.candidate_pairs(queries, docs, 4)
    assert pairs.filter("not contains(prompt, doc_title) or not contains(prompt, text)").count() == 0

    def score(text, title, description):
        if "Data" in title:
            raise RuntimeError("no answer")
        return 2

    plain = {(r["doc_title"], r["relevance"]) for r in judging.judge_with(pairs, judging.row_grader(score)).collect()}
    assert all(g == (0 if "Data" in t else 2) for t, g in plain)
    column = judging.judge_with(pairs, lambda text, title, d: F.when(F.contains(title, F.lit("Data")), F.lit("x"))
                                .otherwise(F.lit("1")))
    assert {r["relevance"] for r in column.collect()} <= {0, 1}


def test_distribution(spark):
    df = spark.createDataFrame([(0,), (3,), (3,), (3,)], "relevance int")
    rows = {r["relevance"]: (r["n"], r["percent"]) for r in judging.grade_distribution(df).collect()}
    assert rows == {0: (1, 25.0), 1: (0, 0.0), 2: (0, 0.0), 3: (3, 75.0)}
    assert judging.relevant_share(df).first().asDict() == {"total": 4, "relevant": 3, "percent": 75.0}
