import pytest
from pyspark.sql import functions as F

from matchlake.operators import metrics

JUDGED = [(11, 2), (12, 0), (13, 3), (14, 0), (15, 1), (16, 2)]


@pytest.fixture(scope="module")
def judgments(spark):
    rows = [(q, d, r) for q in (1, 2, 3) for d, r in JUDGED] + [(4, 13, 0), (5, 13, 3)]
    return spark.createDataFrame(rows, "query_id bigint, doc_id bigint, relevance int")


@pytest.fixture(scope="module")
def ranked(spark):
    lists = {1: [13, 11, 16, 15, 12, 14], 2: [12, 15, 11, 14, 13, 16], 4: [13]}
    rows = [(q, d, i) for q, ds in lists.items() for i, d in enumerate(ds, 1)]
    return spark.createDataFrame(rows, "query_id bigint, doc_id bigint, rank int")


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([(q, "x") for q in (1, 2, 3, 4, 9)], "query_id bigint, text string")


def rows(df):
    return {r["query_id"]: {k: round(v, 6) for k, v in r.asDict().items() if k != "query_id"} for r in df.collect()}


@pytest.mark.parametrize("block", [65536, 2])
def test_golden_metrics(judgments, ranked, known, monkeypatch, block):
    monkeypatch.setattr(metrics, "RANK_BLOCK", block)
    got = rows(metrics.per_query(judgments, ranked, known, (3, 5, 10)))
    assert got[1] == {"p_at_3": 1.0, "ndcg_at_3": 1.0, "p_at_5": 0.6, "ndcg_at_5": 1.0, "p_at_10": 0.3,
                      "ndcg_at_10": 1.0, "ap": 1.0}
    assert (got[2]["p_at_3"], got[2]["ndcg_at_5"], got[2]["ap"]) == (0.333333, 0.447075, 0.411111)
    assert set(got[3].values()) == set(got[4].values()) == {0.0} and set(got) == {1, 2, 3, 4}


def test_aggregate_and_report(judgments, ranked, known):
    two = metrics.per_query(judgments, ranked, known.filter("query_id < 3"))
    agg = metrics.aggregate(two).first()
    assert agg["num_queries"] == 2 and round(agg["map"], 6) == 0.705556 and round(agg["std_ap"], 6) == 0.294444
    names = [r["metric"] for r in metrics.report(metrics.aggregate(two)).orderBy("position").collect()]
    assert names == ["AP", "NDCG@10", "NDCG@20", "NDCG@5", "P@10", "P@20", "P@5", "MAP"]


def test_no_queries(judgments, ranked, known):
    agg = metrics.aggregate(metrics.per_query(judgments, ranked, known.filter("query_id > 5"))).first()
    assert agg["num_queries"] == 0 and agg["map"] == 0.0


def test_zero_k(judgments, ranked, known):
    assert {r["p_at_0"] for r in rows(metrics.per_query(judgments, ranked, known, (0,))).values()} == {0.0}


def test_compare(judgments, ranked, known):
    ways = {"good": lambda q: ranked.filter("query_id = 1"), "none": lambda q: ranked.filter("false")}
    got = {r["metric"]: (r["good"], r["none"]) for r in metrics.compare(judgments, ways, known).collect()}
    assert set(got) == {"P@5", "P@10", "NDCG@5", "NDCG@10", "MAP"} and got["MAP"] == (0.25, 0.0)


def test_evaluate_asks_only_judged_queries(judgments, ranked, known):
    seen = []
    metrics.evaluate(judgments, lambda q: seen.append(sorted(r[0] for r in q.collect())) or ranked, known)
    assert seen == [[1, 2, 3, 4]]


def test_one_query_with_most_rows(spark):
    n = 3000
    judged = spark.range(n).select(F.lit(1).cast("bigint").alias("query_id"), F.col("id").alias("doc_id"),
                                   (F.col("id") % 4).cast("int").alias("relevance"))
    ranking = judged.select("query_id", "doc_id", (F.col("doc_id") + 1).cast("int").alias("rank"))
    got = metrics.per_query(judged, ranking, k_values=(5,)).first()
    hits, ap = 0, 0.0
    for i in range(n):
        if i % 4 >= 2:
            hits += 1
            ap += hits / (i + 1)
    assert abs(got["ap"] - ap / (n // 2)) < 1e-9
