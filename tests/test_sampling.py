import pytest
from pyspark.sql import functions as F

from matchlake.operators import sampling


@pytest.fixture(scope="module")
def docs(spark):
    lang = F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 10 < 4, None).otherwise("hot")
    return spark.range(3000).select(F.col("id").alias("doc_id"), lang.alias("category"))


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(q, ["hot", "rare", "absent"][q % 3]) for q in range(9)]
    return spark.createDataFrame(rows, "query_id bigint, category string")


def ids(df, c="doc_id"):
    return sorted(r[c] for r in df.collect())


def test_places_number_every_row(docs):
    placed = sampling.places(docs, sampling.hash_order(1, F.col("doc_id")), "doc_id", ("category",)).collect()
    by = {}
    for r in placed:
        by.setdefault(r["category"], []).append(r["place"])
        assert r["places"] == {"rare": 300, "hot": 1800}.get(r["category"], r["places"])
    assert sorted(by["hot"]) == list(range(1800)) and sorted(by["rare"]) == list(range(300))


def test_samples_do_not_depend_on_partitioning(docs):
    a, b = docs.repartition(1), docs.repartition(13)
    for take in (lambda d: sampling.simple_sample(d, "doc_id", 50),
                 lambda d: sampling.stratified_queries(d, "doc_id", "category", 11),
                 lambda d: sampling.stratified_sample(d, "doc_id", "category", 700)):
        assert ids(take(a)) == ids(take(b))
    assert len(ids(sampling.simple_sample(a, "doc_id", 50))) == 50
    assert ids(sampling.simple_sample(a, "doc_id", 50)) != ids(sampling.simple_sample(a, "doc_id", 50, seed=7))


def test_stratified_queries(docs):
    rows = sampling.stratified_queries(docs, "doc_id", "category", 11).groupBy("category").count().collect()
    assert {r["category"]: r["count"] for r in rows} == {"hot": 3, "rare": 3}  # nulls are the third share
    assert sampling.stratified_queries(docs, "doc_id", "category", 3).count() == 3


def test_stratified_sample_tops_up(docs, spark):
    rows = sampling.stratified_sample(docs, "doc_id", "category", 1000).groupBy("category").count().collect()
    got = {r["category"]: r["count"] for r in rows}
    assert sum(got.values()) == 1000 and got["rare"] == 300 and got["hot"] >= 500
    assert sampling.stratified_sample(docs, "doc_id", "category", 9999).count() == 3000
    nulls = docs.withColumn("category", F.lit(None).cast("string"))
    assert sampling.stratified_sample(nulls, "doc_id", "category", 40).count() == 40
    assert sampling.stratified_sample(docs, "doc_id", "no_such", 40).count() == 40


@pytest.mark.parametrize("few", [True, False])
def test_random_candidates(docs, queries, few):
    rows = sampling.random_candidates(queries, docs, 20, few=few).collect()
    by = {}
    for r in rows:
        by.setdefault(r["query_id"], set()).add(r["doc_id"])
    assert {len(v) for v in by.values()} == {20} and len(by) == 9
    assert len(set(map(frozenset, by.values()))) > 1
    assert sampling.random_candidates(queries, docs.limit(7), 20).count() == 7 * 9


def test_negatives_stay_outside_the_pool(docs, queries, spark):
    pool = sampling.random_candidates(queries.filter("query_id < 8"), docs, 30).select("query_id", "doc_id")
    got = sampling.random_negatives(queries, docs, pool, 5)
    assert got.count() == 5 * 9 and got.distinct().count() == 5 * 9
    assert got.join(pool, ["query_id", "doc_id"]).count() == 0
    tiny = docs.filter("doc_id < 4")
    full = queries.select("query_id").crossJoin(tiny.filter("doc_id < 3").select("doc_id"))
    assert ids(sampling.random_negatives(queries, tiny, full, 5)) == [3] * 9


def test_half_and_half(docs, queries):
    named = docs.fillna("none")
    rows = sampling.half_and_half(queries, named, 20).join(named, "doc_id").join(
        queries.select("query_id", F.col("category").alias("own")), "query_id").collect()
    by = {}
    for r in rows:
        assert r["same"] == (r["category"] == r["own"])
        by.setdefault((r["query_id"], r["own"]), []).append((r["doc_id"], r["same"]))
    for (_, own), picked in by.items():
        assert len(picked) == 20 == len({d for d, _ in picked})
        assert sum(s for _, s in picked) == (0 if own == "absent" else 10)
    only = named.filter("category = 'rare'").limit(6)
    assert sampling.half_and_half(queries.filter("category = 'rare'"), only, 20).count() == 6 * 3


def test_draws_are_independent(spark):
    """Every document, and every pair of documents, is drawn about as often as any other."""
    asked, n, k = 2000, 12, 3
    queries, docs = spark.range(asked).withColumnRenamed("id", "query_id"), spark.range(n).withColumnRenamed("id", "doc_id")
    by = {}
    for r in sampling.random_candidates(queries, docs, k).collect():
        by.setdefault(r["query_id"], set()).add(r["doc_id"])
    one, two = {}, {}
    for v in by.values():
        for a in v:
            one[a] = one.get(a, 0) + 1
            for b in v:
                if a < b:
                    two[a, b] = two.get((a, b), 0) + 1
    assert len(by) == asked and len(one) == n and len(two) == n * (n - 1) // 2
    assert all(abs(x - asked * k / n) < 110 for x in one.values())
    assert all(abs(x - asked * k * (k - 1) / n / (n - 1)) < 50 for x in two.values())
    assert len(set(map(frozenset, by.values()))) > 200


def test_places_beyond_32_bits_can_be_drawn(spark):
    n = 1 << 40
    q = spark.range(300).select(sampling.chosen(1, "draw", F.col("id"), F.lit(4).cast("long"), F.lit(n)).alias("p"))
    got = [x for r in q.collect() for x in r["p"]]
    assert len(set(got)) == len(got) == 1200 and max(got) > 0.99 * n and min(got) < 0.01 * n
    assert sum(x > n / 2 for x in got) in range(520, 680)
    few = spark.range(50).select(sampling.chosen(1, "draw", F.col("id"), F.lit(5).cast("long"), F.lit(5)).alias("p")).collect()
    assert all(sorted(r["p"]) == [0, 1, 2, 3, 4] for r in few)


def test_null_category_counts_in_the_share(spark):
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "a").alias("category"))
    assert sampling.stratified_queries(rows, "doc_id", "category", 10).count() == 5
