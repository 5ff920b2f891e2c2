import pytest
from pyspark.sql import functions as F

from matchlake.operators import sampling
from matchlake.sources import rank_store


def by_sorting(df, seed=42):
    """Places by a plain sort of everything."""
    rows = df.select("doc_id", sampling.hash_order(seed, F.col("doc_id")).alias("order")).collect()
    return [r["doc_id"] for r in sorted(rows, key=lambda r: (r["order"], r["doc_id"]))]


@pytest.mark.parametrize("n", [0, 7, 20_000])
def test_every_place_is_the_one_of_a_sort(spark, tmp_path, n):
    docs = spark.range(n).select((F.col("id") * 3 - 5).alias("doc_id"))
    built = rank_store.build(docs.repartition(5), str(tmp_path / "d"))
    assert built.n == n and rank_store.open_directory(spark, built.path) == built
    wanted = by_sorting(docs)
    places = range(-2, n + 2) if n < 100 else range(0, n, 97)
    asked = spark.createDataFrame([(p, f"q{p % 3}") for p in places], "place long, query_id string")
    for few in (False, True):
        got = {r["place"]: r["doc_id"] for r in rank_store.fetch(built, asked, few).collect()}
        assert got == {p: wanted[p] for p in places if 0 <= p < n}


def test_ids_of_other_types(spark, tmp_path):
    docs = spark.createDataFrame([(x,) for x in ["b", "", "é", None, "a\nb"]], "doc_id string")
    built = rank_store.build(docs, str(tmp_path / "d"))
    got = rank_store.fetch(built, spark.range(9).select(F.col("id").alias("place"))).collect()
    assert len(got) == 5 and {r["doc_id"] for r in got} == {"b", "", "é", None, "a\nb"}


def test_draws_are_those_without_a_directory(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"))
    queries = spark.range(9).select(F.col("id").alias("query_id"))
    built = rank_store.build(docs, str(tmp_path / "d"))
    pool = sampling.random_candidates(queries, docs, 30).select("query_id", "doc_id")
    for few in (False, True):
        draws = [sorted(sampling.random_candidates(queries, docs, 20, few=few, directory=d).collect()) for d in (None, built)]
        negatives = [sorted(sampling.random_negatives(queries, docs, pool, 5, few=few, directory=d).collect()) for d in (None, built)]
        assert draws[0] == draws[1] and len(draws[0]) == 180
        assert negatives[0] == negatives[1] and len(negatives[0]) == 45
    with pytest.raises(ValueError):
        sampling.random_candidates(queries, docs, 20, seed=7, directory=built)


def test_few_draws_open_few_prefixes(spark, tmp_path):
    """1,000 draws from a million rows open under 3 % of the prefixes, and folders without a hit are not read."""
    docs = spark.range(1_000_000).select(F.col("id").alias("doc_id"))
    built = rank_store.build(docs, str(tmp_path / "d"))
    draws = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(built.n)).alias("place"))
    hit = rank_store.located(built, draws).select("coarse", "fine").distinct().count()
    assert 0 < hit < 0.03 * built.packed.count()
    assert built.digits == 2
    few = rank_store.fetch(built, draws.limit(3), few=True)
    assert "dynamicpruning" in few._jdf.queryExecution().toString().lower()
    assert rank_store.fetch(built, draws, few=True).count() == 1000
