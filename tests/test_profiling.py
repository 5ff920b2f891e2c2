import numpy as np
import pytest

from matchlake.operators import profiling


@pytest.mark.parametrize("values", [[1, 2, 2, 3, 10, 10, 0], [5, 5, 0], list(range(1, 400))])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "word_count int")
    rows = profiling.length_histogram(df, 7).orderBy("bin").collect()
    n, edges = np.histogram([v for v in values if v > 0], bins=7)
    assert [r["n"] for r in rows] == list(n)
    assert np.allclose([r["low"] for r in rows] + [rows[-1]["high"]], edges)


def test_stats(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 9, 0]], "word_count int")
    assert profiling.length_stats(df).first().asDict() == {"n": 4, "median": 2, "mean": 3}
    odd = spark.createDataFrame([(v,) for v in [1, 2]], "word_count int")
    assert profiling.length_stats(odd).first()["median"] == 1


def test_counts(spark):
    df = spark.createDataFrame([("a, b ,,a",), (None,), ("b",), (" ",)], "skill string")
    assert [tuple(r) for r in profiling.top_values(df, "job_skills", "skill").collect()] == [("a", 2), ("b", 2)]
    assert profiling.top_values(df, "other") is None
    assert profiling.top_values(df, "skill", n=1).count() == 1
    levels = spark.createDataFrame([("Mid",), (None,), ("Mid",), ("Low",)], "job_level string")
    assert [tuple(r) for r in profiling.value_counts(levels, "job_level").collect()] == [("Mid", 2), ("Low", 1)]


def test_lengths_pick_a_column(spark):
    text = spark.createDataFrame([("a b",)], "Resume_str string")
    page = spark.createDataFrame([("<p>a b c</p>",)], "Resume_html string")
    none = spark.createDataFrame([("x",)], "other string")
    assert profiling.resume_lengths(text).first()["word_count"] == 2
    assert profiling.resume_lengths(page).first()["word_count"] == 3
    assert profiling.job_lengths(none).first()["word_count"] == 0


def test_sizes(spark):
    rows = profiling.corpus_sizes([("jobs", "a", spark.range(3)), ("jobs", "b", None), ("resumes", "c", spark.range(2))])
    assert {(r[0], r[1]): r[2] for r in rows.collect()} == {
        ("jobs", "a"): 3, ("jobs", "b"): 0, ("resumes", "c"): 2, ("jobs", "all"): 3, ("resumes", "all"): 2,
        ("all", "all"): 5}
