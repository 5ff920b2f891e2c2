import os

import pytest
from pyspark.sql import functions as F

from matchlake.operators import judging
from matchlake.sources import grade_ledger


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(q, "Sales", d, "Legal", f"title {d}", f"text {q}", None if d == 3 else f"about {d}") for q in range(3) for d in range(8)]
    rows += [(9, "Sales", 70, None, "title 1", "text 1", "about 1"), (9, None, 71, None, None, None, None)]
    return spark.createDataFrame(rows, "query_id long, query_category string, doc_id long, doc_category string, "
                                       "doc_title string, text string, description string").withColumn("prompt", F.lit("x"))


def asking(folder, refuse=lambda text, title: False):
    """A grader that notes in `folder` what it is asked."""
    def score(text, title, description):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{text}|{title}|{description}")
        if refuse(text, title):
            raise RuntimeError("no answer")
        return len(title) % 4

    return grade_ledger.asked(score)


def noted(folder):
    return sorted(open(f"{folder}/{f}").read() for f in os.listdir(folder))


def grades(df):
    return sorted((r["query_id"], r["doc_id"], r["relevance"]) for r in df.collect())


def wanted(pairs):
    return sorted((r["query_id"], r["doc_id"], len(r["doc_title"] or "") % 4) for r in pairs.collect())


def test_a_stopped_run_goes_on(pairs, tmp_path):
    """The second batch's write fails; the next run asks exactly the pairs that the first batch did not have."""
    first, second, root = tmp_path / "first", tmp_path / "second", str(tmp_path / "ledger")
    first.mkdir(), second.mkdir()
    calls = []

    def stops(*columns):
        calls.append(1)
        if len(calls) > 2:  # the schema of a batch and the batch take a call each
            raise KeyboardInterrupt
        return asking(first)(*columns)

    with pytest.raises(KeyboardInterrupt):
        grade_ledger.grade(pairs, stops, root, per_batch=9)
    assert 0 < len(noted(first)) < 25
    got = grade_ledger.grade(pairs, asking(second), root, per_batch=9)
    assert grades(got) == wanted(pairs) and got.columns == judging.COLUMNS
    both = noted(first) + noted(second)
    assert len(both) == len(set(both)) == 25  # 26 pairs, two of equal content
    assert grades(grade_ledger.grade(pairs, asking(second), root)) == wanted(pairs) and len(noted(second)) + len(noted(first)) == 25


def test_retries_are_bounded(pairs, spark, tmp_path):
    notes, again, root = tmp_path / "notes", tmp_path / "again", str(tmp_path / "ledger")
    notes.mkdir(), again.mkdir()
    got = grade_ledger.grade(pairs, asking(notes, lambda text, title: title == "title 5"), root, retries=2)
    assert {r["relevance"] for r in got.filter("doc_title = 'title 5'").collect()} == {0}
    assert len(noted(notes)) == 25 + 3  # three pairs are asked twice
    failed = grade_ledger.failures(spark, root).collect()
    assert len(failed) == 3 and {(r["tries"], r["error"]) for r in failed} == {(2, "RuntimeError: no answer")}
    grade_ledger.grade(pairs, asking(again), root, retries=2)
    assert noted(again) == []
    assert grades(grade_ledger.grade(pairs, asking(again), root, retries=3)) == wanted(pairs)
    assert len(noted(again)) == 3 and grade_ledger.failures(spark, root).count() == 0


def test_columns_and_empty_tables(pairs, spark, tmp_path):
    column = lambda text, title, d: F.when(title == "title 1", "3").otherwise("n/a")
    got = grade_ledger.grade(pairs, column, str(tmp_path / "a"), retries=1)
    assert {(r["doc_title"] == "title 1", r["relevance"]) for r in got.collect()} == {(True, 3), (False, 0)}
    assert got.count() == 26
    assert grade_ledger.grade(pairs.limit(0), column, str(tmp_path / "b")).count() == 0
