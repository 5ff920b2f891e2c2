from pyspark.sql import functions as F

from matchlake.operators import cleaning
from matchlake.sources import readers

LONG = " ".join(f"word{i}" for i in range(25))
RAW = [(3, "Civil Engineer!", LONG + " <b>x</b>", None, " Mid "), (1, None, LONG + " x", "Co", None),
       (2, "Sales", "too short", "Co", "Low"), (4, "Sales", None, "Co", "Low")]
SCHEMA = "job_id bigint, title string, description string, company_name string, formatted_experience_level string"


def test_clean_jobs(spark):
    rows = cleaning.clean_jobs(spark.createDataFrame(RAW, SCHEMA)).collect()
    assert [r["job_id"] for r in rows] == [1]  # 3 has the same cleaned description
    r = rows[0]
    assert r["description_clean"] == LONG + " x" and r["desc_word_count"] == 26
    assert (r["title_clean"], r["experience_level"], r["job_category"]) == ("", "Unknown", "Other")


def test_funnel_counts_match_the_cleaned_table(spark):
    got = cleaning.cleaning_funnel(spark.createDataFrame(RAW, SCHEMA)).first().asDict()
    assert got == {"raw": 4, "described": 3, "long_enough": 2, "kept": 1, "removed": 1}


def test_one_content_in_most_rows(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    kept = cleaning.keep_first(df.repartition(8), F.col("t"), "id")
    assert kept.count() == 1667 + 1
    assert kept.filter("t = 'same'").first()["id"] == 1


def test_clean_resumes_falls_back_to_html(spark):
    rows = [(1, "short", f"<p>{LONG} {LONG}</p>", " HR "), (2, f"{LONG} {LONG}", "<p>x</p>", "IT"), (3, LONG, None, "IT"),
            (4, None, None, "IT")]
    df = spark.createDataFrame(rows, "ID bigint, Resume_str string, Resume_html string, Category string")
    got = {r["ID"]: r for r in cleaning.clean_resumes(df).collect()}
    assert set(got) == {1, 2} and got[1]["resume_clean"] == f"{LONG} {LONG}" and got[1]["Category"] == "HR"
    assert set(r["ID"] for r in cleaning.clean_resumes(df.drop("Resume_html")).collect()) == {2}


def test_unmapped_categories_stand_for_themselves(spark):
    df = spark.createDataFrame([("ACCOUNTANT",), ("Zoo",), (None,)], "c string")
    got = cleaning.normalise_category(df, readers.category_map(spark), "c", "m").collect()
    assert {r["c"]: r["m"] for r in got} == {"ACCOUNTANT": "Finance", "Zoo": "Zoo", None: None}


def test_distinct_categories(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    assert [r[0] for r in cleaning.distinct_categories(df, "c").collect()] == ["a", "b"]


def test_numbers_with_type_letters_are_no_numbers(spark):
    from matchlake.operators import cleaning

    cells = ["12d", "1f", "0x1p3", " 12 ", "-1.5e3", ".5", "7.", "inf", "n/a", "", None]
    got = cleaning.lenient_numbers(spark.createDataFrame([(c,) for c in cells], "x string"), ["x"]).collect()
    assert [r["x"] for r in got] == [None, None, None, 12.0, -1500.0, 0.5, 7.0, float("inf"), None, None, None]
