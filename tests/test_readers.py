from pyspark.sql import functions as F

from matchlake.functions.fixed import CATEGORY_MAP
from matchlake.operators import cleaning
from matchlake.sources import readers


def test_postings_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('job_id,title,description,company_name,max_salary,extra\n'
                    '1,"A ""quoted"" title","line one\nline two",N/A,12.5,x\n2,T,,Co,abc,y\n')
    df = readers.read_postings(spark, str(tmp_path / "missing.csv"), str(path))
    assert df.columns == ["job_id", "title", "description", "company_name", "max_salary"]
    rows = {r["job_id"]: r for r in df.collect()}
    assert rows[1]["title"] == 'A "quoted" title' and rows[1]["description"] == "line one\nline two"
    assert rows[1]["company_name"] is None and rows[2]["description"] is None
    numbers = cleaning.lenient_numbers(df, ["max_salary", "views"]).orderBy("job_id").collect()
    assert [r["max_salary"] for r in numbers] == [12.5, None]


def test_missing_inputs(spark, tmp_path):
    assert readers.read_postings(spark, str(tmp_path / "a"), str(tmp_path / "b")) is None
    assert readers.read_resumes(spark, str(tmp_path / "a")) is None
    assert readers.read_delimited(spark, str(tmp_path / "a")) is None
    assert readers.read_category_map(spark, str(tmp_path / "a")).count() == 0


def test_resumes_and_large_postings(spark, tmp_path):
    (tmp_path / "r.csv").write_text("ID,Resume_str,Category\n7,text here,HR\n")
    assert readers.read_resumes(spark, str(tmp_path / "r.csv")).first()["ID"] == 7
    (tmp_path / "j.csv").write_text("job_link,job_title,other,job_level\nl,t,o,Mid\n")
    (tmp_path / "s.csv").write_text("job_link,job_skills\nl,\"a, b\"\n")
    jobs, skills = readers.read_large_postings(spark, str(tmp_path / "j.csv"), str(tmp_path / "s.csv"))
    assert jobs.columns == ["job_link", "job_title", "job_level"] and skills.first()["job_skills"] == "a, b"
    assert readers.read_large_postings(spark, str(tmp_path / "j.csv"), str(tmp_path / "no"))[1] is None


def test_delimited(spark, tmp_path):
    (tmp_path / "d.txt").write_bytes(b"1 ::: dev ; ; ops :::<b>some</b> text\nno separators\n2:::only two\n"
                                     b"3:::x:::bad \xff byte:::rest\n")
    rows = {r["id"]: r for r in readers.read_delimited(spark, str(tmp_path / "d.txt")).collect()}
    assert set(rows) == {"1", "3"}
    assert rows["1"]["occupations"] == ["dev", "ops"] and rows["1"]["num_labels"] == 2
    assert rows["1"]["occupation_str"] == "dev ; ; ops" and rows["1"]["text"] == "some  text"
    assert rows["3"]["text"] == "bad � byte" and rows["3"]["word_count"] == 3


def test_category_map_round_trip(spark, tmp_path):
    path = str(tmp_path / "map")
    readers.write_category_map(readers.category_map(spark), path)
    assert {r["raw"]: r["mapped"] for r in readers.read_category_map(spark, path).collect()} == CATEGORY_MAP


def test_judgments_take_the_best_grade_and_hash_names(spark, tmp_path):
    (tmp_path / "j.csv").write_text("query_id,query_category,doc_id,doc_category,doc_title,relevance\n"
                                    "1,a,10,b,\"t, x\",0\n1,a,10,b,t,3\n1,a,job-x,b,t,2\n")
    rows = readers.read_judgments(spark, str(tmp_path / "j.csv")).collect()
    assert {r["doc_id"]: r["relevance"] for r in rows if r["doc_id"] == 10} == {10: 3}
    assert len(rows) == 2


def test_first_rows_and_pick(spark):
    df = spark.range(100).repartition(7)
    assert [r["id"] for r in readers.first_rows(df, "id", 3).collect()] == [0, 1, 2]
    assert df.select(readers.pick(df, "nope", "id").alias("x"), readers.pick(df, "nope").alias("y")).first()["y"] == ""


def test_write_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c')], "i int, s string")
    readers.write_table(df, str(tmp_path / "o"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "o")).select(F.col("s")).first()["s"] == 'a "b", c'
