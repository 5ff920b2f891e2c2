import random

from matchlake.operators import lexical
from matchlake.plans import jobs
from matchlake.sources import index_store
from matchlake.streaming.matching import match_stream


def corpus(spark):
    rng = random.Random(9)
    topics = {"Sales": "quota client revenue pipeline account", "Finance": "ledger audit tax budget invoice"}
    raw = {"Sales": "SALES", "Finance": "ACCOUNTANT"}

    def words(topic):
        return " ".join(rng.choices(topics[topic].split() + ["team", "work", "office", "people"], k=40))

    postings = [(i, {"Sales": "Sales person", "Finance": "Financial clerk"}[t], words(t), "Co", "Here", "1", None, None)
                for i, t in enumerate(rng.choices(list(topics), k=60))]
    profiles = [(1000 + i, words(t), raw[t]) for i, t in enumerate(rng.choices(list(topics), k=20))]
    return (spark.createDataFrame(postings, "job_id bigint, title string, description string, company_name string, "
                                  "location string, max_salary string, formatted_experience_level string, views string"),
            spark.createDataFrame(profiles, "ID bigint, Resume_str string, Category string"))


def test_all_steps(spark, tmp_path):
    postings, profiles = corpus(spark)
    out = jobs.Layout(str(tmp_path))
    report = {r["metric"]: r["mean"] for r in jobs.run_all(spark, postings, profiles, out).collect()}
    assert 0.5 < report["P@5"] <= 1.0 and 0.0 < report["MAP"] <= 1.0
    again = {r["metric"]: r["mean"] for r in jobs.evaluate(spark, out).collect()}
    assert again == report
    assert jobs.build_indexes(spark, out, n_jobs=10)
    assert index_store.open_lexical(spark, out.jobs_lexical).totals.first()["n_docs"] == 10
    assert jobs.run_all(spark, None, profiles, out) is None
    assert not jobs.build_indexes(spark, jobs.Layout(str(tmp_path / "nothing")))


def test_all_steps_without_vectors(spark, tmp_path):
    postings, profiles = corpus(spark)
    out = jobs.Layout(str(tmp_path))
    assert jobs.run_all(spark, postings, profiles, out, with_vectors=False).count() > 0
    assert not (tmp_path / "jobs_vectors").exists()


def test_stream_equals_batch(spark, tmp_path, five_index):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts = ["sourdough baker bread ovens", "harbour crane container", "galley supplies clean"]
    for part in range(2):
        spark.createDataFrame([(part * 3 + i, t) for i, t in enumerate(texts)], "query_id bigint, text string") \
            .coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema("query_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(source)
    match = lambda batch: lexical.search(five_index, batch, 3)
    for _ in range(2):  # the second run finds nothing new
        match_stream(arriving, match, out, str(tmp_path / "state"), True).awaitTermination()
    batch = match(spark.read.parquet(source))
    columns = ["query_id", "doc_id", "score", "rank"]
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 2
    assert sorted(got.select(columns).collect()) == sorted(batch.select(columns).collect())
