import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.operators import vectors
from matchlake.sources import index_store


def frame(spark, matrix, id_col):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{id_col} bigint, embedding array<float>")


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(4)
    docs = rng.normal(size=(700, 12))
    docs[100:330] = docs[100]  # a third of the vectors are copies of one
    docs /= np.linalg.norm(docs, axis=1, keepdims=True)
    queries = np.vstack([docs[100:103], rng.normal(size=(20, 12))])
    return queries.astype(np.float32), docs.astype(np.float32)


@pytest.mark.parametrize("options", [{}, {"broadcast_values": 0, "query_block": 5, "doc_block": 90}])
def test_exact_top_k(spark, matrices, options):
    queries, docs = matrices
    d = frame(spark, docs, "doc_id").repartition(5)
    found = vectors.search_vectors(frame(spark, queries, "query_id"), d, 10, **options).collect()
    scores = np.round(queries.astype(float) @ docs.astype(float).T, 9)
    assert len(found) == 10 * len(queries)
    for q in range(len(queries)):
        got = [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert got == list(np.lexsort((np.arange(700), -scores[q]))[:10])


def test_fewer_documents_than_k_and_none(spark, matrices):
    queries, docs = matrices
    q = frame(spark, queries, "query_id")
    assert vectors.search_vectors(q, frame(spark, docs[:3], "doc_id"), 10).count() == 3 * len(queries)
    empty = spark.createDataFrame([], "doc_id bigint, embedding array<float>")
    assert vectors.search_vectors(q, empty, 10).count() == 0
    assert vectors.search_vectors(q.filter("false"), frame(spark, docs, "doc_id"), 10).count() == 0


def test_hashing_encoder_equals_its_definition(spark):
    texts = ["python machine learning python", "the of", None, "full-time work x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    got = vectors.encode(df, "i", F.col("t"), vectors.HashingEncoder(16)).orderBy("doc_id").collect()
    for row, tokens in zip(got, [["python", "machine", "learning", "python"], [], [], ["full-time", "work"]]):
        v = np.zeros(16)
        for t in tokens:
            digest = hashlib.md5(t.encode()).hexdigest()
            v[int(digest[:8], 16) % 16] += 1 if int(digest[8], 16) % 2 == 0 else -1
        norm = np.linalg.norm(v)
        assert np.allclose(row["embedding"], v / norm if norm else v, atol=1e-6)


def test_a_batch_hashes_a_repeated_token_once(spark, monkeypatch):
    import pyarrow as pa

    hashed, md5 = [], hashlib.md5
    monkeypatch.setattr(vectors.hashlib, "md5", lambda t: hashed.append(t) or md5(t))
    got = vectors._hashed(pa.array([["a1", "b2", "a1"], None, [], ["a1"]], pa.list_(pa.string())), 8)
    assert sorted(hashed) == [b"a1", b"b2"] and [len(v) for v in got.to_pylist()] == [8] * 4
    assert got.to_pylist()[1:3] == [[0.0] * 8] * 2 and sum(abs(x) for x in got.to_pylist()[3]) == 1.0


def test_model_encoder_loads_a_given_model(spark, tmp_path):
    def load():
        return lambda texts: np.array([[float(len(t)), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(1, 6)], "ID bigint, Resume_str string")
    built = vectors.build_resume_vectors(df, vectors.ModelEncoder(load, "lengths", 2))
    stored = index_store.save_vectors(built, str(tmp_path / "v"))
    got = stored.vectors.orderBy("doc_id").collect()
    assert np.allclose(got[2]["embedding"], np.array([3, 1]) / np.sqrt(10))
    assert spark.read.parquet(str(tmp_path / "v/vectors")).first()["model"] == "lengths"
    assert stored.meta.filter("doc_id = 5").first()["text"] == "xxxxx"


def test_job_vectors_of_a_sample(spark, five):
    jobs = five.withColumnRenamed("doc_id", "job_id")
    built = vectors.build_job_vectors(jobs, sample_size=3)
    assert built.vectors.count() == 3 and built.meta.columns == ["doc_id", "title", "company", "category"]


@pytest.mark.parametrize("options", [{}, {"broadcast_values": 0, "query_block": 2, "doc_block": 2}])
def test_unusable_vectors_take_no_part(spark, options):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0, 0.0])], "query_id bigint, embedding array<double>")
    d = spark.createDataFrame([(5, [1.0, 0.0]), (6, None), (7, [0.5]), (None, [1.0, 1.0]), (8, [0.0, 1.0])], "doc_id bigint, embedding array<double>")
    rows = vectors.search_vectors(q.orderBy("query_id"), d, 5, **options).collect()
    assert [(r["query_id"], r["doc_id"], r["rank"]) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 5, 1), (1, 8, 2)]


def test_grid_copies_rows_by_the_size_of_a_cell(spark, matrices, monkeypatch):
    """Blocks of 5 rows were 140 copies of each query; now there are as many blocks as cores or a cell's bound need."""
    assert vectors._blocks(1_000_000, 256, 64, 12) == 16
    assert vectors._blocks(100_000, 256, 64, 12) == 7
    assert vectors._blocks(500, 256, 64, 12) == 2 and vectors._blocks(0, 256, 64, 12) == 1
    queries, docs = matrices
    monkeypatch.setattr(vectors, "CELL_VALUES", 1_000)
    monkeypatch.setattr(vectors, "PRODUCT", (3, 40))
    found = vectors.search_vectors(frame(spark, queries, "query_id"), frame(spark, docs, "doc_id"), 10, 0, 5, 5)
    scores = np.round(queries.astype(float) @ docs.astype(float).T, 9)
    found = found.collect()
    for q in range(len(queries)):
        got = [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert got == list(np.lexsort((np.arange(700), -scores[q]))[:10])
