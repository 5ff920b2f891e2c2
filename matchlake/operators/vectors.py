"""Text encoding and exact cosine search."""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions import fixed
from matchlake.functions.bind import let
from matchlake.functions.text import job_embed_text, resume_embed_text, tokens
from matchlake.operators.common import top_k
from matchlake.operators.lexical import job_meta, resume_meta
from matchlake.operators.sampling import simple_sample
from matchlake.sources.readers import pick

# Query vectors up to this many values (32 MB of doubles) are sent to every task.
BROADCAST_VALUES = 4_000_000
# Block sizes of the grid used beyond it: a query block and a document block have at least so many rows.
QUERY_BLOCK = 2_048
DOC_BLOCK = 32_768
# A grid cell holds about this many values of either side at most, and smaller blocks are only for more cells than this.
CELL_VALUES = 4_000_000
CELLS_PER_CORE = 4
# Rows of a matrix product inside a task: queries and documents.
PRODUCT = 256, 4_096
# Task functions travel by value: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_FOUND = "query_id bigint, doc_id bigint, score double"


def unit(v: Column) -> Column:
    """The vector over its length; a zero vector stays zero."""
    def scaled(x: Column) -> Column:
        norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, e: s + e * e))
        return F.when(norm > 0, F.transform(x, lambda e: e / norm)).otherwise(x)

    as_double = F.transform(v, lambda e: e.cast("double"))
    return let(as_double, scaled)


def _hashed(found: pa.ListArray, dim: int) -> pa.ListArray:
    """Unit vectors of signed token counts. A batch's distinct tokens are hashed once each."""
    entries = found.flatten().dictionary_encode()
    digests = [hashlib.md5(t.encode()).hexdigest() for t in entries.dictionary.to_pylist()]
    bucket = np.array([int(d[:8], 16) % dim for d in digests], dtype=np.int64)
    sign = np.array([1 - 2 * (int(d[8], 16) % 2) for d in digests], dtype=np.float64)
    code = entries.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    counts = np.bincount(row * dim + bucket[code], weights=sign[code], minlength=len(found) * dim).reshape(-1, dim)
    norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))  # of whole numbers, so exact in any order
    values = (counts / np.where(norm > 0, norm, 1.0)).astype(np.float32)
    return pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * dim, values.ravel())


@dataclass(frozen=True)
class HashingEncoder:
    """Signed feature hashing of tokens: a token adds 1 to the bucket that its hash names, or takes 1 off."""
    dim: int = 64
    name: str = "hashing"

    def __call__(self, text: Column) -> Column:
        dim = self.dim

        @F.arrow_udf(T.ArrayType(T.FloatType()))
        def hashed(found: pa.Array) -> pa.Array:
            return _hashed(found, dim)

        return hashed(tokens(text))


@dataclass(frozen=True)
class ModelEncoder:
    """A model behind `load() -> predict(texts) -> matrix`; it loads once per Python worker."""
    load: Callable
    name: str = "model"
    batch_size: int = fixed.ENCODE_BATCH

    def __call__(self, text: Column) -> Column:
        encode = predict_batch_udf(self.load, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size)
        return F.transform(unit(encode(text)), lambda e: e.cast("float"))


Encoder = Callable[[Column], Column]


@dataclass(frozen=True)
class VectorIndex:
    vectors: DataFrame  # doc_id, embedding of unit length
    meta: DataFrame
    encoder: Encoder = field(default_factory=HashingEncoder)

    @property
    def model(self) -> str:
        return getattr(self.encoder, "name", "given")


def encode(df: DataFrame, id_col: str, text: Column, encoder: Encoder) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), encoder(text).alias("embedding"))


def encode_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """Queries are encoded whole."""
    return queries.select("query_id", encoder(F.coalesce("text", F.lit(""))).alias("embedding"))


def build_job_vectors(jobs: DataFrame, encoder: Encoder | None = None, sample_size: int | None = None) -> VectorIndex:
    encoder = encoder or HashingEncoder()
    if sample_size:
        jobs = simple_sample(jobs, "job_id", sample_size, fixed.SEED)
    text = job_embed_text(pick(jobs, "title_clean", "title"), pick(jobs, "description_clean", "description"))
    return VectorIndex(encode(jobs, "job_id", text, encoder), job_meta(jobs).drop("location"), encoder)


def build_resume_vectors(resumes: DataFrame, encoder: Encoder | None = None) -> VectorIndex:
    encoder = encoder or HashingEncoder()
    text = resume_embed_text(pick(resumes, "resume_clean", "Resume_str"))
    return VectorIndex(encode(resumes, "ID", text, encoder), resume_meta(resumes), encoder)


def _matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


class _Best:
    """The k best documents of each query seen so far, ordered as `top_k` orders them.

    A query's floor is its k-th best score so far; of a block of scores only those that reach it, or tie with it at
    nine decimals, are kept, and kept rows are cut to k per query when they have piled up."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.floor = np.full(len(query_ids), -np.inf)
        self.kept = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self.size = 0

    def add(self, doc_ids: np.ndarray, docs: np.ndarray) -> None:
        for first in range(0, len(doc_ids), PRODUCT[1]):
            self._add(doc_ids[first:first + PRODUCT[1]], docs[first:first + PRODUCT[1]])

    def _add(self, doc_ids: np.ndarray, docs: np.ndarray) -> None:
        for start in range(0, len(self.query_ids), PRODUCT[0]):
            scores = self.queries[start:start + PRODUCT[0]] @ docs.T
            floor = self.floor[start:start + PRODUCT[0]]
            row, column = np.nonzero(scores >= floor[:, None] - 2e-9)
            if len(row) > self.k * len(floor) and len(doc_ids) > self.k:  # the floor lets many through: raise it
                np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k], out=floor)
                row, column = np.nonzero(scores >= floor[:, None] - 2e-9)
            self.kept.append((row + start, doc_ids[column], scores[row, column]))
            self.size += len(row)
        if self.size > 8 * self.k * len(self.query_ids) + 100_000:
            self.cut()

    def cut(self) -> None:
        row, ids, scores = (np.concatenate(c) for c in zip(*self.kept))
        order = np.lexsort((ids, -np.floor(scores * 1e9 + 0.5), row))
        row, ids, scores = row[order], ids[order], scores[order]
        first = np.searchsorted(row, np.arange(len(self.query_ids)))
        place = np.arange(len(row)) - first[row]
        self.floor[row[place == self.k - 1]] = scores[place == self.k - 1]
        keep = place < self.k
        self.kept, self.size = [(row[keep], ids[keep], scores[keep])], int(keep.sum())

    def table(self) -> pa.RecordBatch:
        self.cut()
        row, ids, scores = self.kept[0]
        return pa.RecordBatch.from_arrays([pa.array(self.query_ids[row], pa.int64()), pa.array(ids, pa.int64()),
                                           pa.array(scores, pa.float64())], names=["query_id", "doc_id", "score"])


def _scan(queries: pa.Table, vectors: DataFrame, k: int) -> DataFrame:
    """Every task holds the few query vectors and passes over its own documents once."""
    shared = vectors.sparkSession.sparkContext.broadcast(
        (queries["query_id"].to_numpy(), _matrix(queries["embedding"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*shared.value, k)
        for b in batches:
            if b.num_rows:
                best.add(b["doc_id"].to_numpy(zero_copy_only=False), _matrix(b["embedding"]))
        yield best.table()

    return vectors.select("doc_id", "embedding").mapInArrow(run, _FOUND)


def _blocks(rows: int, least: int, width: int, cores: int) -> int:
    """How many blocks a side of the grid has: enough to bound a cell's values and to keep all cores busy, but none for
    fewer than `least` rows. Each block is copied once per block of the other side, so small ones are dear."""
    for_cores = math.isqrt(CELLS_PER_CORE * cores) + 1
    bounded = -(-rows * width // CELL_VALUES)
    return max(1, bounded, min(-(-rows // least), for_cores))


def _grid(queries: DataFrame, vectors: DataFrame, k: int, width: int, query_block: int, doc_block: int) -> DataFrame:
    """Query blocks meet document blocks. Both are cut by a hash into blocks of bounded size, so no
    task depends on how large either side is, and each cell hands on k rows per query. Rows copied between
    tasks are the sides' product over a block's rows; cells are dealt to more partitions than there are cells."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_q = _blocks(queries.count(), query_block, width, cores)
    n_d = _blocks(vectors.count(), doc_block, width, cores)
    dealt = min(4 * n_q * n_d, 10_000)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())]).empty_table()
        best = _Best(left["query_id"].to_numpy(), _matrix(left["query_vector"]), k)
        best.add(right["doc_id"].to_numpy(), _matrix(right["doc_vector"]))
        return pa.Table.from_batches([best.table()])

    def block(c: str, n: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = queries.select(block("query_id", n_q).alias("qb"), every(n_d).alias("db"), "query_id",
                       F.col("embedding").alias("query_vector"))
    d = vectors.select(block("doc_id", n_d).alias("db"), every(n_q).alias("qb"), "doc_id",
                       F.col("embedding").alias("doc_vector"))
    q, d = (side.repartition(dealt, "qb", "db").groupBy("qb", "db") for side in (q, d))
    return q.cogroup(d).applyInArrow(cell, _FOUND)


def search_vectors(queries: DataFrame, vectors: DataFrame, k: int = 10, broadcast_values: int = BROADCAST_VALUES,
                   query_block: int = QUERY_BLOCK, doc_block: int = DOC_BLOCK) -> DataFrame:
    """(query_id, doc_id, score, rank): exact top k by dot product of unit vectors.

    Null vectors, and vectors of another length than the first query's, take no part. Query vectors within
    `broadcast_values` go to every task; more of them use the block grid."""
    asked = queries.select("query_id", "embedding").filter("query_id is not null and embedding is not null")
    width = asked.select(F.size("embedding").alias("n")).limit(1).collect()
    if not width:
        return vectors.sparkSession.createDataFrame([], _FOUND + ", rank int")
    same = F.size("embedding") == width[0]["n"]
    asked, vectors = asked.filter(same), vectors.filter(same & F.col("doc_id").isNotNull())
    most = broadcast_values // max(1, width[0]["n"])
    head = asked.limit(most + 1).toArrow()
    found = _scan(head, vectors, k) if head.num_rows <= most else _grid(
        asked, vectors, k, max(1, width[0]["n"]), query_block, doc_block)
    return top_k(found, k)
