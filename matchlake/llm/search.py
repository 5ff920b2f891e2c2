"""Exhaustive exact top-k search by inner product, a term at a time.

Candidates are cut into blocks of rows. A block keeps, for every component ("term"), the postings of its vectors:
which vectors have a non-zero value there, and the values. Queries come in blocks as well. A query block meets every
candidate block; each term scatters its weighted postings into the dense score array of the queries that have it. A
partition selection on scores takes the k best of every query in the block, and these are merged over all blocks.
Nothing is approximate, and neither side is broadcast, not by Spark's own choice either: a task holds a candidate block
and all query blocks stream past it, so there is no join whose size Spark could take for a small one.

Scores are integers. Ties go to the smaller id. Defined cases: vectors that are null, or hold a null, NaN or infinite
component, take no part; missing components of shorter vectors are zero; an empty vector scores zero; a query's own id
is not among its candidates, nor are other rows with that id; rows with a null id take no part; repeated candidate
rows are ranked one by one, repeated query rows are one query per distinct row; an empty table gives an empty result.
Components whose integer does not fit 31 bits are computed with exact integers and a score is cut at 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.llm.shared import ship
from matchlake.operators.common import meet, settle

QUERY_BLOCK = 512
DOC_BLOCK = 4096
SCALE = 256
QUERY_ROWS = 32  # of a block that are scored at once, so that scores stay in cache
NAMES = ["query_row", "query_id", "vec_id", "score"]
HITS = ", ".join(f"{c} long" for c in NAMES)


def usable(vector: Column) -> Column:
    """The components as doubles, or null when the vector takes no part."""
    values = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, values)


def _ints(vectors: list, scale: int) -> tuple[np.ndarray, bool]:
    """Rows of integers, zero-padded to one width; exact Python integers where 64 bits could overflow."""
    width = max((len(v) for v in vectors), default=0)
    m = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    with np.errstate(over="ignore"):
        m = np.floor(m * scale)
    if m.size and np.abs(m).max() >= 2 ** 24:
        return np.array([[int(np.floor(x * scale)) if np.isfinite(x * scale) else int(x) * scale for x in v]
                         + [0] * (width - len(v)) for v in vectors], dtype=object).reshape(m.shape), True
    return m.astype(np.int64), False


def _accumulate(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Scores of all queries over all documents of a block, a term at a time."""
    scores = np.zeros((len(queries), len(docs)), dtype=docs.dtype if docs.dtype == queries.dtype else object)
    for t in range(min(queries.shape[1], docs.shape[1])):
        rows, column = np.flatnonzero(queries[:, t]), docs[:, t]
        posting = np.flatnonzero(column)
        if not len(rows) or not len(posting):
            continue
        if 4 * len(posting) * len(rows) > scores.size:  # picking the few zeros out would cost more than adding them
            scores += queries[:, t, None] * column
        else:
            scores[np.ix_(rows, posting)] += queries[rows, t, None] * column[posting]
    return scores


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best scores of one query, ties to the lower column."""
    if len(scores) <= k:
        return np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k])
    floor = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > floor)
    return np.concatenate([above, np.flatnonzero(scores == floor)[:k - len(above)]])


def _blocks(rows: DataFrame, block: int, number: str) -> tuple[DataFrame, int]:
    """One row per block, holding the about `block` rows that a hash deals to it, and the number of blocks."""
    n = max(1, -(-rows.count() // block))
    dealt = rows.withColumn(number, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    return dealt.groupBy(number).agg(F.sort_array(F.collect_list(F.struct("id", "row", "v"))).alias("rows")), n


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = SCALE, query_block: int = QUERY_BLOCK,
           doc_block: int = DOC_BLOCK) -> DataFrame:
    """vectors(id, v) and queries(id, v): query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    numbered = lambda df: df.select(F.col("id").cast("long").alias("id"), usable(F.col("v")).alias("v")).filter(
        "id is not null and v is not null").withColumn("row", F.monotonically_increasing_id())
    docs, asked = settle(numbered(vectors), "search-vectors"), settle(numbered(queries), "search-queries")
    (left, _), (right, n) = _blocks(asked, query_block, "qb"), _blocks(docs, doc_block, "db")

    def rows_of(block: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        v = block.field("v")
        ends = np.cumsum(v.value_lengths().to_numpy())
        m, big = _ints(np.split(v.flatten().to_numpy(), ends[:-1]), scale)
        return block.field("id").to_numpy(), block.field("row").to_numpy(), np.asfortranarray(m), big  # terms side by side

    def score(held: tuple, asked: tuple) -> pa.RecordBatch:
        (ids, _, d, huge), (own, numbers, q, big) = held, asked
        if big or huge:
            q, d = q.astype(object), d.astype(object)
        out = []
        for a in range(0, len(q), QUERY_ROWS):
            for i, s in enumerate(_accumulate(q[a:a + QUERY_ROWS], d), a):
                keep = np.flatnonzero(ids != own[i])
                best = keep[_best(s[keep], k)]
                out += [(numbers[i], own[i], ids[j], max(min(int(s[j]), 2 ** 63 - 1), -2 ** 63)) for j in best]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(len(NAMES))], names=NAMES)

    def run(batches):
        held = None
        for b in batches:
            for i in range(b.num_rows):
                if b["held"][i].as_py():
                    held = rows_of(b["rows"][i].values)
                elif held is not None:
                    yield score(held, rows_of(b["asked"][i].values))

    asked = settle(left.select(F.col("rows").alias("asked")), "search-asked")
    hits = meet(right.withColumnRenamed("db", "block"), asked, n, run, HITS)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
