"""Lexical search with very many queries: every query meets every document, so work per hit decides.

Postings are packed once into blocks of whole documents, in order of their term. A task holds one block and all query
blocks stream past it. A query's hits are added up in an array with a place per document: terms that many documents of
the block have as whole rows, the others by their postings. Only the k best documents of a block leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.common import meet, settle

POSTINGS = 4_000_000  # of a block of documents, about
QUERIES = 1_024       # of a block of queries, about
DENSE = 8             # a term in one of so many documents of a block, or more, is kept as a whole row
STRETCH = 256         # documents of which the best score is looked for at once


def _number(c: str, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _packed(postings: DataFrame, blocks: int) -> DataFrame:
    """postings(doc_id, key, part) in one row per block: documents by id, keys, where their postings begin, and these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        found = rows["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(found, pa.ChunkedArray):
            found = found.combine_chunks()
        by_id = pc.sort_indices(found.dictionary, null_placement="at_start")
        place = np.empty(len(by_id), np.int32)
        place[by_id.to_numpy()] = np.arange(len(by_id), dtype=np.int32)
        key = rows["key"].to_numpy()
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        place = place[found.indices.to_numpy()][order]
        yield pa.RecordBatch.from_arrays(
            [rows["block"].slice(0, 1).combine_chunks(), pa.ListArray.from_arrays(
                pa.array([0, len(by_id)], pa.int32()), found.dictionary.take(by_id))]
            + [pa.array([a.tobytes()], pa.binary()) for a in (keys, np.r_[starts, len(key)], place, rows["part"].to_numpy()[order])],
            names=["block", "docs", "keys", "starts", "places", "parts"])

    dealt = postings.withColumn("block", _number("doc_id", blocks)).repartitionById(blocks, "block")
    kind = f"block int, docs array<{_type(postings, 'doc_id')}>, keys binary, starts binary, places binary, parts binary"
    return dealt.select("block", "doc_id", "key", "part").mapInArrow(run, kind)


class _Block:
    """A packed block, and the scores of queries over it."""

    def __init__(self, row: pa.RecordBatch):
        get = lambda name, kind: np.frombuffer(row[name][0].as_buffer(), kind)
        self.docs = row["docs"][0].values
        self.keys, self.starts = get("keys", np.int64), get("starts", np.int64)
        self.places, self.parts = get("places", np.int32).astype(np.int64), get("parts", np.float64).copy()
        self.size = -(-len(self.docs) // STRETCH) * STRETCH
        often = np.flatnonzero(np.diff(self.starts) * DENSE >= len(self.docs))
        self.row_of = np.full(len(self.keys), -1)
        self.row_of[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), self.size))
        self.weighed = np.zeros(len(self.keys), bool)

    def find(self, keys: np.ndarray, weights: np.ndarray) -> tuple[list, list, list]:
        """Where each key's postings begin and end, and its whole row or -1. A key's postings are weighed, and its row
        made, when it is first asked for."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        new, first = np.unique(at[known & ~self.weighed[at]], return_index=True)
        for i, w in zip(new.tolist(), weights[known & ~self.weighed[at]][first].tolist()):
            a, z = self.starts[i], self.starts[i + 1]
            self.parts[a:z] *= w
            if self.row_of[i] >= 0:
                np.add.at(self.rows[self.row_of[i]], self.places[a:z], self.parts[a:z])
        self.weighed[new] = True
        return (self.starts[at].tolist(), np.where(known, self.starts[at + 1], self.starts[at]).tolist(),
                np.where(known, self.row_of[at], -1).tolist())

    def best(self, terms: list[tuple[int, int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents of a query with (begin, end, row) of each term."""
        few = [(a, z) for a, z, row in terms if row < 0 and z > a]
        if few:
            scores = np.bincount(np.concatenate([self.places[a:z] for a, z in few]),
                                 np.concatenate([self.parts[a:z] for a, z in few]), self.size)
        else:
            scores = np.zeros(self.size)
        for _, _, row in terms:
            if row >= 0:
                scores += self.rows[row]
        tops = scores.reshape(-1, STRETCH).max(axis=1)  # each is a document's score, so the k-th of them bounds from below
        floor = np.partition(tops, -k)[-k] if len(tops) >= k else 0.0
        found = np.flatnonzero(scores >= floor - 2e-9) if floor > 2e-9 else np.unique(
            np.concatenate([self.places[a:z] for a, z, _ in terms]))  # all that have a term, whatever it is worth
        own = scores[found]
        if len(found) > k:
            near = np.flatnonzero(own >= np.partition(own, -k)[-k] - 2e-9)
            near = near[np.lexsort((near, -np.floor(own[near] * 1e9 + 0.5)))[:k]]
            found, own = found[near], own[near]
        return found, own


def _answer(block: _Block, asked: pa.StructArray, k: int) -> pa.RecordBatch:
    terms = asked.field("terms")
    flat, ends = terms.flatten(), np.cumsum(terms.value_lengths().to_numpy()).tolist()
    each = list(zip(*block.find(flat.field("key").to_numpy(), flat.field("weight").to_numpy())))
    found = [block.best(each[a:z], k) for a, z in zip([0, *ends], ends)]
    query = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
    return pa.RecordBatch.from_arrays([
        asked.field("query_id").take(pa.array(query)), block.docs.take(pa.array(np.concatenate([p for p, _ in found]))),
        pa.array(np.concatenate([s for _, s in found]))], names=["query_id", "doc_id", "score"])


def best_of_blocks(postings: DataFrame, terms: DataFrame, k: int, n_postings: int, n_queries: int) -> DataFrame:
    """(query_id, doc_id, score): of every block of documents the k best that share a term with a query.

    postings(doc_id, key, part) and terms(query_id, key, weight): a pair's score is the sum of weight * part over equal
    keys. A key has one weight in all queries. Ties, of scores at nine decimals, go to the lower id."""
    cores = postings.sparkSession.sparkContext.defaultParallelism
    blocks = cores * max(1, math.ceil(n_postings / POSTINGS / cores))
    queries = terms.groupBy("query_id").agg(F.collect_list(F.struct("key", "weight")).alias("terms"))
    asked = queries.groupBy(_number("query_id", max(1, math.ceil(n_queries / QUERIES))).alias("turn")).agg(
        F.collect_list(F.struct("query_id", "terms")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for b in batches:
            for i in range(b.num_rows):
                if b["held"][i].as_py():
                    block = _Block(b.slice(i, 1))
                elif block is not None:
                    yield _answer(block, b["asked"][i].values, k)

    kind = f"query_id {_type(terms, 'query_id')}, doc_id {_type(postings, 'doc_id')}, score double"
    return meet(settle(_packed(postings, blocks), "blocks"), settle(asked.drop("turn"), "asked"), blocks, run, kind)
