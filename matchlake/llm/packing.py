"""Best-fit packing of token sequences with a bounded number of open bins.

A document's ids end with an end id; a document longer than a sequence is cut into full pieces and a rest. Pieces
arrive one by one at a packer that holds a fixed number of open bins. Open bins are stacked by their free space, and
a bitset has a bit for each free space that occurs: the lowest set bit at or above a piece's length is the best fit.
When no bin fits and all places are taken, the fullest open bin is closed. Memory is the open bins only.

Packers run side by side on hash-dealt shares of the pieces. The bins that are still open at the end of a share are
not closed: their pieces go to a further round with fewer shares, until one share is left; its last bins are closed.

Texts never leave the tasks that tokenize them: what is shuffled is a few numbers per piece. A share is bounded in
tokens and in pieces, so documents of a token or two do not gather in one.

Defined cases: a null or empty text is a document of the end id alone; rows that share a doc_id are packed one by
one; a null doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import ship
from matchlake.llm.tokens import WordIds, loaded, tokenizer_path
from matchlake.operators.common import settle

END_ID = 1
CAPACITY = 4096
OPEN_BINS = 256
SHARE_BINS = 2_000  # sequences that a share fills, about
SHARE_PIECES = 500_000  # pieces in a share, about; short pieces fill few sequences

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
PLACED = PIECES + ", share long, bin long, offset long, closed boolean"

def pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece. `row` tells rows with equal ids apart: it is unique per piece's document row. `nth` numbers the
    pieces of a task, so it is unique as well."""

    def cut(batches):
        from pyspark import TaskContext

        end, row = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 36
        nth = row
        for b in batches:
            docs = iter(b.column(0).to_pylist())
            for ids, counts in loaded(WordIds, tokenizer).encode(b.column(1).to_pylist()):
                out, ends = [], np.cumsum(counts).tolist()
                for a, z in zip([0, *ends], ends):
                    doc, whole = next(docs), ids[a:z].tobytes() + end
                    for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                        part = whole[at:at + 4 * capacity]
                        out.append((row, doc, k, at // 4, len(part) // 4, zlib.crc32(part), nth))
                        nth += 1
                    row += 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["row", "doc_id", "piece", "start", "length", "ids_crc32", "nth"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], set[int]]:
    """Bin and offset of each piece in arrival order, and the bins that are open at the end."""
    free_bits, stacks, n_open, n = 0, {}, 0, 0
    bins, offsets = [], []
    for need in lengths:
        fitting = free_bits >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                free_bits ^= 1 << free
            n_open -= 1
        else:
            free, b, n = capacity, n, n + 1
            if n_open == open_bins:
                fullest = (free_bits & -free_bits).bit_length() - 1
                stacks[fullest].pop()
                if not stacks[fullest]:
                    free_bits ^= 1 << fullest
                n_open -= 1
        bins.append(b)
        offsets.append(capacity - free)
        left = free - need
        if left:
            stacks.setdefault(left, []).append(b)
            free_bits |= 1 << left
            n_open += 1
    return bins, offsets, {b for s in stacks.values() for b in s}


def _round(items: DataFrame, shares: int, capacity: int, open_bins: int, last: bool) -> DataFrame:
    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "row", "piece"], ignore_index=True)
        bins, offsets, still = best_fit(part["length"].tolist(), capacity, open_bins)
        part["bin"], part["offset"] = np.array(bins, "int64"), np.array(offsets, "int64")
        part["closed"] = last | ~part["bin"].isin(list(still))
        return part.drop(columns="order")

    order = F.xxhash64("row", "piece")
    dealt = items.withColumn("order", order).withColumn("share", F.pmod(F.col("order"), F.lit(shares)))
    return dealt.groupBy("share").applyInPandas(place, PLACED)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS,
         share_bins: int = SHARE_BINS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ship(docs.sparkSession)
    items = settle(pieces(docs, doc_id, text, tokenizer or tokenizer_path(), capacity, end_id), "pack-pieces")
    whole = items.filter(F.col("length") == capacity)
    out = [whole.select("*", F.col("nth").alias("sequence"), F.lit(0).cast("long").alias("offset"))]
    items = items.filter(F.col("length") < capacity)
    shares = sys.maxsize
    for k in itertools.count(1):
        tokens, n = items.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
        wanted = max(tokens // (capacity * share_bins), n // SHARE_PIECES)
        shares = max(1, min(wanted, shares // 4))  # fewer each time, so rounds end
        placed = settle(_round(items, shares, capacity, open_bins, shares == 1), f"pack-{k}")
        # A sequence's number is told by its round, share and place there: they have bits of their own.
        number = F.shiftleft(F.lit(k).cast("long"), 60) + F.shiftleft("share", 36) + F.col("bin")
        out.append(placed.filter("closed").withColumn("sequence", number).drop("share", "bin", "closed"))
        if shares == 1:
            break
        items = placed.filter("not closed").drop("share", "bin", "offset", "closed")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), "offset")
