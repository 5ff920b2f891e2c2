"""Hard negatives by a secondary-sort shuffle.

An anchor's positives are its best-scoring other rows of the same label. Its hard negatives are, for each positive,
the best rows of other labels whose score lies in a window below the positive's: between `low` and `high` percent.

Rows are packed into blocks, vectors as one matrix of integers. Blocks of anchors are broadcast in rounds of a bounded
size, and every block of rows meets them in the task that holds it: one matrix product gives all scores of a pair of
blocks. The first pass keeps the best positives of each anchor in each block. The second one knows every anchor's
positives, and keeps of each block what can be among the first negatives of one of their windows. So what is shuffled
is a few scores for each anchor and block, not each pair of rows.

These scores are packed into keys that sort by anchor, descending score and id, positives before negatives of equal
score. `repartitionAndSortWithinPartitions` deals keys by anchor and sorts them; a streaming iterator reads a partition
once, opens a window at each positive, and hands every negative that follows to the windows that it falls into, until
they are full. It holds the few windows of one anchor, never the anchor's rows.

Scores are integer inner products, exact whatever their size within 64 bits: products are taken in floats of a width
that holds them without rounding, else in Python integers; beyond 64 bits scores are cut.

Defined cases: rows with a null id, label or vector, or a null, NaN or infinite component, take no part; missing
components of shorter vectors are zero; rows with an anchor's id are not among its own rows; a repeated row is ranked
as often as it occurs; a repeated anchor row is an anchor of its own; ties go to the smaller id; an anchor without
positives, or a window without negatives, gives no row; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.llm.search import usable
from matchlake.llm.shared import ship
from matchlake.operators.common import settle

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
BLOCK = 4096  # rows in a block, about
ANCHOR_BLOCK = 512
ROUND_BYTES = 64 << 20  # of anchors that are broadcast at once, at most
MOST, LEAST = 2 ** 63 - 1, -2 ** 63
PACKED = "block long, part int, bytes long, n int, width int, ids binary, rows binary, labels array<string>, vectors binary, scores binary"
KEY = struct.Struct(">QQBQq")  # anchor's row, descending score, kind, id; last the anchor's id
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integers(vectors: list, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), zero-padded: 64-bit integers, or Python integers where these do not fit."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        out = np.floor(out * scale)
    if out.size and not np.abs(out).max() < 2.0 ** 62:
        exact = [[int(np.floor(x * scale)) if np.isfinite(x * scale) else int(x) * scale for x in v]
                 + [0] * (width - len(v)) for v in vectors]
        return np.array(exact, dtype=object).reshape(out.shape)
    return out.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products as 64-bit integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * width
    for kind, exact in ((np.float32, 2 ** 24), (np.float64, 2 ** 53)):
        if most < exact:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    if most <= MOST and a.dtype != object and b.dtype != object:
        return a.astype(np.int64) @ b.astype(np.int64).T
    full = a.astype(object) @ b.astype(object).T
    return np.vectorize(lambda x: max(min(x, MOST), LEAST), otypes=[np.int64])(full)


def matrix_bytes(m: np.ndarray) -> bytes:
    """A matrix in the narrowest kind of integers that holds it; objects as text."""
    if m.dtype == object:
        return b"o" + " ".join(map(str, m.ravel().tolist())).encode()
    most = int(np.abs(m).max()) if m.size else 0
    kind = "h" if most < 2 ** 15 else "i" if most < 2 ** 31 else "q"
    return kind.encode() + m.astype(f"<{kind}").tobytes()


def matrix(raw: bytes, n: int, width: int) -> np.ndarray:
    kind, rest = raw[:1].decode(), raw[1:]
    if kind == "o":
        return np.array([int(x) for x in rest.split()], dtype=object).reshape(n, width)
    return np.frombuffer(rest, f"<{kind}").reshape(n, width)


def blocks(rows: DataFrame, size: int, scale: int, scored: bool = False) -> DataFrame:
    """Rows (id, row, label, v, and scores of positives if `scored`) packed into blocks, in ascending ids."""
    def pack(batches):
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def block(held: list) -> pa.RecordBatch:
            held.sort(key=lambda r: (r["id"], r["row"]))
            m = integers([r["v"] for r in held], scale)
            raw = matrix_bytes(m)
            scores = np.array([r["scores"] for r in held], "<i8").tobytes() if scored else b""
            data = [number, 0, len(raw) + 64 * len(held), len(held), m.shape[1], np.array([r["id"] for r in held], "<i8").tobytes(),
                    np.array([r["row"] for r in held], "<i8").tobytes(), [r["label"] for r in held], raw, scores]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in PACKED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(data, kinds)], names=names)

        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                if len(held) >= size:
                    yield block(held)
                    held, number = [], number + 1
        if held:
            yield block(held)

    return rows.mapInArrow(pack, PACKED)


class Block:
    def __init__(self, row: dict, side: str, labels: dict):
        get = lambda c: row[f"{side}_{c}"]
        self.ids, self.rows = np.frombuffer(get("ids"), "<i8"), np.frombuffer(get("rows"), "<i8")
        self.vectors = matrix(get("vectors"), get("n"), get("width"))
        self.labels = np.array([labels.setdefault(x, len(labels)) for x in get("labels")], np.int64)
        self.scores = np.frombuffer(get("scores"), "<i8").reshape(len(self.ids), -1) if get("scores") else None


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed scores of every row; columns are in order of ids, so ties go to the left."""
    n, k = scores.shape[1], min(k, scores.shape[1])
    worst = np.where(allowed, scores, LEAST)
    if k < n:
        floor = np.partition(worst, n - k, axis=1)[:, n - k]
        over, ties = worst > floor[:, None], (worst == floor[:, None]) & allowed
        room = k - over.sum(axis=1)
        take = over | (ties & (np.cumsum(ties, axis=1) <= room[:, None]))
    else:
        take = allowed
    return np.nonzero(take & allowed)


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score s with low * p <= 100 * s <= high * p; none where the least is above the greatest."""
    p = positive.astype(object)
    return (np.array([-(-low * x // 100) for x in p.ravel()], np.int64).reshape(p.shape),
            np.array([high * x // 100 for x in p.ravel()], np.int64).reshape(p.shape))


def flipped(x: np.ndarray) -> np.ndarray:
    """64-bit integers as unsigned ones that sort alike."""
    return x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def keys(anchor_rows, anchor_ids, scores, kind: int, ids) -> list[bytes]:
    """Bytes that sort by anchor, descending score, positives first, ascending id."""
    down = ~flipped(scores)
    return [KEY.pack(a, s, kind, i, q) for a, s, i, q in zip(flipped(anchor_rows).tolist(), down.tolist(), flipped(ids).tolist(),
                                                          anchor_ids.tolist())]


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    """Anchor's row, score, kind, id, anchor's id."""
    row, down, kind, i, anchor = KEY.unpack(key)
    return row, (down ^ (2 ** 64 - 1)) - 2 ** 63, kind, i - 2 ** 63, anchor


def emitted(sorted_keys: Iterator, low: int, high: int, most: int) -> Iterator[tuple]:
    """The result's rows from keys in order. Holds the open windows of one anchor."""
    current, windows = None, []
    for key, _ in sorted_keys:
        row, score, kind, i, anchor = unpacked(key)
        if row != current:
            current, windows = row, []
        if kind == 0:
            windows.append([i, score, 0])
            continue
        for w in windows:
            if w[2] < most and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], i, w[1], score


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK,
         round_bytes: int = ROUND_BYTES) -> DataFrame:
    """rows(id, label, v), of which `anchors` names the anchors: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    spark = rows.sparkSession
    ship(spark)
    given = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"),
                        usable(F.col("v")).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    given = given.filter("id is not null and label is not null and v is not null")
    given = settle(given.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    packed = settle(blocks(given.select("id", "row", "label", "v"), block, scale), "negatives-blocks")
    asked = given.filter("anchor").select("id", "row", "label", "v")
    asked = asked.repartition(1 + asked.count() // anchor_block, "row")

    def rounds(anchor_blocks: DataFrame) -> tuple[DataFrame, int]:
        """Blocks of anchors with `part`, the number of their round: at most `round_bytes` in one, or one block."""
        stored = settle(anchor_blocks, "negatives-anchors")
        most = stored.agg(F.max("bytes")).first()[0] or 0
        # A running sum over two numbers for each block of anchors.
        before = F.sum("bytes").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
        part = F.floor(F.coalesce(before, F.lit(0)) / max(1, round_bytes - most)).cast("int")
        numbered = settle(stored.drop("part").join(stored.select("block", part.alias("part")), "block"), "negatives-rounds")
        last = numbered.agg(F.max("part")).first()[0]
        return numbered, 0 if last is None else last + 1

    def met(anchor_blocks: DataFrame, meet, kind: str, name: str) -> DataFrame:
        """What `meet` finds for all pairs of blocks, a round at a time."""
        numbered, n = rounds(anchor_blocks)
        prefix = lambda df, p: df.select([F.col(c).alias(p + c) for c in df.columns])
        out = spark.createDataFrame([], kind)
        for k in range(n):
            now = prefix(numbered.filter(F.col("part") == k).withColumn("part", F.lit(0)), "a_")
            pairs = prefix(packed, "b_").join(F.broadcast(now), F.col("a_part") == F.col("b_part"))
            out = out.unionByName(settle(pairs.mapInArrow(meet, kind), f"negatives-{name}-{k}"))
        return out

    def near(batches):
        labels: dict = {}
        for b in batches:
            for i in range(b.num_rows):
                pair = b.slice(i, 1).to_pylist()[0]
                q, d = Block(pair, "a", labels), Block(pair, "b", labels)
                s = products(q.vectors, d.vectors)
                same = (q.labels[:, None] == d.labels) & (q.ids[:, None] != d.ids)
                r, c = best(s, same, positives)
                yield pa.RecordBatch.from_arrays([pa.array(q.rows[r]), pa.array(d.ids[c]), pa.array(d.rows[c]), pa.array(s[r, c])],
                                                 names=["row", "id", "place", "score"])

    found = met(blocks(asked, anchor_block, scale), near, "row long, id long, place long, score long", "positives")
    order = W.partitionBy("row").orderBy(F.desc("score"), "id", "place")
    first = settle(found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives), "negatives-positives")
    # At most `positives` scores for each anchor; places without one repeat the last, which changes no window.
    lists = first.groupBy("row").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    lists = lists.select("row", F.slice(F.concat("s", F.array_repeat(F.element_at("s", -1), positives)), 1, positives).alias("scores"))

    def below(batches):
        labels: dict = {}
        for b in batches:
            for i in range(b.num_rows):
                pair = b.slice(i, 1).to_pylist()[0]
                q, d = Block(pair, "a", labels), Block(pair, "b", labels)
                s = products(q.vectors, d.vectors)
                other = (q.labels[:, None] != d.labels) & (q.ids[:, None] != d.ids)
                least, most = window(q.scores, low, high)
                take = np.zeros(s.shape, bool)
                for k in range(q.scores.shape[1]):
                    inside = other & (s >= least[:, k, None]) & (s <= most[:, k, None])
                    take[best(s, inside, negatives)] = True
                r, c = np.nonzero(take)
                yield pa.RecordBatch.from_arrays([pa.array(q.rows[r]), pa.array(q.ids[r]), pa.array(s[r, c]), pa.array(d.ids[c])],
                                                 names=["row", "anchor", "score", "id"])

    with_scores = asked.join(lists, "row")
    low_ones = met(blocks(with_scores, anchor_block, scale, scored=True), below, "row long, anchor long, score long, id long", "windows")
    high_ones = first.join(asked.select("row", F.col("id").alias("anchor")), "row").select("row", "anchor", "score", "id")

    def packed_keys(kind: int):
        def run(batches):
            for b in batches:
                row, anchor, score, i = (b.column(k).to_numpy() for k in range(4))
                yield pa.RecordBatch.from_arrays([pa.array(keys(row, anchor, score, kind, i), pa.binary())], names=["key"])
        return run

    all_keys = high_ones.mapInArrow(packed_keys(0), "key binary").union(low_ones.mapInArrow(packed_keys(1), "key binary"))
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_anchor = lambda key: zlib.crc32(key[:8])
    dealt = all_keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(partitions, by_anchor)
    return spark.createDataFrame(dealt.mapPartitions(lambda keys: emitted(keys, low, high, negatives)), RESULT)
