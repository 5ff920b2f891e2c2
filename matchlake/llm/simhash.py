"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its shingle hashes have it set. Two fingerprints within the
radius r link, and documents that are linked directly or through others form one component.

Candidates come from structured masks: every bit position gets a non-zero vector of r + 1 bits, and the mask of a
non-zero vector v keeps the positions whose vector has an odd product with v. The positions where two fingerprints
differ, r at most, span fewer than r + 1 dimensions, so some v is orthogonal to all of them: under that mask the two
are equal. Every pair within the radius therefore meets in one of 2 ** (r + 1) - 1 tables, none is missed by chance.

Equal fingerprints are one node from the start, so a group of copies costs one row per table. Buckets with one
fingerprint are dropped. A bucket above HOT fingerprints is split again: the bits that its mask leaves out are cut
into r + 1 blocks, of which a pair within the radius shares one. Inside a bucket, small groups are compared directly
and larger ones by flipping up to r free bits of each fingerprint and looking the result up, which is linear in the
bucket; only a spanning star per group is emitted. Components come from the links by alternating large-star and
small-star steps, each written to the shared folder.

Defined cases: a null, empty or blank text has fingerprint zero, and is linked like any other; fewer words than a
shingle are hashed as one shingle; rows that share a doc_id each get a row; a null doc_id gets the component of its
fingerprint's group, null only if no row of the component has an id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import ship
from matchlake.operators.common import settle

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
HOT = 50_000
SMALL = 48


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(whole, seed)
    gaps = np.flatnonzero(np.frombuffer(whole, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(whole)]
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        h = np.array([digest(whole[a:b], seed) for a, b in zip(starts[at:to], ends[at + shingle - 1:to + shingle - 1])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int, seed: int) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed number)."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits that each table compares, as unsigned numbers."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    return [sum(1 << i for i, x in enumerate(vectors) if bin(x & v).count("1") % 2) for v in range(1, 2 ** (radius + 1))]


def free_blocks(mask: int, radius: int) -> list[int]:
    """The bits outside a mask, cut into radius + 1 blocks."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << i for i in free[k::radius + 1]) for k in range(radius + 1)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each of n nodes' components, for links a-b."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def bucket_links(run: np.ndarray, fps: np.ndarray, flips: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the distinct fingerprints of buckets; run numbers the bucket of each row, in order.
    flips: all changes of up to `radius` bits that a bucket's members can differ by."""
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if n else np.array([], int)
    sizes = np.diff(np.r_[starts, n])
    size_at = np.repeat(sizes, sizes)
    lefts, rights = [np.array([], int)], [np.array([], int)]
    small = np.flatnonzero(size_at <= SMALL)
    for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = small[small + step < n]
        i = i[(run[i] == run[i + step])]
        i = i[distance(fps[i], fps[i + step]) <= radius]
        lefts.append(i)
        rights.append(i + step)
    for at, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        own = fps[at:at + size]
        order = np.argsort(own)
        ranked = own[order]
        for flip in flips:
            place = np.searchsorted(ranked, own ^ flip)
            hit = np.flatnonzero((place < size) & (ranked[np.minimum(place, size - 1)] == own ^ flip))
            lefts.append(at + hit)
            rights.append(at + order[place[hit]])
    return np.concatenate(lefts), np.concatenate(rights)


def links(nodes: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """nodes(fp, distinct) -> links a, b between fingerprints: in every bucket a star per group of near ones."""
    masks = covering_masks(radius)
    table = lambda m, k: F.struct(F.lit(m).alias("m"), k.alias("k"))
    keys = nodes.select("fp", F.explode(F.array(*[table(m, F.col("fp").bitwiseAND(F.lit(signed(x))))
                                                  for m, x in enumerate(masks)])).alias("t")).select("fp", "t.*")
    shared = keys.groupBy("m", "k").agg(F.count("*").alias("n")).filter("n > 1")
    met = settle(keys.join(shared, ["m", "k"]), "simhash-met")
    split = [(m, j, block) for m, x in enumerate(masks) for j, block in enumerate(free_blocks(x, radius))]
    cases = F.filter(F.array(*[F.when(F.col("m") == m, F.struct(
        F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(signed(block))).alias("s"))) for m, j, block in split]),
        lambda x: x.isNotNull())
    whole = F.array(F.struct(F.lit(-1).alias("j"), F.lit(0).cast("long").alias("s")))
    parts = met.select("fp", "m", "k", F.explode(F.when(F.col("n") > hot, cases).otherwise(whole)).alias("p"))
    parts = parts.select("fp", "m", "k", "p.j", "p.s")
    dealt = parts.repartition("m", "k", "j", "s").sortWithinPartitions("m", "k", "j", "s", "fp")
    free = [[i for i in range(BITS) if not x >> i & 1] for x in masks]
    all_flips = [np.array([sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(f, r)], np.uint64) for f in free]
    names = ["m", "k", "j", "s"]

    def star(part: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for m, own in part.groupby("m", sort=False):
            fps = own["fp"].to_numpy(np.int64).view(np.uint64)
            change = np.zeros(len(own), bool)
            for c in names[1:]:
                v = own[c].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            x, y = bucket_links(np.cumsum(change), fps, all_flips[m], radius)
            label = components(len(fps), x, y)
            moved = np.flatnonzero(label != np.arange(len(fps)))
            a.append(fps[moved])
            b.append(fps[label[moved]])
        none = np.array([], np.uint64)
        return pd.DataFrame({"a": np.concatenate([none, *a]).view(np.int64), "b": np.concatenate([none, *b]).view(np.int64)})

    def run(batches):
        held = None  # rows of the bucket that the last batch may have left unfinished
        for part in batches:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            if not len(part):
                continue
            last = (part[names] == part[names].iloc[-1]).all(axis=1).to_numpy()
            done = len(part) - int(last[::-1].argmin() if not last.all() else len(part))
            held = part.iloc[done:].reset_index(drop=True)
            if done:
                yield star(part.iloc[:done].reset_index(drop=True))
        if held is not None:
            yield star(held)

    return dealt.mapInPandas(run, "a long, b long").filter("a <> b")


def connected(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """edges(a, b) -> node, root: the least node of each component, for every node that has a link.

    A large-star step links the greater neighbours of a node to its least neighbour, a small-star step the lesser
    ones. Neither needs the neighbours of a node in one place: least neighbours are an aggregate that is written and
    joined back, so Spark can split the join at a node that most links share."""
    def large(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = settle(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(
            least.select("a", F.col("m").alias("b")))

    e = settle(edges.filter("a <> b").distinct(), "links")
    state = None
    for _ in range(rounds):
        e = settle(small(settle(large(e).distinct(), "links")).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (its component's least doc_id)."""
    ship(docs.sparkSession)
    marked = settle(fingerprints(docs, doc_id, text, shingle, seed), "simhash-fingerprints")
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = settle(connected(links(nodes.select("fp"), radius, hot)), "simhash-roots")
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    found = grouped.join(least, "root").select("fp", "component_id")
    return marked.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
