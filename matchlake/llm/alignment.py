"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded twice. Tokens are told by where they end, so a text is two rising arrays of ends; where both end
together a group is complete. The arrays are walked along a diagonal: at the current shift between the indexes,
exponential probing compares ever longer stretches of both arrays at once, and so jumps over tokens that match one to
one. Where a stretch differs, the irregular group there is resolved by stepping whichever side ends first, and the
shift is updated. Two tokens are linked where their bytes overlap; each stretch between neighbouring ends is one link.

A link's count is the number of documents of the corpus that hold its pair of ids linked. Tasks keep documents in
slices: a slice's documents with their distinct pairs, and the slice's distinct pairs with a count of documents. Only
the latter meet: they are summed per pair, joined back to the slices that have the pair, and each A id's highest count
is taken from the sums. A pair that every document holds is one row per slice; Spark's adaptive join splits it beyond
that. The number of A ids bounds what is broadcast.

Defined cases: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens;
rows that share a doc_id are documents one by one; a null doc_id is kept; a very long text is handled a stretch at a
time; extra columns do not matter; an empty table gives an empty result. Ties of the highest count are all best.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import slices as S
from matchlake.llm import tokens as K
from matchlake.llm.shared import ship
from matchlake.operators.common import settle

SLICE_BYTES = 16 << 20
UNIT_TOKENS = 400_000  # tokens of one side that are aligned in one go, about
CUT = ("slice long, doc_ids array<long>, counts binary, hashes array<string>, shown array<string>, n_pairs binary, "
       "place binary, times binary, pairs binary, docs binary")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string, groups string")


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rising ends that finish alike: after each group the number of tokens before, on either side."""
    n = len(a)
    ends_a, ends_b = [*a.tolist(), -1], [*b.tolist(), -2]  # what follows the last end never matches
    at, other, runs = [], [], []
    i = shift = 0
    while i < n:
        j = i + shift
        x, y = ends_a[i], ends_b[j]
        if x != y:  # irregular: step the side that ends first until both end together
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            shift = j - i
        # Both end together here: probe along the diagonal, doubling, then halving.
        p, q, step = i + 1, j + 1, 1
        while ends_a[p:p + step] == ends_b[q:q + step]:
            p += step
            q += step
            step += step
        while step > 1:
            step >>= 1
            if ends_a[p:p + step] == ends_b[q:q + step]:
                p += step
                q += step
        at.append(i)
        other.append(j)
        runs.append(p - i)
        i = p
    runs = np.array(runs, np.int64)
    inner = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + 1
    return np.repeat(np.array(at, np.int64), runs) + inner, np.repeat(np.array(other, np.int64), runs) + inner


def links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of tokens whose bytes overlap, by their numbers: one for each end of A, and one for each end of B
    that is inside a group."""
    inside = np.ones(len(b), bool)
    inside[group_b - 1] = False
    inner = np.flatnonzero(inside)
    return (np.r_[np.arange(len(a)), np.searchsorted(a, b[inner])], np.r_[np.searchsorted(b, a), inner])


class Shown:
    """Groups as text: `a1,a2|b1;a3|b2,b3`, decimal ids in order."""

    def __init__(self, n_a: int, n_b: int):
        # An id followed by a comma, and an id at the end of its side of a group.
        self.words = [f"{i}{mark}" for n, last in ((n_a, "|"), (n_b, ";")) for mark in (",", last) for i in range(n)]
        self.n_a, self.n_b = n_a, n_b

    def text(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        """The groups of some tokens, each followed by a semicolon."""
        word_a, word_b = a.astype(np.int64), b.astype(np.int64) + 2 * self.n_a
        word_a[group_a - 1] += self.n_a
        word_b[group_b - 1] += self.n_b
        size_a, size_b = np.diff(group_a, prepend=0), np.diff(group_b, prepend=0)
        both = np.empty(len(a) + len(b), np.int64)
        both[np.arange(len(a)) + np.repeat(group_b - size_b, size_a)] = word_a
        both[np.arange(len(b)) + np.repeat(group_a, size_b)] = word_b
        return "".join(map(self.words.__getitem__, both.tolist()))


class Tokens:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = K.loaded(K.ByteIds, path_a), K.loaded(K.PieceIds, path_b)
        self.size_a, self.size_b = K.sizes(self.a.bytes), K.sizes(self.b.bytes)
        self.n_a, self.n_b = len(self.size_a), len(self.size_b)
        self.shown = Shown(self.n_a, self.n_b)

    def same_bytes(self, stretch: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both sides give the stretch back. An ordinary one is given back if its words are."""
        if self.a.exact and self.b.exact and self.a.ordinary(stretch) and self.b.ordinary(stretch):
            return True
        raw = stretch.encode()
        return (self.size_a[a].sum() == self.size_b[b].sum() == len(raw)
                and b"".join(map(self.a.bytes.__getitem__, a.tolist())) == raw
                and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == raw)


class SliceOfDocuments:
    """Documents of a slice as they are aligned, and what is known of them."""

    def __init__(self, tokens: Tokens, keep: bool):
        self.t, self.keep, self.n_bytes = tokens, keep, 0
        self.ids, self.counts, self.hashes, self.shown, self.keys, self.times = [], [], [], [], [], []

    def add(self, doc_ids: list, pieces: list[list[tuple[np.ndarray, np.ndarray]]]) -> None:
        """Documents, each as the ids of its stretches on both sides; none for a document without tokens."""
        unit, n, first = [], 0, len(self.ids)
        self.ids += [S.NO_ID if x is None else x for x in doc_ids]
        hashes, shown = [hashlib.sha256() for _ in doc_ids], [[] for _ in doc_ids]
        self.counts += [np.zeros(3, np.int64) for _ in doc_ids]
        for d, stretches in enumerate(pieces):
            for a, b in stretches:
                unit.append((d, a, b))
                n += len(a)
                if n >= UNIT_TOKENS:
                    self._align(unit, first, hashes, shown)
                    unit, n = [], 0
        if unit:
            self._align(unit, first, hashes, shown)
        self.hashes += [h.hexdigest() if p else "" for h, p in zip(hashes, pieces)]
        self.shown += ["".join(s) if self.keep else None for s in shown]

    def _align(self, unit: list, first: int, hashes: list, shown: list) -> None:
        t = self.t
        a, b = (np.concatenate([u[k] for u in unit]).astype(np.int64) for k in (1, 2))
        ends_a, ends_b = np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b])
        group_a, group_b = groups(ends_a, ends_b)
        link_a, link_b = links(ends_a, ends_b, group_a, group_b)
        owner = np.repeat(np.array([u[0] for u in unit]), [len(u[1]) for u in unit])
        key = ((owner[link_a] + first) << 32) | (a[link_a] * t.n_b + b[link_b])
        keys, times = np.unique(key, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        at_a = at_b = at_group = 0
        for d, x, y in unit:
            to_a, to_b = at_a + len(x), at_b + len(y)
            to_group = int(np.searchsorted(group_a, to_a)) + 1
            own_a, own_b = group_a[at_group:to_group] - at_a, group_b[at_group:to_group] - at_b
            text = t.shown.text(x, y, own_a, own_b)
            c = self.counts[first + d]
            part = text[:-1] if not c[2] else ";" + text[:-1]  # a semicolon between groups
            hashes[d].update(part.encode())
            if self.keep:
                shown[d].append(part)
            c += (len(x), len(y), to_group - at_group)
            at_a, at_b, at_group = to_a, to_b, to_group

    def row(self, number: int) -> pa.RecordBatch:
        none = np.zeros(0, np.int64)
        keys, times = np.concatenate([none, *self.keys]), np.concatenate([none, *self.times])
        order = np.argsort(keys, kind="stable")
        starts = S.group_starts(keys[order])  # a document of several units has some pairs in each
        keys, times = keys[order][starts], np.add.reduceat(times[order], starts) if len(starts) else times
        pairs, place = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
        docs = np.bincount(place, minlength=len(pairs))
        n_pairs = np.bincount(keys >> 32, minlength=len(self.ids))
        small = lambda x: S.compressed(x.astype(np.int32))
        data = {"slice": number, "doc_ids": self.ids, "counts": S.compressed(np.array(self.counts, np.int64).ravel()),
                "hashes": self.hashes, "shown": self.shown, "n_pairs": small(n_pairs), "place": small(place),
                "times": small(times), "pairs": S.compressed(pairs), "docs": small(docs)}
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(data.values(), kinds)], names=list(data))


def both_ids(tokens: Tokens, texts: list[str | None]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each text the ids of its stretches on both sides; none for a text without tokens."""
    items, owner = [], []
    for d, t in enumerate(texts):
        for s in K.stretches(" " + t) if t else ():
            items.append(s)
            owner.append(d)
    out: list = [[] for _ in texts]
    bad, first, size = set(), 0, 0
    for last, item in enumerate(items, 1):
        size += len(item)
        if size < K.BATCH and last < len(items):
            continue
        own, at = items[first:last], owner[first:last]
        (a, n_a), (b, n_b) = tokens.a.lay_out(own), tokens.b.lay_out(own)
        for d, s, x, y in zip(at, own, np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1])):
            out[d].append((x, y))
            if not tokens.same_bytes(s, x, y):
                bad.add(d)
        first, size = last, 0
    for d in bad:
        out[d] = []
    return out


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer_a: str | None = None,
          tokenizer_b: str | None = None, keep_groups: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, where
    `keep_groups` asks for them, the groups as text. A is a byte-level tokenizer, B one of pieces; together they have
    at most 2 ** 32 pairs of ids."""
    ship(docs.sparkSession)
    path_a, path_b = tokenizer_a or K.tokenizer_path(K.BYTE_BPE), tokenizer_b or K.tokenizer_path(K.PIECE_BPE)

    def cut(batches):
        from pyspark import TaskContext

        tokens, number = Tokens(path_a, path_b), TaskContext.get().partitionId() << 32
        if tokens.n_a * tokens.n_b > 1 << 32:
            raise ValueError("the tokenizers have more than 2 ** 32 pairs of ids")
        own = SliceOfDocuments(tokens, keep_groups)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            first, size = 0, 0
            for last, t in enumerate(texts, 1):
                size += len(t or "")
                if size >= K.BATCH or last == len(texts):
                    own.add(ids[first:last], both_ids(tokens, texts[first:last]))
                    own.n_bytes += size
                    first, size = last, 0
                    if own.n_bytes >= slice_bytes:
                        yield own.row(number)
                        own, number = SliceOfDocuments(tokens, keep_groups), number + 1
        if own.ids:
            yield own.row(number)

    def entries(batches):
        for b in batches:
            for number, pairs, n in zip(*(c.to_pylist() for c in b.columns)):
                pairs, n = S.restored(pairs, np.int64), S.restored(n, np.int32)
                for a in range(0, len(pairs), 100_000):
                    z = min(a + 100_000, len(pairs))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(z - a, number)), pa.array(pairs[a:z]), pa.array(n[a:z])],
                                                     names=["slice", "pair", "n"])

    def counted(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        right = right.sort_values("pair")
        place, times = S.restored(row["place"], np.int32), S.restored(row["times"], np.int32).astype(np.int64)
        n_pairs = S.restored(row["n_pairs"], np.int32)
        owner = np.repeat(np.arange(len(n_pairs)), n_pairs)
        total, best = right["total"].to_numpy(np.int64)[place], right["best"].to_numpy(bool)[place]
        sums = np.zeros((2, len(n_pairs)), np.int64)
        np.add.at(sums[0], owner, times * best)
        np.add.at(sums[1], owner, times * total)
        n_a, n_b, n_groups = S.restored(row["counts"], np.int64).reshape(-1, 3).T
        return pd.DataFrame({"doc_id": S.longs([None if x == S.NO_ID else x for x in row["doc_ids"]]),
                             "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups,
                             "n_best": sums[0], "count_sum": sums[1], "groups_sha256": list(row["hashes"]),
                             "groups": list(row["shown"])})

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = settle(given.mapInArrow(cut, CUT), "alignments")
    rows = settle(held.select("slice", "pairs", "docs").mapInArrow(entries, "slice long, pair long, n int"), "pairs")
    sums = settle(rows.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    n_b = len(K.loaded(K.PieceIds, path_b).bytes)
    a_id = F.floor(F.col("pair") / n_b)
    highest = sums.groupBy(a_id.alias("a_id")).agg(F.max("total").alias("highest"))
    marked = sums.withColumn("a_id", a_id).join(F.broadcast(highest), "a_id").select(
        "pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = rows.drop("n").join(marked, "pair")
    out = held.drop("pairs", "docs").groupBy("slice").cogroup(back.groupBy("slice")).applyInPandas(counted, RESULT)
    return out if keep_groups else out.drop("groups")
