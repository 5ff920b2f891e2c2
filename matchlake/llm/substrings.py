"""Removal of word windows that occur more than once, anchored at difference-cover positions.

A window of `window` words is removed if its word sequence also starts anywhere else. Every text is hashed at the
positions of a difference cover modulo a period only: a set of residues in which every difference occurs, so for any
two places there is a shift below the period that takes both to a cover position. Two equal windows therefore share
an aligned anchor of window - period + 1 words, and about a quarter of the positions is hashed and exchanged.

Anchors that occur once end there. The others extend: all whole windows that hold a repeated anchor at a cover
position are hashed over all their words, to 96 bits, and exchanged again; those that occur twice or more are removed,
all words they cover at once, judged on the input.

Defined cases: a null or blank text has no words; fewer words than a window keep all; rows that share a doc_id are
separate documents; a null doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from matchlake.llm import slices as S
from matchlake.llm.shared import ship

WINDOW = 35
PERIOD = 21
COVER = (3, 6, 7, 12, 14)  # every difference modulo 21 occurs in it
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


class Words:
    """The words of a slice: byte bounds, place in the document, and hashes of stretches of words."""

    def __init__(self, s: S.Slice):
        space = _SPACE[s.bytes]
        before = np.r_[True, space[:-1]] if len(space) else space
        after = np.r_[space[1:], True] if len(space) else space
        inner = s.bounds[(s.bounds > 0) & (s.bounds < len(space))]
        before[inner] = True
        after[inner - 1] = True
        self.starts, self.ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.starts, s.bounds)  # the first word of each document, and the end
        n = len(self.starts)
        sizes = np.diff(self.first)
        self.place = np.arange(n) - np.repeat(self.first[:-1], sizes)
        self.left = np.repeat(self.first[1:], sizes) - np.arange(n)  # words up to the document's end
        own = S.stretch_hash(S.prefix_hash(S.BYTE_VALUES[s.bytes]), self.starts, self.ends)
        self.prefix, self.second = S.prefix_hash(own), S.prefix_hash(S.mix(own ^ np.uint64(0x5851F42D4C957F2D)))

    def anchors(self, window: int, period: int, cover) -> tuple[np.ndarray, np.ndarray]:
        """Places of anchors and their hashes."""
        size = window - period + 1
        at = np.flatnonzero(np.isin(self.place % period, list(cover)) & (self.left >= size))
        return at, S.stretch_hash(self.prefix, at, at + size) >> np.uint64(64 - S.HASH_BITS)

    def candidates(self, anchors: np.ndarray, window: int, period: int) -> np.ndarray:
        """Starts of the whole windows that hold one of the anchors less than a period after their start."""
        near = S.covered(len(self.starts), np.maximum(anchors - period + 1, anchors - self.place[anchors]), anchors + 1)
        return np.flatnonzero(near & (self.left >= window))

    def windows(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        return (S.stretch_hash(self.prefix, at, at + window) >> np.uint64(64 - S.HASH_BITS),
                S.stretch_hash(self.second, at, at + window) >> np.uint64(64 - S.HASH_BITS))


def distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows in order, how often each occurs (1, or 2 for more), and each row's number among them."""
    order = np.lexsort(columns[::-1])
    ranked = [c[order] for c in columns]
    starts = S.group_starts(*ranked)
    sizes = np.diff(np.r_[starts, len(order)])
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), sizes)
    return [c[starts] for c in ranked], np.minimum(sizes, 2).astype(np.uint8), number


def repeated(h: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    """1 for each entry whose content occurs twice or more over all slices."""
    *columns, times, _ = rest
    order = np.lexsort([*columns[::-1], h])
    starts = S.group_starts(h[order], *[c[order] for c in columns])
    sums = np.add.reduceat(times[order].astype(np.int64), starts)
    out = np.empty(len(h), np.uint8)
    out[order] = np.repeat(sums > 1, np.diff(np.r_[starts, len(h)]))
    return out


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, period: int = PERIOD,
          cover=COVER) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and kept, the kept words joined by a space."""
    ship(docs.sparkSession)
    cut = S.slices(docs, doc_id, text)
    buckets = S.bucket_total(cut, len(cover) / period / 6)

    def anchors(batches):
        for b in batches:
            for _, row in b.iterrows():
                (h,), times, _ = distinct(Words(S.Slice.of(row)).anchors(window, period, cover)[1])
                yield S.blob_rows(list(S.dealt(row["slice"], h, [times], buckets)))

    def known(words: Words, codes: pd.DataFrame) -> tuple[np.ndarray, tuple, tuple]:
        at, h = words.anchors(window, period, cover)
        again = S.codes_of(codes)[distinct(h)[2]] > 0
        starts = words.candidates(at[again], window, period)
        return starts, *[distinct(*words.windows(starts, window))]

    def extended(left: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return S.blob_rows([])
        _, ((h, r), times, _) = known(Words(S.Slice.of(left.iloc[0])), codes)
        return S.blob_rows(list(S.dealt(left["slice"].iloc[0], h, [r, times], buckets)))

    def kept(left: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        s = S.Slice.of(left.iloc[0])
        words = Words(s)
        starts, (_, _, number) = known(words, codes[codes["step"] == 1])
        hit = starts[S.codes_of(codes[codes["step"] == 2])[number] > 0] if len(starts) else starts
        gone = S.covered(len(words.starts), hit, hit + window)
        rows = []
        a, z = words.starts.tolist(), words.ends.tolist()
        for d, (i, j) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            stay = (np.flatnonzero(~gone[i:j]) + i).tolist()
            whole = b" ".join([s.raw[a[w]:z[w]] for w in stay])
            rows.append((j - i, j - i - len(stay), hashlib.sha256(whole).hexdigest(), whole.decode()))
        out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])
        out.insert(0, "doc_id", s.doc_ids())
        return out

    first = S.answered(cut.mapInPandas(anchors, S.BLOBS), [np.uint8], repeated)
    blobs = cut.groupBy("slice").cogroup(first.groupBy("slice")).applyInPandas(extended, S.BLOBS)
    second = S.answered(blobs, [np.uint64, np.uint8], repeated)
    both = first.selectExpr("*", "1 as step").union(second.selectExpr("*", "2 as step"))
    return cut.groupBy("slice").cogroup(both.groupBy("slice")).applyInPandas(kept, RESULT)
