"""Removal of byte strings that an earlier document holds, by sorting suffixes.

Each byte is removed that a string of `length` bytes covers which also starts in a document with a smaller id. Only
suffixes that can matter are sorted. Every window of `length` bytes picks an anchor: of the strings of ANCHOR bytes in
it the one whose hash is least. Equal windows pick equal anchors at equal places, and neighbouring windows mostly
pick the same one, so a text falls into runs of windows. Runs with equal bytes are settled at once: the smallest
document among them keeps them, which also reduces a group of copies to one run each before anything is sorted. Where
an anchor occurs in different runs of different documents, windows may still be shared in part, mostly at the ends of
a copied passage. The suffixes of these runs are sorted in the bucket of their anchor, and equal ones found. An anchor
whose runs have more than HOT windows is taken apart: each distinct window of a slice goes by itself to one of so many
parts as the anchor's windows ask for, by a hash of its bytes, so equal windows meet and no anchor makes a bucket
large. A bucket is sorted so:

- shallow: multikey quicksort, all groups of a level at once, 8 bytes per symbol, to a depth of SHALLOW bytes;
- deep: groups whose suffixes agree that far are ordered by a blind trie, which compares an arriving suffix with one
  stored suffix only and branches where they first differ. Each distinct suffix arrives once, with all its places.

Defined cases: a null text is empty; shorter texts keep all; documents with equal ids do not precede each other; a
null doc_id comes after all ids; an empty table gives an empty result. The digest is over all remaining bytes; `kept`
is their text, without characters of which a part was removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import slices as S
from matchlake.llm.shared import ship

LENGTH = 50
ANCHOR = 24
SHALLOW = 16
HOT = 20_000  # windows of an anchor that are sorted in one bucket as whole runs, at most
SORTED = 400_000  # windows that are sorted in one bucket, about
DEALT = 10_000  # tasks that sort, at most
STRETCH = 1 << 14  # windows whose anchors are looked for at once
SECOND_VALUES = S.mix(S.BYTE_VALUES ^ np.uint64(0x5851F42D4C957F2D))  # bytes of a second hash, not tied to the first
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


class Runs:
    """The runs of a slice: first window, end of windows, document, anchor hash and two hashes of the bytes."""

    def __init__(self, s: S.Slice, length: int, anchor: int):
        none = np.zeros(0, np.int64)
        found = [(none,) * 3 + (none.astype(np.uint64),) * 3]
        for a, z in s.parts():
            bounds, first = s.bounds[a:z + 1], s.bounds[a]
            if (np.diff(bounds) >= length).any():
                start, stop, document, *hashes = self._part(s.bytes[first:bounds[-1]], bounds - first, length, anchor)
                found.append((start + first, stop + first, document + a, *hashes))
        self.start, self.stop, self.document, self.h, self.r, self.second = (np.concatenate(c) for c in zip(*found))

    @staticmethod
    def _part(raw: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
        whole = np.diff(bounds) >= length
        prefix = S.byte_prefix(raw, S.BYTE_VALUES)
        steps = np.zeros(len(raw) + 1, np.int8)  # a document's windows are those that end in it
        steps[bounds[:-1][whole]] += 1
        steps[bounds[1:][whole] - length + 1] -= 1
        valid = np.cumsum(steps, dtype=np.int8, out=steps)[:len(raw) - length + 1].view(bool)
        start, at = run_starts(prefix, valid, length, anchor)
        document = np.searchsorted(bounds, start, side="right") - 1
        stop = np.minimum(np.r_[start[1:], len(raw)], bounds[1:][document] - length + 1)
        h = S.mix(S.stretch_hash(prefix, at, at + anchor) ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - S.HASH_BITS)
        r = S.stretch_hash(prefix, start, stop + length - 1)
        other = S.byte_prefix(raw, SECOND_VALUES)
        return start, stop, document, h, r, S.stretch_hash(other, start, stop + length - 1) >> np.uint64(64 - S.HASH_BITS)

    def entries(self, ids: np.ndarray):
        """Distinct (r, second) in order of r, the least id of each, the run that holds it, and each run's entry."""
        own, order = ids[self.document], np.argsort(self.r, kind="stable")
        r = self.r[order]
        same = r[1:] == r[:-1]
        again = np.flatnonzero(np.r_[same, False] | np.r_[False, same])  # only these need the other two columns
        at = order[again]
        order[again] = at[np.lexsort((own[at], self.second[at], r[again]))]
        second = self.second[order]
        starts = S.group_starts(r, second)
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
        return (r[starts], second[starts]), own[order][starts], order[starts], number


def run_starts(prefix: np.ndarray, valid: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of valid windows with one anchor begin, and the place of the anchor.

    Goes over the text in stretches that stay in the processor's cache. Two documents' windows have no anchor in
    common, so the first valid window of a document always begins a run."""
    width, starts, places, before = length - anchor + 1, [], [], -1
    for a in range(0, len(valid), STRETCH):
        z = min(a + STRETCH, len(valid))
        # The upper half orders anchors, the lower half is the place: a minimum tells where it is, ties to the left.
        best = S.fixed_hash(prefix[a:z + length], anchor, a)
        best &= np.uint64(0xFFFFFFFF00000000)
        best |= np.arange(a, a + len(best), dtype=np.uint64)
        have = 1
        while have < width:
            step = min(have, width - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        own = valid[a:z]
        first = np.flatnonzero(own & np.r_[at[0] != before, (at[1:] != at[:-1]) | ~own[:-1]])
        before = at[-1] if own[-1] else -1
        starts.append(first + a)
        places.append(at[first])
    return np.concatenate(starts), np.concatenate(places)


LATER = 1


def compare_runs(top: np.ndarray, low: np.ndarray, second: np.ndarray, doc: np.ndarray, _) -> np.ndarray:
    """LATER: a smaller document has an equal run."""
    order = np.lexsort((doc, second, low, top))
    d = doc[order]
    kinds = S.group_starts(top[order], low[order], second[order])
    out = np.empty(len(d), np.uint8)
    out[order] = d > np.repeat(d[kinds], np.diff(np.r_[kinds, len(d)]))
    return out


def at_anchors(h: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray):
    """Distinct anchors in order, their least and greatest document and sum of n, and the number of each row's anchor."""
    order = np.argsort(h, kind="stable")
    starts = S.group_starts(h[order])
    number = np.empty(len(order), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
    each = lambda f, c: f.reduceat(c[order], starts) if len(starts) else c
    return h[order][starts], each(np.minimum, low), each(np.maximum, high), each(np.add, n), number


def compare_anchors(h: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, _) -> np.ndarray:
    """How many windows the anchor's runs have, 0 if one document has them all."""
    _, least, most, total, number = at_anchors(h, low, high, n)
    return np.where(least < most, total, 0)[number]


def distinct_windows(raw: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start at `at`: one of the least document for each distinct one, and each one's number."""
    grid = np.lib.stride_tricks.sliding_window_view(raw, length)[at]
    _, number = np.unique(np.ascontiguousarray(grid).view(f"V{length}").ravel(), return_inverse=True)
    order = np.lexsort((doc, number))
    return order[S.group_starts(number[order])], number


def distinct_by_part(s: S.Slice, at: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """distinct_windows of each part of a slice, and a hash of the bytes of those that were taken."""
    taken, number, hashes = [np.zeros(0, np.int64)], np.empty(len(at), np.int64), [np.zeros(0, np.uint64)]
    part, done = np.searchsorted(s.bounds[[a for a, _ in s.parts()]], at, side="right") - 1, 0
    for i, (a, z) in enumerate(s.parts()):
        own = np.flatnonzero(part == i)
        if len(own):
            raw, places = s.bytes[s.bounds[a]:s.bounds[z]], at[own] - s.bounds[a]
            first, inner = distinct_windows(raw, places, doc[own], length)
            places = places[first]
            taken.append(own[first])
            hashes.append(S.stretch_hash(S.byte_prefix(raw, S.BYTE_VALUES), places, places + length))
            number[own], done = inner + done, done + len(first)
    return np.concatenate(taken), number, np.concatenate(hashes)


class Pieces:
    """What a slice has to sort: the first runs of their kind at anchors of several documents. They stay whole, or are
    taken apart into distinct windows; all in order of `key`, which deals them to buckets."""

    def __init__(self, s: S.Slice, own: Runs, codes: pd.DataFrame, length: int, hot: int):
        _, self.doc, holder, self.number = own.entries(s.ids)
        self.code = S.codes_of(codes[codes["step"] == 1])
        entry = np.flatnonzero(self.code != LATER)
        run, self.key, self.single = holder[entry], None, None
        sizes, h, d = own.stop[run] - own.start[run], own.h[run], self.doc[entry]
        self.anchors = at_anchors(h, d, d, sizes)
        if not (codes["step"] == 2).any():
            return
        total = S.codes_of(codes[codes["step"] == 2], np.int64)[self.anchors[4]]
        whole, apart = np.flatnonzero((total > 0) & (total <= hot)), np.flatnonzero(total > hot)
        self.whole, key, start, size, least = entry[whole], h[whole], own.start[run[whole]], sizes[whole], d[whole]
        if len(apart):
            n = sizes[apart]
            self.inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            self.of = np.repeat(entry[apart], n)
            at = np.repeat(own.start[run[apart]], n) + self.inner
            first, self.single, content = distinct_by_part(s, at, self.doc[self.of], length)
            at, run_of = at[first], np.repeat(apart, n)[first]
            part = ((content >> np.uint64(32)) * (1 + total[run_of] // hot).astype(np.uint64)) >> np.uint64(32)
            own_key = S.mix(h[run_of] ^ S.mix(part + np.uint64(1))) >> np.uint64(64 - S.HASH_BITS)
            key, start = np.r_[key, own_key], np.r_[start, at]
            size, least = np.r_[size, np.ones(len(at), np.int64)], np.r_[least, self.doc[self.of[first]]]
        self.order, self.least = np.argsort(key, kind="stable"), least
        self.key, self.start, self.size = key[self.order], start[self.order], size[self.order]

    def blobs(self, s: S.Slice, number: int, buckets: int, length: int) -> list[tuple]:
        """Rows of BLOBS: documents, sizes and bytes."""
        rows, bucket = [], ((self.key >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(S.HASH_BITS - 16)
        doc, starts = self.least[self.order], S.group_starts(bucket)
        for a, z in zip(starts, [*starts[1:], len(bucket)]):
            begin, end = self.start[a:z], self.start[a:z] + self.size[a:z] + length - 1
            whole = b"".join([s.raw[x:y] for x, y in zip(begin.tolist(), end.tolist())])
            rows.append((number, int(bucket[a]), int(z - a), S.joined([
                S.compressed(doc[a:z]), S.compressed(self.size[a:z]), S.zipped(whole)])))
        return rows

    def shared(self, answers: np.ndarray) -> np.ndarray:
        """Per distinct run of the slice a bit for each window that a smaller document has."""
        found, bits = np.empty(len(answers), np.uint64), np.zeros(len(self.doc), np.uint64)
        found[self.order] = answers
        bits[self.whole] = found[:len(self.whole)]
        if self.single is not None:
            at = len(self.whole) + self.single
            again = np.flatnonzero((found[at] > 0) | (self.doc[self.of] > self.least[at]))
            np.bitwise_or.at(bits, self.of[again], np.uint64(1) << self.inner[again].astype(np.uint64))
        return bits


def multikey_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of symbols by multikey quicksort, and where groups of equal rows begin.

    All open groups are split at once, each by its own middle row's symbol, into less, equal and greater. The equal
    part goes on to the next symbol."""
    n, depths = symbols.shape
    order, group, depth = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)  # places in the order that are in open groups
    while len(live):
        g = group[live]
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        sizes = np.diff(np.r_[starts, len(live)])
        own = symbols[order[live], depth[live]]
        pivot = np.repeat(own[starts + sizes // 2], sizes)
        side = (own > pivot).astype(np.int64) - (own < pivot) + 1
        by = np.lexsort((side, np.repeat(np.arange(len(starts)), sizes)))
        order[live], side, deep = order[live][by], side[by], depth[live][by]
        depth[live] = deep + (side == 1)
        change = np.r_[True, (g[1:] != g[:-1]) | (side[1:] != side[:-1])]
        heads = np.flatnonzero(change)
        sizes = np.diff(np.r_[heads, len(live)])
        group[live] = np.repeat(live[heads], sizes)
        live = live[np.repeat(sizes > 1, sizes) & (depth[live] < depths)]
    return order, S.group_starts(group)


class BlindTrie:
    """Orders byte strings of one length. A node holds a depth and branches by the byte there; what lies between
    branches is not stored, but read from any string below."""

    def __init__(self):
        self.root = None

    def add(self, s: bytes, places: list[int]) -> None:
        """A string that is not there yet, and the places that have it."""
        leaf = (s, places)
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while isinstance(node[1], dict):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other, n = node[0], len(s)
        differing = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        at = n - (differing.bit_length() + 7) // 8  # the first byte where they differ
        parent, node = None, self.root
        while isinstance(node[1], dict) and node[0] < at:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node[1], dict) and node[0] == at:
            node[1][s[at]] = leaf
            return
        branch = (at, {s[at]: leaf, other[at]: node})
        if parent is None:
            self.root = branch
        else:
            parent[1][s[parent[0]]] = branch

    def groups(self) -> list[list[int]]:
        """The places of equal strings together, in order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node[1], dict):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.append(node[1])
        return out


def sorted_groups(text: np.ndarray, at: np.ndarray, length: int, shallow: int = SHALLOW) -> list[np.ndarray]:
    """The suffixes of text that start at `at`, sorted to `length` bytes: groups of two or more equal ones."""
    padded = np.r_[text, np.zeros(length + 8, np.uint8)]
    grid = np.lib.stride_tricks.sliding_window_view(padded, shallow)[at]
    order, starts = multikey_order(np.ascontiguousarray(grid).view(">u8").astype(np.uint64).reshape(len(at), -1))
    sizes = np.diff(np.r_[starts, len(order)])
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    alike = all_equal(padded, at[order], starts, sizes, shallow, length)
    raw, out = padded.tobytes(), []
    for a, size, same in zip(starts.tolist(), sizes.tolist(), alike.tolist()):
        own = order[a:a + size]
        if same:  # one string: nothing to put in order
            out.append(own)
            continue
        if size == 2:
            continue
        distinct = {}
        for i, p in zip(own.tolist(), at[own].tolist()):
            distinct.setdefault(raw[p + shallow:p + length], []).append(i)
        if len(distinct) == size:
            continue  # no two are equal
        trie = BlindTrie()
        for s, places in distinct.items():
            trie.add(s, places)
        out += [np.array(g) for g in trie.groups() if len(g) > 1]
    return out


def all_equal(text: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Which groups of places have equal bytes everywhere from begin up to end."""
    if not len(starts):
        return np.zeros(0, bool)
    row = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    place, first, alike = at[row], np.repeat(at[starts], sizes), np.ones(len(row), bool)
    width = min(8, end - begin) or 1
    symbol = np.lib.stride_tricks.sliding_window_view(text, width)
    for step in range(begin, end, width):
        step = min(step, end - width)
        alike &= (symbol[place + step] == symbol[first + step]).all(axis=1)
    return np.logical_and.reduceat(alike, np.cumsum(sizes) - sizes)


def shared_windows(text: np.ndarray, sizes: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For runs of `sizes` windows one after the other in text: a bit per window that a smaller document shares."""
    begins = np.r_[0, np.cumsum(sizes + length - 1)[:-1]].astype(np.int64)
    run = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = np.zeros(len(sizes), np.uint64)
    groups = sorted_groups(text, begins[run] + inner, length)
    if not groups:
        return found
    order, sizes = np.concatenate(groups), np.array([len(g) for g in groups])
    own = doc[run[order]]
    least = np.minimum.reduceat(own, np.cumsum(sizes) - sizes)
    later = order[own > np.repeat(least, sizes)]
    np.bitwise_or.at(found, run[later], np.uint64(1) << inner[later].astype(np.uint64))
    return found


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
          hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept."""
    ship(docs.sparkSession)
    if not max(SHALLOW, length - 63) < anchor <= length:
        raise ValueError("an anchor is longer than the shallow depth and leaves at most 64 windows to a run")
    cut = S.slices(docs, doc_id, text, S.slice_size(docs, text))
    buckets = S.bucket_total(cut, 2 / (length - anchor + 2), S.bucket_size(cut.count()))

    def runs(batches):
        for b in batches:
            for _, row in b.iterrows():
                s = S.Slice.of(row)
                (r, second), doc, _, _ = Runs(s, length, anchor).entries(s.ids)
                top, low = r >> np.uint64(64 - S.HASH_BITS), r.astype(np.uint16)
                yield S.blob_rows(list(S.dealt(row["slice"], top, [low, second, doc], buckets)))

    def anchors(left: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        s = S.Slice.of(left.iloc[0])
        h, *columns, _ = Pieces(s, Runs(s, length, anchor), codes, length, hot).anchors
        return S.blob_rows(list(S.dealt(left["slice"].iloc[0], h, columns, buckets)))

    def unsettled(left: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        s, number = S.Slice.of(left.iloc[0]), left["slice"].iloc[0]
        own = Pieces(s, Runs(s, length, anchor), codes, length, hot)
        return S.blob_rows(own.blobs(s, number, parts, length) if own.key is not None else [])

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        blobs = [S.parted(b) for b in part["blob"]]
        doc = np.concatenate([S.restored(b[0], np.int64) for b in blobs])
        sizes = np.concatenate([S.restored(b[1], np.int64) for b in blobs])
        text = np.frombuffer(b"".join(S.unzipped(b[2]) for b in blobs), np.uint8)
        found, ends = shared_windows(text, sizes, doc, length), np.cumsum(part["n"].to_numpy())
        return pd.DataFrame({"slice": part["slice"], "bucket": part["bucket"], "codes": [
            S.compressed(found[a:z]) for a, z in zip([0, *ends[:-1]], ends)]})

    def kept(left: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        s = S.Slice.of(left.iloc[0])
        own = Runs(s, length, anchor)
        mine = Pieces(s, own, codes, length, hot)
        doc, number, bits = mine.doc, mine.number, np.zeros(len(mine.doc), np.uint64)
        if mine.key is not None:
            bits = mine.shared(S.codes_of(codes[codes["step"] == 3], np.uint64))
        later = (mine.code[number] == LATER) | (s.ids[own.document] > doc[number])
        partly = np.flatnonzero(~later & (bits[number] > 0))
        sizes = own.stop[partly] - own.start[partly]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = (np.repeat(bits[number[partly]], sizes) >> inner.astype(np.uint64)) & np.uint64(1) > 0
        single = (np.repeat(own.start[partly], sizes) + inner)[hit]
        whole, rows = np.flatnonzero(later), []
        for first, last in s.parts():
            begin, end = s.bounds[first], s.bounds[last]
            some = whole[slice(*np.searchsorted(own.start[whole], [begin, end]))]
            one = single[slice(*np.searchsorted(single, [begin, end]))]
            gone = S.covered(end - begin, np.r_[own.start[some], one] - begin,
                             np.r_[own.stop[some] + length - 1, one + length] - begin)
            bounds = (s.bounds[first:last + 1] - begin).tolist()
            for a, z in zip(bounds[:-1], bounds[1:]):
                g = gone[a:z]
                rest = s.bytes[begin + a:begin + z][~g].tobytes()
                spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                rows.append((z - a, z - a - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore")))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        out.insert(0, "doc_id", s.doc_ids())
        return out

    def by_slice(frame: DataFrame, codes: DataFrame, run, kind: str) -> DataFrame:
        return frame.groupBy("slice").cogroup(codes.groupBy("slice")).applyInPandas(run, kind)

    def open_windows(codes: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(codes > 0, n, 0)

    codes = S.answered(cut.mapInPandas(runs, S.BLOBS), [np.uint16, np.uint64, np.int64], compare_runs).selectExpr("*", "1 as step")
    second = S.answered(by_slice(cut, codes, anchors, S.BLOBS), [np.int64] * 3, compare_anchors, open_windows)
    parts = 1 + (second.agg(F.sum("weight")).first()[0] or 0) // SORTED
    codes = codes.union(second.drop("weight").selectExpr("*", "2 as step"))
    open_runs = by_slice(cut, codes, unsettled, S.BLOBS)
    open_runs = open_runs.repartition(min(parts, DEALT), "bucket")  # few bytes, but much to do: Spark would make few tasks
    third = S.settle(open_runs.groupBy("bucket").applyInPandas(sort, S.CODES), "codes")
    return by_slice(cut, codes.union(third.selectExpr("*", "3 as step")), kept, RESULT)
