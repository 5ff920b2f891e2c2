"""Slices of a corpus, rolling hashes over them, and an exchange of content hashes between slices.

A slice is a row that holds some whole documents, about two megabytes of text. Operators look for content that slices
share: every slice sends its distinct content hashes, packed and dealt by hash range, to buckets; a bucket sees all
slices' entries for its range and answers with a code per entry. The number of buckets grows with the corpus, and a
content that occurs a million times in a slice is one entry of it, so frequent contents do not make a bucket large.
Every slice sends a blob to every bucket, and a blob has a price of its own: `slice_size` and `bucket_size` let both
grow with the corpus, within bounds of memory, so that a blob keeps its entries. Arrays with a number per byte are made
for a part of a slice at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.common import settle

SLICE_BYTES = 2 << 20
SLICE_MOST = 8 << 20
BUCKET_ENTRIES = 100_000
BUCKET_MOST = 1_200_000
BLOB_ENTRIES = 500  # that a slice should have for a bucket
HASH_BITS = 48  # of the hash that deals entries to buckets
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: after all ids

SLICE = "slice long, ids array<long>, sizes array<long>, n_bytes long, data binary"
BLOBS = "slice long, bucket long, n long, blob binary"
CODES = "slice long, bucket long, codes binary"
WEIGHED = CODES + ", weight long"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = len(_powers.get(base, ()))
    if have < n:
        steps = np.full(max(n, 2 * have, SLICE_BYTES + 1024), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of values follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def byte_prefix(raw: np.ndarray, values: np.ndarray) -> np.ndarray:
    """prefix_hash(values[raw]) without copies in between."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.take(values, raw, out=out[1:], mode="clip")
    out[1:] *= powers(_BASE, len(raw))
    np.cumsum(out[1:], out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the values from start up to end, whatever their place."""
    return mix((prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start])


def fixed_hash(prefix: np.ndarray, size: int, begin: int = 0) -> np.ndarray:
    """Hashes of all stretches of one size; `begin` is the place of the first sum where the sums before are left out."""
    n = len(prefix) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((prefix[size:] - prefix[:n]) * powers(_INVERSE, begin + len(prefix))[begin:begin + n])


def compressed(a: np.ndarray) -> bytes:
    """An array, bytes of equal weight side by side, compressed."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def restored(b: bytes, kind) -> np.ndarray:
    raw, width = unzipped(b), np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def zipped(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def unzipped(b: bytes) -> bytes:
    size = int.from_bytes(b[:8], "little")
    return pa.Codec("zstd").decompress(b[8:], size, asbytes=True) if size else b""


def joined(parts: list[bytes]) -> bytes:
    """Byte strings in one, each with its size in front."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def parted(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        size = int.from_bytes(b[at:at + 8], "little")
        out.append(b[at + 8:at + 8 + size])
        at += 8 + size
    return out


class Slice:
    """The ids (NO_ID for null), the bounds of the documents' bytes, and the bytes."""

    def __init__(self, ids, sizes, data: bytes):
        self.ids = np.array(ids, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        self.raw = unzipped(data)
        self.bytes = np.frombuffer(self.raw, np.uint8)

    @classmethod
    def of(cls, row) -> Slice:
        return cls(row["ids"], row["sizes"], row["data"])

    def doc_ids(self):
        return longs([None if x == NO_ID else x for x in self.ids.tolist()])

    def document_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1

    def parts(self) -> Iterator[tuple[int, int]]:
        """First and last bound of stretches of whole documents, of about SLICE_BYTES each."""
        starts = group_starts(self.bounds[:-1] // SLICE_BYTES).tolist()
        yield from zip(starts, [*starts[1:], len(self.bounds) - 1])


def slices(docs: DataFrame, doc_id: str, text: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Whole documents in slices, written to the shared folder. A null text is empty."""
    def run(batches):
        from pyspark import TaskContext

        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            data = zipped(b"".join(texts))
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([size], pa.int64()),
                pa.array([data], pa.binary())], names=["slice", "ids", "sizes", "n_bytes", "data"])

        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                raw = (t.as_py() or "").encode()
                ids.append(i.as_py() if i.is_valid else NO_ID)
                texts.append(raw)
                size += len(raw)
                if size >= slice_bytes:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return settle(given.mapInArrow(run, SLICE), "slices")


def slice_size(docs: DataFrame, text: str) -> int:
    """Bytes of a slice: as many as leave eight slices to a core, at least SLICE_BYTES and at most SLICE_MOST."""
    n = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return min(SLICE_MOST, max(SLICE_BYTES, n // (8 * docs.sparkSession.sparkContext.defaultParallelism)))


def bucket_size(slices: int) -> int:
    """Entries of a bucket, for which each of so many slices has BLOB_ENTRIES where BUCKET_MOST allows it."""
    return min(BUCKET_MOST, max(BUCKET_ENTRIES, BLOB_ENTRIES * slices))


def bucket_total(cut: DataFrame, entries_per_byte: float, bucket_entries: int = BUCKET_ENTRIES) -> int:
    n = cut.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, int(n * entries_per_byte) // bucket_entries)


def dealt(number: int, h: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """Rows of BLOBS for entries sorted by h: in each bucket's blob the steps of h and the other columns."""
    bucket = ((h >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(HASH_BITS - 16)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(h) else []
    for a, z in zip(starts, [*starts[1:], len(h)]):
        steps = np.diff(h[a:z], prepend=np.uint64(0))
        yield number, int(bucket[a]), int(z - a), joined([compressed(steps), *[compressed(c[a:z]) for c in columns]])


def blob_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["slice", "bucket", "n", "blob"])


def answered(blobs: DataFrame, kinds: list, answer: Callable, weigh: Callable | None = None) -> DataFrame:
    """CODES for all blobs: answer(h, *columns, slice number of each entry) -> a code per entry, a numpy array.
    WEIGHED, if weigh(codes, *columns) tells what entries weigh; a blob's weight is their sum."""
    def run(own: pd.DataFrame) -> pd.DataFrame:
        parts = [parted(b) for b in own["blob"]]
        h = np.concatenate([np.cumsum(restored(p[0], np.uint64)) for p in parts])
        columns = [np.concatenate([restored(p[1 + i], k) for p in parts]) for i, k in enumerate(kinds)]
        codes = answer(h, *columns, np.repeat(np.arange(len(parts)), own["n"].to_numpy()))
        ends = np.cumsum(own["n"].to_numpy())
        out = pd.DataFrame({"slice": own["slice"], "bucket": own["bucket"], "codes": [
            compressed(codes[a:z]) for a, z in zip([0, *ends[:-1]], ends)]})
        if weigh:
            out["weight"] = np.diff(np.r_[0, np.cumsum(weigh(codes, *columns))[ends - 1]])
        return out

    return settle(blobs.groupBy("bucket").applyInPandas(run, WEIGHED if weigh else CODES), "codes")


def codes_of(rows: pd.DataFrame, kind=np.uint8) -> np.ndarray:
    """The codes of a slice's entries, in the order in which they were dealt."""
    parts = [restored(c, kind) for c in rows.sort_values("bucket")["codes"]]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def longs(values: list) -> pd.api.extensions.ExtensionArray:
    """Whole numbers and None as a column; plain pandas columns would turn them into doubles."""
    return pd.array([None if x is None else int(x) for x in values], dtype="Int64")


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a group of equal rows begins, in sorted columns."""
    change = np.ones(len(columns[0]), bool)
    if len(change):
        change[1:] = False
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in a stretch from start up to end."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
