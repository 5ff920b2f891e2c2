"""Token ids of a corpus in files of compressed planes.

Documents are tokenized, get an end id, and follow each other in ascending doc_id. A file's ids are cut into chunks of
a fixed number. A chunk is transposed: plane p holds byte p (or bit p) of all its ids, and each plane is compressed by
itself with zstandard. Neighbouring ids have little in common, but their upper bytes do, and upper planes shrink to
nearly nothing. Behind the chunks a file holds the chunk index (offset, ids, sizes of the planes) and its documents
(doc_id and number of ids), so any stretch of ids is read without what is before it.

Texts are dealt to files by ranges of doc_id; rows of one doc_id follow each other by a hash of their text and their
row, so that a doc_id that a third of all rows share is spread over files as well. Numbers of ids are summed up over
files alone: a document's start is its file's start and what is before it in the file.

A file's name holds a random part, and only the index row of the attempt that succeeded names it. Files are written
and read through Arrow's file systems, so the folder may be on any store that all executors reach.

Defined cases: a null or empty text has the end id alone; a null doc_id comes last; rows that share a doc_id are
documents one by one; very long texts are tokenized in stretches and span chunks; extra columns do not matter; an
empty table gives an empty index and no documents.
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.llm.shared import ship
from matchlake.llm.tokens import WordIds, loaded, tokenizer_path
from matchlake.llm.warc import filesystem

END_ID = 2
CHUNK = 1 << 18  # ids
FILE_BYTES = 64 << 20  # of text that go to a file, about
LEVEL = 3
READ_BYTES = 8 << 20  # of ids in a batch that is read, about
MAGIC = b"IDPLANES"
NO_ID = np.iinfo(np.int64).max
INDEX = "file string, number long, n_docs long, n_ids long, n_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def transposed(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of 32-bit ids, least significant first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        return [p.tobytes() for p in np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)]
    return [np.ascontiguousarray(p).tobytes() for p in rows.T]


def restored(planes: list[bytes], n: int) -> np.ndarray:
    """The ids whose planes these are: 4 planes of bytes or 32 of bits."""
    parts = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if len(planes) == 32:
        rows = np.packbits(np.unpackbits(parts, axis=1, count=n).T, axis=1, bitorder="little")
    else:
        rows = parts.T
    return np.ascontiguousarray(rows).view("<u4").ravel()


class Writer:
    """A file that takes documents one by one."""

    def __init__(self, folder: str, number: int, chunk: int, bits: bool, level: int):
        self.name = f"{folder}/part-{number:06d}-{uuid.uuid4().hex[:12]}.ids"
        store, path = filesystem(self.name)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.size, self.n_ids = store.open_output_stream(path, compression=None), 0, 0
        self.chunk, self.bits, self.packer = chunk, bits, zstandard.ZstdCompressor(level=level)
        self.held, self.n_held, self.chunks, self.docs = [], 0, [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, int(doc_id is None), len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.chunk:
            ids = np.concatenate(self.held)
            whole = len(ids) // self.chunk * self.chunk
            for a in range(0, whole, self.chunk):
                self._chunk(ids[a:a + self.chunk])
            self.held, self.n_held = [ids[whole:].copy()], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.packer.compress(p) for p in transposed(ids, self.bits)]
        self.chunks.append((self.size, len(ids), *map(len, planes)))
        self._put(b"".join(planes))

    def close(self) -> tuple[str, int, int, int]:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        tables = [np.array(t, "<i8").reshape(-1, w) for t, w in ((self.chunks, 34 if self.bits else 6), (self.docs, 3))]
        packed = [self.packer.compress(np.ascontiguousarray(t.T).tobytes()) for t in tables]
        at = self.size
        self._put(b"".join(packed))
        self._put(np.array([at, *map(len, packed), tables[0].shape[1]], "<i8").tobytes() + MAGIC)
        self.out.close()
        return self.name, len(self.docs), self.n_ids, self.size


class Reader:
    """A file's chunk index, its documents, and any stretch of its ids."""

    def __init__(self, name: str):
        store, path = filesystem(name)
        self.file, self.unpacker = store.open_input_file(path), zstandard.ZstdDecompressor()
        size = self.file.size()
        tail = self.file.read_at(40, size - 40)
        if tail[32:] != MAGIC:
            raise ValueError(f"{name} is not a whole file of ids")
        at, a, b, width = np.frombuffer(tail[:32], "<i8").tolist()
        footer = self.file.read_at(a + b, at)
        table = lambda raw, w: np.frombuffer(self._unpacked(raw), "<i8").reshape(w, -1).T
        self.chunks, self.docs = table(footer[:a], width), table(footer[a:], 3)
        self.chunk_ends, self.doc_ends = np.cumsum(self.chunks[:, 1]), np.cumsum(self.docs[:, 2])

    def _unpacked(self, raw: bytes) -> bytes:
        with self.unpacker.stream_reader(io.BytesIO(raw)) as r:
            return r.read()

    def chunk(self, k: int) -> np.ndarray:
        at, n, *sizes = self.chunks[k].tolist()
        raw, cuts = self.file.read_at(sum(sizes), at), np.r_[0, np.cumsum(sizes)].tolist()
        return restored([self._unpacked(raw[a:z]) for a, z in zip(cuts, cuts[1:])], n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from place start up to end; only the chunks that hold them are read."""
        if start >= end:
            return np.zeros(0, "<u4")
        first, last = np.searchsorted(self.chunk_ends, [start, end - 1], side="right").tolist()
        before = int(self.chunk_ends[first] - self.chunks[first, 1])
        return np.concatenate([self.chunk(k) for k in range(first, last + 1)])[start - before:end - before]


def write(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          end_id: int = END_ID, chunk: int = CHUNK, bits: bool = False, level: int = LEVEL,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files and their index below a shared folder and returns the index: a row per file, in order of
    `number`. `bits` asks for 32 planes of bits instead of 4 of bytes."""
    spark, tokenizer = docs.sparkSession, tokenizer or tokenizer_path()
    ship(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = max(spark.sparkContext.defaultParallelism, size // file_bytes)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("row")]
    dealt = given.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(files, *order)
    dealt = dealt.sortWithinPartitions(*order).select("doc_id", "text")

    def put(batches):
        from pyspark import TaskContext

        number, out, end = TaskContext.get().partitionId(), None, np.array([end_id], "<u4")
        for b in batches:
            own = iter(b.column(0).to_pylist())
            for ids, counts in loaded(WordIds, tokenizer).encode(b.column(1).to_pylist()):
                ends = np.cumsum(counts)
                for part in np.split(ids, ends[:-1]):
                    out = out or Writer(folder, number, chunk, bits, level)
                    out.add(next(own), np.concatenate([part, end]))
        if out is not None:
            name, n_docs, n_ids, n_bytes = out.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "number": number, "n_docs": n_docs, "n_ids": n_ids, "n_bytes": n_bytes}])

    dealt.mapInArrow(put, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(index: DataFrame) -> DataFrame:
    """A row per document of the files: doc_id, start (ids of all documents before it), n_tokens, and ids, which are
    little-endian and unsigned, of 32 bits."""
    spark = index.sparkSession
    ship(spark)
    # One row per file: the running sum is over a small table.
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    dealt = index.select(before.alias("before"), "file").repartitionByRange(max(1, index.count()), "before")

    def fetch(batches):
        for b in batches:
            for before, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = Reader(name)
                starts = np.r_[0, f.doc_ends].tolist()
                first, n = 0, len(f.docs)
                while first < n:
                    last = first + 1
                    while last < n and 4 * (starts[last + 1] - starts[first]) <= READ_BYTES:
                        last += 1
                    ids, own = f.ids(starts[first], starts[last]), f.docs[first:last].tolist()
                    cuts = [4 * (x - starts[first]) for x in starts[first:last + 1]]
                    raw = ids.tobytes()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([None if no else d for d, no, _ in own], pa.int64()),
                        pa.array([before + x for x in starts[first:last]], pa.int64()), pa.array([k for _, _, k in own], pa.int64()),
                        pa.array([raw[a:z] for a, z in zip(cuts, cuts[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    first = last

    return dealt.mapInArrow(fetch, DOCUMENTS)
