"""WARC archives with an index that is written first, and reads of selected records as coalesced byte ranges.

Every task writes its pages as one archive file, each record a gzip member of its own, and returns an index row per
record: file, offset, length, URL, digest. Reading goes by the index alone: the wanted rows of a file are sorted by
offset, neighbours with a small gap between them become one byte range, and records are cut out of the ranges.

Of pages with equal payloads the one with the greatest page_id is stored, others are revisit records that refer to
it. Which page that is comes from digests alone, before the payloads are moved; a payload is dealt by its page_id,
so a group of copies is spread over all tasks.

A file's name holds a random part, and only the index rows of the attempt that succeeded name it: a lost or repeated
task leaves an unnamed file behind, never a wrong record. Files are written and read through Arrow's file systems, so
the folder may be on any store that all executors reach.

Defined cases: a null html is an empty payload; a null page_id is written as a response and read back as null; rows
that share page_id and payload are all of the same type; a null URL is written empty; line breaks in a URL are
percent-encoded in the header; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import ship
from matchlake.operators.common import settle

DATE = "2024-01-01T00:00:00Z"  # fixed value: a run must not depend on the clock
MIN_REVISIT_BYTES = 0
GAP = 64 * 1024
SPAN = 8 * 1024 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("file string, offset long, length long, page_id long, url string, payload_digest string, "
         "record_type string, refers_to long")
RECORDS = ("page_id long, url string, payload string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str):
    from pyarrow import fs

    found, at = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return found, at


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, as a gzip member. A revisit has the response's headers, which state the payload's length."""
    at = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {at}",
             f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """The fields of a record. A response's digest is checked against its payload."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(named["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    digest, kind = named["WARC-Payload-Digest"].removeprefix("sha1:"), named["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {named['WARC-Record-ID']} does not match its digest")
    number = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">")) if x and x != "<urn:page:>" else None
    return {"page_id": number(named["WARC-Record-ID"]), "url": named["WARC-Target-URI"],
            "payload": payload.decode() if kind == "response" else None, "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": number(named.get("WARC-Refers-To"))}


def exact(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers stay whole beside missing ones."""
    kinds = {c: "Int64" for c in ("offset", "length", "page_id", "payload_bytes", "refers_to") if c in rows}
    return rows.astype(kinds)


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload another page with a greater id stores."""
    keyed = settle(pages.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least)).select(
        "page_id", F.sha1(F.col("payload").cast("binary")).alias("digest")), "warc-digests").distinct()
    stored = keyed.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    return keyed.join(stored.drop("n"), "digest").filter("page_id <> refers_to")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes the archives and their index below a shared folder and returns the index."""
    ship(pages.sparkSession)
    given = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                         F.coalesce(F.col(html), F.lit("")).alias("payload"))
    known = settle(revisits(given, least), "warc-revisits")
    given = given.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    dealt = given.join(known, ["page_id", "digest"], "left").select(
        F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        out, offset = None, 0
        for b in batches:
            rows = []
            for page, at, payload, refers in zip(b["page_id"], b["url"], b["payload"], b["refers_to"]):
                if out is None:
                    store, path = filesystem(name)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                page, refers, data = *(None if x is None else int(x) for x in (page, refers)), payload.encode()
                member = record(page, at, data, refers)
                out.write(member)
                rows.append((name, offset, len(member), page, at, base32_sha1(data), "response" if refers is None else "revisit", refers))
                offset += len(member)
            yield exact(pd.DataFrame(rows, columns=["file", "offset", "length", "page_id", "url", "payload_digest",
                                                    "record_type", "refers_to"], dtype=object))
        if out is not None:
            out.close()

    dealt.mapInPandas(archive, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def coalesced(offsets: list[int], lengths: list[int], gap: int = GAP, span: int = SPAN) -> list[tuple[int, int, list[int]]]:
    """Byte ranges (start, end, places of the records in them) that cover records sorted by offset."""
    ranges: list = []
    for i, (at, size) in enumerate(zip(offsets, lengths)):
        if ranges and at - ranges[-1][1] <= gap and at + size - ranges[-1][0] <= span:
            ranges[-1][1] = max(ranges[-1][1], at + size)
            ranges[-1][2].append(i)
        else:
            ranges.append([at, at + size, [i]])
    return [tuple(r) for r in ranges]


def read(index: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """The records that the given index rows name."""
    ship(index.sparkSession)
    # A file is cut into stretches of about a span, so one large archive is read by several tasks.
    placed = index.select("file", "offset", "length", F.floor(F.col("offset") / span).alias("stretch"))
    dealt = placed.repartition("file", "stretch").sortWithinPartitions("file", "offset")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, own in b.groupby("file", sort=False):
                store, path = filesystem(name)
                with store.open_input_file(path) as f:
                    at, size = own["offset"].tolist(), own["length"].tolist()
                    for start, end, places in coalesced(at, size, gap, span):
                        data = f.read_at(end - start, start)
                        rows = [parse(data[at[i] - start:at[i] - start + size[i]]) for i in places]
                        yield exact(pd.DataFrame(rows, dtype=object))

    return dealt.mapInPandas(fetch, RECORDS)
