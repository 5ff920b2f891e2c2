"""A lexical index that takes documents without rewriting what it has.

Documents that are added become a segment: their postings, lengths, metadata and sums, written once and never changed.
A document that replaces or removes an older one puts that one's id into a set of tombstones of its segment, beside
the sums which the segment loses by it. So statistics of the whole index are sums over segments less sums over
tombstones, and adding reads of the old postings only the replaced documents' terms, from segments that have such.

Segments are merged in tiers: a tier holds segments of like size, and when it has `fanout` of them they become one of
the next tier, without the rows that tombstones name. A row is thus rewritten once per tier, and there are at most
about fanout * log(documents) segments. Versions are published by `versions`; a reader that holds an older one
keeps reading its segments.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import fixed
from matchlake.operators.common import BROADCAST_ROWS, hint_small, is_at_most
from matchlake.operators.lexical import LexicalIndex, build_index, term_counts, term_part, totals
from matchlake.sources import versions

SETTINGS = "position int, field string, weight double, b double, k1 double, stemmed boolean, term_parts int"
SEGMENT = "folder string, n_docs long, tombstones array<string>, n_gone long"
FANOUT = 4


@dataclass(frozen=True)
class Segment:
    folder: str
    n_docs: int                     # rows of `lengths`
    tombstones: tuple[str, ...] = ()
    n_gone: int = 0                 # ids in the tombstones

    @property
    def n_live(self) -> int:
        return self.n_docs - self.n_gone


@dataclass(frozen=True)
class SegmentedIndex:
    """One version of the index."""
    spark: SparkSession
    root: str
    version: int
    segments: tuple[Segment, ...]
    fields: Mapping[str, tuple[float, float]]
    k1: float
    stemmed: bool
    term_parts: int


def create(spark: SparkSession, root: str, fields: Mapping[str, tuple[float, float]], k1: float = fixed.K1,
           stemmed: bool = False, term_parts: int = 16) -> SegmentedIndex:
    """An index without documents. With `term_parts` postings are partitioned by a hash of the term, and a search reads
    the partitions of its terms."""
    conf = [(i, f, w, b, k1, stemmed, term_parts) for i, (f, (w, b)) in enumerate(fields.items())]
    spark.createDataFrame(conf, SETTINGS).coalesce(1).write.mode("error").json(f"{root}/settings")
    versions.commit(spark, root, SEGMENT, [], 1)
    return open_version(spark, root)


def open_version(spark: SparkSession, root: str, version: int | None = None) -> SegmentedIndex:
    """A version of the index, the newest if none is named."""
    conf = spark.read.schema(SETTINGS).json(f"{root}/settings").orderBy("position").collect()  # a row per field
    version = versions.latest(spark, root) if version is None else version
    found = versions.entries(spark, root, SEGMENT, version)
    segments = tuple(Segment(r["folder"], r["n_docs"], tuple(r["tombstones"]), r["n_gone"]) for r in found)
    return SegmentedIndex(spark, root, version, segments, {r["field"]: (r["weight"], r["b"]) for r in conf}, conf[0]["k1"],
                          conf[0]["stemmed"], conf[0]["term_parts"])


def _commit(index: SegmentedIndex, segments: list[Segment]) -> SegmentedIndex:
    rows = [(s.folder, s.n_docs, list(s.tombstones), s.n_gone) for s in segments]
    versions.commit(index.spark, index.root, SEGMENT, rows, index.version + 1)
    return open_version(index.spark, index.root, index.version + 1)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _gone(index: SegmentedIndex, s: Segment) -> DataFrame:
    return _all([index.spark.read.parquet(f"{t}/ids").select("doc_id") for t in s.tombstones])


def _live(index: SegmentedIndex, s: Segment, table: str) -> DataFrame:
    rows = index.spark.read.parquet(f"{s.folder}/{table}")
    if not s.tombstones:
        return rows
    return rows.join(hint_small(_gone(index, s), s.n_gone <= BROADCAST_ROWS), "doc_id", "left_anti")


def _negative(df: DataFrame, *sums: str) -> DataFrame:
    return df.select(*[(-F.col(c)).alias(c) if c in sums else F.col(c) for c in df.columns])


def _summed(index: SegmentedIndex, segments) -> tuple[DataFrame, DataFrame]:
    """Totals and document frequencies: sums over segments less sums over their tombstones."""
    read, sums = index.spark.read.parquet, ["n_docs", *[f"total_{f}" for f in index.fields]]
    lost = [t for s in segments for t in s.tombstones]
    parts = [read(f"{s.folder}/totals") for s in segments] + [_negative(read(f"{t}/totals"), *sums) for t in lost]
    counts = [read(f"{s.folder}/term_counts") for s in segments] + [_negative(read(f"{t}/term_counts"), "df") for t in lost]
    return (_all(parts).agg(*[F.sum(c).alias(c) for c in sums]),
            _all(counts).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0"))


def lexical_index(index: SegmentedIndex) -> LexicalIndex:
    """The version as an index that every search and statistic takes."""
    if not index.segments:
        none = index.spark.createDataFrame([], "doc_id long, " + ", ".join(f"`{f}` string" for f in index.fields))
        return build_index(none, index.fields, None, index.k1, index.stemmed)
    total, counts = _summed(index, index.segments)
    live = lambda table: _all([_live(index, s, table) for s in index.segments])
    return LexicalIndex(live("rows"), live("lengths"), total, counts, live("meta"), index.fields, index.k1, index.stemmed,
                        index.term_parts)


def _write(index: SegmentedIndex, rows: DataFrame, lengths: DataFrame | None, meta: DataFrame, sums=None) -> Segment | None:
    """Writes a segment. Lengths and sums are derived from the written rows where none are given."""
    read, folder = index.spark.read.parquet, versions.new_folder(index.root, "segments")
    names = [f"dl_{f}" for f in index.fields]
    if index.term_parts:
        rows.withColumn("term_part", term_part(F.col("term"), index.term_parts)).write.partitionBy("term_part").parquet(f"{folder}/rows")
    else:
        rows.write.parquet(f"{folder}/rows")
    written = read(f"{folder}/rows")
    if lengths is None:
        lengths = written.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in names])
    lengths.select("doc_id", *names).write.parquet(f"{folder}/lengths")
    meta.write.parquet(f"{folder}/meta")
    stored = read(f"{folder}/lengths")
    total, counts = sums or (totals(stored, index.fields), term_counts(written))
    total.write.parquet(f"{folder}/totals")
    counts.write.parquet(f"{folder}/term_counts")
    n = stored.count()
    return Segment(folder, n) if n else None


def _without(index: SegmentedIndex, s: Segment, ids: DataFrame, few: bool) -> Segment | None:
    """The segment with tombstones for those of `ids` that it holds; None if it holds no other."""
    lost = _live(index, s, "lengths").join(hint_small(ids, few), "doc_id", "left_semi")
    folder = versions.new_folder(index.root, "tombstones")
    lost.write.parquet(f"{folder}/ids")
    written = index.spark.read.parquet(f"{folder}/ids")
    n = written.count()
    if n == 0:
        return s
    if n == s.n_live:
        return None
    terms = index.spark.read.parquet(f"{s.folder}/rows").select("doc_id", "term").join(
        hint_small(written.select("doc_id"), n <= BROADCAST_ROWS), "doc_id", "left_semi")
    totals(written, index.fields).write.parquet(f"{folder}/totals")
    term_counts(terms).write.parquet(f"{folder}/term_counts")
    return Segment(s.folder, s.n_docs, (*s.tombstones, folder), s.n_gone + n)


def add(index: SegmentedIndex, docs: DataFrame, meta: DataFrame | None = None, fanout: int | None = FANOUT) -> SegmentedIndex:
    """The next version, with `docs(doc_id, <field>…)` of unique ids. A document replaces an older one of its id. Tiers
    that are full are merged, unless `fanout` is None."""
    new = build_index(docs, index.fields, meta, index.k1, index.stemmed)
    added = _write(index, new.rows, None, new.meta)
    if added is None:
        return index
    ids = index.spark.read.parquet(f"{added.folder}/lengths").select("doc_id")
    few = added.n_docs <= BROADCAST_ROWS
    kept = [_without(index, s, ids, few) for s in index.segments]
    return _commit(index, _settled(index, [*[s for s in kept if s], added], fanout))


def remove(index: SegmentedIndex, ids: DataFrame) -> SegmentedIndex:
    """The next version, without documents whose doc_id is in `ids`."""
    ids = ids.select("doc_id").distinct()
    few = is_at_most(ids, BROADCAST_ROWS)
    kept = [_without(index, s, ids, few) for s in index.segments]
    return _commit(index, [s for s in kept if s])


def tier(s: Segment, fanout: int) -> int:
    return int(math.log(max(s.n_live, 1), fanout) + 1e-9)


def _settled(index: SegmentedIndex, segments: list[Segment], fanout: int | None) -> list[Segment]:
    """Segments with no tier of `fanout` or more."""
    while fanout:
        tiers = defaultdict(list)
        for s in segments:
            tiers[tier(s, fanout)].append(s)
        full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fanout), None)
        if full is None:
            break
        segments = [s for s in segments if s not in full] + [_merged(index, full)]
    return segments


def _merged(index: SegmentedIndex, segments: list[Segment]) -> Segment:
    live = lambda table: _all([_live(index, s, table) for s in segments])
    return _write(index, live("rows").drop("term_part"), live("lengths"), live("meta"), _summed(index, segments))


def merge(index: SegmentedIndex) -> SegmentedIndex:
    """The next version, with all segments in one."""
    return _commit(index, [_merged(index, list(index.segments))]) if len(index.segments) > 1 else index
