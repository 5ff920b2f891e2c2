"""An index in segments against one that is built anew; versions and their manifests."""

import os

import pytest
from pyspark.sql import functions as F

from matchlake.functions.fixed import JOB_FIELDS
from matchlake.operators import lexical
from matchlake.sources import segments, versions


def tables(index):
    """Everything an index answers with, rounded and in order."""
    terms = sorted((r["term"], r["df"], round(r["idf"], 9)) for r in lexical.term_stats(index).collect())
    hits = sorted((r["term"], r["doc_id"], round(r["impact"], 9)) for r in lexical.impacts(index).collect())
    lengths = sorted(tuple(r) for r in lexical.doc_lengths(index).collect())
    meta = sorted(tuple(r) for r in index.meta.select("doc_id", "title").collect())
    return terms, hits, lengths, meta, index.totals.first().asDict()


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names}


def batches(spark):
    def docs(ids, word):
        return spark.createDataFrame([(i, f"title{i % 3} {word}", f"{word} text of {i} and {word}{i % 5}") for i in ids],
                                     "doc_id long, title string, description string")
    return [docs(range(0, 12), "old"), docs(range(8, 20), "newer"), docs([3, 9, 15, 40], "newest"), docs([41], "last")]


def anew(spark, given):
    latest = {}
    for b in given:
        latest |= {r["doc_id"]: tuple(r) for r in b.collect()}
    docs = spark.createDataFrame(sorted(latest.values()), given[0].schema)
    return lexical.build_index(docs, JOB_FIELDS, docs.select("doc_id", "title"))


@pytest.mark.parametrize("fanout", [None, 2])
def test_added_batches_equal_an_index_built_anew(spark, tmp_path, fanout):
    index = segments.create(spark, str(tmp_path / "i"), JOB_FIELDS, term_parts=3 if fanout else 0)
    given = batches(spark)
    for n, b in enumerate(given, 1):
        before = files(tmp_path)
        index = segments.add(index, b, b.select("doc_id", "title"), fanout)
        after = files(tmp_path)
        assert {f: after[f] for f in before} == before  # earlier files stay as they are
        if fanout or n == len(given):
            assert tables(segments.lexical_index(index)) == tables(anew(spark, given[:n]))
    assert index.version == 5
    assert len(index.segments) == 4 if fanout is None else len(index.segments) < 4
    merged = segments.merge(index)
    assert len(merged.segments) == 1 and merged.segments[0].tombstones == ()
    assert tables(segments.lexical_index(merged)) == tables(segments.lexical_index(index))


def test_search_and_removal(spark, tmp_path, five, sample_queries):
    index = segments.create(spark, str(tmp_path / "i"), JOB_FIELDS, term_parts=2)
    for k in (0, 1):
        index = segments.add(index, five.filter(F.col("doc_id") % 2 == k))
    found = lambda i: sorted((r[0], r[1], round(r[2], 9), r[3]) for r in lexical.search(i, sample_queries).collect())
    assert found(segments.lexical_index(index)) == found(lexical.build_index(five, JOB_FIELDS))
    without = segments.remove(index, spark.createDataFrame([(0,), (3,), (77,)], "doc_id long"))
    assert found(segments.lexical_index(without)) == found(lexical.build_index(five.filter("doc_id not in (0, 3)"), JOB_FIELDS))
    none = segments.remove(without, five.select("doc_id"))
    assert none.segments == () and found(segments.lexical_index(none)) == []


def test_a_reader_keeps_its_version(spark, tmp_path):
    root, given = str(tmp_path / "i"), batches(spark)
    first = segments.add(segments.create(spark, root, JOB_FIELDS), given[0], given[0].select("doc_id", "title"))
    held = segments.lexical_index(first)
    want = tables(held)
    segments.merge(segments.add(first, given[1], given[1].select("doc_id", "title"), None))
    assert tables(held) == want == tables(segments.lexical_index(segments.open_version(spark, root, first.version)))
    assert tables(segments.lexical_index(segments.open_version(spark, root))) != want


def test_of_two_writers_one_publishes(spark, tmp_path):
    root, given = str(tmp_path / "i"), batches(spark)
    index = segments.create(spark, root, JOB_FIELDS)
    mine = segments.add(index, given[0])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        segments.add(index, given[1])
    assert segments.open_version(spark, root).segments == mine.segments


def test_tiers(spark):
    at = lambda n: segments.tier(segments.Segment("x", n), 4)
    assert [at(n) for n in (0, 1, 3, 4, 15, 16, 63, 64)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_published_folders(spark, tmp_path):
    root = str(tmp_path / "p")
    assert versions.latest(spark, root) == 0
    with pytest.raises(ValueError):
        versions.published(spark, root)
    one, _ = versions.publish(spark, root, lambda f: spark.range(3).write.parquet(f))
    with pytest.raises(RuntimeError):
        versions.publish(spark, root, lambda f: (_ for _ in ()).throw(RuntimeError("killed")))
    assert versions.published(spark, root) == one
    two, n = versions.publish(spark, root, lambda f: spark.range(4).write.parquet(f))
    assert n == 2 and versions.published(spark, root) == two and versions.published(spark, root, 1) == one
    with pytest.raises(ValueError):
        versions.published(spark, root, 9)
