"""The pipeline, stage by stage, against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from matchlake.llm import quality
from matchlake.operators.common import settle
from tests.llm.conftest import rows
from tests.llm.test_table_operators import WORD, brute_targets
from tests.llm.test_text_operators import brute_components, check_packing


def in_order(given):
    """Rows as the pipeline numbers them, but for the order of texts under one id, which is that of a hash."""
    return sorted(((r["doc_id"], r["text"] or "", r["hash"]) for r in given), key=lambda x: (x[0] is None, x[0] or 0, x[2]))


def first_of_groups(before):
    """The first row of each group of near-duplicates."""
    numbered = [(i, t) for i, (_, t, _) in enumerate(in_order(before))]
    ids = [d for d, _, _ in in_order(before)]
    return Counter((ids[c], numbered[c][1]) for c in {c for _, _, c in brute_components(numbered)})


def without_earlier_passages(before):
    first, want = {}, Counter()
    for n, (d, t, _) in enumerate(in_order(before)):
        raw = t.encode()
        gone = bytearray(len(raw))
        grams = [raw[i:i + 50] for i in range(len(raw) - 49)]
        for i, g in enumerate(grams):
            if first.get(g, n) < n:
                gone[i:i + 50] = b"\1" * 50
        for g in grams:
            first.setdefault(g, n)
        left = bytes(x for x, y in zip(raw, gone) if not y).decode("utf-8", "ignore")
        if left or not any(gone):
            want[d, left] += 1
    return want


@pytest.mark.parametrize("name", ["SimHash near-dedup", "suffix-array dedup"])
def test_rows_that_share_an_id_or_have_none(spark, name):
    """Nothing is lost or doubled by repeated and missing ids."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in ("one", "two", "three"))
    data = [(1, a), (1, b), (2, b), (2, b), (None, c), (None, c), (None, a), (3, "x" + c), (4, None), (4, ""), (None, None), (5, b + "\n" + "tail " * 30)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in data],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs = settle(docs, "docs")
    before = rows(docs.withColumn("hash", F.xxhash64("text")))
    got = Counter((r["doc_id"], r["text"] or "") for r in rows(dict(P.STAGES)[name](spark, docs, "")))
    assert got == (first_of_groups if name.startswith("Sim") else without_earlier_passages)(before)


def test_stages(spark, pair, empty):
    docs = settle(pair.withColumn("n_chars", F.length("text").cast("long")).withColumn("row_key", F.lit(1)), "docs")
    kind = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    steps = {}
    for name, stage in P.STAGES:
        before, docs = docs, settle(stage(spark, docs, ""), "stage")
        steps[name] = (rows(before.withColumn("hash", F.xxhash64("text"))), rows(docs))
        if name != P.STAGES[-1][0]:
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in kind]

    before, after = steps["quality rules"]
    text = lambda rs: Counter((r["doc_id"], r["text"] or "") for r in rs)
    judged = Counter((r["doc_id"], r["t"]) for r in rows(quality.judge(pair.withColumn("t", F.col("text"))).filter("kept").join(
        pair.select("doc_id", F.col("text").alias("t")), "doc_id")))
    assert set(text(after)) == {k for k in judged} | {k for k in text(after) if k[0] is None}
    assert len(after) < len(before)

    before, after = steps["SimHash near-dedup"]
    assert text(after) == first_of_groups(before)

    before, after = steps["suffix-array dedup"]
    assert text(after) == without_earlier_passages(before)
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = steps["mixing sources to target weights"]
    sizes, got = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in after:
        got[r["source"]] += len(WORD.findall(r["text"]))
    longest = max(len(WORD.findall(r["text"])) for r in before)
    for s, t in brute_targets(sizes).items():
        assert abs(got[s] - t) <= longest
    assert max(text(after).values()) <= 3

    before, after = steps["best-fit packing"]
    check_packing(after, [(r["doc_id"], r["text"]) for r in before], 4096)


def test_run_and_no_rows(spark, empty, tmp_path):
    assert rows(P.run(spark, "/root/testdata/sf0.001"))
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(P.run(spark, str(tmp_path))) == []
    assert re.fullmatch(r"[A-Za-z0-9 -]+", "".join(n for n, _ in P.STAGES))


def test_mixing_takes_no_document_without_words(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    blank = [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, "\n")]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in blank], kind)
    assert rows(P.source_mixing(spark, docs, "")) == []
    named = spark.createDataFrame([(4, "one two three", "en", "a", 13), (5, "four five", "en", None, 9)], kind)
    assert {r["doc_id"] for r in rows(P.source_mixing(spark, docs.union(named), ""))} == {4, 5}
