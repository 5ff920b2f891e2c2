import sys

import pytest

SF = "/root/testdata/sf0.001"


def planted_rows():
    """(doc_id, text, lang, source): copies, near copies, shared passages, ties, nulls, empty and long texts."""
    base = " ".join(f"word{i} of the number {i * 7 % 50}" for i in range(60))
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("word7", "other"), "en", "b"), (4, None, "en", "b"),
            (5, "", "en", None), (6, " \n\t ", None, None), (7, "alpha " + passage + " omega", "en", "c"),
            (8, "x\n" + passage, "fr", "c"), (9, "ab " * 400, "de", "c"), (10, "Ünïcode ß 漢字 " * 40, "de", "c"),
            (11, "one two", "en", "d"), (12, "One TWO", "en", "d"), (13, passage[:49], "en", "d"), (14, passage[:50], "en", "d"),
            (15, "q" + passage[3:80] + "r", "en", "d"), (16, base[100:400] + base[100:400], "en", "e"),
            (17, "long text " + " ".join(str(i % 977) for i in range(30000)), "en", "e"), (None, base, "en", "e"),
            (18, "a" * 200, "en", "a"), (19, "b" + "a" * 120, "en", "a"), (20, "one two", "en", None), (20, "one two", "en", None)]
    return rows


CLASHING = ["size", "key", "fp", "row", "slice", "ids", "sizes", "data", "bucket", "blob", "n", "share", "piece", "start", "length",
            "order", "bin", "n_words", "words", "kept", "quality", "component_id", "fingerprint", "root", "target", "part", "before",
            "skey", "weight", "taken", "n_bytes", "n_removed", "step", "codes", "pair", "round", "v0"]


@pytest.fixture(scope="session")
def planted(spark):
    df = spark.createDataFrame(planted_rows(), "doc_id long, text string, lang string, source string")
    # Clashing and extra columns must not matter.
    return df.selectExpr("*", "1 as size", "'x' as key", "2 as fp", "length(text) as n_chars").repartition(3)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def pair(given, planted):
    """The given documents and the planted ones, with ids that do not meet, and columns named as the operators' own."""
    cols = ["doc_id", "text", "lang", "source"]
    both = given.selectExpr("doc_id + 1000 as doc_id", *cols[1:]).union(planted.select(*cols))
    return both.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(CLASHING)])


def rows(df):
    return [r.asDict() for r in df.collect()]
