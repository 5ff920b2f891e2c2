import html
import random

import pytest
from pyspark.sql import functions as F

from matchlake.functions import labels, text
from matchlake.functions.entities import unescape_entities


def apply(spark, fn, values):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, c string").select("i", fn(F.col("c")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


@pytest.mark.parametrize("fn, given, wanted", [
    (text.tokens, ["Don't use a full-time C++ R2 x", None, ""], [["don", "use", "full-time", "r2"], [], []]),
    (lambda c: text.tokens(c, True), ["running station singing boxes"], [["runn", "sta", "sing", "box"]]),
    (text.stem, ["running", "station", "sing", "less", "boxes", "quickly"], ["runn", "sta", "sing", "les", "box", "quick"]),
    (text.strip_html, ["<p>A &lt;b&gt;x&lt;/b&gt; &amp; y</p>", None], ["A x & y", ""]),
    (text.strip_tags, [" <p>A &amp;  y</p>\n"], ["A &amp;  y"]),
    (text.clean_text, ["see https://x.y/z mail a@b.c now! (C++/C#)", "a  b www.q.r é_1"],
     ["see mail now (C++/C#)", "a b é_1"]),
    (text.clean_html, ["<p>A &lt;b&gt;x&lt;/b&gt; &amp;amp; y%% http://q a@b www</p>", None], ["A x &amp; y www", ""]),
    (text.clean_word_count, ["", "a", "a b c"], [0, 1, 3]),
    (text.word_count, ["  a  b ", "   ", None, "a\x1cb　c"], [2, 0, 0, 3]),
    (labels.title_category, ["Civil Engineer", "Luxury Sales", "Team Lead", "Help with IT", "Baker", None],
     ["Engineering", "Design", "Management", "Other", "Other", "Other"]),
    (labels.parse_grade, ["3", " 2 ok", "9", "-1", "", "n/a", None], [3, 2, 3, 0, 0, 0, 0]),
    (lambda c: labels.match_label(c.cast("double")), ["0.85", "1.0", "1.98085"],
     ["85.0% match", "100.0% match", "1.981 match"]),
    (labels.category_label, ["", None, "HR"], ["Unclassified", "Unclassified", "HR"]),
    (labels.file_label, ["Public Relations, Inc.", None], ["public-relations-inc", "unclassified"]),
    (lambda c: labels.search_link(c, F.lit("A&B")), ["C++ ~dev* é"],
     ["https://www.linkedin.com/jobs/search/?keywords=C%2B%2B+~dev%2A+%C3%A9+A%26B"]),
])
def test_values(spark, fn, given, wanted):
    assert apply(spark, fn, given) == wanted


def test_search_link_without_company(spark):
    assert apply(spark, lambda c: labels.search_link(F.lit("x y"), c), ["", None]) == [labels.fixed.SEARCH_LINK + "x+y"] * 2


def test_judge_prompt_fills_bounded_excerpts(spark):
    got = apply(spark, lambda c: labels.judge_prompt(F.repeat(c, 3000), c, F.repeat(c, 3000)), ["z"])[0]
    wanted = labels.fixed.JUDGE_PROMPT.format(resume_text="z" * 2000, job_title="z", job_description="z" * 1000)
    assert got == wanted


def test_embed_text(spark):
    assert apply(spark, lambda c: text.job_embed_text(F.lit("T"), F.repeat(c, 600)), ["d"]) == ["T. T. " + "d" * 500]
    assert apply(spark, lambda c: F.length(text.resume_embed_text(F.repeat(c, 2000))), ["d"]) == [1000]


def test_entities_equal_the_standard_library(spark):
    rng = random.Random(3)
    names = list(html.entities.html5)
    cases = ["&amp;lt;", "&notit;", "&#0;", "&#13;", "&#128;", "&#x80;", "&#xD800;", "&#1114112;", "&#x1F600;",
             "&#99999999999;", "&#11;", "&#xFFFE;", "&#65", "&#x41z", "&bogus;", "&", "& amp;", "&#;", "&#x;", "&AMP"]
    for _ in range(800):
        parts = ["&", "#", "x", "amp;", "lt", "12;", " ", rng.choice(names), "&" + rng.choice(names),
                 f"&#{rng.randint(0, 0x110010)};"]
        cases.append("".join(rng.choice(parts) for _ in range(rng.randint(1, 8))))
    assert apply(spark, unescape_entities, cases) == [html.unescape(c) for c in cases]


def test_character_classes_equal_python(spark):
    import re

    # Letters added to Unicode after the JVM's tables were made are left out.
    chars = [chr(c) for c in range(1, 0x2E80) if not 0xD800 <= c <= 0xDFFF]
    samples = ["".join(chars[i:i + 64]) for i in range(0, len(chars), 64)]
    keep = re.compile(r"[^\w\-/.,;:()&+#]")
    got = apply(spark, lambda c: F.regexp_replace(c, text.NOT_KEPT.removesuffix("++"), " "), samples)
    off = sum(a != b for g, s in zip(got, samples) for a, b in zip(g, keep.sub(" ", s)))
    assert off <= 60


def test_fixed_lists_are_pinned():
    """The SQL checks share these lists with the engine, so a changed word shows here only."""
    import hashlib

    from matchlake.functions import fixed

    digest = lambda x: hashlib.sha256(repr(x).encode()).hexdigest()[:16]
    got = {n: (len(v), digest(sorted(v) if isinstance(v, (set, frozenset)) else v)) for n, v in vars(fixed).items()
           if n.isupper() and isinstance(v, (str, tuple, list, set, frozenset, dict)) and len(v) > 20}
    assert got == PINNED


PINNED = {
    "STOPWORDS": (177, "5e80f99e21ad5429"),
    "TOKEN_PATTERN": (24, "f2f3fd0512c0d2ce"),
    "CATEGORY_MAP": (24, "889c6129ca70e053"),
    "SEARCH_LINK": (47, "5e932fce2cd13b10"),
    "JUDGE_PROMPT": (587, "cbc4d27e5f43f0ad"),
}
