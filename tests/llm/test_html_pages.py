"""Hand-written pages of unlike templates, and the blocks against an independent parser."""

import tracemalloc
from html.parser import HTMLParser

import pytest

from matchlake.llm import html
from tests.llm.conftest import rows

SF = "/root/testdata/sf0.01"
LONG = ("The river rose by nearly two metres during the night, and the lower meadows were under water before dawn. "
        "Volunteers carried sandbags to the mill, where the old wall had given way in three places.")
MORE = ("By noon the level had begun to fall, slowly at first, then faster as the wind turned. The council said that the "
        "bridge would stay closed until engineers had looked at its piers.")

# page, main blocks
PAGES = [
    (f"<html><body class='single has-sidebar header-fixed'><article><h1>Flood</h1><p>{LONG}</p><p>{MORE}</p></article></body></html>",
     [LONG, MORE]),
    (f"<body id=nav-open><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><main><p>{LONG}<p>{MORE}</main><footer>Imprint</footer>",
     [LONG, MORE]),
    (f"<body><header><h2>Daily</h2></header><article><p>{LONG}</p><form><label>Mail</label><button>Join</button></form><p>{MORE}</p></article>",
     [LONG, MORE]),
    (f"<body><div class=cookie-notice>We use cookies. <a href=#>Accept</a></div><article><p>{LONG}</p></article>"
     f"<section class=comments><p>Great piece!</p><p>First.</p></section>", [LONG]),
    (f"<body><main><article><p>{LONG}</p><aside>Read also: <a href=/x>older floods</a></aside><p>{MORE}</p></article></main>"
     "<div class=sidebar><ul><li>Most read</li><li>Weather</li></ul></div>", [LONG, MORE]),
    (f"<article><p>{LONG}</p><script>var p = '<p>no</p>';</script><style>p {{ color: red }}</style><p>{MORE}</p></article>", [LONG, MORE]),
]


class Leaves(HTMLParser):
    """Texts between block tags, without what is not shown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.parts, self.skipped = [], [], 0

    def cut(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in html.RAW:
            self.skipped += 1
        elif tag == "br":
            self.parts.append(" ")
        elif tag not in html.INLINE:
            self.cut()

    def handle_endtag(self, tag):
        if tag in html.RAW:
            self.skipped -= 1
        elif tag not in html.INLINE:
            self.cut()

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)


@pytest.fixture(scope="module")
def labeller(spark):
    return html.fit(html.training_pages(spark.read.parquet(f"{SF}/pages.parquet"), "page_id", "html"))


def test_blocks_are_those_of_another_parser(spark):
    given = [r["html"] for r in rows(spark.read.parquet(f"{SF}/pages.parquet")) if r["html"]]
    for source in given + [p for p, _ in PAGES]:
        other = Leaves()
        other.feed(source)
        other.close()
        other.cut()
        assert [b[1] for b in html.blocks(source)] == other.out


def test_hand_written_pages(spark, labeller):
    """A block is wrong if it is missing or too many. One of these is, a reader's comment of two words; README says so."""
    pages = spark.createDataFrame([(i, "u", p) for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r["page_id"]: set(r["text"].split("\n")) - {"Flood"} for r in rows(html.extract(pages, model=labeller))}
    wrong = [t for i, (_, wanted) in enumerate(PAGES) for t in got[i] ^ set(wanted)]
    assert not {LONG, MORE} & set(wrong)
    assert len(wrong) <= 0.1 * sum(len(html.blocks(p)) for p, _ in PAGES)


def test_labels_look_below_body():
    page = "<html class=nav><body class='has-sidebar menu'><article><p>text</p><div class=menu>no</div></article><p>out</p>"
    assert [(b[1], html.is_main(b[0])) for b in html.blocks(page)] == [("text", True), ("no", False), ("out", False)]


def test_end_tags_that_are_left_out():
    page = ("<table><thead><tr><th>a<th>b<tbody><tr><td>c<td><table><tr><td>in</table>d<tr><td>e</table><ul><li>f<ul><li>g<li>h</ul>"
            "<li>i</ul><dl><dt>j<dd>k<dt>l</dl><select><optgroup><option>m<option>n<optgroup><option>o</select>")
    depth = {b[1]: sum(abs(b[0].sums)) for b in html.blocks(page)}
    said = [b[1] for b in html.blocks(page)]
    assert said == ["a", "b", "c", "in", "d", "e", "f", "g", "h", "i", "j", "k", "l", "m", "n", "o"]
    assert depth["c"] == depth["e"] and depth["a"] == depth["b"] and depth["g"] == depth["h"]
    assert depth["f"] == depth["i"] and depth["j"] == depth["l"] and depth["m"] == depth["o"]


def test_open_rows_take_linear_memory(spark, labeller):
    page = "<table>" + "<tr><td>cell" * 50_000
    tracemalloc.start()
    assert len(html.blocks(page)) == 50_000
    nested = html.blocks("<div>x" * 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(nested) == 50_000 and peak < 200 << 20
    pages = spark.createDataFrame([(i, "u", page) for i in range(3)], "page_id long, url string, html string")
    assert len(rows(html.extract(pages, model=labeller))) == 3


def test_batches_change_nothing(spark, labeller, monkeypatch):
    read = [html.vectors(html.blocks(r["html"])) for r in rows(spark.read.parquet(f"{SF}/pages.parquet").limit(60))]
    whole = html.label(labeller, read)
    monkeypatch.setattr(html, "BATCH_BLOCKS", 40)
    assert all((a == b).all() for a, b in zip(whole, html.label(labeller, read)))
