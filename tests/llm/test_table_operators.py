"""Quality rules, URL filter, mixing, WARC, HTML extraction and exact search: brute force, round trips, accuracy."""

import base64
import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from checks.compare import connect, difference
from matchlake.llm import html, mixing, quality, search, urls, warc
from matchlake.llm import queries as Q
from tests.llm.conftest import SF, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("name", list(Q.ORACLE))
def test_query_equals_sql(spark, name):
    got = Q.QUERIES[name](spark, SF).toArrow()
    assert difference(got, connect(SF).execute(Q.ORACLE[name]).to_arrow_table()) is None


# Quality ----------------------------------------------------------------------------------------

def test_quality_counts(pair):
    got = defaultdict(list)
    for r in rows(quality.judge(pair)):
        got[r["doc_id"]].append(r)
    for d in rows(pair.select("doc_id", "text")):
        t = d["text"] or ""
        w = WORD.findall(t)
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        repeated = len({i + j for v in at.values() if len(v) > 1 for i in v for j in range(3)})
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", t)),
                "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated,
                "base_failed": len(w) < 50 or 100 * repeated > 50 * len(w)}
        for r in got[d["doc_id"]]:
            assert {k: r[k] for k in want} == want
            assert not (r["base_failed"] and r["kept"])


def test_quality_agrees_with_labels(spark):
    judged = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("not base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").withColumnRenamed("quality", "label")
    both = rows(judged.join(labels, "doc_id"))
    assert sum((r["label"] == 1) == r["kept"] for r in both) >= 0.98 * len(both) > 100


def test_quality_of_no_rows(empty):
    assert rows(quality.judge(empty)) == []


# URLs -------------------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def brute_rule(host, path):
    best = (None, None)
    for said, text in urls.RULES:
        on, _, under = text.partition("/")
        if (host == on or host.endswith("." + on)) and path.startswith("/" + under) and len(text) > len(best[0] or ""):
            best = (text, said)
    return best


def test_urls_by_rule(spark):
    odd = [None, "", "no scheme/x", "http://", "https://ORG/", "http://a.b.org", "http://x.org/a?b#c", "http://notorg/", "ftp://Example.org/es/1",
           "http://example.org/en/12", "http://sub.example.org/en/1?x=1", "http://com/fr/", "http://a.com/de/x#y", "http://a.com?q=/fr/", "http://İ.ORG/é",
           "http://a://b.org/", "x://" + "long/" * 3000]
    given = [r["url"] for r in rows(spark.read.parquet(f"{SF}/pages.parquet"))]
    pages = spark.createDataFrame(list(enumerate(odd + given + given[:5])), "page_id long, url string").selectExpr("*", "1 as host", "2 as rule", "'z' as y")
    got = {r["page_id"]: r for r in rows(urls.judge(pages))}
    for i, u in enumerate(odd + given + given[:5]):
        host, path = brute_url(u)
        rule, said = brute_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == said if said else got[i]["verdict"] in ("allow", "block")


def test_url_trees_on_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    part = urls.parsed(pages, "page_id", "url").filter("said is not null").withColumn("y", urls.F.expr("double(said = 'block')"))
    train, test = part.filter("page_id % 2 = 0"), part.filter("page_id % 2 = 1")
    trees, bias = urls.fit(urls.with_rates(train, train))
    assert len(trees) == urls.ROUNDS
    got = rows(urls.with_rates(test, train).select("y", urls.score(trees, bias).alias("s")))
    right, most = sum((r["s"] > 0) == (r["y"] == 1) for r in got), sum(r["y"] == 0 for r in got)
    assert right > most and right >= 0.85 * len(got)


def test_url_trees_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert {r["verdict"] for r in rows(urls.judge(pages))} <= {"allow", "block"}
    assert rows(urls.judge(pages.limit(0))) == []


def test_url_features_cover_the_whole_url(spark):
    urls_ = ["http://a.org/x?a&b&c#k=1&l", "http://h.com/" + "".join(chr(0x4E00 + i) for i in range(80)), "http://h.com/p#q=1&r=2",
             "http://h.com/?&&a=1&", "http://h.com/😀😀~+~!", "http://AA.com/aa", "x", None]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    for r in rows(urls.parsed(pages, "page_id", "url")):
        u = urls_[r["page_id"]] or ""
        host, path = brute_url(u)
        tail = u.split("://", 1)[1][len(host) + len(path):] if "://" in u else ""
        whole = "".join(c.lower() if "A" <= c <= "Z" else c for c in host + path + tail)
        n = [whole.count(c) / len(whole) for c in set(whole)]
        assert r["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in n), abs=2e-6)
        query = tail.split("#")[0].removeprefix("?") if tail.startswith("?") else ""
        assert r["n_params"] == sum(1 for x in query.split("&") if x)


def test_every_folder_has_a_statistic_and_trees_agree_with_brute_force(spark):
    pages = spark.range(4000).selectExpr("id as page_id", "concat(if(id % 2 = 0, 'http://a.org/', 'http://b.example.org/es/'), "
                                         "'f', id div 2, '/x', id, if(id % 3 = 0, '?q=1', '')) as url")
    part = urls.settle(urls.parsed(pages, "page_id", "url").withColumn("y", urls.F.expr("double(said = 'block')")), "part")
    seen = rows(urls.with_rates(part, part))
    share = sum(r["y"] for r in seen) / len(seen)
    for c in urls.STATISTICS:
        sums = defaultdict(lambda: [0.0, 0])
        for r in seen:
            sums[r[c]][0] += r["y"]
            sums[r[c]][1] += 1
        assert c != "folder" or len(sums) > 1500
        for r in seen:
            y, n = sums[r[c]]
            assert r[f"{c}_rate"] == pytest.approx((y + urls.SMOOTH * share) / (n + urls.SMOOTH) if r[c] else share)
    trees, bias = urls.fit(urls.with_rates(part, part), rounds=3)

    def walked(node, r):
        while isinstance(node, tuple):
            node = node[2] if r[node[0]] <= node[1] else node[3]
        return node

    for r in rows(urls.with_rates(part, part).withColumn("s", urls.score(trees, bias)))[::50]:
        assert r["s"] == pytest.approx(bias + urls.RATE * sum(walked(t, r) for t in trees))


# Mixing -----------------------------------------------------------------------------------------

def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, held, total = {}, set(), sum(sizes.values())
    while True:
        left, w = total - sum(3 * sizes[s] for s in held), sum(weight[s] for s in order if s not in held)
        target = {s: 3 * sizes[s] if s in held else left * weight[s] / w for s in order}
        over = {s for s in order if s not in held and target[s] > 3 * sizes[s]}
        if not over:
            return target
        held |= over


def test_mixing_equals_brute_force(pair):
    got = rows(mixing.mix(pair))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows(pair.select("source", "text")):
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want = brute_targets(sizes)
    by_source = defaultdict(list)
    for d, g in ((d, g) for d in rows(pair.select("doc_id", "text", "source")) for g in got if g["doc_id"] == d["doc_id"]):
        by_source[d["source"]].append(g)
        assert g["size"] == len(WORD.findall(d["text"] or "")) and g["source_size"] == sizes[d["source"]]
        assert math.isclose(g["target"], want[d["source"]], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= g["taken"] <= 3 * g["size"]
    for r in got:
        taken[round(r["target"], 3), r["source_size"]] += r["taken"]
    assert all(abs(v - k[0]) <= 1 for k, v in taken.items())
    assert sorted(map(repr, rows(mixing.mix(pair.repartition(7))))) == sorted(map(repr, got))


def test_mixing_of_no_rows_and_no_words(empty, spark):
    assert rows(mixing.mix(empty)) == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert all(r["taken"] == 0 and r["target"] == 0 for r in rows(mixing.mix(blank)))


# WARC -------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    given = [(r["page_id"], r["url"], r["html"]) for r in rows(spark.read.parquet(f"{SF}/pages.parquet"))]
    big = 2 ** 60 + 1
    odd = [(1000, "http://a/\r\nX: y", None), (1001, None, ""), (1002, "u", "same"), (1003, "v", "same"), (1004, "w", "same"), (None, "n", "same"),
           (big, "long", "é\r\n\r\n" * 50000), (1005, "x", "same "), (1006, "t", "twice"), (1006, "t", "twice")]
    pages = spark.createDataFrame(given + odd, "page_id long, url string, html string").selectExpr("*", "1 as offset", "'q' as digest").repartition(4)
    index = warc.write(pages, str(tmp_path / "w"))
    got = rows(warc.read(index))
    stored = {}
    for i, _, h in given + odd:
        if i is not None:
            stored[h or ""] = max(i, stored.get(h or "", -1))
    want = []
    for i, u, h in given + odd:
        raw = (h or "").encode()
        refers = None if i is None or stored[h or ""] == i else stored[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if refers else "response", refers,
                     None if refers else h or ""))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"]) for r in got), key=key) == sorted(want, key=key)
    some = rows(warc.read(index.filter("page_id % 7 = 3"), gap=10))
    assert {r["page_id"] for r in some} == {w[0] for w in want if w[0] is not None and w[0] % 7 == 3}
    plain = rows(warc.read(warc.write(pages, str(tmp_path / "p"), least=10 ** 9)))
    assert all(r["record_type"] == "response" and r["refers_to"] is None for r in plain)
    assert rows(warc.read(warc.write(pages.limit(0), str(tmp_path / "e")))) == []


def test_coalesced_ranges():
    assert warc.coalesced([0, 10, 500, 520], [10, 5, 20, 5], 100, 1000) == [(0, 15, [0, 1]), (500, 525, [2, 3])]
    assert warc.coalesced([0, 10], [10, 10], 100, 15) == [(0, 10, [0]), (10, 20, [1])]


# HTML -------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def labeller(spark):
    return html.fit(html.training_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), "page_id", "html"))


def test_html_on_held_out_pages(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id >= 1000")
    got = {r["page_id"]: r for r in rows(html.extract(pages, model=labeller))}
    wrong = 0
    for r in rows(pages):
        want = "\n".join(b[1] for b in html.blocks(r["html"]) if html.is_main(b[0]))
        wrong += got[r["page_id"]]["text"] != want
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    assert wrong <= 0.01 * len(got)


def test_html_on_other_templates(spark, labeller):
    r, bad, total = random.Random(99), 0, 0
    for p in rows(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id between 2000 and 2200")):
        page, labels = html.disguised(html.blocks(p["html"]), r)
        hits = html.label(labeller, [html.vectors(page)])[0]
        bad, total = bad + sum(bool(a) != b for a, b in zip(hits, labels)), total + len(labels)
    assert bad <= 0.01 * total


def test_html_blocks():
    page = ("<!DOCTYPE html><title>T &amp; x</title><script>var a='<p>no</p>'</script><!-- c <p>no</p> --><body><p>one<br>two\n three<p>four <b>bo"
            "ld</b><a href='>'>li&eacute;</a></article><div CLASS=\"x y\">5 &lt; 6<unclosed")
    assert [(b[1], b[0][-1][0]) for b in html.blocks(page)] == [("T & x", "title"), ("one two three", "p"), ("four boldlié", "p"), ("5 < 6<unclosed", "div")]
    assert html.blocks(None) == [] and html.blocks("") == [] and html.blocks("<<<>>>")[0][1]


def test_html_odd_pages(spark, labeller):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "v", "<p>" * 3000 + "deep"), (2, "v", "plain " * 20000)], "page_id long, url string, html string")
    assert len(rows(html.extract(pages, model=labeller))) == 4
    assert rows(html.extract(pages.limit(0))) == []
    assert [r["text"] for r in rows(html.extract(pages.filter("page_id = 1")))] == [""]


# Search -----------------------------------------------------------------------------------------

def brute_search(vectors, queries, k):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = lambda v: [math.floor(256 * float(x)) for x in v]
    docs = [(i, ints(v)) for i, v in vectors if i is not None and ok(v)]
    for q, v in queries:
        if q is not None and ok(v):
            w = ints(v)
            s = sorted((-sum(a * b for a, b in zip(w, d)), i) for i, d in docs if i != q)[:k]
            yield from [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 7)])
def test_search_equals_brute_force(spark, blocks):
    r = np.random.default_rng(2)
    vectors = [(i, [float(np.float32(x)) for x in r.integers(-3, 3, 8) / 4]) for i in range(120)]
    vectors += [(120, None), (121, [1.0, None]), (122, [float("nan")] * 8), (123, [float("inf")] * 8), (124, []), (125, [1.0, -2.0]), (126, [0.0] * 8),
                (None, [1.0] * 8), (60, vectors[60][1]), (128, [1e6] * 8), (150, [0.001] * 12)]
    df = spark.createDataFrame(vectors, "id long, v array<double>").selectExpr("*", "1 as row", "2 as rank")
    got = [(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in rows(search.search(df, df.filter("id % 10 = 0 and id <> 60"), 5, query_block=blocks[0], doc_block=blocks[1]))]
    want = list(brute_search(vectors, [x for x in vectors if x[0] is not None and x[0] % 10 == 0 and x[0] != 60], 5))
    assert sorted(got) == sorted(want)


def test_search_of_no_rows(spark):
    none = spark.createDataFrame([], "id long, v array<float>")
    assert rows(search.search(none, none)) == []
    one = spark.createDataFrame([(0, [1.0])], "id long, v array<float>")
    assert rows(search.search(one, one)) == []


def test_search_broadcasts_no_side(spark):
    """Blocks of both sides look small to Spark, whose estimate does not know how often they are copied."""
    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, r.integers(-3, 3, 4).astype(float).tolist()) for i in range(300)], "id long, v array<double>")
    found = search.search(df, df.filter("id % 3 = 0"), 5, query_block=20, doc_block=30)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan and "Cartesian" not in plan
    assert found.count() == 500
