"""File sources and page extraction."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.sources.files import guarded, read_json_auto, read_jsonl_tolerant, read_lookup, read_split_json
from presslens.sources.pages import (DEFAULT_RULES, GENERIC_RULE, extract_articles, extract_page, harvest_links,
                                     resolve_url)

SCH = T.StructType([T.StructField("url", T.StringType()), T.StructField("bias", T.DoubleType())])


def test_tolerant_jsonl(spark, scratch):
    p = os.path.join(scratch, "a.jsonl")
    with open(p, "w") as f:
        f.write('{"url": "a", "bias": 0.1}\n\n{broken\n{"url": "b", "bias": "x"}\n')
    rows = sorted(map(tuple, read_jsonl_tolerant(spark, p, SCH).collect()), key=str)
    assert rows == [("a", 0.1), ("b", None)]


def test_json_auto_detect(spark, scratch):
    arr, lines = os.path.join(scratch, "arr.json"), os.path.join(scratch, "lines.jsonl")
    with open(arr, "w") as f:
        json.dump([{"url": "a", "bias": 0.5}, {"url": "b", "bias": 0.6}], f, indent=2)
    with open(lines, "w") as f:
        f.write('{"url": "c", "bias": 0.7}\n')
    assert read_json_auto(spark, arr, SCH).count() == 2
    assert [r.url for r in read_json_auto(spark, lines, SCH).collect()] == ["c"]


def test_split_json_and_guard(spark, scratch):
    p = os.path.join(scratch, "split.json")
    with open(p, "w") as f:
        json.dump({"columns": ["source", "url"], "data": [["s1", "u1"], ["s2", "u2"]]}, f)
    assert sorted(map(tuple, read_split_json(spark, p, ["source", "url"]).collect())) == [("s1", "u1"), ("s2", "u2")]
    assert guarded(spark, os.path.join(scratch, "missing.jsonl"), SCH, read_jsonl_tolerant).count() == 0


def test_lookup_file(spark, scratch):
    p = os.path.join(scratch, "lk.json")
    with open(p, "w") as f:
        json.dump({"top_sites": [{"rank": 1, "website": "a.gr"}, {"rank": 2, "website": "b.gr"}]}, f)
    rows = read_lookup(spark, p, "top_sites", "rank bigint, website string").collect()
    assert [(r["rank"], r.website) for r in rows] == [(1, "a.gr"), (2, "b.gr")]


HTML = ('<html><head><meta property="article:published_time" content="2026-04-30T07:54:20Z"></head><body>'
        '<nav><a href="/politics">P</a><a href="https://x.gr/a">X</a><a href="rel">R</a></nav>'
        '<h1>  Big &amp; news </h1><div class="main-content"><p>First <b>bold</b> tail<p>Second</div>'
        '<time datetime="2026-04-30T10:00:00+03:00"></time></body></html>')


def test_extract_rules():
    d = extract_page("https://www.tanea.gr/2026/04/30/x", HTML, DEFAULT_RULES)
    assert d == {"rule": "tanea.gr", "title": "Big & news", "date": "2026-04-30T07:54:20Z",
                 "text": "First tail Second", "error": None}  # texts of the paragraphs themselves
    d2 = extract_page("https://www.tovima.gr/x", HTML, DEFAULT_RULES)
    assert d2["date"] == "2026-04-30T10:00:00+03:00"
    assert extract_page("https://unknown.org/x", HTML, DEFAULT_RULES)["rule"] is None


def test_extract_other_layouts():
    page = "<article><h1>T</h1><p>One <b>bold <i>it</i></b> end<p>two<br>x</p>no<script>s</script></article><p>out</p>"
    assert extract_page("http://a.b/", page, [GENERIC_RULE])["text"] == "One bold it end two x"
    cnt = '<div class="x cnt">own<p>a <b>b</b></p><div>c</div></div><div>d</div>'
    assert extract_page("http://protothema.gr", cnt, DEFAULT_RULES)["text"] == "a b c"  # below the element, not its own text
    date = '<span class="created"> 30 April </span><time datetime="t"></time>'
    assert extract_page("http://iefimerida.gr", date, DEFAULT_RULES)["date"] == "30 April"
    inside = '<div class="article-date"><time> 1 May </time></div>'
    assert extract_page("http://in.gr", inside, DEFAULT_RULES)["date"] == "1 May"
    empty = {"rule": "", "title": None, "date": "", "text": None, "error": None}
    assert extract_page(None, None, [GENERIC_RULE]) == extract_page("x", "", [GENERIC_RULE]) == empty


def test_deep_pages_and_bad_rows(spark):
    deep = "<article>" + "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000 + "</article>"
    df = spark.createDataFrame([(1, "http://a.b/", deep), (2, "http://a.b/", "<article><p>ok"), (3, None, None),
                                (4, "http://a.b/", "<![bad["), (5, "http://a.b/", "<p " * 2000)], "page_id int, url string, html string")
    got = {r.page_id: r.text for r in extract_articles(df).collect()}
    assert got[1] == "deep" and got[2] == "ok" and len(got) == 5


def test_links_of_all_blocks_and_quotes(spark):
    page = ("<nav><a href='/no'></a></nav><article><a class=x href=\"/a\">A</a><a href='b?x=1&amp;y'>B</a><a href=c>C</a>"
            "<a name=n>N</a><a href=\"/a\">again</a></article><article><A HREF=\"../d\">D</A></article>")
    df = spark.createDataFrame([(1, "http://h.com/p/q/r", page)], "page_id int, url string, html string")
    got = sorted(r.link for r in harvest_links(df).collect())
    assert got == ["http://h.com/a", "http://h.com/p/d", "http://h.com/p/q/b?x=1&y", "http://h.com/p/q/c"]


@pytest.mark.parametrize("page, links", [
    ("<article><a href=1>x</a><article><a href=2>x</a></article><a href=3>x</a></article><a href=no>x</a>", "123"),
    ("<article><article><article><a href=1></a></article></article><a href=2></a></article><a href=no></a>", "12"),
    ("<a href=no>x</a><article class=c><a href=1>x</a><p><a href=2>x</a>", "12"),  # no end tag
    ("<div><article><a href=1>x</a></div><a href=no>x</a>", "1"),  # ends with the element around it
    ("</article><a href=no>x</a><article><a href=1>x</a><!-- </article> --><a href=2>x</a></article>", "12"),
    ("<article><![bad[ x]><a href=1>x</a></article><article-card><a href=no>x</a></article-card>", "1"),
    (None, ""), ("<article>" * 3000 + "<a href=1>x</a>", "1")])
def test_links_of_nested_and_unclosed_blocks(spark, page, links):
    df = spark.createDataFrame([(1, "http://h.com/", page)], "page_id int, url string, html string")
    assert [r.link for r in harvest_links(df).collect()] == [f"http://h.com/{k}" for k in links]


@pytest.mark.parametrize("tag, href", [
    ('<a title="see href=x" href="y">', "y"), ("<a href='a&amp;b'>", "a&b"), ('<a href="/caf&eacute;?a=1&#38;b=2&#x1F600;">', "/café?a=1&b=2😀"),
    ('<A\n HREF = "u v" >', "u v"), ("<a href=u/v/>", "u/v/"), ('<a href="?x=1&copy=2&lt;&nope;&copy">', "?x=1&copy=2<&nope;©"),
    ('<a data-href="no" xhref=no>', None), ('<a href="first" href="second">', "first"), ("<a href>", None), ('<a href="">', ""),
    ('<a title="a > b" href="c>d">', "c>d"), ("<a title=it's href=e>", "e"), ('<a href="&#0;&#xD800;&#1114112;">', "&#0;&#xD800;&#1114112;"),
    ('<a title="' + "x" * 30000 + '" href="far">', "far")])
def test_href_of_a_tag(spark, tag, href):
    page = f"<article>{tag}</a></article>"
    got = harvest_links(spark.createDataFrame([(1, "http://h.com/", page)], "page_id int, url string, html string")).collect()
    assert [r.href for r in got] == ([] if href is None else [href])


def test_no_page_ends_the_job(spark):
    pages = ["<article><a href=1>", '<article><a title="open href=2>x</a>', "<article>" + "<p class='" * 4000, "<article><!-- <a href=no>",
             "<article><script>'<a href=no>'</script><style><a href=no></style><a href=3>", "<article><p><div></p><a href=4>", "<a <article href=no>"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").withColumn("url", F.lit("http://h.com/"))
    got = {r.page_id: r.href for r in harvest_links(df).collect()}
    assert got[0] == "1" and got[4] == "3" and got[5] == "4" and not {3, 6} & set(got)


def test_links_resolved(spark):
    from urllib.parse import urljoin
    hrefs = ["//cdn.com/z", "?q=2", "#top", "", "c/d", "/root", "mailto:a@b", "../d", "./e", "../../../x", "a/../b/./c", "..", ".",
             "/a/./b/../c", "c/..", "d?e=../f", "g#../h", "https://o.org/a/../b"]
    for base in ("http://h.com/a/b.html?x=1#y", "https://h.com/a/b/c/", "http://h.com", "http://h.com/z?p=/q/r"):
        df = spark.createDataFrame([(i, h) for i, h in enumerate(hrefs)], "i int, href string").orderBy("i")
        got = [r[0] for r in df.select(resolve_url(F.lit(base), F.col("href"))).collect()]
        assert got == [urljoin(base, h) for h in hrefs], base
