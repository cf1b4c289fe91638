"""Raw pages -> article rows (SRC-10/11), link harvest (SRC-12), title regex.

Per-host extraction rules are data. For articles a page is read once, tag by tag, by the
standard library's HTML tokenizer inside ``mapInPandas``; the open elements are a flat stack, so
neither depth nor size of a page matters, and a page that cannot be read costs its own row only. Links
are found by built-in functions: one pattern cuts the page into tags, a fold keeps the open elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import collapse_ws, py_strip
from presslens.operators.projections import materialize

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES_P = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table",
            "header", "footer", "nav", "blockquote", "pre", "form", "aside", "figure"}


@dataclass(frozen=True)
class Value:
    """Where a text is found: in (or, with ``attr``, on) elements of a tag, with a class or an attribute's value."""

    tag: str = ""
    cls: str = ""
    prop: str = ""  # value of the attribute "property"
    attr: str = ""
    inside: str = ""  # class that an element around it has

    def on(self, tag: str, classes: set, attrs: dict) -> bool:
        return ((not self.tag or tag == self.tag) and (not self.cls or self.cls in classes)
                and (not self.prop or attrs.get("property") == self.prop))


@dataclass(frozen=True)
class ExtractRule:
    host: str  # substring of the page host; first matching rule wins
    body: tuple  # classes (or a tag in <>) of the elements around the body
    leaf: str = "p"  # the body's texts stand in these elements ("*": in any)
    deep: bool = False  # texts inside other elements of a leaf count too
    dates: tuple = ()  # tried in order, first non-empty


# FIXED VALUES: per-host extraction rules (the title is the first h1 text).
PT, MT = Value("meta", prop="article:published_time", attr="content"), Value("meta", prop="article:modified_time", attr="content")
TIME = Value("time", attr="datetime")
DEFAULT_RULES = [
    ExtractRule("protothema.gr", ("cnt",), "*", dates=(TIME,)),
    ExtractRule("iefimerida.gr", ("field--name-body", "article-main-body"), dates=((Value(cls="created"), TIME),)),
    ExtractRule("kathimerini.gr", ("entry-content",), dates=(Value("time", "entry-date", attr="datetime"), PT)),
    ExtractRule("tanea.gr", ("main-content",), dates=(PT, MT, TIME)),
    ExtractRule("tovima.gr", ("main-content",), dates=(TIME, PT)),
    ExtractRule("efsyn.gr", ("article__body", "field--name-body"), dates=(TIME, PT, Value(cls="field--name-created"))),
    ExtractRule("naftemporiki.gr", ("post-content",), dates=(TIME, PT, Value(cls="article-date"))),
    ExtractRule("ethnos.gr", ("article-content-container",), dates=(MT, PT, TIME)),
    ExtractRule("in.gr", ("main-content",), dates=(TIME, PT, Value("time", inside="article-date"))),
    ExtractRule("skai.gr", ("post-content",), dates=(TIME, PT)),
]
# Rule for other pages: all text of the paragraphs of the <article>, no date.
GENERIC_RULE = ExtractRule("", ("<article>",), deep=True)


class _Reader(HTMLParser):
    """Collects a rule's texts while the tags go by."""

    def __init__(self, rule: ExtractRule):
        super().__init__(convert_charrefs=True)
        self.rule, self.open = rule, []  # (tag, classes, body elements at or above, leaves at or above)
        self.title, self.body = None, []
        groups = [d if isinstance(d, tuple) else (d,) for d in rule.dates]
        self.dates = [(v, g) for g, vs in enumerate(groups) for v in vs]
        self.found = [None] * len(groups)

    def _is_body(self, tag: str, classes: set) -> bool:
        return any(b == f"<{tag}>" or b in classes for b in self.rule.body)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:  # a block element ends an open paragraph of the same block
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    del self.open[k:]
                if k >= len(self.open) or self.open[k][0] in CLOSES_P:
                    break
        attrs = {k: v or "" for k, v in attrs}
        classes = set(attrs.get("class", "").split())
        for v, g in self.dates:
            if v.attr and self.found[g] is None and v.on(tag, classes, attrs) and v.attr in attrs:
                self.found[g] = attrs[v.attr]
        if tag in VOID:
            return
        inside, leaves = (self.open[-1][2], self.open[-1][3]) if self.open else (0, 0)
        leaf = inside > 0 and self.rule.leaf in (tag, "*")
        self.open.append((tag, classes, inside + self._is_body(tag, classes), leaves + leaf))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if not self.open:
            return
        tag, classes, inside, leaves = self.open[-1]
        if tag == "h1" and self.title is None:
            self.title = data
        for v, g in self.dates:
            if not v.attr and self.found[g] is None and v.on(tag, classes, {}) and (
                    not v.inside or any(v.inside in c for _, c, _, _ in self.open[:-1])):
                self.found[g] = data
        own = self.rule.leaf in (tag, "*") and inside - self._is_body(tag, classes) > 0
        if own or (self.rule.deep and leaves and tag not in ("script", "style")):
            self.body.append(data)


def _clean(s: str | None) -> str | None:
    return " ".join(s.split()) if s else None


def page_host_of(url: str | None) -> str:
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "")
    return re.sub(r"^www\.", "", re.split(r"[/?#]", rest, maxsplit=1)[0])


def extract_page(url: str | None, html: str | None, rules) -> dict:
    """rule, title, date, text and error of one page (null rule: none fits its host)."""
    host = page_host_of(url)
    rule = next((r for r in rules if r.host in host), None)
    out = dict.fromkeys(("rule", "title", "date", "text", "error"))
    if rule is None:
        return out
    out["rule"] = rule.host
    reader = _Reader(rule)
    try:
        reader.feed(html or "")
        reader.close()
    except Exception as e:  # of this page alone
        return {**out, "error": f"{type(e).__name__}: {e}"}
    date = next((d.strip() for d in reader.found if d and d.strip()), "")
    return {**out, "title": _clean(reader.title), "date": date, "text": _clean(" ".join(reader.body))}


def extract_articles(pages: DataFrame, rules=None, url: str = "url", html: str = "html") -> DataFrame:
    """SRC-10/11 + JOIN-09: one output row per page with the matched rule,
    title, date text, body and error (rows with no rule keep nulls; FLT-17 drops them)."""
    rules = list(rules) if rules is not None else DEFAULT_RULES + [GENERIC_RULE]
    keep = [c for c in pages.columns if c != html]
    names = ("rule", "title", "date", "text", "error")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != html)
    schema += ", source string, " + ", ".join(f"{n} string" for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [extract_page(u, h, rules) for u, h in zip(pdf[url], pdf[html])]
            out = pdf[keep].copy()
            out["source"] = pdf[url].map(page_host_of)
            for k in names:
                out[k] = [r[k] for r in rows]
            yield out
    return pages.mapInPandas(run, schema)


# -- native (regex) pieces --------------------------------------------------
# FIXED VALUES: the XML entities unescaped by the regex title path.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def unescape_basic(c: Column) -> Column:
    for k, v in ENTITIES:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def h1_title(html: Column) -> Column:
    """Text of the first <h1> (tags dropped, basic entities decoded, whitespace
    collapsed) - the regex form of the title rule."""
    inner = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return collapse_ws(unescape_basic(F.regexp_replace(inner, r"<[^>]*>", "")))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved (RFC 3986, 5.2.4)."""
    parts = F.slice(F.split(path, "/", -1), 2, F.greatest(F.lit(1), F.size(F.split(path, "/", -1)) - 1))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x)))))
    open_end = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(open_end, F.lit("/")).otherwise(F.lit("")))


def resolve_url(base: Column, href: Column) -> Column:
    """urljoin for the reference forms: absolute, scheme-relative, root-relative,
    query/fragment-only and path-relative, dot segments resolved."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    base_nofrag = F.regexp_replace(base, "#.*$", "")
    base_noquery = F.regexp_replace(base_nofrag, r"\?.*$", "")
    base_path = F.substring(base_noquery, F.length(origin(base)) + 1, F.length(base_noquery))
    base_dir = F.when(base_path.startswith("/"), F.regexp_replace(base_path, "[^/]*$", "")).otherwise(F.lit("/"))
    path, rest = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_extract(href, "([?#].*)?$", 0)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(base_dir, path))
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("?"), F.concat(base_noquery, href))
            .when(href.startswith("#"), F.concat(base_nofrag, href))
            .when(href == "", base)
            .otherwise(F.concat(origin(base), without_dots(full), rest)))


# a start tag's rest: quotes count after a = only, and every repetition is possessive, so long tags cost no stack
_REST = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+|["'])*+>"""
# comments; raw text elements whole; declarations; tags
_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b{_REST}.*?(?:</\1\s*>|\z)|<[!?][^>]*+>?|</?[a-z]{_REST}"
_ATTRIBUTE = r"""(?s)[^\s"'<>/=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*+)(?:;|(?![=A-Za-z0-9]))"


def decode_references(c: Column) -> Column:
    """Character references of attribute values decoded: numbers, and the names of HTML 5 (without the ``;`` where
    HTML allows that and no letter, digit or = follows). Unknown ones stay as they are."""
    names = F.str_to_map(F.lit("\1".join(f"{name}\2{text}" for name, text in sorted(html5.items()))), F.lit("\1"), F.lit("\2"))

    def text(ref: Column) -> Column:
        body = F.regexp_replace(ref, "^&|;$", "")
        code = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10)).when(
            body.startswith("#"), F.substring(body, 2, 8)).cast("long")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(F.when(valid, char), F.try_element_at(names, F.substring(ref, 2, 40)), ref)

    parts = F.regexp_extract_all(c, F.lit(f"(?s){_REFERENCE}|[^&]+|&"), F.lit(0))
    decoded = F.array_join(F.transform(parts, lambda x: F.when(x.startswith("&") & (F.length(x) > 1), text(x)).otherwise(x)), "")
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def attribute(tag: Column, name: str) -> Column:
    """The value of a start tag's first attribute of that name, references decoded; null if it has none."""
    attributes = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+", ""), F.lit(_ATTRIBUTE), F.lit(0))
    own = F.get(F.filter(attributes, lambda a: a.rlike(rf"(?is)^{name}\s*=")), F.lit(0))
    value = F.regexp_replace(own, r"(?is)^[^=]*=\s*", "")
    quoted = value.startswith('"') | value.startswith("'")
    return decode_references(F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value))


def scoped_anchors(html: Column, scope_tag: str) -> Column:
    """The <a> tags inside any ``<scope_tag>``: nested ones count whole, one without an end tag up to the end
    of the element around it. One pass over the page's tags with the open elements as a path like ``/div/p/``."""
    scope = f"/{scope_tag.lower()}/"
    block = "|".join(sorted(CLOSES_P - {"p"}))
    names = F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda t: F.struct(
        t.alias("tag"), F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1)).alias("name")))
    tags = F.filter(names, lambda t: ~t["name"].isin("", "script", "style", *sorted(VOID)))

    def after(path: Column, t: Column) -> Column:
        step = F.concat(t["name"], F.lit("/"))
        mark = F.concat(F.lit("/"), step)
        beyond = F.length(F.call_function("substring_index", path, mark, F.lit(-1)))
        closed = F.when(F.contains(path, mark), F.substring(path, F.lit(1), F.length(path) - beyond - F.length(step))).otherwise(path)
        # a block element ends an open paragraph of the same block
        ends_p = t["name"].isin(*sorted(CLOSES_P)) & F.contains(path, F.lit("/p/"))
        outer = F.when(ends_p, F.regexp_replace(path, rf"/p/(?:(?!(?:{block}|p)/)[^/]++/)*+$", "/")).otherwise(path)
        opened = F.when(t["tag"].endswith("/>"), outer).otherwise(F.concat(outer, step))
        return F.when(t["tag"].startswith("</"), closed).otherwise(opened)

    def step(state: Column, t: Column) -> Column:
        def use(path: Column) -> Column:
            hit = (t["name"] == "a") & ~t["tag"].startswith("</") & F.contains(path, F.lit(scope))
            return F.struct(path.alias("path"), F.when(hit, F.concat(state["found"], F.array(t["tag"]))).otherwise(state["found"]).alias("found"))
        return F.transform(F.array(after(state["path"], t)), use)[0]

    start = F.struct(F.lit("/").alias("path"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(tags, start, step, lambda state: state["found"])


def harvest_links(pages: DataFrame, scope_tag: str = "article", url: str = "url", html: str = "html") -> DataFrame:
    """SRC-12: distinct hrefs of all anchors inside any ``<scope_tag>`` of each page,
    resolved against the page URL; one row per (page, link). Nested and unclosed elements are included; built-in
    functions only, per row: no shuffle, and no page can end the job."""
    rest = [c for c in pages.columns if c != html]
    found = pages.where(F.contains(F.lower(html), F.lit(f"<{scope_tag.lower()}")))
    found = materialize(found, html, scoped_anchors(F.col(html), scope_tag))
    hrefs = F.transform(html, lambda tag: py_strip(attribute(tag, "href")))
    found = found.select(*rest, F.explode(F.array_distinct(F.filter(hrefs, lambda h: h.isNotNull()))).alias("href"))
    return found.withColumn("link", resolve_url(F.col(url), F.col("href")))
