"""String functions (Column -> Column), all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens import specs

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(_c(c), F.lit(specs.WS_CHARS))


def collapse_ws(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space, strip; empty -> null (STR-01)."""
    return F.nullif(py_strip(F.regexp_replace(_c(c), f"{specs.WS}+", " ")), F.lit(""))


def word_count(c: ColumnOrName) -> Column:
    """``len(s.split())`` for any string: count of non-whitespace runs."""
    s = py_strip(c)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, f"{specs.WS}+")))


def keep_before(c: ColumnOrName, marker: str) -> Column:
    """Text before the first occurrence of ``marker`` (whole text when absent)."""
    return F.substring_index(_c(c), marker, 1)


def _literal(s: str) -> str:
    """Java regex matching ``s`` literally."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def keep_after_last(c: ColumnOrName, marker: str) -> Column:
    """Python ``text.split(marker)[-1]``: the part after the last of the
    non-overlapping, left-to-right occurrences (whole text when absent)."""
    return F.element_at(F.split(_c(c), _literal(marker), -1), -1)


def apply_marker_rules(text: ColumnOrName, source: ColumnOrName,
                       rules=specs.MARKER_RULES) -> Column:
    """Source-specific cleaning (STR-02/03, JOIN-08 dispatch) then strip.

    Rules are (source, mode, marker) rows applied in order; a row whose source
    has no rule keeps its text. Empty/null text becomes null, as the cleaners
    return None for falsy input.
    """
    t, src = _c(text), _c(source)
    by_source: dict[str, list[tuple[str, str]]] = {}
    for s, mode, marker in rules:
        by_source.setdefault(s, []).append((mode, marker))
    out = None
    for s, steps in by_source.items():
        cleaned = t
        for mode, marker in steps:
            cleaned = keep_before(cleaned, marker) if mode == "before" else keep_after_last(cleaned, marker)
        cleaned = py_strip(cleaned)
        out = F.when(src == s, cleaned) if out is None else out.when(src == s, cleaned)
    cleaned_all = t if out is None else out.otherwise(t)
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("string")).otherwise(cleaned_all)


def general_clean(c: ColumnOrName, marker: str = specs.GENERAL_MARKER,
                  drop_sentence: str = specs.VIDEO_SENTENCE) -> Column:
    """STR-04: cut at the news-today marker, delete the video sentence, strip."""
    t = _c(c)
    cleaned = py_strip(F.replace(keep_before(t, marker), F.lit(drop_sentence), F.lit("")))
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("string")).otherwise(cleaned)


def purify_markdown(c: ColumnOrName, stop_phrases=specs.STOP_PHRASES,
                    min_words: int = specs.MIN_WORDS_PER_LINE) -> Column:
    """STR-05: markdown page text -> article paragraphs.

    Cut before the first '# ', drop images, unwrap links, drop URLs; drop the
    first line holding a stop phrase (case-insensitive) and everything after
    it; keep the remaining lines with at least ``min_words`` words, stripped,
    joined by a blank line. Whole-text regexes only (no per-line lambdas), so
    each step is one native pass; ``(?d)`` makes '\\n' the only line break,
    as in ``str.split('\\n')``.
    """
    t = F.coalesce(_c(c), F.lit(""))
    pos = F.instr(t, "# ")
    t = F.when(pos > 0, t.substr(pos, F.length(t))).otherwise(t)
    t = F.regexp_replace(t, f"(?d){specs.MD_IMAGE}", "")
    t = F.regexp_replace(t, f"(?d){specs.MD_LINK}", "$1")
    t = F.regexp_replace(t, specs.MD_URL, "")
    phrases = "|".join(_literal(p) for p in stop_phrases)
    t = F.regexp_replace(t, f"(?s)(?:^|\n)[^\n]*(?iu:{phrases}).*\\z", "")
    h, n = f"[{specs.WS_CLASS_NO_NL}]", specs.NON_WS
    k = max(min_words - 1, 0)
    # a bounded look-ahead checks the word count; the captured span runs from
    # the first to the last non-blank character (no unbounded group
    # repetition, which the JVM's regex engine would recurse on)
    line = f"(?md)^{h}*+(?={n}++(?:{h}++{n}++){{{k}}})({n}[^\\n]*{n}|{n}){h}*$"
    return F.array_join(F.regexp_extract_all(t, F.lit(line), 1), "\n\n")


def truncate(c: ColumnOrName, n: int) -> Column:
    """STR-06: first ``n`` characters."""
    return F.substring(_c(c), 1, n)


def url_host(c: ColumnOrName) -> Column:
    """STR-08: URL host with the 'www.' removed (netloc)."""
    return F.replace(F.regexp_extract(_c(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1),
                     F.lit("www."), F.lit(""))


def url_year(c: ColumnOrName) -> Column:
    """STR-09: first '/YYYY/' in a URL as int, else null."""
    return F.nullif(F.regexp_extract(_c(c), r"/([0-9]{4})/", 1), F.lit("")).try_cast("int")


def text_year(c: ColumnOrName) -> Column:
    """STR-09: first standalone 20YY in a date string, else null."""
    return F.nullif(F.regexp_extract(_c(c), r"\b(20[0-9]{2})\b", 1), F.lit("")).try_cast("int")


def doc_key(c: ColumnOrName) -> Column:
    """STR-10: md5 of the url ('' when null)."""
    return F.md5(F.coalesce(_c(c), F.lit("")))


def char_count(c: ColumnOrName) -> Column:
    """STR-11: characters (code points); null stays null."""
    return F.length(_c(c))


def first_nonempty(*cols: ColumnOrName) -> Column:
    """STR-15: first non-empty of several strings, else ''."""
    return F.coalesce(*[F.nullif(_c(x), F.lit("")) for x in cols], F.lit(""))


def normalise_entities(c: ColumnOrName) -> Column:
    """STR-13: lower + strip each entity, as a set (distinct)."""
    return F.array_distinct(F.transform(F.coalesce(_c(c), F.array().cast("array<string>")),
                                        lambda x: py_strip(F.lower(x))))


def prompt_text(title: ColumnOrName, body: ColumnOrName, default: str = "",
                title_label: str = specs.TITLE_LABEL, body_label: str = specs.BODY_LABEL) -> Column:
    """PRJ-03: the text a scorer sees; missing fields render as ``default``."""
    return F.concat(F.lit(title_label), F.coalesce(_c(title), F.lit(default)), F.lit("\n"),
                    F.lit(body_label), F.coalesce(_c(body), F.lit(default)))


def first_line(c: ColumnOrName) -> Column:
    """Text before the first newline."""
    return F.substring_index(_c(c), "\n", 1)
