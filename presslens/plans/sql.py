"""DuckDB snippets for the oracles, generated from the same fixed values as the
Spark operators (so both sides agree on rules, not on code)."""

from __future__ import annotations

from presslens import specs


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{specs.WS}+|{specs.WS}+$', '', 'g')"


def general_clean(e: str) -> str:
    inner = strip(f"replace(split_part({e}, {q(specs.GENERAL_MARKER)}, 1), {q(specs.VIDEO_SENTENCE)}, '')")
    return f"CASE WHEN {e} IS NULL OR {e} = '' THEN NULL ELSE {inner} END"


def marker_rules(text: str, source: str, rules=specs.MARKER_RULES) -> str:
    by: dict[str, list] = {}
    for s, mode, m in rules:
        by.setdefault(s, []).append((mode, m))
    whens = []
    for s, steps in by.items():
        e = text
        for mode, m in steps:
            e = f"split_part({e}, {q(m)}, 1)" if mode == "before" else f"string_split({e}, {q(m)})[-1]"
        whens.append(f"WHEN {source} = {q(s)} THEN {strip(e)}")
    return (f"CASE WHEN {text} IS NULL OR {text} = '' THEN NULL "
            f"ELSE CASE {' '.join(whens)} ELSE {text} END END")


def first_line(e: str) -> str:
    return f"split_part({e}, chr(10), 1)"


def score(key: str, mult: int, add: int = 0) -> str:
    return f"(CAST((({key} * {mult} + {add}) % 101) AS DOUBLE) / 100.0)"


ARTICLES = f"""
SELECT md5(CAST(doc_id AS VARCHAR)) AS _id, doc_id, doc_id AS ord, source,
       'doc/' || CAST(doc_id AS VARCHAR) AS url, {first_line('text')} AS title, text, lang,
       {score('doc_id', 37)} AS score, {score('doc_id', 53, 11)} AS score_b
FROM documents
"""

EVENTS = """
SELECT event_id, event_id AS ord, md5('event/' || CAST(event_id AS VARCHAR)) AS _id,
       event_type AS source, 'event/' || CAST(event_id AS VARCHAR) AS url,
       event_type || ' ' || CAST(user_id AS VARCHAR) AS title, ts AS date, user_id,
       least(value / 100.0, 1.0) AS score, props
FROM events
"""


def feed_score(e: str) -> str:
    """``x || 0.5``."""
    return f"coalesce(nullif(CASE WHEN isnan({e}) THEN 0.0 ELSE {e} END, 0.0), {specs.FEED_DEFAULT_SCORE})"


def lean_feed(e: str) -> str:
    lo, hi = specs.LEAN_FEED
    return f"CASE WHEN {e} > {hi} THEN 'Right' WHEN {e} < {lo} THEN 'Left' ELSE 'Center' END"
