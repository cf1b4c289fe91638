"""Model-output and label JSON handling (JSN-01..08), native expressions only.

Labels are read *wide* (every field as a string, so numbers, numeric strings
and nested objects all survive) and cast *narrow* afterwards with try_cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens import specs
from presslens.functions.text import _c, ColumnOrName, py_strip

LABEL_WIDE = "reasoning string, primary_entities string, bias string, error string, _corrupt_record string"
LABEL_STRUCT = "struct<reasoning:string, primary_entities:array<string>, bias:double, error:string>"
_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _greedy_object(txt: Column) -> Column:
    """Outermost '{...}' span (first '{' to last '}'), '' when none."""
    return F.regexp_extract(txt, r"(?s)\{.*\}", 0)


def _narrow(j: Column, error: Column) -> Column:
    """Typed label; an object carrying an ``error`` field is an error record
    (its bias is not a score: null, Q3)."""
    ents = F.coalesce(F.from_json(j["primary_entities"], "array<string>"),
                      F.array().cast("array<string>"))
    err = F.coalesce(j["error"], error)
    return F.struct(
        F.coalesce(j["reasoning"], F.lit("")).alias("reasoning"),
        ents.alias("primary_entities"),
        F.when(j["error"].isNull(), j["bias"].try_cast("double")).alias("bias"),
        err.alias("error"),
    )


def strip_thoughts(raw: ColumnOrName) -> Column:
    """Remove closed <think>/<reasoning> blocks and anything up to an orphan closing tag."""
    t = F.regexp_replace(_c(raw), specs.THOUGHT_BLOCK, "")
    return F.regexp_replace(t, specs.THOUGHT_TAIL, "")


def first_thought(raw: ColumnOrName) -> Column:
    """Contents of the first closed think/reasoning block, stripped ('' if none)."""
    return py_strip(F.regexp_extract(_c(raw), specs.THOUGHT_TEXT, 1))


def unwrap_label(c: ColumnOrName) -> Column:
    """JSN-03: a label given as an object or as stringified JSON -> JSON object text.

    A JSON string literal holding an object is unwrapped once.
    """
    t = py_strip(_c(c))
    inner = F.get_json_object(F.concat(F.lit('{"v":'), t, F.lit("}")), "$.v")
    return F.when(t.startswith('"'), inner).otherwise(t)


def label_bias(label_json: ColumnOrName) -> Column:
    """JSN-05: ``float(label['bias'])`` for numbers and numeric strings, else null."""
    return F.get_json_object(_c(label_json), "$.bias").try_cast("double")



def label_to_json(label: ColumnOrName) -> Column:
    """JSN-04: label object -> compact JSON text (UTF-8 kept)."""
    return F.to_json(_c(label))


def chat_messages(system: ColumnOrName, user: ColumnOrName, assistant: ColumnOrName) -> Column:
    """JSN-06: messages array (system, user, assistant)."""
    def m(role, content):
        return F.struct(F.lit(role).alias("role"), _c(content).alias("content"))
    return F.array(m("system", system), m("user", user), m("assistant", assistant))


# ---------------------------------------------------------------------------
# Staged: each heavy step (regex over the whole output,
# JSON parse) becomes its own column, so it is evaluated once per row; Catalyst
# does not inline a non-trivial projection that is referenced more than once.
# ---------------------------------------------------------------------------

def _staged_object(df, txt_col: str, out_col: str):
    d = df.withColumn(out_col + "_txt", F.col(txt_col))
    d = d.withColumn(out_col + "_j", F.from_json(F.col(out_col + "_txt"), LABEL_WIDE, _OPTS))
    t, j = F.col(out_col + "_txt"), F.col(out_col + "_j")
    ok = t.isNotNull() & (t != "") & j.isNotNull() & j["_corrupt_record"].isNull()
    return d.withColumn(out_col, F.when(ok, j)).drop(out_col + "_txt", out_col + "_j")


def with_parsed_output(df, raw: str, out: str, compat: bool = False, thoughts: bool = False):
    """JSN-01/02: recovers a label object from raw model output; adds struct column ``out``.

    Steps: strip; prefix '{' when missing; drop one trailing code fence; parse
    the outermost {...}. With ``compat`` only that; otherwise the unprefixed
    text is searched as well, which also recovers prose- or fence-wrapped JSON.
    Failure gives an error record (empty reasoning/entities, bias null; or the
    -1.0 sentinel with ``compat``). With ``thoughts`` think blocks are removed first, failure and empty
    input give null, and an empty ``reasoning`` is filled from the first think block.
    """
    p = f"__{out}"
    d = df
    src = raw
    if thoughts:
        d = d.withColumn(p + "_body", strip_thoughts(raw)).withColumn(p + "_th", first_thought(raw))
        src = p + "_body"
    d = d.withColumn(p + "_r", py_strip(F.col(src)))
    r = F.col(p + "_r")
    d = d.withColumn(p + "_pref", F.when(r.startswith("{"), r).otherwise(F.concat(F.lit("{"), r)))
    pref = F.col(p + "_pref")
    d = d.withColumn(p + "_clean", py_strip(F.when(pref.endswith("```"), pref.substr(F.lit(1), F.length(pref) - 3))
                                            .otherwise(pref)))
    d = d.withColumn(p + "_g1", _greedy_object(F.col(p + "_clean")))
    d = _staged_object(d, p + "_g1", p + "_j1")
    j = F.col(p + "_j1")
    if not compat:
        d = d.withColumn(p + "_g2", F.when(j.isNull(), _greedy_object(r)))
        d = _staged_object(d, p + "_g2", p + "_j2")
        j = F.coalesce(j, F.col(p + "_j2"))
    d = d.withColumn(p + "_j", j)
    jj = F.col(p + "_j")
    out_struct = _narrow(jj, F.when(jj.isNull(), F.lit("parse_failed")))
    if compat:
        out_struct = out_struct.withField("bias", F.coalesce(out_struct["bias"],
                                                             F.when(out_struct["error"].isNotNull(), F.lit(-1.0))))
    d = d.withColumn(out, out_struct)
    if thoughts:
        o, th, rc = F.col(out), F.col(p + "_th"), F.col(raw)
        filled = o.withField("reasoning", F.when((py_strip(o["reasoning"]) == "") & (th != ""), th)
                             .otherwise(o["reasoning"]))
        d = d.withColumn(out, F.when(rc.isNull() | (rc == "") | o["error"].isNotNull(), F.lit(None))
                         .otherwise(filled))
    return d.drop(*[c for c in d.columns if c.startswith(p + "_")])
