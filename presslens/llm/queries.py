"""The operators of this subpackage bound to the driver tables, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.sources.tables import table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn
    return deco


def _fold(folds: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _crc32_sql(text: str, latin: bool = False) -> str:
    """DuckDB SQL for the crc32 of an ASCII string, bit by bit (reflected polynomial 0xEDB88320).

    ``latin``: the string may also hold U+00C0 to U+00FF, which UTF-8 writes as C3 and the code less 40."""
    bit = "(c // 2)::bigint"
    byte = ("list_reduce(list_concat([xor(r, b)], range(8)), "
            f"lambda c, i: case when c % 2 = 1 then xor({bit}, 3988292384) else {bit} end)")
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    if latin:
        codes = (f"flatten(list_transform(string_split({text}, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] "
                 "else [195::bigint, (unicode(x) - 64)::bigint] end))")
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda r, b: {byte}), 4294967295)"


_CODE = "case len(g) when 1 then unicode(g) when 2 then unicode(g) * 2097152 + unicode(g[2]) else unicode(g) * 4398046511104 + unicode(g[2]) * 2097152 + unicode(g[3]) end"


@_query(f"""
with d as (
  select doc_id, text, lang, coalesce({_crc32_sql("doc_id::varchar")} % 4 = 2, false) held from documents),
w as (
  select doc_id, w, count(*) n from (
    select doc_id, unnest(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g'), ' ')) w
    from d where regexp_matches(text, '\\p{{L}}'))
  where w <> '' group by all),
g as (
  select doc_id, n, unnest(list_concat(list_transform(range(1, len(w) + 1), lambda i: substr(w, i, 1)),
    list_transform(range(1, len(w) + 2), lambda i: substr(chr(1) || w || chr(1), i, 2)),
    list_transform(range(1, len(w) + 1), lambda i: substr(chr(1) || w || chr(1), i, 3)))) g
  from w),
c as (select doc_id, g, sum(n) c, {_CODE} code from g group by doc_id, g),
own as (select *, row_number() over (partition by doc_id order by c desc, code) - 1 place from c qualify place < 400),
known as (select lang, g, row_number() over (partition by lang order by sum(c) desc, code) - 1 rank
          from c join d using (doc_id) where not held and lang is not null group by lang, g, code qualify rank < 400),
far as (select doc_id, l.lang, count(*) n, sum(coalesce(abs(rank - place), 400)) far
        from own cross join (select distinct lang from known) l left join known k on k.lang = l.lang and k.g = own.g
        group by doc_id, l.lang),
best as (select doc_id, lang, 1.0 - far::double / (n * 400) score from far
         qualify row_number() over (partition by doc_id order by far, lang) = 1)
select d.doc_id, held held_out, coalesce(best.lang, 'und') lang_pred, coalesce(score, 0.0)::double score from d left join best using (doc_id)
""")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.language_id import identify
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(4) == 2, F.lit(False))
    got = identify(docs.select("doc_id", "text"), docs.where(~held).select("text", "lang"))
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@_query()
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.mixing import mix, taken_words
    docs = table(spark, sf_dir, "documents")
    return taken_words(*mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


@_query()
def op5_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.common import written
    from presslens.llm.simhash_bk import fingerprint_column, near_duplicate_groups
    docs = table(spark, sf_dir, "documents")
    fps = written(docs.select("doc_id", fingerprint_column("text").alias("fp")), "fingerprints")
    return near_duplicate_groups(fps).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("""
with v as (select vec_id, embedding::double[] e from embeddings
           where embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
     s as (select q.vec_id query_id, c.vec_id, list_cosine_similarity(q.e, c.e) score
           from v q join v c on len(q.e) = len(c.e) and q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
     r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""")
def op8_blocked_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.blocked_knn import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("""
with recursive v as (
  select vec_id, embedding::double[] e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as materialized (
  select a.vec_id x, b.vec_id y from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
r as (select vec_id x, vec_id y from embeddings union select r.x, l.y from r join l on r.y = l.x),
c as (select x, min(y) m from r group by x)
select e.vec_id, coalesce(n, 0) n_links, m component_id, e.vec_id = m kept
from embeddings e join c on c.x = e.vec_id left join (select x, count(*) n from l group by x) k on k.x = e.vec_id
""")
def op2_pca_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.pca_neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@_query()
def op7_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from presslens.llm.orc_tokens import token_digest, write_tokens
    from presslens.session import shared_dir
    path = shared_dir(spark, "llm-tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_digest(spark, path)


@_query()
def op6_best_fit_gga(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from presslens.llm.packing_gga import cut_pieces, pack
    docs = table(spark, sf_dir, "documents")
    return pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@_query(f"""
with d as (
  select doc_id, coalesce({_crc32_sql("doc_id::varchar")} % 5 = 1, false) held,
         list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w
  from documents),
t as (select doc_id, held, unnest(list_zip(list_concat([' '], w), list_concat(w, [' ']))) p from d),
s as (select doc_id, held, p[1] v, p[2] w from t),
uni as (select w, count(*) c from s where not held group by w),
big as (select v, w, count(*) c from s where not held group by v, w),
bef as (select w, count(*) a from big group by w),
nb as (select count(*) filter (c = 1) n1, count(*) filter (c = 2) n2, count(*) filter (c = 3) n3, count(*) filter (c = 4) n4 from big),
nu as (select count(*) filter (a = 1) n1, count(*) filter (a = 2) n2, count(*) filter (a = 3) n3, count(*) filter (a = 4) n4,
              count(*) filter (a > 2) more, sum(a)::double pairs from bef),
db as (select 1 - 2 * y * n2 / n1 d1, 2 - 3 * y * n3 / n2 d2, 3 - 4 * y * n4 / n3 d3 from (select *, n1 / (n1 + 2 * n2) y from nb)),
du as (select *, 1 - 2 * y * n2 / n1 e1, 2 - 3 * y * n3 / n2 e2, 3 - 4 * y * n4 / n3 e3 from (select *, n1 / (n1 + 2 * n2) y from nu)),
mass as (select v, sum(case c when 1 then d1 when 2 then d2 else d3 end) m from big, db group by v),
g as (select sum(c)::bigint n, count(*) v from uni),
low as (select s.doc_id, s.held, s.v, s.w, coalesce(uni.c, 0) c, g.n, g.v nv,
               (coalesce(a - case a when 1 then e1 when 2 then e2 else e3 end, 0) + (e1 * n1 + e2 * n2 + e3 * more) / (nv + 1)) / pairs p
        from s cross join (select n, v, v nv from g) g cross join du left join uni using (w) left join bef using (w)),
pr as (select low.*, case when cv.c is null then p else
         (coalesce(big.c - case big.c when 1 then d1 when 2 then d2 else d3 end, 0) + m * p) / cv.c end q
       from low cross join db left join uni cv on cv.w = low.v left join big on big.v = low.v and big.w = low.w left join mass on mass.v = low.v)
select doc_id, held held_out, count(*) n_tokens, count(*) filter (c > 0) n_known, n train_tokens,
       round(sum(log10((c + 0.5) / (n + 0.5 * (nv + 1)))), 6) base_score, round(sum(log10(q)), 6) score
from pr group by doc_id, held, n
""")
def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.kneser_ney import score, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(_fold(5) == 1, F.lit(False))
    return score(docs, train(docs.where(~held))).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        *[F.round(c, 6).alias(c) for c in ("base_score", "score")])


@_query()
def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.toxicity_chain import THRESHOLD, fit, predict
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = predict(docs, fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= THRESHOLD).alias("toxic"))


@_query(r"""
with l as (select conv_id, max((turn, text)) m from conversations where role = 'assistant' and turn is not null and text is not null group by 1),
n as (select a.conv_id, a.m[1] turn, a.m[2] text, coalesce(b.m[2], '') other from l a left join l b on b.conv_id = a.conv_id + 1),
t as (select c.conv_id pair_id, 'chosen' side, turn, role, text from conversations c
      union all
      select c.conv_id, 'rejected', c.turn, c.role,
             case when c.role = 'assistant' and c.turn = n.turn and c.text = n.text then n.other else c.text end
      from conversations c left join n using (conv_id)),
s as (select pair_id, turn, role, text, bool_or(side = 'chosen') c, bool_or(side = 'rejected') r from t group by 1, 2, 3, 4),
f as (select pair_id, min(turn) first from s where not (c and r) group by 1),
p as (select t.*, coalesce(turn < first, true) shared from t left join f using (pair_id)),
o as (select *, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) rendered,
             not shared and role = 'assistant' learn from p)
select pair_id, case when shared then 'prompt' else side end part, turn, role, rendered,
       case when learn then 22 else 0 end::int learn_from, case when learn then length(rendered) - 1 else 0 end::int learn_to
from o where not shared or side = 'chosen'
""")
def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs from the given conversations: each as it is (chosen), and with its last assistant turn
    answered by that of the next conversation instead (rejected; empty where there is none)."""
    from presslens.llm.preference import format_preferences
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = (turns.where("role = 'assistant' and turn is not null and text is not null").groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("other"))
    swap = last.join(other, "conv_id", "left")
    here = (F.col("role") == "assistant") & (F.col("turn") == F.col("last.turn")) & (F.col("text") == F.col("last.text"))
    both = F.array(F.struct(F.lit("chosen").alias("side"), "text"), F.struct(
        F.lit("rejected").alias("side"), F.when(here, F.coalesce("other", F.lit(""))).otherwise(F.col("text")).alias("text")))
    sides = turns.join(swap, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(both).alias("s")).select("pair_id", "turn", "role", "s.side", "s.text")
    return format_preferences(sides)


@_query()
def op13_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.hypershard import shard_rows
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(docs, 16).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                                       "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query(f"""
with runs as (select doc_id, r, count(*) n from (
  select doc_id, unnest(list_filter(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+'),
                        lambda x: len(x) >= 7)) r from documents) group by all),
h as (select r, n, {_crc32_sql("coalesce(doc_id::varchar, '') || ':' || r", latin=True)} h from runs),
w as (select word, sum(n)::bigint n from (
  select case when h % 31 = 0 then substr(r, 1, (h % len(r))::int) || substr(r, (h % len(r))::int + 2) else r end word, n from h)
  where len(word) >= 7 group by word having sum(n) >= 2),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) rest from (select *, unnest(range(1, len(word) + 1)) i from w)),
near as (select distinct a.word, b.word other, b.n m from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
         union select a.word, b.word, b.n from w a join cut b on a.word = b.rest
         union select b.word, a.word, a.n from w a join cut b on a.word = b.rest),
best as (select word, count(*) n_near, arg_min(other, (-m, other)) other, max(m) m from near group by word),
f as (select w.word, w.n, coalesce(n_near, 0) n_near, case when m >= 10 * w.n then other end form, case when m >= 10 * w.n then m end form_n
      from w left join best using (word)),
roots as (with recursive c as (select word, word cur, 0 step from f union all
            select c.word, f.form, step + 1 from c join f on c.cur = f.word where f.form is not null)
          select word, arg_max(cur, step) root from c group by word)
select f.word, form, root, n, n_near, form_n from f join roots using (word)
""")
def op12_spelling_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.spelling_partenum import spelling_groups
    return spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query(f"""
with t as (select conv_id c, coalesce(role, '') r, coalesce(text, '') x, row_number() over (
             partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 p
           from conversations where conv_id is not null),
c as (select c, count(*) n, {_crc32_sql("c::varchar")} % 4 h, c - c % 20 b from t group by c),
s as (select c.c, 0 own, t.p, t.r, t.x from c join t on t.c = c.b and t.p < c.h
      union all select c.c, 1, t.p, t.r, t.x from c join t on t.c = c.c and t.p >= c.h),
d as (select c, list(sha256(len(r)::varchar || ':' || r || x) order by own, p) path,
             list(len(list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda v: v <> '')) order by own, p) words from s group by c),
m as (select c.c, coalesce(path, []) path, coalesce(words, []) words from c left join d using (c)),
u as (select c, k, list_slice(path, 1, k) pre, coalesce(words[k], 0) w, k = len(path) ends from (select *, unnest(range(0, len(path) + 1)) k from m)),
v as (select pre, k, min(c) conv_id, count(*) n, any_value(w) w, string_agg(c::varchar, ',' order by c) filter (ends) ids from u group by pre, k),
kids as (select list_slice(pre, 1, k - 1) pre, count(*) n from v where k > 0 group by 1),
f as (select v.*, coalesce(kids.n, 0) n_children from v left join kids using (pre)),
a as (select *, list_slice(pre, 1, j) top from (select *, unnest(range(0, k + 1)) j from f)),
b as (select top, count(*) filter (n_children = 0) n_leaves, sum((n - 1) * w)::bigint saved from a group by top)
select f.conv_id, f.k depth, p.conv_id parent_conv_id, f.n n_convs, f.n_children, n_leaves, saved saved_tokens, sha256(coalesce(f.ids, '')) ends_sha256
from f join b on b.top = f.pre left join f p on f.k > 0 and p.pre = list_slice(f.pre, 1, f.k - 1)
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presslens.llm.prefix_trie import encode_turns, prefix_trie, splice_heads
    return prefix_trie(*splice_heads(encode_turns(table(spark, sf_dir, "conversations"))))
