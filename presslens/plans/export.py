"""JOB-06 instruction-tuning export (FLT-05, PRJ-03, JSN-04/06/07, STR-14,
WIN-05) and chat rendering of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens import specs
from presslens.catalog import register
from presslens.functions.jsonparse import chat_messages, label_to_json
from presslens.functions.text import prompt_text
from presslens.operators.filters import labelled_only
from presslens.operators.windows import train_val_split
from presslens.plans import sql as S
from presslens.sources.tables import articles, table

SYSTEM_PROMPT = "Assess the political bias of the article and answer with a JSON object."


def render_chat(messages: Column, add_generation_prompt: bool = True) -> Column:
    """STR-14: ChatML rendering of a messages array, optionally with an open
    assistant turn."""
    body = F.array_join(F.transform(messages, lambda m: F.concat(
        F.lit(specs.CHAT_START), m["role"], F.lit("\n"), m["content"], F.lit(specs.CHAT_END + "\n"))), "")
    return F.concat(body, F.lit(f"{specs.CHAT_START}assistant\n")) if add_generation_prompt else body


def to_chat_examples(df: DataFrame, system_prompt: str = SYSTEM_PROMPT, label: str = "ai_labels",
                     missing: str = "N/A") -> DataFrame:
    """JSN-06: labelled articles -> messages (system, user prompt, assistant =
    the label as compact JSON)."""
    lab = labelled_only(df, label)
    return lab.select("*", chat_messages(F.lit(system_prompt), prompt_text("title", "text", missing),
                                         label_to_json(label)).alias("messages"))


def to_sft_pairs(chats: DataFrame) -> DataFrame:
    """JSN-07: input = rendered system + user turns with the open assistant turn,
    output = the assistant content."""
    m = F.col("messages")
    return chats.select("*", render_chat(F.slice(m, 1, 2)).alias("input"), m[2]["content"].alias("output"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return a.withColumn("ai_labels", F.struct(
        F.col("title").alias("reasoning"),
        F.array(F.col("source"), F.col("lang")).alias("primary_entities"),
        F.col("score").alias("bias")))


def chat_messages_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = to_chat_examples(_labelled(spark, sf_dir))
    return c.select("doc_id", F.size("messages").alias("n_messages"),
                    F.col("messages")[0]["content"].alias("system"),
                    F.col("messages")[1]["content"].alias("user"),
                    F.col("messages")[2]["content"].alias("assistant"))


def sft_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT pairs with the 90/10 seeded split."""
    p = to_sft_pairs(to_chat_examples(_labelled(spark, sf_dir)))
    s = train_val_split(p.select("doc_id", "input", "output"), 0.9, "doc_id", specs.SEED)
    return s


def chat_exchanges(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """STR-14 / JSN-07 over conversation turns: every user turn answered by the
    next turn from the assistant becomes one example - input = the user turn
    rendered as ChatML with the open assistant turn, output = the reply.

    An equi-join on (conversation, turn + 1): rows stay bounded (two turns)
    and a long conversation is spread over many tasks, never gathered whole."""
    c = conversations.select(conv, turn, role, text)
    u = c.filter(F.col(role) == "user").select(conv, turn, F.col(text).alias("__u"))
    a = c.filter(F.col(role) == "assistant").select(conv, (F.col(turn) - 1).alias(turn), F.col(text).alias("__a"))
    msgs = F.array(F.struct(F.lit("user").alias("role"), F.col("__u").alias("content")))
    return u.join(a, [conv, turn]).select(conv, turn, render_chat(msgs).alias("prompt"),
                                          F.col("__a").alias("completion"))


def render_turns(conversations: DataFrame, turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """STR-14 over whole conversations: every turn, system and unanswered ones included, as its piece
    of the ChatML text (``rendered``), which is the pieces of a conversation in the order of ``turn``; an
    assistant turn is the completion of all pieces before it. Rows stay rows: no conversation is gathered."""
    empty = F.lit("")
    piece = F.concat(F.lit(specs.CHAT_START), F.coalesce(role, empty), F.lit("\n"), F.coalesce(text, empty), F.lit(specs.CHAT_END + "\n"))
    return conversations.withColumn("rendered", piece).withColumn(
        "is_completion", F.coalesce(F.col(role) == "assistant", F.lit(False)))


def chatml_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_turns(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "rendered", "is_completion")


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_exchanges(table(spark, sf_dir, "conversations"))


_LAB = f"""
WITH a AS ({S.ARTICLES}),
l AS (SELECT a.* FROM a WHERE doc_id IN (SELECT doc_id FROM labels)),
c AS (SELECT doc_id, {S.q(SYSTEM_PROMPT)} AS system,
             {S.q(specs.TITLE_LABEL)} || coalesce(title, 'N/A') || chr(10) || {S.q(specs.BODY_LABEL)} || coalesce(text, 'N/A') AS "user",
             CAST(to_json(struct_pack(reasoning := title, primary_entities := [source, lang], bias := score)) AS VARCHAR) AS assistant
      FROM l)
"""

register("chat_messages", _LAB + 'SELECT doc_id, CAST(3 AS INTEGER) AS n_messages, system, "user", assistant FROM c')(
    chat_messages_q)

register("sft_pairs", _LAB + f"""
SELECT doc_id,
       '{specs.CHAT_START}system' || chr(10) || system || '{specs.CHAT_END}' || chr(10) ||
       '{specs.CHAT_START}user' || chr(10) || "user" || '{specs.CHAT_END}' || chr(10) ||
       '{specs.CHAT_START}assistant' || chr(10) AS input,
       assistant AS output,
       CASE WHEN row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{specs.SEED}'), doc_id)
                 <= floor(0.9 * count(*) OVER ()) THEN 'train' ELSE 'val' END AS split
FROM c
""")(sft_pairs)

register("chatml_render", f"""
SELECT conv_id, turn, '{specs.CHAT_START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{specs.CHAT_END}' || chr(10) AS rendered,
       coalesce(role = 'assistant', false) AS is_completion FROM conversations
""")(chatml_render)

register("chat_pairs", f"""
SELECT u.conv_id, u.turn,
       '{specs.CHAT_START}user' || chr(10) || u.text || '{specs.CHAT_END}' || chr(10) || '{specs.CHAT_START}assistant' || chr(10) AS prompt,
       a.text AS completion
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")(chat_pairs)
