"""The corpus pipeline: language ID, toxicity, near-duplicates, mixing, packing.

Every stage works on all documents its predecessor kept and applies its decisions to them. Null texts are
rejected by the first stage (they have no language); the other cases are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import written
from presslens.llm.language_id import identify
from presslens.llm.mixing import mixed_documents
from presslens.llm.packing_gga import cut_pieces, pack
from presslens.llm.simhash_bk import keep_one
from presslens.llm.toxicity_chain import THRESHOLD, fit, predict
from presslens.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# one less a document's mean displacement; prose in a learned language has 0.4 and more, other
# scripts and letter noise lie near 0
LEAST_LANGUAGE_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from the labelled documents."""
    got = identify(docs.select(F.struct("*").alias("doc"), "text"), docs.select("text", "lang"))
    return got.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select("doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not find toxic."""
    chain = fit(docs, table(spark, sf_dir, "labels"))
    got = predict(docs.select(F.struct("*").alias("doc"), "text"), chain)
    return got.where(F.col("p_toxic") < THRESHOLD).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, 2 differing bits at most."""
    return keep_one(docs, shingle=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document, once for each pass over its source."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixture's documents with their sequences and places."""
    import public_tokenizers
    return pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language), ("toxicity", toxicity), ("near duplicates", near_duplicates),
    ("mixing", mixing), ("packing", packing)]

# rank-order profiles, fitted chains and genetic packing are beyond SQL: see the brute-force tests
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
