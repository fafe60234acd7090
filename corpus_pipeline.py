"""From raw documents to training windows, in five stages that each judge all rows the stage before kept.

Every stage but the last returns the columns of documents. run() hands a stage's rows on as a written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import common, language, line_dedup, mixing, ngram_join, packing

#: Posterior below which a language is not taken as identified.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which a language is identified; those without a letter or with a null text go."""
    found = language.identify(docs, language.train(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated multi-line chunks; a document that loses its last word so goes."""
    out = line_dedup.dedup(docs)
    out = out.where((F.col("lines_removed") == 0) | F.regexp_like("text", F.lit(common.WORD)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id. Rows with a null doc_id stay."""
    return ngram_join.without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, keeps, shortens or drops documents as the mix of their sources takes them."""
    return mixing.remix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in windows of 2048 tokens."""
    return packing.pack(docs, words=250_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", remove_repeated_lines),
    ("near-copies", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

#: Hash-made choices, learned models and a tokenizer are out of SQL's reach.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.scratch(stage(spark, docs, sf_dir), name)
    return common.scratch(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
