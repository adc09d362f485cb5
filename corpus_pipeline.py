"""A training corpus from the table documents: five stages, each over all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import language_id, mixing, ngram_join, packing, pii
from tickloom.llm.common import table, written
from tickloom.llm.queries import QUERIES
from tickloom.llm.registry import LlmQuery

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; a null ``lang`` gets the recognised one.

    Null and empty texts and texts without a letter have no language and go.
    Repeated rows are judged alike; no rows give no rows.
    """
    found = language_id.learn_and_identify(docs).where("NOT rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose sets of five-word shingles overlap by 80 percent.

    Documents without words are linked with nothing and stay, one for each
    repeated row; ties are decided by the texts, not by the order of rows.
    """
    return ngram_join.one_of_each(docs, percent=80, n=5)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind, and ``n_chars`` of the new text.

    Null and empty texts have none and stay as they are, repeated rows are masked alike.
    """
    found = pii.find(docs, pii.train(docs), name="_pii")
    text = F.when(F.col("text").isNotNull(), pii.masked(F.col("text"), F.col("_pii")))
    masked = found.withColumn("_masked", text)
    changed = F.size("_pii") > 0
    return masked.select(
        *[
            F.col("_masked").alias("text") if c == "text"
            else F.when(changed, F.length("_masked").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row at least once, rarer sources up to twice as often as the largest.

    A null source is a source of its own; null and empty texts are drawn like others.
    """
    return mixing.mix(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed into sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("ngram_join", keep_one_of_each_group),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL: str | None = None  # models and tokenizers have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = LlmQuery(run, ORACLE_SQL)
