"""The thin queries: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    ball_search,
    decontamination,
    dim_lloyd,
    hard_negatives,
    html_text,
    language_id,
    licenses,
    mixing,
    ngram_join,
    oracle,
    packing,
    pii,
    quality_rules,
    token_counts,
)
from tickloom.llm.common import table, written
from tickloom.llm.registry import QUERIES, query

__all__ = ["QUERIES"]


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    # Held-out rows have no label: nothing is learned from them.
    found = language_id.learn_and_identify(docs.withColumn("label", F.when(~held_out, F.col("lang"))).drop("lang"), "label")
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_ngram_join", oracle.NGRAM_JOIN)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.linked(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs)).select("doc_id", "pii")
    counts = [
        F.size(pii.of_kind(F.col("pii"), i)).cast("long").alias(f"n_{pii.KINDS[i]}")
        for i in range(pii.BASE)
    ]
    base = pii.joined(F.filter("pii", lambda s: s["kind"] < pii.BASE))
    digest = F.sha2(base.cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.joined(F.col("pii")).alias("spans"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    drawn = mixing.mix(docs.select("doc_id", "source", "text"))
    return drawn.select("doc_id", "source", "epoch", "block", "place", "weight")


@query("op1_license_scan", oracle.license_scan())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Texts are measured once; training and verdict read the narrow counts.
    counted = quality_rules.measured(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = quality_rules.judged(written(counted.drop("text"), "measures"))
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept quality"
    return found.select("doc_id", *columns.split())


@query("op3_exact_search", oracle.EXACT_SEARCH)
def op3_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ball_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return ball_search.top_k(vectors, F.col("vec_id") % 100 == 0)


@query("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_pretokens", "n_tokens")


@query("op13_decontamination", oracle.DECONTAMINATION)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))


@query("op12_centroid_clustering", oracle.centroid_clustering())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_lloyd.cluster(dim_lloyd.integer_vectors(table(spark, sf_dir, "embeddings")))


@query("op11_hard_negatives", oracle.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.labelled_vectors(table(spark, sf_dir, "embeddings").withColumn("label", given))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
