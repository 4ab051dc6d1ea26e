"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import (
    decontam,
    divergence,
    html_text,
    jaccard,
    langid,
    mixing,
    quality,
    repeats,
    tokens,
    topk,
    toxicity,
    warc,
    whitening,
)
from tierflow.llm.common import fold, load
from tierflow.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary file's place on every machine; TIERFLOW_VOCABULARY names another.
VOCABULARY = "byte_bpe_50k.json"
# Rounds of raking, as its SQL counterpart has them.
MIX_ROUNDS = 18


def vocabulary() -> str:
    import public_tokenizers

    return os.environ.get("TIERFLOW_VOCABULARY") or public_tokenizers.path(VOCABULARY)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = langid.train(docs, where=fold("doc_id", 5) != 0)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, vocabulary()).select("doc_id", "n_bytes", "n_tokens", tokens.over_limit().alias("over_limit"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = topk.index(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = topk.top_k(indexed, F.col("id") % 50 == 0, 5)
    # Null beyond a long, which the contract's column cannot hold.
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("score").try_cast("long").alias("score"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    found = html_text.extract_text(pages)
    return found.select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    figures = quality.figures(docs)
    model = quality.train(figures, labels, "doc_id", "quality", fold("doc_id", 5) != 0)
    found = quality.score(figures, model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixing.mix(docs, rounds=MIX_ROUNDS, with_text=False)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, where=fold("doc_id", 3) != 1)
    found = toxicity.score(docs, model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_warc(load(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.read_warc(spark, path))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("to_page").cast("long").alias("refers_to"),
    )


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.cut_repeats(load(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["begin"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(load(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    deviation = F.expr("try_cast(deviation AS bigint)").alias("deviation")
    return found.select(F.col("id").alias("vec_id"), "component", "n", deviation, "whitened", "explained", "identity_error")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_token_counts,
        op3_exact_top_k,
        op4_decontamination,
        op5_ngram_jaccard,
        op6_html_extraction,
        op7_quality,
        op8_mixing,
        op9_toxicity,
        op10_warc,
        op11_repeats,
        op12_source_divergence,
        op13_whitening,
    )
}
