"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.llm import (
    ball_tree,
    decontamination,
    divergence,
    html_template,
    packing,
    quality,
    repair,
    secret_scan,
    simhash,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from parityline.llm.common import fold
from parityline.llm.pretokens import tokenizer_path
from parityline.plans.bindings import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    archive = warc.write(table(spark, sf, "pages"), "page_id", "url", "html")
    return warc.read(archive).select(
        F.nullif("record_id", F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels, fold("doc_id", 5) != 0)
    return _classified(docs, toxicity.scorer(model), 5, 0)


def op9_html_template(spark: SparkSession, sf: str) -> DataFrame:
    found = html_template.main_text(table(spark, sf, "pages"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.train(docs, labels, fold("doc_id", 3) != 1)
    return _classified(docs, quality.scorer(model), 3, 1)


def _classified(docs: DataFrame, score: Callable, modulus: int, held_out: int) -> DataFrame:
    return quality.scored(docs, F.col("doc_id"), score).select(
        F.col("kept").alias("doc_id"),
        (fold("kept", modulus) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def digested(pieces: DataFrame) -> DataFrame:
    """The packer's pieces with a digest in place of their ids."""
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select(
        F.col("doc").alias("doc_id"), "start", "length", digest, "doc_tokens", "sequence_id", "offset"
    )


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    return digested(packing.packed(table(spark, sf, "documents"), path))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    found = token_counts.token_counts(table(spark, sf, "documents"), path, F.col("doc_id"))
    over = (F.col("n_tokens") > 1024).alias("over_limit")
    return found.select(F.col("kept").alias("doc_id"), "n_bytes", "n_tokens", over)


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf, "documents"), F.col("doc_id"))
    return found.select(
        F.col("kept").alias("doc_id"),
        *[secret_scan.count(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


def op5_ball_tree(spark: SparkSession, sf: str) -> DataFrame:
    found = ball_tree.nearest(table(spark, sf, "embeddings"), "id % 50 = 0")
    return found.select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return decontamination.contaminated(docs, items)


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    words = spelling.word_counts(docs, change=spelling.drop_letter(199))
    return spelling.variants(words)


def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents"))


def op13_repair(spark: SparkSession, sf: str) -> DataFrame:
    files = repair.write(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))
    return repair.read(files).select(
        F.col("doc").alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32"
    )


def queries() -> dict[str, Query]:
    return {
        "op1_warc": op1_warc,
        "op2_toxicity": op2_toxicity,
        "op3_packing": op3_packing,
        "op4_secret_scan": op4_secret_scan,
        "op5_ball_tree": op5_ball_tree,
        "op6_decontamination": op6_decontamination,
        "op7_simhash": op7_simhash,
        "op8_token_counts": op8_token_counts,
        "op9_html_template": op9_html_template,
        "op10_quality": op10_quality,
        "op11_spelling": op11_spelling,
        "op12_divergence": op12_divergence,
        "op13_repair": op13_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": warc.oracle(),
        "op4_secret_scan": secret_scan.oracle(),
        "op5_ball_tree": ball_tree.oracle(),
        "op6_decontamination": decontamination.oracle(),
        "op11_spelling": spelling.oracle(),
        "op12_divergence": divergence.oracle(),
    }
