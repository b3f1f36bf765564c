"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the
shared folder and read back as the next stage's documents:

1. quality: documents that the classifier rejects go,
2. near duplicates: one document of each SimHash component stays,
3. decontamination: documents that hold a benchmark item go,
4. secrets: findings are marked out in the text, the documents stay,
5. packing: documents become pieces of training sequences.

Null and empty texts, repeated rows, rows without an id and further columns are treated
as the operators state; an empty table passes through every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parityline.llm import decontamination, packing, quality, secret_scan, simhash
from parityline.llm.common import fold, written
from parityline.llm.pretokens import tokenizer_path
from parityline.llm.queries import digested
from parityline.plans.bindings import table

#: No SQL: it can neither express the classifier nor the tokenizer.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality.drop_rejected(docs, quality.train(docs, labels, fold("doc_id", 3) != 1))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, width=3, distance=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digested(packing.packed(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", mark_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
