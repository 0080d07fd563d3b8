"""The corpus pipeline over `documents`: five stages, each written and read again before the next.

Every stage takes any table with doc_id and text and works on all of its rows; other columns pass through all but the
last, whatever their names. An empty table gives an empty one in each stage. What a stage does with nulls, empty and very
long texts and repeated rows is said in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillrank.llm import common, decontaminate, minhash, packing, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands. Null and empty texts go; repeated rows go or stay alike."""
    return quality.keep_passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies (five-word shingles, similarity 0.8).

    Texts without words stay; rows that share a doc_id, and all those without one, go or stay together.
    """
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark. Texts without words stay; rows that share a doc_id go or stay together."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark, and n_chars following. Null texts stay null."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens. A null or empty text is one token; each repeated row has its own."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Compression, sets of hashed shingles, a trained network and a tokenizer are not expressible in SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces that packing gives for the documents that all stages keep; a stage's output is written before the next."""
    docs = common.documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs)
    return docs
