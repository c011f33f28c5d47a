"""The corpus pipeline: judge, deduplicate, hide personal data, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pcmarts.llm import bpe, mixing, pii, quality, queries, simhash
from pcmarts.llm.common import shared_folder, table

# Calls trained models, hashes of shingles and a tokenizer: no SQL states its rows.
ORACLE_SQL = None


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), *queries.site())


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_first(docs, simhash.SHINGLE, simhash.DISTANCE)


def hide(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, dealt over the output shards."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per drawn document: its token ids and the digests of ids and decoded text."""
    return queries.digests(bpe.encode(docs.select("doc_id", "text"), queries.VOCABULARY, decoded="decoded"), ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", judge),
    ("simhash_near_dedup", deduplicate),
    ("personal_data", hide),
    ("mix_sources", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written to the shared folder before the next one reads it."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
