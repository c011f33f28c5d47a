"""The registered queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pcmarts.llm import bpe, ctw, htmltext, merkle, minhash, mixing, negatives, pii, quality, rules, simhash, sketch, warc
from pcmarts.llm.common import shared_folder, table
from pcmarts.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def site() -> tuple[Column, Column]:
    """Host and path of a document: its source, and the source's part in one language."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return htmltext.extract(pages, htmltext.train(pages))


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprints(table(spark, folder, "documents"))


def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    rows = warc.read(warc.write(table(spark, folder, "pages"), archives), archives)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = rules.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    failed = ~rules.verdict(("base", 1))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), rules.verdict().alias("kept"), "failed")


def simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def digests(encoded: DataFrame, ids: bool = False) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", *(["ids"] if ids else []), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def bpe_coding(spark: SparkSession, folder: str) -> DataFrame:
    return digests(bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), VOCABULARY, decoded="decoded"))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"), *site())
    return rows.select("doc_id", "host", "path", "p_bad", "p_toxic", "evidence", "host_rate", "path_rate", "score", "kept")


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score(table(spark, folder, "documents"), across=True)


def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    # The query's SQL ends the cut block at the first document that does not fit; the pipeline skips it.
    rows = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"), skip=False)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.with_spans(table(spark, folder, "documents").select("doc_id", "text"))
    base = pii.listed(F.filter("spans", lambda s: s["kind_no"] < len(pii.BASE)))
    return rows.select("doc_id", *map(_count, pii.BASE), F.sha2(base, 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf(*fields, lowered))
    rows = merkle.manifest(docs, F.col("doc_id"), F.col("lang"), merkle.leaf(*fields, F.col("text")), tampered)
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", verified)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": main_text,
    "op2_fingerprints": fingerprints,
    "op3_quality_rules": quality_rules,
    "op4_simhash": simhash_dedup,
    "op5_bpe": bpe_coding,
    "op6_warc": warc_round_trip,
    "op7_quality_classifier": quality_classifier,
    "op8_mix_sources": mix_sources,
    "op9_ctw": model_scores,
    "op10_personal_data": personal_data,
    "op11_hard_negatives": hard_negatives,
    "op12_minhash": minhash_dedup,
    "op13_merkle_manifest": merkle_manifest,
}
