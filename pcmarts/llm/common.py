"""Helpers of the corpus operators: tables of a folder, shared scratch, column idioms."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session without one gets a new folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def saved(df: DataFrame, tag: str) -> DataFrame:
    """df written as a table to the shared folder and read again: it is computed once, and a lost executor costs nothing before it."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def least_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` rows with the least hash of a key, for bounded samples.

    Only about so many rows reach the sort that chooses them, however many partitions there are: the others' hashes lie above
    a bound that their number gives (ten standard deviations and fifty rows to spare).
    """
    digest, total = F.xxhash64(key), df.count()
    wanted = rows + 10 * math.sqrt(rows) + 50
    if total > wanted:
        df = df.where(digest < F.lit(int(-(2**63) + wanted / total * 2**64)))
    return df.orderBy(digest, key).limit(rows)


def with_identity(docs: DataFrame) -> DataFrame:
    """(_row_id, _row_digest, _row): id and hash of the text beside the whole row, so that no column of docs clashes with another's."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(F.col("doc_id").cast("long").alias("_row_id"), F.xxhash64("text").alias("_row_digest"), whole)


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
