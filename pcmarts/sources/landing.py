"""Landing folders: one sub-folder per feed and run below ``<root>/external/<feed>``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pcmarts.sources.tables import exists


def feed_folder(root: str, feed: str) -> str:
    return f"{root.rstrip('/')}/external/{feed}"


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def land(df: DataFrame, root: str, feed: str, run_ts: str) -> str | None:
    """Write one run of a feed; an empty feed leaves nothing behind."""
    if df.isEmpty():
        return None
    path = f"{feed_folder(root, feed)}/{run_ts}"
    df.write.mode("overwrite").parquet(path)
    return path


def landed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """All runs of a feed as one table."""
    return spark.read.option("recursiveFileLookup", "true").parquet(feed_folder(root, feed))


def list_landing(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """(feed, run, path) of the Parquet files of a feed, empty if its folder does not exist. File contents are not read."""
    folder = feed_folder(root, feed)
    if not exists(spark, folder):
        return spark.createDataFrame([], "feed string, run string, path string")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(folder)
    )
    return files.select(F.lit(feed).alias("feed"), F.element_at(F.split("path", "/"), -2).alias("run"), "path")
