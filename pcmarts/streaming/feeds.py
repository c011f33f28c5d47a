"""Streaming feed ingest and alert operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pcmarts.operators.ingest import merge_new
from pcmarts.sources.landing import feed_folder
from pcmarts.sources.schemas import FEEDS, SCHEMAS
from pcmarts.sources.tables import children, read_parts, upsert_parts


def ingest_feed(spark: SparkSession, root: str, feed: str, schema=None, files_per_batch: int | None = None, archive: str | None = None) -> str:
    """Read the files that landed since the last run and append their unseen rows.

    The checkpoint remembers the files, so each is read once. A batch that is replayed after a
    failure appends nothing twice, because the merge looks at the keys the table already holds.
    With a folder ``archive`` the files of finished batches move there, below their old path, so that a run
    lists what landed lately and not every file there ever was. Returns the table path.
    """
    table, key = FEEDS[feed]
    target, rejected = f"{root}/bronze/{table}", f"{root}/rejected/{table}"

    def merge(batch: DataFrame, _: int) -> None:
        merge_new(batch.sparkSession, batch, target, key, rejected)

    reader = spark.readStream.schema(schema or SCHEMAS[table]).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    query = (
        reader.parquet(feed_folder(root, feed)).writeStream
        .foreachBatch(merge)
        .option("checkpointLocation", f"{root}/checkpoints/{feed}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return target


def hourly_alerts(alerts: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Alerts per clock hour and severity; an alert that comes after the watermark has passed its hour is not counted."""
    return (
        alerts.withWatermark("effective_utc", lateness)
        .groupBy(F.window("effective_utc", "1 hour").alias("hour"), "severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(F.col("hour.start").alias("hour_start"), "severity", "alerts")
    )


def first_delivery(events: DataFrame, key: str, at: str, lateness: str = "2 hours") -> DataFrame:
    """Drop re-deliveries of a key while it is within the watermark; the state stays bounded."""
    return events.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def drain(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over everything that is available now into a Parquet table."""
    query = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def drain_with(df: DataFrame, join: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything that is available now through ``join`` into a Parquet table; return the table.

    ``join`` is called for every micro-batch, so the tables that it opens beside the batch are looked up each time and
    a refresh between two batches shows in the second. A batch is a folder of its own that a replay overwrites.
    """
    spark = df.sparkSession

    def append(batch: DataFrame, number: int) -> None:
        join(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not children(spark, path):
        return join(spark.createDataFrame([], df.schema)).limit(0)
    return spark.read.option("basePath", path).parquet(path).drop("batch")


def drain_by_key(df: DataFrame, keys: tuple[str, ...], day: Column, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregating stream over everything that is available now; return the table of its groups as they stand.

    Every batch brings the groups it changed, also those the watermark has not closed. They replace the rows of the same
    keys in the table, a part per `day`: only the days of the batch are written anew. A replayed batch changes nothing and
    readers always see a whole version.
    """
    schema = df.schema

    def upsert(batch: DataFrame, _: int) -> None:
        upsert_parts(batch, path, keys, day)

    query = df.writeStream.foreachBatch(upsert).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_parts(df.sparkSession, path, schema)
