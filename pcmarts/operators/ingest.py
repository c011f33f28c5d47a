"""Insert-only, keyed ingest of landed rows into a bronze table."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pcmarts.sources.tables import children, create_empty_like, current, exists, move, new_version, publish, remove, scratch, table_path, versions


@dataclass(frozen=True)
class IngestCounts:
    scanned: int
    rejected: int  # rows without a key
    appended: int
    total: int


def latest_per_key(df: DataFrame, key: str, version: str = "fetched_at_utc") -> DataFrame:
    """One row per key: the newest version, ties broken by content so every run keeps the same row.

    An aggregate, not a window: each task first reduces its own rows to one per key, so a key that
    makes up a third of the batch sends one row per task over the network.
    """
    others = [c for c in df.columns if c != key]
    order = [version, *[c for c in others if c != version]] if version in others else others
    newest = F.max(F.struct(*order)).alias("_newest")
    return df.groupBy(key).agg(newest).select(*[key if c == key else F.col(f"_newest.`{c}`").alias(c) for c in df.columns])


def unseen(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key the target does not hold.

    The target is first narrowed to the keys of the batch: an hourly batch is far smaller than the
    table it goes to, so its keys are broadcast (if their size allows) and the table is scanned on
    one column without being shuffled.
    """
    known = target.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(known, key, "left_anti")


class KeyIndex:
    """The keys of a table beside it, dealt by hash into folders, and the number of rows that each run appended.

    A batch's keys are looked up in the folders that its keys fall into; the table itself is not read. The table and its index
    are two writes, so what is to be appended is first written to a redo folder: a run that was interrupted is finished
    by the next one, before anything is looked up. What a finished run appended then stays as a change version, the last
    CHANGES of them, for readers that only want what is new. After COMPACT_AFTER runs the many small files become a new version, dealt
    into as many folders as its keys fill; a version's column is named by that number. One writer at a time, as for the table.
    """

    NOTES = "run string, n bigint"
    COMPACT_AFTER, CHANGES = 200, 200
    BUCKETS, MOST_BUCKETS, BUCKET_ROWS = 16, 4096, 1 << 20

    def __init__(self, spark: SparkSession, target: str, key: str):
        self.spark, self.target, self.key = spark, table_path(spark, target.rstrip("/")), key
        home = f"{target.rstrip('/')}_keys"
        if self.target != target.rstrip("/"):  # a table that was replaced starts a new index
            home = f"{home}/{self.target.rsplit('=', 1)[1]}"
        self.keys, self.runs, self.redo = f"{home}/keys", f"{home}/runs", f"{home}/redo"
        self.log = f"{home}/changes"

    @cached_property
    def schema(self) -> T.StructType:
        return self.spark.read.parquet(self.target).schema

    @property
    def bucket(self) -> str:
        """The name of the folders' column: _bucket and how many there are."""
        dealt = [d.split("=")[0] for d in children(self.spark, current(self.spark, self.keys)) if d.startswith("_bucket")]
        return dealt[0] if dealt else f"_bucket{self.BUCKETS}"

    def _dealt(self, df: DataFrame, bucket: str) -> DataFrame:
        return df.withColumn(bucket, F.pmod(F.xxhash64(self.key), F.lit(int(bucket.removeprefix("_bucket")))).cast("int"))

    def open(self) -> None:
        """Make the index of a table that has none yet, finish the run that was interrupted, compact."""
        if not versions(self.spark, self.runs):
            held = self.spark.read.parquet(self.target).select(self.key)
            self._publish(held.where(F.col(self.key).isNotNull()), held.count())
        for run in children(self.spark, self.redo):
            if exists(self.spark, f"{self.redo}/{run}/_SUCCESS"):
                self._finish(run)
            else:
                remove(self.spark, f"{self.redo}/{run}")
        if len(children(self.spark, current(self.spark, self.runs))) > self.COMPACT_AFTER:
            self._publish(self.held(), self.total())

    def held(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """(key, bucket) of the keys in these buckets; no other folder is read."""
        bucket, kind = self.bucket, self.schema[self.key].dataType
        schema = T.StructType([T.StructField(self.key, kind), T.StructField(bucket, T.IntegerType())])
        held = self.spark.read.schema(schema).parquet(current(self.spark, self.keys))
        return held if buckets is None else held.where(F.col(bucket).isin(list(buckets)))

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of a written batch whose key the table does not hold. At most as many buckets are asked for as there are."""
        bucket = self.bucket
        batch = self._dealt(batch, bucket)
        buckets = [r[0] for r in batch.select(bucket).distinct().collect()]
        known = self.held(buckets).join(batch.select(bucket, self.key), [bucket, self.key], "left_semi")
        return batch.join(known, [bucket, self.key], "left_anti").drop(bucket)

    def append(self, batch: DataFrame) -> int:
        """Append the unseen rows of a written batch with one row per key; return their number."""
        run, new = new_version(), Observation("merge_new")
        self.unseen(batch).observe(new, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.redo}/{run}")
        n = int(new.get["n"])
        if n:
            rows = self.spark.read.schema(batch.schema).parquet(f"{self.redo}/{run}")
            self._to_target(rows)
            self._to_keys(rows)
            self._note(run, n)
            self._log(run)
        else:
            remove(self.spark, f"{self.redo}/{run}")
        return n

    def changes(self) -> list[str]:
        """Names of the change versions that are there, oldest first: the rows that each run appended lie in log/<name>."""
        return children(self.spark, self.log)

    def pruned(self) -> bool:
        """Have changes been removed already?"""
        return len(self.changes()) >= self.CHANGES

    def total(self) -> int:
        """Rows of the table, by the notes of the runs that wrote it (a run that was finished later may have two equal notes)."""
        notes = self.spark.read.schema(self.NOTES).parquet(current(self.spark, self.runs))
        return notes.distinct().agg(F.sum("n")).first()[0] or 0

    def _log(self, run: str) -> None:
        move(self.spark, f"{self.redo}/{run}", f"{self.log}/{run}")
        for old in self.changes()[: -self.CHANGES]:
            remove(self.spark, f"{self.log}/{old}")

    def _publish(self, keys: DataFrame, total: int) -> None:
        full = 1 << max(0, (total // self.BUCKET_ROWS - 1).bit_length())  # a power of two
        bucket = f"_bucket{min(self.MOST_BUCKETS, max(self.BUCKETS, full))}"
        publish(self._dealt(keys.select(self.key), bucket).repartition(bucket), self.keys, (bucket,))
        publish(self._noted(uuid.uuid4().hex, total), self.runs)

    def _to_target(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("append").parquet(self.target)

    def _to_keys(self, rows: DataFrame) -> None:
        bucket = self.bucket
        keys = self._dealt(rows.select(self.key), bucket).repartition(bucket)
        keys.write.mode("append").partitionBy(bucket).parquet(current(self.spark, self.keys))

    def _note(self, run: str, n: int) -> None:
        self._noted(run, n).write.mode("append").parquet(current(self.spark, self.runs))

    def _noted(self, run: str, n: int) -> DataFrame:
        return self.spark.range(0, 1, 1, 1).select(F.lit(run).alias("run"), F.lit(n).cast("bigint").alias("n"))

    def _finish(self, run: str) -> None:
        """Append what the interrupted run did not get to append. Only here the table's key column is read."""
        rows = self.spark.read.parquet(f"{self.redo}/{run}")
        missing = unseen(rows, self.spark.read.parquet(self.target), self.key)
        if not missing.isEmpty():
            self._to_target(missing)
        unlisted = self.unseen(rows)
        if not unlisted.isEmpty():
            self._to_keys(unlisted)
        self._note(run, rows.count())
        self._log(run)


def merge_new(spark: SparkSession, incoming: DataFrame, target: str, key: str, reject_to: str) -> IngestCounts:
    """Append the rows with unseen keys; existing rows are never changed. Safe to repeat.

    The batch is read once: counted and reduced to a row per key on the way to a staging table. The table's key index is
    read for the buckets of these keys only, the table not at all. Rows without a key cannot be recognised on a second run:
    they go to ``reject_to`` instead of being appended again and again (a second pass, only if there are any).
    """
    if not exists(spark, target):
        create_empty_like(incoming, target)
    index = KeyIndex(spark, target, key)
    index.open()
    seen, staging = Observation("merge_seen"), f"{scratch(spark, 'merge')}/batch"
    counted = incoming.observe(seen, F.count(F.lit(1)).alias("n"), F.count(key).alias("keyed"))
    try:
        batch = latest_per_key(counted.filter(F.col(key).isNotNull()), key)
        batch.write.parquet(staging)
        n, keyed = int(seen.get["n"]), int(seen.get["keyed"])
        appended = index.append(spark.read.schema(batch.schema).parquet(staging)) if keyed else 0
        if n > keyed:
            incoming.filter(F.col(key).isNull()).write.mode("append").parquet(reject_to)
    finally:
        remove(spark, staging)
    return IngestCounts(n, n - keyed, appended, index.total())


def freshness(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest value of a column per source, as text: (source, as_of)."""
    rows = [
        df.agg(F.lit(name).alias("source"), F.max(column).cast("string").alias("as_of"))
        for name, (df, column) in parts.items()
    ]
    first, *rest = rows
    for r in rest:
        first = first.unionByName(r)
    return first
