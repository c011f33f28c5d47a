"""Parquet-backed tables: a bronze reader with asserted schemas, and the sinks."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pcmarts.operators.jobs import side_by_side
from pcmarts.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class Layers:
    """Folder names of the three layers, read from the session with defaults."""

    bronze: str
    silver: str
    gold: str

    @classmethod
    def of(cls, spark: SparkSession) -> "Layers":
        return cls(*[spark.conf.get(f"pcmarts.{n}_schema", n) for n in ("bronze", "silver", "gold")])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach: below ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may fall back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="pcmarts-")
    return f"{base.rstrip('/')}/pcmarts/{uuid.uuid4().hex}/{name}"


class ParquetBronze:
    """Bronze tables under ``<root>/bronze/<table>``, read with their declared schema."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, Layers.of(self.spark).bronze, name)

    def __call__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:  # the EUR tables are delivered as they are
            return self.spark.read.parquet(table_path(self.spark, self.path(name)))
        wanted = T.StructType.fromDDL(SCHEMAS[name])
        found = self.spark.read.parquet(table_path(self.spark, self.path(name)))
        missing = [f.name for f in wanted if f.name not in found.columns]
        if missing:
            raise ValueError(f"bronze table {name} lacks {missing}")
        return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def exists(spark: SparkSession, path: str) -> bool:
    """Does the folder exist (on whatever file system the path names)?"""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, with all that is in it."""
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    home.getFileSystem(spark._jsc.hadoopConfiguration()).delete(home, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder of this library's own making."""
    here, there = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(there.getParent())
    if not files.rename(here, there):
        raise OSError(f"cannot rename {path} to {to}")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if it does not exist."""
    home = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(home)) if files.exists(home) else []


def versions(spark: SparkSession, folder: str) -> list:
    """Complete versions of a published table, oldest first."""
    home = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(home):
        return []
    found = [s.getPath() for s in files.listStatus(home) if s.getPath().getName().startswith("version=")]
    mark = lambda p: files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))  # noqa: E731  written last
    return sorted((p for p in found if mark(p)), key=lambda p: p.getName())


def current(spark: SparkSession, folder: str) -> str:
    """The newest complete version of a published table."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no complete version of a table in {folder}")
    return found[-1].toString()


def publish(df: DataFrame, folder: str, partition_by: tuple[str, ...] = (), keep: int = 2) -> str:
    """Write a new version of a table and return its path; all but the newest `keep` versions are removed.

    Readers see the version before until the new one is complete, also if the write fails.
    """
    spark = df.sparkSession
    path = f"{folder}/{new_version()}"
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    for old in versions(spark, folder)[:-keep]:
        remove(spark, old.toString())
    return path


def new_version() -> str:
    return f"version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def table_path(spark: SparkSession, folder: str) -> str:
    """Where a table lies that may have versions: its newest one, or the folder itself."""
    found = versions(spark, folder)
    return found[-1].toString() if found else folder


def overwrite(df: DataFrame, folder: str, partition_by: tuple[str, ...] = ()) -> str:
    """Replace the whole table, schema included; read it through ``table_path``.

    The new rows are a version beside the one before, which stays as it is until the next replacement: open readers finish, a
    failed write changes nothing, and df may read the table that it replaces. Files of a table without versions go
    with the second replacement.
    """
    spark = df.sparkSession
    path = publish(df, folder, partition_by)
    if len(versions(spark, folder)) > 1:
        for name in children(spark, folder):
            if not name.startswith("version="):
                remove(spark, f"{folder}/{name}")
    return path


# A table in parts ----------------------------------------------------------------------------------

PART = "_part"


def _parts(spark: SparkSession, folder: str) -> dict[str, str]:
    """Part -> folder of its newest version, by the newest manifest (a row per part)."""
    if not versions(spark, f"{folder}/manifest"):
        return {}
    return {r.part: r.path for r in spark.read.schema("part string, path string").parquet(current(spark, f"{folder}/manifest")).collect()}


def read_parts(spark: SparkSession, folder: str, schema: T.StructType, only: Iterable[str] | None = None) -> DataFrame:
    """A table in parts as its newest manifest has it; with `only`, no other part's files are read or listed."""
    held = _parts(spark, folder)
    paths = [path for part, path in held.items() if only is None or part in set(only)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_parts(batch: DataFrame, folder: str, keys: Iterable[str], part: Column, grace: float = 3600.0) -> list[str]:
    """Put the rows of a batch in the place of those with the same keys; return the parts that were written anew.

    `part` is a date of the row that its keys determine. Only the parts that the batch touches are read and written, as new
    versions; a manifest names the version of every part, and appears when all of them are complete. Readers thus see the
    table before or after the batch. What no manifest names that is kept (the last two, and those younger than `grace`
    seconds) is removed. A batch that is repeated changes nothing.
    """
    spark, keys, schema, version = batch.sparkSession, list(keys), batch.schema, new_version()
    staged = f"{folder}/staged/{version}"
    dealt = batch.withColumn(PART, F.coalesce(part.cast("date").cast("string"), F.lit("none")))
    dealt.write.partitionBy(PART).parquet(staged)  # the batch is computed once
    touched = [name.split("=", 1)[1] for name in children(spark, staged) if name.startswith(f"{PART}=")]
    if touched:
        full = T.StructType([*schema, T.StructField(PART, T.StringType())])
        new = spark.read.schema(full).parquet(staged)
        held = read_parts(spark, folder, schema, touched)
        held = held.withColumn(PART, F.coalesce(part.cast("date").cast("string"), F.lit("none")))
        changed = new.select(*[F.col(c).alias(f"_new_{c}") for c in keys])
        kept = held.join(changed, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in keys], "left_anti")
        kept.unionByName(new).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{folder}/parts/{version}")
        paths = _parts(spark, folder) | {p: f"{folder}/parts/{version}/{PART}={p}" for p in touched}
        named = [f"named_struct('part', '{p}', 'path', '{path}')" for p, path in sorted(paths.items())]  # no quotes in either
        spark.range(0, 1, 1, 1).selectExpr(f"inline(array({', '.join(named)}))").write.parquet(f"{folder}/manifest/{new_version()}")
        _prune(spark, folder, grace)
    remove(spark, staged)
    return touched


def _prune(spark: SparkSession, folder: str, grace: float) -> None:
    """Remove manifests that are neither among the last two nor young, and the parts that no manifest names any more."""
    found = versions(spark, f"{folder}/manifest")
    young = time.time_ns() - int(grace * 1e9)
    gone = [m for m in found[:-2] if int(m.getName().split("=")[1].split("-")[0]) < young]
    if not gone:
        return
    for manifest in gone:
        remove(spark, manifest.toString())
    named = spark.read.schema("part string, path string").parquet(*[m.toString() for m in versions(spark, f"{folder}/manifest")])
    used = {tuple(r.path.split("/")[-2:]) for r in named.select("path").distinct().collect()}
    for version in children(spark, f"{folder}/parts"):
        parts = [p for p in children(spark, f"{folder}/parts/{version}") if p.startswith(f"{PART}=")]
        for p in parts:
            if (version, p) not in used:
                remove(spark, f"{folder}/parts/{version}/{p}")
        if all((version, p) not in used for p in parts):
            remove(spark, f"{folder}/parts/{version}")


def create_empty_like(df: DataFrame, path: str) -> str:
    """An empty table with the schema of the frame."""
    df.limit(0).write.mode("errorifexists").parquet(path)
    return path


def copy_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Idempotent copy of tables to ``<root>/<name>``, side by side; rows are counted by the copy itself."""

    def copy(name: str, df: DataFrame) -> int:
        seen = Observation(f"copy_{name}")
        overwrite(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{name}")
        return int(seen.get["n"])

    rows = side_by_side({name: partial(copy, name, df) for name, df in tables.items()})
    return spark.createDataFrame(list(rows.items()), "table_name string, n bigint")


def drop_source_schema(spark: SparkSession, database: str, confirmed: bool = False) -> bool:
    """Drop a migrated database with everything in it; does nothing unless confirmed."""
    if not confirmed:
        return False
    name = database.replace("`", "``")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    return True
