"""Exact ranks within groups of any size, by range partition.

A window over a group puts the group into one task. Here rows are dealt by range over group and value into a written table, a folder
per range, each sorted. Counts per range and group are a small table; a running sum over it, by range, says how many rows of a
group lie before each range. Positions are that offset plus the place within the range, and a single rank needs only the one range
that holds it: the others are not read.

The ranges are chosen by sampling, so the dealt table is written once and read by every later step. How the ranges fall changes who
does the work, not what comes out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "_range"


def dealt(df: DataFrame, folder: str, group: str, value: str, ranges: int | None = None) -> DataFrame:
    """df as a table of ranges over (group, value) in a new folder; the column ``_range`` numbers them in order.

    Rows of one group and one value stay together: count equal ones first, so that a frequent value is one row.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, F.col(group).asc_nulls_first(), F.col(value).asc_nulls_first())
    rows = rows.withColumn(RANGE, F.spark_partition_id()).sortWithinPartitions(group, value)
    rows.write.partitionBy(RANGE).parquet(folder)
    schema = T.StructType([*df.schema, T.StructField(RANGE, T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(folder)


def offsets(ranged: DataFrame, group: str, weight: Column) -> DataFrame:
    """(group, _range, held, before, all): weight of a group in a range, in the ranges before it, and altogether.

    A row per range and group at most, so the windows see as many rows of a group as there are ranges.
    """
    held = ranged.groupBy(group, RANGE).agg(F.sum(weight).alias("held"))
    of_group = Window.partitionBy(group)
    before = F.sum("held").over(of_group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1))
    return held.select(group, RANGE, "held", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(of_group).alias("all"))


def _within(ranged: DataFrame, placed: DataFrame, group: str) -> DataFrame:
    placed = placed.withColumnRenamed(group, "_group").withColumnRenamed(RANGE, "_of")
    return ranged.join(placed, (F.col(RANGE) == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group"))).drop("_group", "_of")


def cumulated(ranged: DataFrame, group: str, value: str, weight: Column) -> DataFrame:
    """ranged with ``upto``, the weight of the group's rows up to and with this one in order of value, and ``all``."""
    rows = _within(ranged, offsets(ranged, group, weight).drop("held"), group)
    running = F.sum(weight).over(Window.partitionBy(group, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("upto", F.col("before") + running).drop("before", RANGE)


def at_share(ranged: DataFrame, group: str, value: str, weight: Column, percent: int) -> DataFrame:
    """(group, value): the least value that at least `percent` per cent of a group's weight does not exceed; exact.

    Only the range that holds a group's rank is read, all others are pruned. Groups without weight have no row.
    """
    rank = F.greatest(F.lit(1), F.ceil(F.col("all") * percent / 100))
    holds = offsets(ranged, group, weight).withColumn("rank", rank).where("before < rank and rank <= before + held")
    rows = _within(ranged, holds.select(group, RANGE, (F.col("rank") - F.col("before")).alias("left")), group)
    running = F.sum(weight).over(Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("upto", running).where("upto >= left").groupBy(group).agg(F.min_by(value, "upto").alias(value))
