"""The hourly run: stored partial results of the feeds, merged with what has been appended since.

Feeds are insert-only, so what a report needs of them can be kept. A partial result is a folder of increments per feed. An increment
is computed from the change versions that the ingest left since the last one (``KeyIndex.changes``) and named after
the newest of them; it appears when it is complete, and computing it again gives the same. The result of a report is
its increments put together, so an hour costs the hour's rows and the partials, not the feed.

Counts add up. Distinct counts are kept as the groups that they count. Alerts are kept with the states that they
name; the exposure of a state is looked up when the report is read, since it changes with the book and not with the feed.
A new list of states needs ``rebuild=True``, and so does any change of a feed other than by the ingest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.operators.ingest import KeyIndex, merge_new
from pcmarts.operators.jobs import side_by_side
from pcmarts.operators.shapes import mentions, stack
from pcmarts.plans import event_report, gold, silver
from pcmarts.plans.registry import high, low, query
from pcmarts.sources.schemas import FEEDS
from pcmarts.sources.tables import children, exists, remove, scratch, table_path
from pcmarts.workspace import Workspace

KEYS = dict(FEEDS.values())  # bronze table -> its key
START = "version=0"  # an increment of a feed that the ingest had left no changes of
COMPACT_AFTER = 50
ALERT = ("alert_id", "event_type", "severity", "urgency", "effective_utc", "expires_utc")


@dataclass(frozen=True)
class Partial:
    """What is kept of a silver table: ``of`` its new rows, and how kept rows of one group (``by``) add up; () keeps all rows."""

    name: str
    table: str
    of: Callable[[Workspace], DataFrame]
    by: tuple[str, ...] = ()

    @property
    def bronze(self) -> str:
        return silver.TABLES[self.table].bronze

    def merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by).agg(F.sum("n").alias("n")) if self.by else rows


def _counted(table: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: ws.table(table).groupBy(F.lit(table).alias("table_name")).agg(F.count(F.lit(1)).alias("n"))


def _severities(ws: Workspace) -> DataFrame:
    return ws.table("noaa_alerts").groupBy("severity", "event_type").agg(F.count(F.lit(1)).alias("n"))


def _named_states(ws: Workspace) -> DataFrame:
    alerts = ws.table("noaa_alerts").select(*ALERT, "area_desc")
    return mentions(alerts, "area_desc", gold.states_of(ws), "state_name", "state_code").select(*ALERT, "state_code", "state_name")


COUNTS = {t: Partial(f"counts/{t}", t, _counted(t), ("table_name",)) for t in event_report.COUNTED.values()}
SEVERITIES = Partial("alerts_by_severity", "noaa_alerts", _severities, ("severity", "event_type"))
STATES = Partial("alert_states", "noaa_alerts", _named_states)


def _folder(ws: Workspace, partial: Partial) -> str:
    if not ws.root:
        raise ValueError("this workspace has no root folder to keep increments in")
    return f"{ws.root.rstrip('/')}/partials/{partial.name}"


def _increments(ws: Workspace, partial: Partial) -> list[str]:
    """Complete increments that count: the last compacted one, which holds all before it, and those after it."""
    folder = _folder(ws, partial)
    found = [n for n in children(ws.spark, folder) if exists(ws.spark, f"{folder}/{n}/_SUCCESS")]
    return found[max((k for k, n in enumerate(found) if n.endswith("+")), default=0) :]


def delta(ws: Workspace, partial: Partial, feed: str) -> tuple[DataFrame, str] | None:
    """(rows to be added, name of their increment), from the changes of the bronze folder ``feed`` since the last increment; None: no change."""
    spark, index, held = ws.spark, KeyIndex(ws.spark, feed, KEYS[partial.bronze]), _increments(ws, partial)
    changes = index.changes()
    if not held:
        rows = ws.bronze_reader(partial.bronze)
    else:
        last = held[-1].removesuffix("+")
        new = [c for c in changes if c > last]
        if not new:
            return None
        if len(new) == len(changes) and index.pruned():
            raise LookupError(f"changes after {last} of {partial.bronze} are gone: rebuild")
        full = ws.bronze_reader(partial.bronze)
        rows = spark.read.schema(full.schema).parquet(*[f"{index.log}/{c}" for c in new])
    reader = lambda name: rows if name == partial.bronze else ws.bronze_reader(name)
    return partial.of(Workspace(spark, reader, ws.as_of)), max(changes, default=START)


def advance(ws: Workspace, partial: Partial, feed: str, rebuild: bool = False) -> DataFrame:
    """Bring a partial result up to date with the feed's bronze folder and return it, added up."""
    spark, folder = ws.spark, _folder(ws, partial)
    if rebuild:
        remove(spark, folder)
    step = delta(ws, partial, feed)
    if step is not None:
        rows, name = step
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    held = _increments(ws, partial)
    schema = spark.read.parquet(f"{folder}/{held[-1]}").schema
    read = lambda names: partial.merged(spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names]))
    if partial.by and len(held) > COMPACT_AFTER:
        whole = f"{held[-1].removesuffix('+')}+"
        read(held).write.mode("overwrite").parquet(f"{folder}/{whole}")
        held = [whole]
    return read(held)


def counts(ws: Workspace, feeds: dict[str, str]) -> DataFrame:
    """``rpt_counts`` from the counts kept of each feed; feeds: the bronze folder of each event table's feed."""
    kept = side_by_side({t: lambda t=t, p=p: advance(ws, p, feeds[t]) for t, p in COUNTS.items()})
    labels = [
        rows.agg(F.lit(label).alias("source"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        for label, rows in ((label, kept[t]) for label, t in event_report.COUNTED.items())
    ]
    return stack(*labels)


def alerts_by_severity(ws: Workspace, feed: str) -> DataFrame:
    """``rpt_alerts_by_severity`` from the groups kept."""
    groups = advance(ws, SEVERITIES, feed).groupBy(F.col("severity").alias("_raw")).agg(
        F.sum("n").alias("alerts"), F.countDistinct("event_type").alias("distinct_event_types")
    )
    return groups.select(F.coalesce("_raw", F.lit("Unknown")).alias("severity"), "alerts", "distinct_event_types").orderBy(high("alerts"), low("severity"))


def event_risk(ws: Workspace, feed: str) -> DataFrame:
    """``gld_event_risk_correlation`` from the states kept of each alert, with the exposure of now."""
    exposure = ws.table("exposure_by_state").select(
        F.col("state_code").alias("_code"), F.col("state_tiv_usd").alias("exposed_tiv_usd"), F.col("state_policy_count").alias("exposed_policy_count"),
    )
    rows = advance(ws, STATES, feed).join(exposure, F.col("state_code") == F.col("_code"), "left")
    return rows.select(*ALERT, "state_code", "state_name", "exposed_tiv_usd", "exposed_policy_count")


# --- queries ------------------------------------------------------------------------------------


def _in_three_runs(ws: Workspace, name: str, report: Callable[[Workspace, str], DataFrame]) -> DataFrame:
    """The alerts ingested in three runs, the report brought up to date after each; what it says in the end."""
    root = scratch(ws.spark, name)
    feed = f"{root}/bronze/noaa_alerts"
    reader = lambda t: ws.spark.read.parquet(table_path(ws.spark, feed)) if t == "noaa_alerts" else ws.bronze_reader(t)
    hourly = Workspace(ws.spark, reader, ws.as_of, root)
    for run in range(3):
        number = F.coalesce(F.col("alert_id").cast("bigint"), F.lit(0))
        batch = ws.bronze("noaa_alerts").filter(number % 3 <= run)  # the later runs bring known alerts again
        merge_new(ws.spark, batch, feed, "alert_id", f"{root}/rejected/noaa_alerts")
        found = report(hourly, feed)
    return found


@query("inc_alerts_by_severity")
def severities_in_three_runs(ws: Workspace) -> DataFrame:
    return _in_three_runs(ws, "severities", alerts_by_severity)


@query("inc_event_risk_correlation")
def event_risk_in_three_runs(ws: Workspace) -> DataFrame:
    return _in_three_runs(ws, "event_risk", event_risk)
