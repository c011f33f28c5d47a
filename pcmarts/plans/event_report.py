"""Extracts of the event-risk report, and the writer that survives a failing section."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pcmarts.functions.money import billions, rounded
from pcmarts.operators.jobs import side_by_side
from pcmarts.operators.shapes import stack
from pcmarts.plans import gold
from pcmarts.plans.registry import high, low, query, top
from pcmarts.plans.reports import by_exposed_tiv, pml_figures, with_exposed_tiv
from pcmarts.workspace import Workspace

# Report label -> event table
COUNTED = {
    "NOAA active alerts": "noaa_alerts", "GDACS catastrophes": "catastrophe_events",
    "USGS earthquakes": "earthquake_events", "Weather obs": "weather_observations", "News items": "news_events",
}


@query("rpt_counts")
def counts(ws: Workspace) -> DataFrame:
    return stack(
        *[ws.table(t).agg(F.lit(label).alias("source"), F.count(F.lit(1)).alias("n")) for label, t in COUNTED.items()]
    )


@query("rpt_alerts_by_severity")
def alerts_by_severity(ws: Workspace) -> DataFrame:
    groups = ws.table("noaa_alerts").groupBy(F.col("severity").alias("_raw")).agg(
        F.count(F.lit(1)).alias("alerts"), F.countDistinct("event_type").alias("distinct_event_types")
    )
    return groups.select(
        F.coalesce("_raw", F.lit("Unknown")).alias("severity"), "alerts", "distinct_event_types"
    ).orderBy(high("alerts"), low("severity"))


@query("rpt_top_exposed_alerts")
def top_exposed_alerts(ws: Workspace) -> DataFrame:
    return top(with_exposed_tiv(ws), 20, *by_exposed_tiv()).select(
        "event_type", "severity", "state_code", "state_name", billions("exposed_tiv_usd").alias("exposed_tiv_busd"),
        "exposed_policy_count", "effective_utc", "expires_utc",
    )


@query("rpt_top_pml_events")
def top_pml_events(ws: Workspace) -> DataFrame:
    return gold.worst_pml(ws, 15).select(
        "title", "event_type", "severity", "state_code", "event_time_utc", *pml_figures()
    )


@query("rpt_earthquakes")
def strongest_earthquakes(ws: Workspace) -> DataFrame:
    return top(ws.table("earthquake_events"), 10, high("magnitude"), low("event_id")).select(
        "place", "magnitude", "depth_km", "event_time_utc", "severity"
    )


@query("rpt_weather_extremes")
def weather_extremes(ws: Workspace) -> DataFrame:
    gust = F.coalesce("wind_gust_mph", F.lit(0.0)).desc()
    return top(ws.table("weather_observations"), 15, gust, low("observation_id")).select(
        "city", rounded("temperature_f", 1).alias("temp_f"), rounded("wind_speed_mph", 1).alias("wind_mph"),
        rounded("wind_gust_mph", 1).alias("gust_mph"), rounded("precipitation_in", 2).alias("precip_in"),
        rounded("humidity_pct", 0).alias("humidity_pct"), "observed_time_utc",
    )


@query("rpt_news")
def latest_news(ws: Workspace) -> DataFrame:
    """Latest by the parsed publication time (the text form does not sort by time)."""
    return top(ws.table("news_events"), 12, high("published_ts"), low("news_id")).select(
        "title", "category", "published_utc", "link"
    )


def trimmed(c: Column | str, n: int) -> Column:
    """Text of at most n characters; a cut text ends in an ellipsis; NULL becomes empty."""
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 1), F.lit("…"))).otherwise(text)


@query("rpt_text_trim")
def trimmed_summaries(ws: Workspace) -> DataFrame:
    return ws.table("news_events").select("news_id", trimmed("summary", 120).alias("summary"))


SECTIONS: dict[str, Callable[[Workspace], DataFrame]] = {
    "counts": counts, "alerts_by_severity": alerts_by_severity, "top_exposed_alerts": top_exposed_alerts,
    "top_pml_events": top_pml_events, "earthquakes": strongest_earthquakes, "weather_extremes": weather_extremes,
    "news": latest_news,
}


def write_report(
    ws: Workspace, folder: str, sections: dict[str, Callable[[Workspace], DataFrame]] | None = None
) -> DataFrame:
    """Write every section as a table under the folder, side by side; a section that fails is reported, not raised.

    Returns (section, status, rows, message). The row count is observed while the section is written.
    """
    def write(name: str, build: Callable[[Workspace], DataFrame]) -> tuple:
        seen = Observation(f"report_{name}")
        try:
            build(ws).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/{name}")
            return name, "ok", int(seen.get["n"]), None
        except Exception as problem:  # noqa: BLE001  (any failure of one section must not stop the report)
            return name, "failed", 0, str(problem).splitlines()[0]

    log = list(side_by_side({name: partial(write, name, build) for name, build in (sections or SECTIONS).items()}).values())
    return ws.spark.createDataFrame(log, "section string, status string, rows bigint, message string")
