"""Registered queries over feeds: parsing, classification, ingest, sources and sinks, text scan, streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.functions import classify
from pcmarts.functions.dates import as_instant, as_mail_instant
from pcmarts.functions.money import as_public
from pcmarts.functions.textscan import sql_lines
from pcmarts.operators.jobs import side_by_side
from pcmarts.operators.ingest import freshness, latest_per_key, merge_new, unseen
from pcmarts.operators.shapes import stack
from pcmarts.plans import event_report, gold, silver
from pcmarts.plans.registry import query
from pcmarts.sources import payloads
from pcmarts.sources.landing import land, landed, list_landing
from pcmarts.sources.schemas import FEEDS
from pcmarts.sources.tables import copy_tables, create_empty_like, overwrite, scratch, table_path
from pcmarts.streaming import feeds as streams
from pcmarts.workspace import Workspace

# --- payload parsing ----------------------------------------------------------------------------


@query("feed_weather_parse")
def parsed_weather(ws: Workspace) -> DataFrame:
    rows = payloads.weather(ws.bronze("raw_payloads/weather"))
    return rows.withColumn("observed_time_utc", as_instant("observed_time_utc"))


@query("feed_earthquake_parse")
def parsed_earthquakes(ws: Workspace) -> DataFrame:
    rows = payloads.earthquakes(ws.bronze("raw_payloads/earthquakes"))
    return rows.withColumn("event_time_utc", as_instant("event_time_utc"))


@query("feed_gdacs_parse")
def parsed_catastrophes(ws: Workspace) -> DataFrame:
    rows = payloads.catastrophes(ws.bronze("raw_payloads/catastrophes"))
    return rows.withColumn("event_time_utc", as_mail_instant("event_time_utc"))


@query("feed_news_parse")
def parsed_news(ws: Workspace) -> DataFrame:
    return payloads.news(ws.bronze("raw_payloads/news"))


@query("feed_noaa_parse")
def parsed_alerts(ws: Workspace) -> DataFrame:
    rows = payloads.alerts(ws.bronze("raw_payloads/noaa_alerts"))
    return rows.withColumns({c: as_instant(c) for c in ("sent_utc", "effective_utc", "expires_utc")})


@query("feed_payload_guard")
def unusable_answers(ws: Workspace) -> DataFrame:
    answers = stack(*[ws.bronze(f"raw_payloads/{feed}") for feed in payloads.PARSERS])
    return payloads.quarantine(answers).groupBy("feed", "reason").agg(
        F.count(F.lit(1)).alias("answers")
    )


@query("feed_accepted")
def accepted_answers(ws: Workspace) -> DataFrame:
    """Rows and quarantined answers of each feed, both from one parse of its answers."""
    root = scratch(ws.spark, "accepted")
    parts = side_by_side({f: lambda f=f: payloads.accepted(ws.bronze(f"raw_payloads/{f}"), f, f"{root}/{f}") for f in payloads.PARSERS})
    sizes = [
        stack(rows.select(F.lit(1).alias("accepted")), bad.select(F.lit(1).alias("refused"))).agg(
            F.lit(feed).alias("feed"), F.count("accepted").alias("item_rows"), F.count("refused").alias("quarantined")
        )
        for feed, (rows, bad) in parts.items()
    ]
    return stack(*sizes)


@query("feed_page_tags")
def page_tags(ws: Workspace) -> DataFrame:
    """The tag patterns on whole web pages."""
    return ws.bronze("pages").select(
        "page_id", payloads.tag("html", "title").alias("title"),
        F.size(F.regexp_extract_all("html", F.lit("(?s)<p>(.*?)</p>"), F.lit(1))).alias("paragraphs"),
    )


# --- classification -----------------------------------------------------------------------------


@query("cls_earthquake_severity")
def earthquake_severities(ws: Workspace) -> DataFrame:
    return ws.bronze("earthquakes").select(
        "event_id", "magnitude", classify.earthquake_severity("magnitude").alias("severity")
    )


@query("cls_alert_colour")
def alert_colours(ws: Workspace) -> DataFrame:
    return ws.bronze("catastrophe_events").select(
        "event_id", "title", classify.alert_colour("title").alias("severity")
    )


@query("cls_catastrophe_type")
def catastrophe_types(ws: Workspace) -> DataFrame:
    return ws.bronze("catastrophe_events").groupBy(classify.catastrophe_type("title").alias("event_type")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("cls_news_category")
def news_categories(ws: Workspace) -> DataFrame:
    return ws.bronze("news").select("news_id", "title", classify.news_category("title").alias("category"))


# --- ingest -------------------------------------------------------------------------------------


@query("ing_dedupe_incoming")
def deduped_deliveries(ws: Workspace) -> DataFrame:
    keyed = ws.bronze("deliveries").filter(F.col("alert_id").isNotNull())
    return latest_per_key(keyed, "alert_id")


@query("snk_append_new")
def appendable_alerts(ws: Workspace) -> DataFrame:
    """What an ingest would append to a table that already holds every second alert."""
    held = ws.bronze("noaa_alerts").filter("cast(alert_id as bigint) % 2 = 0")
    return unseen(deduped_deliveries(ws), held, "alert_id").select("alert_id", "headline")


def _two_runs(ws: Workspace, root: str) -> tuple[DataFrame, DataFrame]:
    """Land the deliveries in two runs that overlap."""
    deliveries = ws.bronze("deliveries")
    number = F.coalesce(F.col("alert_id").cast("bigint"), F.lit(0))
    first, second = deliveries.filter(number % 4 != 0), deliveries.filter(number % 4 < 2)
    land(first, root, "noaa_alerts", "20240101T000000Z")
    land(second, root, "noaa_alerts", "20240101T010000Z")
    return first, second


@query("ing_merge_feed")
def merged_alerts(ws: Workspace) -> DataFrame:
    """Two landed runs and a repeat, merged into a bronze table: each key once, as first seen."""
    root = scratch(ws.spark, "merge")
    _, key = FEEDS["noaa_alerts"]
    runs = _two_runs(ws, root)
    for batch in (*runs, runs[0]):
        merge_new(ws.spark, batch, f"{root}/bronze/noaa_alerts", key, f"{root}/rejected/noaa_alerts")
    return ws.spark.read.parquet(f"{root}/bronze/noaa_alerts")


@query("ing_counts")
def merge_counts(ws: Workspace) -> DataFrame:
    """Scanned, rejected, appended and total rows of two runs per feed, and over all feeds."""
    root = scratch(ws.spark, "counts")

    def two_runs(feed: str, table: str, key: str) -> list[tuple]:
        incoming = ws.bronze("deliveries" if feed == "noaa_alerts" else table)
        number = F.coalesce(F.col(key).cast("bigint"), F.lit(0))
        found = []
        for run, batch in enumerate((incoming.filter(number % 4 != 0), incoming), start=1):
            c = merge_new(ws.spark, batch, f"{root}/bronze/{table}", key, f"{root}/rejected/{table}")
            found.append((feed, run, c.scanned, c.rejected, c.appended, c.total))
        return found

    rows = sum(side_by_side({feed: partial(two_runs, feed, *names) for feed, names in FEEDS.items()}).values(), [])
    per_feed = ws.spark.createDataFrame(
        rows, "feed string, run int, scanned bigint, rejected bigint, appended bigint, total bigint"
    )
    sums = [F.sum(c).alias(c) for c in ("scanned", "rejected", "appended", "total")]
    return stack(per_feed, per_feed.groupBy("run").agg(F.lit("all").alias("feed"), *sums))


@query("ing_freshness")
def feed_freshness(ws: Workspace) -> DataFrame:
    feeds = {feed: (ws.bronze(table), "fetched_at_utc") for feed, (table, _) in FEEDS.items()}
    return freshness(
        feeds | {
            "pc_solvency_metrics": (ws.table("pc_solvency_metrics"), "reporting_date"),
            "pc_combined_ratios": (ws.table("pc_combined_ratios"), "reporting_quarter"),
        }
    )


# --- sources and sinks --------------------------------------------------------------------------


@query("src_bronze_view")
def bronze_counts(ws: Workspace) -> DataFrame:
    """Rows of each bronze table that feeds silver."""
    names = sorted({s.bronze for n, s in silver.TABLES.items() if n not in silver.STATIC})
    return stack(
        *[ws.bronze(n).agg(F.lit(n).alias("view_name"), F.count(F.lit(1)).alias("n")) for n in names]
    )


@query("src_parquet_dir")
def landed_alerts(ws: Workspace) -> DataFrame:
    """All landed files of a feed read as one table."""
    root = scratch(ws.spark, "landing")
    _two_runs(ws, root)
    return landed(ws.spark, root, "noaa_alerts").groupBy("event_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("src_list_landing")
def landed_runs(ws: Workspace) -> DataFrame:
    """Runs found by listing a landing folder, and a feed that never landed."""
    root = scratch(ws.spark, "listing")
    _two_runs(ws, root)
    sizes = landed(ws.spark, root, "noaa_alerts").agg(F.count(F.lit(1)).alias("n"))
    runs = [list_landing(ws.spark, root, f).agg(F.lit(f).alias("feed"), F.countDistinct("run").cast("int").alias("runs")) for f in ("noaa_alerts", "news")]
    return stack(*runs).select("feed", "runs", sizes.scalar().alias("landed_rows"))


@query("snk_create_empty_like")
def emptied_alerts(ws: Workspace) -> DataFrame:
    """A new table with the schema of the feed, then one append."""
    path = create_empty_like(ws.bronze("noaa_alerts"), scratch(ws.spark, "empty"))
    created = ws.spark.read.parquet(path).count()
    ws.bronze("noaa_alerts").write.mode("append").parquet(path)
    return ws.spark.read.parquet(path).agg(
        F.lit(created).cast("bigint").alias("created_rows"), F.count(F.lit(1)).alias("appended_rows")
    )


@query("rpt_safe_section")
def report_log(ws: Workspace) -> DataFrame:
    """The event report written section by section; one section is made to fail."""

    def failing(ws: Workspace) -> DataFrame:
        return ws.table("noaa_alerts").select("a_column_that_is_gone")

    sections = {"broken": failing} | event_report.SECTIONS
    return event_report.write_report(ws, scratch(ws.spark, "report"), sections).select("section", "status", "rows")


@query("snk_land_feed_file")
def landed_weather(ws: Workspace) -> DataFrame:
    """A parsed feed written as one run and read back."""
    root = scratch(ws.spark, "land")
    land(payloads.weather(ws.bronze("raw_payloads/weather")), root, "weather", "20240101T000000Z")
    return landed(ws.spark, root, "weather").groupBy("city", "cresta_zone").agg(F.count(F.lit(1)).alias("n"))


@query("src_literal_table")
def factors_in_use(ws: Workspace) -> DataFrame:
    """Catastrophe events per type next to the fixed factor of the type."""
    factors = ws.spark.createDataFrame(list(gold.PERIL_FACTORS.items()), "event_type string, severity_factor double")
    seen = ws.table("catastrophe_events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return seen.join(F.broadcast(factors), "event_type", "left")  # seven fixed rows


@query("snk_overwrite_table")
def rewritten_book(ws: Workspace) -> DataFrame:
    """A mart written twice to the same place: the second write replaces the first."""
    path = scratch(ws.spark, "overwrite")
    overwrite(ws.table("claims_summary"), path)
    overwrite(ws.table("book_health"), path)
    return ws.spark.read.parquet(table_path(ws.spark, path))


@query("snk_ctas_copy")
def copied_tables(ws: Workspace) -> DataFrame:
    """The ten EUR tables copied, with their row counts."""
    names = [n for n in silver.TABLES if n.startswith("pc_")]
    return copy_tables(ws.spark, {n: as_public(ws.bronze(n)) for n in names}, scratch(ws.spark, "copy"))


# --- text scan ----------------------------------------------------------------------------------


@query("txt_sql_in_text")
def lines_with_sql(ws: Workspace) -> DataFrame:
    # the outer form keeps the scan from being run a second time as a derived filter
    lines = ws.bronze("notes").select("doc_id", F.explode_outer(sql_lines("text")).alias("line"))
    return lines.filter(F.col("line").isNotNull())


@query("txt_sql_per_source")
def texts_with_sql(ws: Workspace) -> DataFrame:
    """Offending lines per text table, over whole texts: pages and conversations as they are, documents with notes."""
    sources = {"notes": "text", "conversations": "text", "pages": "html"}
    return stack(
        *[
            ws.bronze(name).agg(
                F.lit(name).alias("source"), F.count(F.lit(1)).alias("texts"),
                F.coalesce(F.sum(F.size(sql_lines(c)).cast("bigint")), F.lit(0)).alias("sql_lines"),
            )
            for name, c in sources.items()
        ]
    )


# --- streams ------------------------------------------------------------------------------------


def streaming(ws: Workspace) -> Workspace:
    """The same workspace with the event table read as a stream."""
    return Workspace(ws.spark, ws.bronze_reader.as_stream("events"), as_of=ws.as_of)


def _drained(ws: Workspace, name: str, df: DataFrame) -> DataFrame:
    root = scratch(ws.spark, name)
    streams.drain(df, f"{root}/out", f"{root}/checkpoint")
    return ws.spark.read.schema(df.schema).parquet(f"{root}/out")


@query("stm_feed_ingest")
def streamed_ingest(ws: Workspace) -> DataFrame:
    """Two landed runs, picked up by two stream runs; the second finds only the new file."""
    root = scratch(ws.spark, "ingest")
    deliveries = ws.bronze("deliveries")
    number = F.coalesce(F.col("alert_id").cast("bigint"), F.lit(0))
    for stamp, part in (("20240101T000000Z", number % 4 != 0), ("20240101T010000Z", number % 4 < 2)):
        land(deliveries.filter(part), root, "noaa_alerts", stamp)
        target = streams.ingest_feed(ws.spark, root, "noaa_alerts", archive=f"{root}/archive")
    return ws.spark.read.parquet(target)


@query("stm_alert_exposure")
def streamed_exposure(ws: Workspace) -> DataFrame:
    """Stream of alerts against the exposure per state as it stands when a batch comes."""
    root = scratch(ws.spark, "exposure")

    def exposed(batch: DataFrame) -> DataFrame:
        return gold.alert_exposure(ws.reopened(), batch)

    return streams.drain_with(streaming(ws).table("noaa_alerts"), exposed, f"{root}/out", f"{root}/checkpoint")


@query("stm_alerts_hourly")
def streamed_hours(ws: Workspace) -> DataFrame:
    root = scratch(ws.spark, "hourly")
    hours = streams.hourly_alerts(streaming(ws).table("noaa_alerts"))
    return streams.drain_by_key(hours, ("hour_start", "severity"), F.col("hour_start"), f"{root}/out", f"{root}/checkpoint")


@query("stm_dedupe")
def streamed_first_deliveries(ws: Workspace) -> DataFrame:
    """Every alert delivered three times within the hour; one survives."""
    alerts = streaming(ws).table("noaa_alerts").select("alert_id", "event_type", "severity", "effective_utc")
    again = alerts.withColumn("delivery", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn(
        "delivered_utc", F.col("effective_utc") + F.col("delivery") * F.expr("interval 20 minutes")
    )
    kept = streams.first_delivery(again, "alert_id", "delivered_utc")
    return _drained(ws, "dedupe", kept.select("alert_id", "event_type", "severity", "delivered_utc"))
