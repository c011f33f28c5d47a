import json
import time

import pytest
from pyspark.sql import functions as F

from pcmarts.sources import payloads
from pcmarts.sources.landing import feed_folder, land, landed, list_landing, run_stamp
from pcmarts.sources.schemas import RAW_PAYLOAD, SCHEMAS
from pcmarts.operators.ingest import KeyIndex, merge_new
from pcmarts.plans import event_report, gold, increments, silver
from pcmarts.sources.tables import (
    Layers, ParquetBronze, copy_tables, create_empty_like, drop_source_schema, overwrite, publish, read_parts, table_path, upsert_parts,
)
from pcmarts.workspace import Workspace
from pcmarts.streaming import feeds as streams


@pytest.fixture
def raw(spark):
    def make(feed, *answers, request=None, status=200):
        return spark.createDataFrame([(feed, request, "2024-01-01T00:00:00Z", status, a) for a in answers], RAW_PAYLOAD)

    return make


def feature(i, **properties):
    return {"id": f"f{i}", "properties": properties, "geometry": {"coordinates": [10.0, 20.0, 5.5]}}


def test_earthquakes(raw):
    body = {"features": [feature(1, mag=6.5, time=1704164645000, place="here"), feature(2, mag=6.49), {"id": "f3"}]}
    got = {r.event_id: r for r in payloads.earthquakes(raw("earthquakes", json.dumps(body))).collect()}
    assert (got["f1"].severity, got["f1"].longitude, got["f1"].latitude, got["f1"].depth_km) == ("high", 10.0, 20.0, 5.5)
    assert got["f1"].event_time_utc.startswith("2024-01-02T03:04:05")
    assert (got["f2"].severity, got["f2"].event_time_utc[:10]) == ("moderate", "1970-01-01")
    assert (got["f3"].magnitude, got["f3"].longitude) == (None, None)


def test_bad_answers_give_no_rows_but_a_quarantine_entry(raw):
    for feed in payloads.JSON_SCHEMAS:
        bad = raw(feed, '{"features": [{"id": "x"', "not json")
        assert payloads.PARSERS[feed](bad).count() == 0
        assert [r.reason for r in payloads.quarantine(bad).collect()] == ["malformed json"] * 2
        down = raw(feed, '{"features": [{"id": "x"}], "current": {}}', status=503)
        assert payloads.PARSERS[feed](down).count() == 0
        assert payloads.quarantine(down).first().reason == "bad status"
    for feed in payloads.RSS_FEEDS:
        bad = raw(feed, "<html>busy</html>", None)
        assert payloads.PARSERS[feed](bad).count() == 0
        assert sorted(r.reason for r in payloads.quarantine(bad).collect()) == ["no payload", "not a feed document"]
    assert payloads.quarantine(raw("noaa_alerts", '{"title": "no features"}')).count() == 0


@pytest.mark.parametrize("feed,table", [("earthquakes", "earthquakes"), ("noaa_alerts", "noaa_alerts"), ("catastrophes", "catastrophe_events"),
                                        ("news", "news"), ("weather", "weather_obs")])
def test_parsed_columns_are_the_bronze_columns(raw, feed, table):
    parsed = payloads.PARSERS[feed](raw(feed, "{}"))
    assert ", ".join(f"{n} {t}" for n, t in parsed.dtypes) == SCHEMAS[table]


def test_all_alert_features_of_an_answer_are_taken(raw):
    body = json.dumps({"features": [feature(i, event="Flood", areaDesc="Dade, FL", sent="2024-01-01T00:00:00-05:00") for i in range(301)]})
    got = payloads.alerts(raw("noaa_alerts", body))
    assert got.count() == 301
    assert got.first().area_desc == "Dade, FL"


def test_a_malformed_answer_is_quarantined_and_yields_nothing(raw):
    body = json.dumps({"features": [feature(1, mag=5.0), feature(2, mag="strong")]})
    assert payloads.earthquakes(raw("earthquakes", body)).count() == 0
    assert payloads.quarantine(raw("earthquakes", body)).first().reason == "malformed json"


@pytest.mark.parametrize("feed", ["weather", "earthquakes", "catastrophes", "noaa_alerts", "news"])
def test_rows_and_quarantine_come_from_one_parse(raw, rows, tmp_path, monkeypatch, feed):
    fine = json.dumps({"features": [feature(1, mag=5.0)], "current": {"time": "t"}}) if feed in payloads.JSON_SCHEMAS else rss(3)
    answers = raw(feed, fine, None, "{broken", "<html>busy</html>", request="Miami, FL").unionByName(raw(feed, fine, status=503)).unionByName(raw("other", fine))
    parses = []
    real = payloads.F.from_json
    monkeypatch.setattr(payloads.F, "from_json", lambda *a: parses.append(a) or real(*a))
    got, bad = payloads.accepted(answers, feed, str(tmp_path / "a"))
    assert len(parses) == (feed in payloads.JSON_SCHEMAS)
    monkeypatch.undo()
    assert rows(got) == rows(payloads.PARSERS[feed](answers)) != []
    assert rows(bad) == rows(payloads.quarantine(answers.filter(F.col("feed") == feed))) and bad.count() == 4
    assert "from_json" not in got._jdf.queryExecution().executedPlan().toString()


def test_items_without_link_title_and_date_keep_apart(raw):
    body = "<rss><item><description>a</description></item><item><description>b</description></item></rss>"
    assert payloads.news(raw("news", body)).select("news_id").distinct().count() == 2
    assert payloads.catastrophes(raw("catastrophes", body)).select("event_id").distinct().count() == 2


def rss(n, extra=""):
    return "<rss>" + "".join(
        f"<item>\n<title> EQ {i} \n</title><description>{'d' * 600}\nx</description><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate>{extra}"
        f"<link>https://x.test/{i}</link></item>" for i in range(n)
    ) + "</rss>"


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 1), (250, 250)])
def test_catastrophe_items(raw, n, expected):
    assert payloads.catastrophes(raw("catastrophes", rss(n))).count() == expected


def test_catastrophe_fields(raw):
    row = payloads.catastrophes(raw("catastrophes", rss(1, "<geo:lat> 1.5 </geo:lat><geo:long>x</geo:long>"))).first()
    assert (row.title, row.event_type, len(row.description), row.latitude, row.longitude) == ("EQ 0", "Earthquake", 602, 1.5, None)
    again = payloads.catastrophes(raw("catastrophes", rss(1))).first()
    assert again.event_id == row.event_id  # a re-fetched item keeps its key
    assert again.latitude is None


def test_news_items(raw):
    assert payloads.news(raw("news", rss(250))).count() == 250
    row = payloads.news(raw("news", "<item><title><![CDATA[War]]></title></item>")).first()
    assert (row.title, row.category, row.summary, row.link) == ("<![CDATA[War]]>", "Conflict", "", "")


def test_weather(raw):
    body = json.dumps({"current": {"time": "2024-01-02T03:00", "temperature_2m": 70.5, "weather_code": 3}})
    row = payloads.weather(raw("weather", body, request="Charleston, SC")).first()
    assert (row.cresta_zone, row.latitude, row.temperature_f, row.wind_gust_mph) == ("USA-SC-1", 32.7765, 70.5, None)
    assert payloads.weather(raw("weather", body, request="Atlantis")).first().latitude is None


def alert(i, **more):
    return {"alert_id": i, "event_type": "Flood", "fetched_at_utc": "2024-01-01T00:00:00Z"} | more


def alerts(spark, *rows):
    columns = [c.split()[0] for c in SCHEMAS["noaa_alerts"].split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], SCHEMAS["noaa_alerts"])


def test_landing(spark, tmp_path):
    root = str(tmp_path)
    assert list_landing(spark, root, "noaa_alerts").count() == 0
    assert land(alerts(spark), root, "noaa_alerts", run_stamp()) is None
    assert list_landing(spark, root, "noaa_alerts").count() == 0
    assert land(alerts(spark, alert("1")), root, "noaa_alerts", "20240101T000000Z") == f"{feed_folder(root, 'noaa_alerts')}/20240101T000000Z"
    assert list_landing(spark, root, "noaa_alerts").count() > 0
    assert landed(spark, root, "noaa_alerts").count() == 1


def test_stream_ingest_reads_each_file_once(spark, rows, tmp_path):
    root = str(tmp_path)
    land(alerts(spark, alert("1"), alert("1"), alert("2"), alert(None)), root, "noaa_alerts", "r1")
    target = streams.ingest_feed(spark, root, "noaa_alerts")
    assert rows(spark.read.parquet(target), "alert_id") == [("1",), ("2",)]
    streams.ingest_feed(spark, root, "noaa_alerts")  # nothing new
    land(alerts(spark, alert("2"), alert("3")), root, "noaa_alerts", "r2")
    land(alerts(spark, alert("3", headline="same key in a second file")), root, "noaa_alerts", "r3")
    streams.ingest_feed(spark, root, "noaa_alerts", files_per_batch=1)
    assert rows(spark.read.parquet(target), "alert_id") == [("1",), ("2",), ("3",)]
    assert spark.read.parquet(f"{root}/rejected/noaa_alerts").count() == 1


def timed(spark, path, name, *stamps):
    df = spark.createDataFrame([(k, s, "Severe") for k, s in stamps], "alert_id string, t string, severity string")
    df.select("alert_id", F.to_timestamp("t").alias("effective_utc"), "severity").coalesce(1).write.parquet(f"{path}/{name}")


def source(spark, path):
    return (
        spark.readStream.schema("alert_id string, effective_utc timestamp, severity string")
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path)
    )


def test_hourly_counts_drop_late_rows(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, path, "1", ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:50:00"), ("c", "2024-01-01 05:00:00"))
    query = lambda: streams.drain(streams.hourly_alerts(source(spark, path)), out, str(tmp_path / "cp"))
    query()
    timed(spark, path, "2", ("late", "2024-01-01 00:20:00"), ("d", "2024-01-01 09:30:00"))
    query()
    got = rows(spark.read.parquet(out).select(F.date_format("hour_start", "HH"), "alerts"))
    assert got == [("00", 2), ("05", 1)]  # the late row is gone, hour 09 is not final yet


def test_hours_inside_the_watermark_are_published(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    query = lambda: streams.drain_by_key(streams.hourly_alerts(source(spark, path)), ("hour_start", "severity"), F.col("hour_start"), str(tmp_path / "out"), str(tmp_path / "cp"))
    timed(spark, path, "1", ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 05:00:00"))
    assert rows(query().select(F.date_format("hour_start", "HH"), "alerts")) == [("00", 1), ("05", 1)]
    timed(spark, path, "2", ("c", "2024-01-01 05:30:00"), ("d", "2024-01-01 09:30:00"))
    assert rows(query().select(F.date_format("hour_start", "HH"), "alerts")) == [("00", 1), ("05", 2), ("09", 1)]


def test_a_batch_writes_the_days_it_touches(spark, rows, tmp_path):
    """A table of 30 days; a batch of one hour writes the files of one day, readers of before keep theirs."""
    path = str(tmp_path / "t")
    month = spark.range(30 * 24).select((F.lit("2024-01-01 00:00:00").cast("timestamp") + F.col("id") * F.expr("interval 1 hour")).alias("h"), F.lit("x").alias("s"), F.lit(1).alias("n"))
    assert len(upsert_parts(month, path, ("h", "s"), F.col("h"), grace=0)) == 30
    before = read_parts(spark, path, month.schema)
    files = lambda: {str(f) for f in (tmp_path / "t" / "parts").rglob("*.parquet")}
    old = files()
    hour = month.filter("h = '2024-01-07 05:00:00'").withColumn("n", F.lit(9)).union(month.filter("h = '2024-01-07 06:00:00'").withColumn("s", F.lit("new")))
    assert upsert_parts(hour, path, ("h", "s"), F.col("h"), grace=0) == ["2024-01-07"]
    assert before.count() == 720 and before.filter("n = 9").count() == 0  # the manifest before the last one is still whole
    assert upsert_parts(hour, path, ("h", "s"), F.col("h"), grace=0) == ["2024-01-07"]  # a replay changes nothing
    new = files() - old
    assert new and all("_part=2024-01-07" in f for f in new)
    now = read_parts(spark, path, month.schema)
    assert now.count() == 721 and now.filter("n = 9").count() == 1 and now.filter("s = 'new'").count() == 1
    assert len(read_parts(spark, path, month.schema, ["2024-01-07"]).inputFiles()) < len(now.inputFiles())
    upsert_parts(hour.withColumn("h", F.lit(None).cast("timestamp")), path, ("h", "s"), F.col("h"), grace=0)
    assert read_parts(spark, path, month.schema, ["none"]).count() == 2
    assert not [f for f in old if "_part=2024-01-07" in f and f in files()]  # what no manifest names any more is gone
    assert upsert_parts(month.limit(0), path, ("h", "s"), F.col("h")) == []


def test_archived_files_are_not_listed_again(spark, rows, tmp_path):
    root = str(tmp_path)
    listed = []
    for run in range(6):
        land(alerts(spark, alert(str(run))), root, "noaa_alerts", f"r{run}")
        target = streams.ingest_feed(spark, root, "noaa_alerts", archive=f"{root}/archive")
        time.sleep(0.5)  # files are moved by a thread of their own
        listed.append(len(list((tmp_path / "external").rglob("*.parquet"))))
    assert max(listed[2:]) <= listed[1] + 1 and listed[5] < 6
    assert rows(spark.read.parquet(target), "alert_id") == [(str(run),) for run in range(6)]


def test_a_refresh_between_two_batches_shows_in_the_second(spark, rows, frames, tmp_path):
    def book(tiv):
        ws = frames(geography=[{"geo_id": "g1", "state_code": "TX", "state_name": "Texas"}])
        ws.root = str(tmp_path / "lake")
        exposure = spark.createDataFrame([("TX", tiv, 1)], "state_code string, state_tiv_usd double, state_policy_count long")
        publish(exposure, ws.path("exposure_by_state"))
        return ws

    path = str(tmp_path / "in")
    schema = "alert_id string, event_type string, severity string, urgency string, effective_utc timestamp, expires_utc timestamp, area_desc string"
    got = []
    for run, tiv in enumerate((100.0, 250.0)):
        ws = book(tiv)
        spark.createDataFrame([(str(run), None, None, None, None, None, "parts of Texas")], schema).coalesce(1).write.parquet(f"{path}/{run}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
        out = streams.drain_with(stream, lambda batch: gold.alert_exposure(ws.reopened(), batch), str(tmp_path / "out"), str(tmp_path / "cp"))  # noqa: B023
        got = rows(out, "alert_id", "exposed_tiv_usd")
    assert got == [("0", 100.0), ("1", 250.0)]


def test_hourly_increments_equal_the_full_run(spark, rows, frames, tmp_path, monkeypatch):
    monkeypatch.setattr(increments, "COMPACT_AFTER", 2)
    feeds = {t: f"{tmp_path}/bronze/{silver.TABLES[t].bronze}" for t in event_report.COUNTED.values()}
    literal = frames(geography=[{"geo_id": f"g{k}", "state_code": c, "state_name": n} for k, (c, n) in enumerate((("TX", "Texas"), ("OK", "Oklahoma"), ("XX", None)))])
    stored = ParquetBronze(spark, str(tmp_path))
    read = lambda t: stored(t) if f"{tmp_path}/bronze/{t}" in feeds.values() else literal.bronze(t)
    ws = Workspace(spark, read, literal.as_of, str(tmp_path))
    for t, feed in feeds.items():
        create_empty_like(spark.createDataFrame([], SCHEMAS[silver.TABLES[t].bronze]), feed)
    levels = ["Severe", None, "Minor"]
    for run in range(4):
        batch = [alert(str(i), severity=levels[i % 3], event_type="Flood" if i % 4 else "Heat", area_desc=f"parts of {'Texas, OK' if i % 2 else 'Oklahoma'}") for i in range(run * 3, run * 10 + 5)]
        merge_new(spark, alerts(spark, *batch), feeds["noaa_alerts"], "alert_id", str(tmp_path / "rejected"))
        if run:  # what is computed reads the changes since the last increment only
            step, _ = increments.delta(ws, increments.SEVERITIES, feeds["noaa_alerts"])
            assert {f.split("/")[-3] for f in step.inputFiles()} == {"changes"} and len({f.split("/")[-2] for f in step.inputFiles()}) == 1
        full = Workspace(spark, read, literal.as_of)
        assert rows(increments.alerts_by_severity(ws, feeds["noaa_alerts"])) == rows(event_report.alerts_by_severity(full))
        assert rows(increments.event_risk(ws, feeds["noaa_alerts"])) == rows(full.table("event_risk_correlation"))
        assert rows(increments.counts(ws, feeds)) == rows(event_report.counts(full))
    assert increments.delta(ws, increments.STATES, feeds["noaa_alerts"]) is None  # nothing new
    assert any(p.name.endswith("+") for p in (tmp_path / "partials" / "alerts_by_severity").iterdir())
    monkeypatch.setattr(KeyIndex, "CHANGES", 1)
    for k in range(2):
        merge_new(spark, alerts(spark, alert(f"late{k}")), feeds["noaa_alerts"], "alert_id", str(tmp_path / "rejected"))
    with pytest.raises(LookupError, match="rebuild"):
        increments.alerts_by_severity(ws, feeds["noaa_alerts"])
    again = increments.advance(ws, increments.SEVERITIES, feeds["noaa_alerts"], rebuild=True)
    assert again.agg({"n": "sum"}).first()[0] == stored("noaa_alerts").count()


def test_redelivery_inside_the_watermark(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, path, "1", ("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("b", "2024-01-01 00:30:00"))
    query = lambda: streams.drain(streams.first_delivery(source(spark, path), "alert_id", "effective_utc"), out, str(tmp_path / "cp"))
    query()
    timed(spark, path, "2", ("a", "2024-01-01 00:40:00"), ("c", "2024-01-01 12:00:00"))
    query()
    timed(spark, path, "3", ("a", "2024-01-01 11:00:00"))  # far outside: a is forgotten and counts as new
    query()
    assert rows(spark.read.parquet(out), "alert_id") == [("a",), ("a",), ("b",), ("c",)]


def test_bronze_reader_asserts_the_schema(spark, tmp_path):
    root = str(tmp_path)
    overwrite(alerts(spark, alert("1")).withColumn("extra", F.lit(1)), f"{root}/bronze/noaa_alerts")
    assert ParquetBronze(spark, root)("noaa_alerts").columns == [c.split()[0] for c in SCHEMAS["noaa_alerts"].split(", ")]
    overwrite(alerts(spark, alert("1")).drop("severity"), f"{root}/bronze/noaa_alerts")
    with pytest.raises(ValueError, match="severity"):
        ParquetBronze(spark, root)("noaa_alerts")


def test_layer_names_come_from_the_session(spark):
    assert Layers.of(spark) == Layers("bronze", "silver", "gold")
    spark.conf.set("pcmarts.bronze_schema", "raw")
    try:
        assert Layers.of(spark).bronze == "raw"
    finally:
        spark.conf.unset("pcmarts.bronze_schema")


def test_copy_and_empty_tables(spark, rows, tmp_path):
    root = str(tmp_path)
    tables = {"a": spark.range(3), "b": spark.range(0)}
    for _ in range(2):  # idempotent
        assert rows(copy_tables(spark, tables, root)) == [("a", 3), ("b", 0)]
        assert rows(spark.read.parquet(table_path(spark, f"{root}/a"))) == [(0,), (1,), (2,)]
    assert spark.read.parquet(create_empty_like(spark.range(3), f"{root}/e")).columns == ["id"]


def test_overwrite_keeps_the_table_before(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)  # written before there were versions
    first = spark.read.parquet(path)
    overwrite(first.selectExpr("id + 10 as id"), path)  # reads what it replaces
    second = spark.read.parquet(table_path(spark, path))
    with pytest.raises(Exception, match="no data"):
        overwrite(spark.range(1).select(F.raise_error(F.lit("no data")).alias("id")), path)
    overwrite(spark.range(1), path)
    assert rows(second) == [(10,), (11,)] and rows(spark.read.parquet(table_path(spark, path))) == [(0,)]
    assert [f.name for f in (tmp_path / "t").iterdir() if not f.name.startswith("version=")] == []


def test_a_schema_is_only_dropped_on_demand(spark, tmp_path):
    spark.sql(f"create database if not exists migrated location '{tmp_path}/migrated'")
    assert not drop_source_schema(spark, "migrated")
    assert spark.catalog.databaseExists("migrated")
    assert drop_source_schema(spark, "migrated", confirmed=True)
    assert not spark.catalog.databaseExists("migrated")


def test_report_survives_a_failing_section(spark, rows, frames, tmp_path):
    from pcmarts.plans.event_report import latest_news, write_report

    def broken(ws):
        return ws.spark.range(1).select(F.raise_error(F.lit("no data")))

    ws = frames(news=[{"news_id": "1", "title": "t", "published_utc": "2 Jan 2024 03:04:05 GMT"}])
    log = write_report(ws, str(tmp_path), {"bad": broken, "worse": lambda ws: ws.table("nothing"), "news": latest_news})
    assert rows(log, "section", "status", "rows") == [("bad", "failed", 0), ("news", "ok", 1), ("worse", "failed", 0)]
    assert spark.read.parquet(str(tmp_path / "news")).count() == 1
