"""Feed payloads to bronze rows, as Spark jobs over a table of raw answers.

Input columns: ``feed, request, fetched_at_utc, status, payload`` (see ``schemas.RAW_PAYLOAD``).
JSON is read with a fixed schema, RSS by tag patterns. A bad answer never fails the job: it yields
no rows, and ``quarantine`` lists it with the reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.functions import classify

# The places weather is asked for (city, latitude, longitude, CRESTA zone).
LOCATIONS = (
    ("Miami, FL", 25.7617, -80.1918, "USA-FL-1"),
    ("Houston, TX", 29.7604, -95.3698, "USA-TX-2"),
    ("New Orleans, LA", 29.9511, -90.0715, "USA-LA-1"),
    ("Tampa, FL", 27.9506, -82.4572, "USA-FL-2"),
    ("Charleston, SC", 32.7765, -79.9311, "USA-SC-1"),
    ("Norfolk, VA", 36.8508, -76.2859, "USA-VA-1"),
    ("Los Angeles, CA", 34.0522, -118.2437, "USA-CA-1"),
    ("San Francisco, CA", 37.7749, -122.4194, "USA-CA-2"),
    ("Seattle, WA", 47.6062, -122.3321, "USA-WA-1"),
    ("New York, NY", 40.7128, -74.0060, "USA-NY-1"),
    ("Chicago, IL", 41.8781, -87.6298, "USA-IL-1"),
    ("Boston, MA", 42.3601, -71.0589, "USA-MA-1"),
    ("Denver, CO", 39.7392, -104.9903, "USA-CO-1"),
    ("Phoenix, AZ", 33.4484, -112.0740, "USA-AZ-1"),
    ("Atlanta, GA", 33.7490, -84.3880, "USA-GA-1"),
)

_BROKEN = "_broken"
JSON_SCHEMAS = {
    "weather": "current struct<time:string, temperature_2m:double, wind_speed_10m:double, wind_gusts_10m:double, "
               "precipitation:double, rain:double, weather_code:bigint, pressure_msl:double, "
               f"relative_humidity_2m:double>, {_BROKEN} string",
    "earthquakes": "features array<struct<id:string, properties:struct<mag:double, place:string, time:bigint, "
                   f"url:string>, geometry:struct<coordinates:array<double>>>>, {_BROKEN} string",
    "noaa_alerts": "features array<struct<id:string, properties:struct<event:string, severity:string, "
                   "certainty:string, urgency:string, areaDesc:string, headline:string, sent:string, "
                   f"effective:string, expires:string>>>, {_BROKEN} string",
}
RSS_FEEDS = ("catastrophes", "news")


def _document(feed: str) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return F.from_json("payload", JSON_SCHEMAS[feed], options)


def _answered() -> Column:
    return F.coalesce(F.col("status"), F.lit(200)) == 200


def _answers(raw: DataFrame, feed: str) -> DataFrame:
    """Answers of one feed with a good status."""
    return raw.filter((F.col("feed") == feed) & _answered())


def _unfolded(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per item. The outer form keeps Catalyst from deriving a filter on the array, which
    would parse the payload a second time; empty and missing arrays drop out afterwards."""
    return df.select("fetched_at_utc", F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def _parsed(raw: DataFrame, feed: str) -> DataFrame:
    """(request, fetched_at_utc, doc) of the answers with a good status: the document, or the items of a feed document."""
    doc = _document(feed) if feed in JSON_SCHEMAS else F.regexp_extract_all("payload", F.lit("(?s)<item>(.*?)</item>"), F.lit(1))
    return _answers(raw, feed).select("request", "fetched_at_utc", doc.alias("doc"))


def _features(docs: DataFrame) -> DataFrame:
    """All features of the well-formed answers; a malformed answer is quarantined as a whole and yields none."""
    return _unfolded(docs, F.when(F.col(f"doc.{_BROKEN}").isNull(), F.col("doc.features")), "f")


def digest(*parts: Column) -> Column:
    """Stable id from natural fields, so a re-fetched item keeps its key."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def _weather(docs: DataFrame) -> DataFrame:
    """The ``current`` block per requested city; the place comes from the list, not the answer."""
    places = F.create_map(
        *[
            c for city, lat, lon, zone in LOCATIONS
            for c in (F.lit(city), F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"), F.lit(zone).alias("zone")))
        ]
    )
    place = F.try_element_at(places, F.col("request"))
    now = F.col("doc.current")
    return docs.filter(F.col("doc").isNotNull() & F.col(f"doc.{_BROKEN}").isNull()).select(
        digest(F.col("request"), now["time"]).alias("observation_id"), F.col("request").alias("city"),
        place["zone"].alias("cresta_zone"), place["lat"].alias("latitude"), place["lon"].alias("longitude"),
        now["time"].alias("observed_time_utc"), now["temperature_2m"].alias("temperature_f"),
        now["wind_speed_10m"].alias("wind_speed_mph"), now["wind_gusts_10m"].alias("wind_gust_mph"),
        now["precipitation"].alias("precipitation_in"), now["rain"].alias("rain_in"),
        now["weather_code"].alias("weather_code"), now["pressure_msl"].alias("pressure_mb"),
        now["relative_humidity_2m"].alias("humidity_pct"), "fetched_at_utc", F.lit("open-meteo").alias("source"),
    )


def _earthquakes(docs: DataFrame) -> DataFrame:
    """GeoJSON features; coordinates are longitude, latitude, depth; a missing time is the epoch."""
    p, at = F.col("f.properties"), F.col("f.geometry.coordinates")
    when = F.timestamp_millis(F.coalesce(p["time"], F.lit(0)))
    return _features(docs).select(
        F.col("f.id").alias("event_id"), F.lit("Earthquake").alias("event_type"), p["mag"].alias("magnitude"),
        p["place"].alias("place"), F.get(at, 0).alias("longitude"), F.get(at, 1).alias("latitude"),
        F.get(at, 2).alias("depth_km"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time_utc"),
        p["url"].alias("url"), classify.earthquake_severity(p["mag"]).alias("severity"), "fetched_at_utc",
        F.lit("usgs").alias("source"),
    )


def _alerts(docs: DataFrame) -> DataFrame:
    p = F.col("f.properties")
    return _features(docs).select(
        F.col("f.id").alias("alert_id"), p["event"].alias("event_type"), p["severity"].alias("severity"),
        p["certainty"].alias("certainty"), p["urgency"].alias("urgency"), p["areaDesc"].alias("area_desc"),
        p["headline"].alias("headline"), p["sent"].alias("sent_utc"), p["effective"].alias("effective_utc"),
        p["expires"].alias("expires_utc"), "fetched_at_utc", F.lit("noaa-nws").alias("source"),
    )


def tag(text: Column | str, name: str) -> Column:
    """Text of the first ``<name>`` element without surrounding white space; empty if there is none."""
    inner = F.regexp_extract(text, f"(?s)<{name}>(.*?)</{name}>", 1)
    return F.regexp_replace(inner, r"^\s+|\s+$", "")


def _natural() -> Column:
    """What tells an item apart: its link, else its title and date; without all three, all of its text."""
    named = F.concat("title", "pubDate")
    return F.when(F.col("link") != "", F.col("link")).when(named != "", named).otherwise(F.col("item"))


def _number(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("double")


def _catastrophes(docs: DataFrame) -> DataFrame:
    fields = {n: tag("item", n) for n in ("title", "description", "pubDate", "link")}
    items = _unfolded(docs, F.col("doc"), "item").withColumns(
        fields | {"lat": tag("item", "geo:lat"), "lon": tag("item", "geo:long")}
    )
    return items.select(
        digest(_natural()).alias("event_id"), "title", "description",
        classify.catastrophe_type("title").alias("event_type"), classify.alert_colour("title").alias("severity"),
        _number(F.col("lat")).alias("latitude"), _number(F.col("lon")).alias("longitude"),
        F.col("pubDate").alias("event_time_utc"), "link", "fetched_at_utc", F.lit("gdacs").alias("source"),
    )


def _news(docs: DataFrame) -> DataFrame:
    items = _unfolded(docs, F.col("doc"), "item").withColumns(
        {n: tag("item", n) for n in ("title", "description", "pubDate", "link")}
    )
    return items.select(
        digest(_natural()).alias("news_id"), "title", F.col("description").alias("summary"),
        F.col("pubDate").alias("published_utc"), "link", classify.news_category("title").alias("category"),
        "fetched_at_utc", F.lit("reliefweb").alias("source"),
    )


_SHAPES = {"weather": _weather, "earthquakes": _earthquakes, "catastrophes": _catastrophes, "noaa_alerts": _alerts, "news": _news}


def _parser(feed: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: _SHAPES[feed](_parsed(raw, feed))


PARSERS = {feed: _parser(feed) for feed in _SHAPES}
weather, earthquakes, catastrophes, alerts, news = PARSERS.values()


def _verdict(broken: Column) -> Column:
    """Why an answer is unusable, NULL if it is fine."""
    tagged = F.col("feed").isin(*RSS_FEEDS) & ~F.col("payload").rlike("<rss|<item>")
    return (
        F.when(~_answered(), "bad status").when(F.col("payload").isNull(), "no payload")
        .when(broken.isNotNull(), "malformed json").when(tagged, "not a feed document")
    )


def verdict() -> Column:
    broken = F.lit(None).cast("string")
    for feed in JSON_SCHEMAS:
        broken = F.when(F.col("feed") == feed, _document(feed)[_BROKEN]).otherwise(broken)
    return _verdict(broken)


def quarantine(raw: DataFrame) -> DataFrame:
    """Answers that yield no rows because they are unusable, with the reason."""
    return raw.withColumn("reason", verdict()).filter(F.col("reason").isNotNull())


def accepted(raw: DataFrame, feed: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined answers) of a feed, from one parse of each answer.

    The parsed answers are written once to ``folder``: typed documents as they are, with the verdict, and the payload of the
    unusable ones only. What is returned reads that table; its columns are typed, so each side reads no more than it shows.
    """
    answers = raw.filter(F.col("feed") == feed)
    doc = _document(feed) if feed in JSON_SCHEMAS else F.regexp_extract_all("payload", F.lit("(?s)<item>(.*?)</item>"), F.lit(1))
    judged = answers.withColumn("doc", doc)  # a column of its own: what uses it does not parse again
    broken = F.col(f"doc.{_BROKEN}") if feed in JSON_SCHEMAS else F.lit(None)
    judged = judged.withColumn("reason", _verdict(broken))
    judged = judged.withColumn("payload", F.when(F.col("reason").isNotNull(), F.col("payload")))
    judged.write.parquet(folder)
    written = raw.sparkSession.read.schema(judged.schema).parquet(folder)
    good = written.filter(F.col("reason").isNull()).select("request", "fetched_at_utc", "doc")
    return _SHAPES[feed](good), written.filter(F.col("reason").isNotNull()).select(*raw.columns, "reason")
