"""Oracle queries for feed parsing, ingest, sources, sinks, text scan and streams."""

from oracle.base import CTES

_FETCH = "strftime(date_trunc('hour', {c}) + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ')"


def fetched(c: str) -> str:
    return _FETCH.format(c=c)


def usable(key: str) -> str:
    return f"{key} % 10 not in (3, 7)"


# The places of the weather feed.
CTES["x_place"] = """select * from (values (0,'Miami, FL',25.7617::double,-80.1918::double,'USA-FL-1'),(1,'Houston, TX',29.7604,-95.3698,'USA-TX-2'),(2,'New Orleans, LA',29.9511,-90.0715,'USA-LA-1'),
  (3,'Tampa, FL',27.9506,-82.4572,'USA-FL-2'),(4,'Charleston, SC',32.7765,-79.9311,'USA-SC-1'),(5,'Norfolk, VA',36.8508,-76.2859,'USA-VA-1'),(6,'Los Angeles, CA',34.0522,-118.2437,'USA-CA-1'),
  (7,'San Francisco, CA',37.7749,-122.4194,'USA-CA-2'),(8,'Seattle, WA',47.6062,-122.3321,'USA-WA-1'),(9,'New York, NY',40.7128,-74.0060,'USA-NY-1'),(10,'Chicago, IL',41.8781,-87.6298,'USA-IL-1'),
  (11,'Boston, MA',42.3601,-71.0589,'USA-MA-1'),(12,'Denver, CO',39.7392,-104.9903,'USA-CO-1'),(13,'Phoenix, AZ',33.4484,-112.0740,'USA-AZ-1'),(14,'Atlanta, GA',33.7490,-84.3880,'USA-GA-1')) t(i, city, lat, lon, zone)"""

CTES["x_weather_feed"] = f"""select sha256(p.city || '|' || strftime(observed_time_utc, '%Y-%m-%dT%H:%M:%S.%fZ')) as observation_id, p.city, p.zone as cresta_zone, p.lat as latitude, p.lon as longitude,
    observed_time_utc, temperature_f, wind_speed_mph, wind_gust_mph, precipitation_in, precipitation_in as rain_in, 3 as weather_code, 1013.5::double as pressure_mb, humidity_pct,
    {fetched('observed_time_utc')} as fetched_at_utc, 'open-meteo' as source
  from b_weather w join x_place p on p.i = cast(substring(w.city, 6) as int) where {usable('observation_id')}"""

CTES["x_deliveries"] = """select alert_id, event_type, severity, certainty, urgency, area_desc, headline, sent_utc, effective_utc, expires_utc, fetched_at_utc, source from s_alert
  union all select alert_id, event_type, severity, certainty, urgency, area_desc, 'CORRECTED ' || headline, sent_utc, effective_utc, expires_utc,
    strftime(strptime(fetched_at_utc, '%Y-%m-%dT%H:%M:%SZ') + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ'), source from s_alert where cast(alert_id as bigint) % 3 = 0
  union all select null, event_type, severity, certainty, urgency, area_desc, headline, sent_utc, effective_utc, expires_utc, fetched_at_utc, source from s_alert where cast(alert_id as bigint) % 50 = 0"""

_ISO = "%Y-%m-%dT%H:%M:%S.%fZ"
CTES["x_text_alerts"] = f"""select * replace (strftime(sent_utc, '{_ISO}') as sent_utc, strftime(effective_utc, '{_ISO}') as effective_utc, strftime(expires_utc, '{_ISO}') as expires_utc) from x_deliveries"""
CTES["x_newest_alerts"] = """select * exclude (rn) from (select *, row_number() over (partition by alert_id order by fetched_at_utc desc) as rn from x_text_alerts where alert_id is not null) t where rn = 1"""

_W = r"[\p{L}\p{N}_]"
_ID = r'[`"\p{L}\p{N}_.]'
_SQL_LINE = " or ".join(
    f"regexp_matches(line, '(?i){p}')"
    for p in (
        r"\bSELECT\b[^.]*?\bFROM\b",
        rf"\bFROM\s+{_ID}+\s+(?:AS\s+{_W}+|WHERE|JOIN|GROUP|ORDER|HAVING|LIMIT)\b",
        rf"\bJOIN\s+{_ID}+\s+ON\b",
        rf"\bWHERE\s+{_ID}+\s*(?:=|<>|!=|<=|>=|<|>|\bLIKE\b|\bIN\s*\()",
        rf"\bGROUP\s+BY\s+{_ID}+(?:\s*,\s*{_ID}+)*\s+(?:\bHAVING\b|\bORDER\s+BY\b|\bLIMIT\b)",
        rf"\bORDER\s+BY\s+{_ID}+(?:\s*,\s*{_ID}+)*\s+(?:\bASC\b|\bDESC\b|\bLIMIT\b)",
        r"\bHAVING\s+(?:SUM|COUNT|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(",
    )
)
_PROSE = r"^\s*[-*•]?\s*(?:Do\s+not|Don[''’]t|Never|Always|When|If|Prefer|Avoid|Combine|Link|Pair|Associate|Consider|Note)\b"
_SIGN = rf'[`"]?{_W}+[`"]?\.[`"]?{_W}+[`"]?|=|<>|!=|<=|>=|\bLIKE\b|\bIN\s*\(|\bBETWEEN\s+{_W}+|\b(?:SUM|COUNT|AVG|MAX|MIN|STDDEV|VARIANCE)\s*\(|\bIS\s+(?:NOT\s+)?NULL\b'
_FLAG = rf"""({_SQL_LINE}) or (not regexp_matches(line, '(?i){_PROSE}')
    and len(list_distinct(list_transform(regexp_extract_all(line, '(?i)\b(SELECT|WHERE|JOIN|GROUP\s+BY|ORDER\s+BY|HAVING)\b', 1), lambda w: upper(w)))) >= 2
    and regexp_matches(line, '(?i){_SIGN}'))"""
_LINES = r"unnest(regexp_split_to_array({c}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')) as line"
CTES["x_notes"] = """select doc_id, text || chr(10) || case doc_id % 9 when 0 then 'Do not join policies to claims here' when 1 then 'Use: SELECT total FROM orders' when 2 then 'group by urgency'
    when 3 then 'WHERE amount = 1' when 4 then 'SELECT t.amount, HAVING more' when 5 then 'Never select a.b where c.d is null' when 6 then '- order by priority, not date'
    when 7 then 'ORDER BY o_total DESC' else 'Where appropriate, join the call' end as text from documents"""

BRONZE = {
    "agents": "b_agent", "asset_portfolio": "b_asset", "catastrophe_events": "b_cat", "claims": "b_clm", "customers": "b_cust",
    "earthquakes": "b_quake", "geography": "b_geo", "news": "b_news", "noaa_alerts": "b_alert", "pc_claims": "b_pc_clm",
    "pc_investment_assets": "b_pc_asset", "pc_policies": "b_pc_pol", "pc_realtime_events": "b_pc_realtime",
    "pc_reinsurance_treaties": "b_pc_treaty", "pc_weather_events": "b_pc_weather", "policies": "b_pol", "premiums": "b_prem",
    "reinsurance_treaties": "b_treaty", "weather_obs": "b_weather",
}
COPIED = {k: v for k, v in BRONZE.items() if k.startswith("pc_")} | {
    "pc_combined_ratios": "b_pc_combined", "pc_loss_development": "b_pc_triangle", "pc_risk_exposure": "b_pc_risk", "pc_solvency_metrics": "b_pc_solvency",
}
KEYS = {  # feed -> (rows, key, numeric key)
    "weather": ("s_weather", "observation_id"), "earthquakes": ("s_quake", "event_id"), "catastrophes": ("s_cat", "event_id"),
    "noaa_alerts": ("x_deliveries", "alert_id"), "news": ("s_news", "news_id"),
}


def _counts(feed: str) -> str:
    rows, key = KEYS[feed]
    n = f"coalesce(cast({key} as bigint), 0)"
    first = f"{n} % 4 <> 0"
    return f"""select '{feed}' as feed, 1 as run, count(*) filter (where {first}) as scanned, 0::bigint as rejected, count(distinct {key}) filter (where {first}) as appended,
        count(distinct {key}) filter (where {first}) as total from {rows}
      union all select '{feed}', 2, count(*), count(*) - count({key}), count(distinct {key}) filter (where not ({first})), count(distinct {key}) from {rows}"""


CTES["x_counts"] = " union all ".join(_counts(f) for f in KEYS)

_KIND = """case when contains(upper({c}),'TC ') or contains(upper({c}),'CYCLONE') or contains(upper({c}),'HURRICANE') then 'TropicalCyclone' when contains(upper({c}),'EQ ') or contains(upper({c}),'EARTHQUAKE') then 'Earthquake'
    when contains(upper({c}),'FL ') or contains(upper({c}),'FLOOD') then 'Flood' when contains(upper({c}),'DR ') or contains(upper({c}),'DROUGHT') then 'Drought'
    when contains(upper({c}),'WF ') or contains(upper({c}),'WILDFIRE') then 'Wildfire' when contains(upper({c}),'VO ') or contains(upper({c}),'VOLCAN') then 'Volcanic' else 'Other' end"""
_COLOUR = "case when contains(upper({c}),'RED') then 'high' when contains(upper({c}),'ORANGE') then 'moderate' else 'low' end"
_MAIL = "strftime(event_time_utc, '%-d %b %Y %H:%M:%S GMT')"

QUERIES: dict[str, str] = {
    "feed_weather_parse": "select * from x_weather_feed",
    "feed_earthquake_parse": f"""select id as event_id, 'Earthquake' as event_type, mag as magnitude, place, depth_km - 50 as longitude, depth_km / 2 as latitude, depth_km,
        case when event_id % 13 = 0 then timestamp '1970-01-01' else date_trunc('milliseconds', event_time_utc) + k * interval 1 second end as event_time_utc,
        'https://feed.test/q/' || cast(event_id as varchar) as url, case when coalesce(mag, 0) >= 6.5 then 'high' else 'moderate' end as severity, {fetched('event_time_utc')} as fetched_at_utc, 'usgs' as source
      from (select *, 'q' || cast(event_id as varchar) || '-' || cast(k as varchar) as id, case when event_id % 11 <> 0 then magnitude + k * 0.25::double end as mag
        from b_quake cross join (values (0), (1), (2)) t(k)) q where {usable('event_id')}""".replace("event_id as event_id", "event_id"),
    "feed_gdacs_parse": f"""select sha256('https://feed.test/c/' || cast(event_id as varchar)) as event_id, title, 'Bulletin for ' || title as description, {_KIND.format(c='title')} as event_type,
        {_COLOUR.format(c='title')} as severity, latitude, longitude, date_trunc('second', event_time_utc) as event_time_utc, 'https://feed.test/c/' || cast(event_id as varchar) as link,
        {fetched('event_time_utc')} as fetched_at_utc, 'gdacs' as source from b_cat where {usable('event_id')}
      union all select sha256('Update: ' || title || {_MAIL}), 'Update: ' || title, '', {_KIND.format(c="('Update: ' || title)")}, {_COLOUR.format(c="('Update: ' || title)")}, null, null,
        date_trunc('second', event_time_utc), '', {fetched('event_time_utc')}, 'gdacs' from b_cat where {usable('event_id')}""",
    "feed_news_parse": f"""select sha256('https://feed.test/n/' || cast(doc_id as varchar)) as news_id, 'Report from ' || source as title,
        regexp_replace(text, '^\\s+|\\s+$', '', 'g') as summary, '2 Jan 2024 03:04:05 GMT' as published_utc, 'https://feed.test/n/' || cast(doc_id as varchar) as link,
        'General' as category, '2024-01-02T04:00:00Z' as fetched_at_utc, 'reliefweb' as source from documents where {usable('doc_id')}""",
    "feed_noaa_parse": f"""select 'a' || cast(alert_id as varchar) || '-' || cast(k as varchar) as alert_id, event_type, severity, 'Likely' as certainty, urgency, area_desc, cast(null as varchar) as headline,
        effective_utc as sent_utc, effective_utc, expires_utc, {fetched('effective_utc')} as fetched_at_utc, 'noaa-nws' as source
      from b_alert cross join (values (0), (1)) t(k) where b_alert.alert_id % 10 not in (3, 7)""",
    "feed_payload_guard": " union all ".join(
        f"""select '{feed}' as feed, case {key} % 10 when 7 then 'bad status' else '{reason}' end as reason, count(*) as answers from {rows} where {key} % 10 in (3, 7) group by 2"""
        for feed, rows, key, reason in (
            ("weather", "b_weather", "observation_id", "malformed json"), ("earthquakes", "b_quake", "event_id", "malformed json"),
            ("noaa_alerts", "b_alert", "alert_id", "malformed json"), ("catastrophes", "b_cat", "event_id", "not a feed document"),
            ("news", "documents", "doc_id", "not a feed document"),
        )
    ),
    "feed_page_tags": r"""select page_id, regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '^\s+|\s+$', '', 'g') as title,
        cast(len(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)) as int) as paragraphs from pages""",
    "cls_earthquake_severity": "select cast(event_id as varchar) as event_id, magnitude, case when coalesce(magnitude, 0) >= 6.5 then 'high' else 'moderate' end as severity from b_quake",
    "cls_alert_colour": "select event_id, title, severity from s_cat",
    "cls_catastrophe_type": "select event_type, count(*) as events from s_cat group by 1",
    "cls_news_category": "select news_id, title, category from s_news",
    "ing_dedupe_incoming": "select * from x_newest_alerts",
    "snk_append_new": "select alert_id, headline from x_newest_alerts where cast(alert_id as bigint) % 2 <> 0",
    "ing_merge_feed": "select * from x_newest_alerts",
    "ing_counts": "select * from x_counts union all select 'all', run, cast(sum(scanned) as bigint), cast(sum(rejected) as bigint), cast(sum(appended) as bigint), cast(sum(total) as bigint) from x_counts group by run",
    "ing_freshness": f"""select 'weather' as source, max({fetched('observed_time_utc')}) as as_of from b_weather union all select 'earthquakes', max(fetched_at_utc) from s_quake
      union all select 'catastrophes', max(fetched_at_utc) from s_cat union all select 'noaa_alerts', max(fetched_at_utc) from s_alert union all select 'news', max(fetched_at_utc) from s_news
      union all select 'pc_solvency_metrics', cast(max(reporting_date) as varchar) from b_pc_solvency union all select 'pc_combined_ratios', max(reporting_quarter) from b_pc_combined""",
    "src_bronze_view": " union all ".join(f"select '{k}' as view_name, count(*) as n from {v}" for k, v in BRONZE.items()),
    "src_parquet_dir": """select event_type, severity, cast(sum(case when coalesce(cast(alert_id as bigint), 0) % 4 = 1 then 2 else 1 end) as bigint) as n from x_deliveries group by 1, 2""",
    "src_list_landing": """select v.feed, v.runs, n as landed_rows from (select sum(case when coalesce(cast(alert_id as bigint), 0) % 4 = 1 then 2 else 1 end)::bigint as n from x_deliveries) t,
        (values ('noaa_alerts', 2), ('news', 0)) v(feed, runs)""",
    "snk_create_empty_like": "select 0::bigint as created_rows, count(*) as appended_rows from b_alert",
    "rpt_safe_section": """select 'broken' as section, 'failed' as status, 0::bigint as rows union all select 'counts', 'ok', 5
      union all select 'alerts_by_severity', 'ok', count(distinct coalesce(severity, '-')) from b_alert union all select 'top_exposed_alerts', 'ok', least(20, count(*)) from g_alerts where exposed_tiv_usd is not null
      union all select 'top_pml_events', 'ok', least(15, count(*)) from g_pml where pml_estimate_usd is not null union all select 'earthquakes', 'ok', least(10, count(*)) from b_quake
      union all select 'weather_extremes', 'ok', least(15, count(*)) from b_weather union all select 'news', 'ok', least(12, count(*)) from b_news""",
    "snk_land_feed_file": "select city, cresta_zone, count(*) as n from x_weather_feed group by 1, 2",
    "src_literal_table": "select event_type, severity_factor, count(*) as events from s_cat left join g_factor using (event_type) group by 1, 2",
    "snk_overwrite_table": "select * from g_book",
    "snk_ctas_copy": " union all ".join(f"select '{k}' as table_name, count(*) as n from {v}" for k, v in COPIED.items()),
    "txt_sql_in_text": f"select doc_id, line from (select doc_id, {_LINES.format(c='text')} from x_notes) t where {_FLAG}",
    "txt_sql_per_source": " union all ".join(
        f"""select '{name}' as source, (select count(*) from {rows}) as texts, (select count(*) from (select {_LINES.format(c=c)} from {rows}) t where {_FLAG}) as sql_lines"""
        for name, rows, c in (("notes", "x_notes", "text"), ("conversations", "conversations", "text"), ("pages", "pages", "html"))
    ),
    "stm_feed_ingest": "select * from x_newest_alerts",
    "stm_alert_exposure": "select * from g_alerts",
    "stm_alerts_hourly": "select date_trunc('hour', effective_utc) as hour_start, severity, count(*) as alerts from b_alert group by 1, 2",
    "stm_dedupe": "select cast(alert_id as varchar) as alert_id, event_type, severity, effective_utc as delivered_utc from b_alert",
}

QUERIES["feed_accepted"] = " union all ".join(
    f"""select '{feed}' as feed, (select count(*) from ({QUERIES[name]})) as item_rows,
    coalesce((select sum(answers) from ({QUERIES["feed_payload_guard"]}) where feed = '{feed}'), 0)::bigint as quarantined"""
    for feed, name in (("weather", "feed_weather_parse"), ("earthquakes", "feed_earthquake_parse"), ("catastrophes", "feed_gdacs_parse"), ("noaa_alerts", "feed_noaa_parse"), ("news", "feed_news_parse"))
)
