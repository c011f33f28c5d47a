"""Common table expressions the oracle queries build on: bridge rows, silver and gold in plain SQL."""

from __future__ import annotations

import re

from pcmarts.sources.bridge import SQL as BRIDGE

CTES: dict[str, str] = {
    name: re.sub(r"\{(\w+)\}", r"\1", text).strip() for name, text in BRIDGE.items()
}


def public(name: str, money: str) -> str:
    """SELECT * with the named DECIMAL columns as DOUBLE."""
    casts = ", ".join(f"cast({c} as double) as {c}" for c in money.split())
    return f"select * replace ({casts}) from {name}"


# --- silver -------------------------------------------------------------------------------------
CTES |= {
    "s_geo": "select * from b_geo where geo_id is not null",
    "s_cust": "select * replace (cast(date_of_birth as date) as date_of_birth, cast(signup_date as date) as signup_date) from b_cust where customer_id is not null",
    "s_agent": "select * replace (cast(hire_date as date) as hire_date) from b_agent",
    "s_pol": """select *, case line_of_business when 'Personal' then 'PL' when 'Commercial' then 'CL' else 'SP' end as lob_code
      from b_pol where policy_id is not null""",
    "s_prem": "select *, cast(gross_premium_usd - ceded_to_reinsurance_usd as decimal(18,2)) as net_premium_usd from b_prem",
    "s_clm": """select *, cast(paid_amount_usd - salvage_recovery_usd - subrogation_recovery_usd as decimal(18,2)) as net_paid_usd,
      catastrophe_code is not null as is_cat from b_clm""",
    "s_asset": "select * replace (cast(purchase_date as date) as purchase_date, cast(maturity_date as date) as maturity_date) from b_asset",
    "s_alert": """select cast(alert_id as varchar) as alert_id, event_type, severity, 'Likely' as certainty, urgency, area_desc,
      event_type || ' for ' || area_desc as headline, effective_utc as sent_utc, effective_utc, expires_utc,
      strftime(date_trunc('hour', effective_utc) + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ') as fetched_at_utc, 'alerts' as source from b_alert""",
    "s_cat": """select cast(event_id as varchar) as event_id, title, 'Bulletin: ' || title as description,
        case when contains(upper(title),'TC ') or contains(upper(title),'CYCLONE') or contains(upper(title),'HURRICANE') then 'TropicalCyclone'
             when contains(upper(title),'EQ ') or contains(upper(title),'EARTHQUAKE') then 'Earthquake'
             when contains(upper(title),'FL ') or contains(upper(title),'FLOOD') then 'Flood'
             when contains(upper(title),'DR ') or contains(upper(title),'DROUGHT') then 'Drought'
             when contains(upper(title),'WF ') or contains(upper(title),'WILDFIRE') then 'Wildfire'
             when contains(upper(title),'VO ') or contains(upper(title),'VOLCAN') then 'Volcanic' else 'Other' end as event_type,
        case when contains(upper(title),'RED') then 'high' when contains(upper(title),'ORANGE') then 'moderate' else 'low' end as severity,
        latitude, longitude, case when event_id%2=0 then date_trunc('second', event_time_utc) else event_time_utc end as event_time_utc,
        'https://feed.test/' || cast(event_id as varchar) as link,
        strftime(date_trunc('hour', event_time_utc) + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ') as fetched_at_utc, 'disasters' as source
      from b_cat""",
    "s_quake": """select cast(event_id as varchar) as event_id, event_type, magnitude, place, depth_km - 50 as longitude, depth_km / 2 as latitude,
        depth_km, event_time_utc, 'https://feed.test/quake/' || cast(event_id as varchar) as url,
        case when coalesce(magnitude,0) >= 6.5 then 'high' else 'moderate' end as severity,
        strftime(date_trunc('hour', event_time_utc) + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ') as fetched_at_utc, 'quakes' as source
      from b_quake""",
    "s_weather": """select cast(observation_id as varchar) as observation_id, city, cresta_zone, latitude, latitude - 120 as longitude, observed_time_utc,
        temperature_f, wind_speed_mph, wind_gust_mph, precipitation_in, precipitation_in as rain_in, cast(humidity_pct as int) % 4 as weather_code,
        humidity_pct + 950 as pressure_mb, humidity_pct, date_trunc('hour', observed_time_utc) + interval 1 hour as fetched_at_utc, 'weather' as source
      from b_weather""",
    "s_news": """select cast(news_id as varchar) as news_id, title, summary, strftime(published_date, '%-d %b %Y %H:%M:%S GMT') as published_utc,
        'https://feed.test/news/' || cast(news_id as varchar) as link,
        case when regexp_matches(lower(title),'flood|hurricane|cyclone|tornado|earthquake|wildfire|typhoon') then 'Catastrophe'
             when regexp_matches(lower(title),'cyber|ransomware|breach') then 'Cyber'
             when regexp_matches(lower(title),'epidemic|outbreak|covid') then 'Health'
             when regexp_matches(lower(title),'conflict|war|violence') then 'Conflict' else 'General' end as category,
        strftime(published_date + interval 1 day, '%Y-%m-%dT%H:%M:%SZ') as fetched_at_utc, 'news' as source,
        cast(published_date as timestamp) as published_ts from b_news""",
    "s_pc_pol": "select * replace (cast(inception_date as date) as inception_date, cast(expiry_date as date) as expiry_date) from b_pc_pol",
    "s_pc_clm": """select * replace (cast(loss_date as date) as loss_date, cast(report_date as date) as report_date),
      paid_amount - reserved_amount*0 as net_paid_usd from b_pc_clm""",
    "s_pc_asset": "select * replace (cast(maturity_date as date) as maturity_date) from b_pc_asset",
    "s_pc_treaty": "select * replace (cast(inception_date as date) as inception_date, cast(expiry_date as date) as expiry_date) from b_pc_treaty",
    "s_pc_weather": "select * replace (cast(event_date as date) as event_date) from b_pc_weather",
    "s_pc_realtime": "select * replace (cast(event_timestamp as timestamp) as event_timestamp) from b_pc_realtime",
}

# --- gold ---------------------------------------------------------------------------------------
CTES |= {
    "g_kpi_p": """select cast(date_trunc('month', billing_month) as date) as month, line_of_business, sum(gross_premium_usd) as gross,
        sum(net_premium_usd) as net, sum(commission_usd) as comm, sum(ceded_to_reinsurance_usd) as ceded from s_prem group by 1, 2""",
    "g_kpi_c": """select cast(date_trunc('month', loss_date) as date) as month, line_of_business, sum(incurred_amount_usd) as inc,
        sum(paid_amount_usd) as paid, count(*) as n from s_clm group by 1, 2""",
    "g_kpis": """select *, loss_ratio + expense_ratio as combined_ratio from (
        select p.month, p.line_of_business, cast(coalesce(gross,0) as double) as gross_written_premium_usd,
          cast(coalesce(net,0) as double) as net_written_premium_usd, cast(coalesce(comm,0) as double) as commission_usd,
          cast(coalesce(ceded,0) as double) as ceded_premium_usd, cast(coalesce(inc,0) as double) as incurred_loss_usd,
          cast(coalesce(paid,0) as double) as paid_loss_usd, coalesce(n,0) as claim_count,
          case when gross > 0 then cast(coalesce(inc,0) as double) / cast(gross as double) else 0.0::double end as loss_ratio,
          case when gross > 0 then cast(coalesce(comm,0) as double) / cast(gross as double) else 0.0::double end as expense_ratio
        from g_kpi_p p left join g_kpi_c c on p.month = c.month and p.line_of_business = c.line_of_business) t""",
    "g_claims": """select line_of_business, product, peril, count(*) as claim_count, cast(sum(incurred_amount_usd) as double) as total_incurred_usd,
        cast(sum(incurred_amount_usd) as double) / count(incurred_amount_usd) as avg_severity_usd, cast(max(incurred_amount_usd) as double) as max_severity_usd,
        count(*) filter (where is_cat) as cat_claim_count, count(*) filter (where fraud_flag) as fraud_flag_count
      from s_clm group by all""",
    "g_exposure": """select state_code, cresta_zone, region, line_of_business, product, cast(sum(sum_insured_usd) as double) as total_insured_value_usd,
        cast(sum(annual_premium_usd) as double) as annual_premium_usd, count(*) as policy_count
      from b_pol join s_geo using (geo_id) group by all""",
    "g_state": """select state_code, cast(sum(sum_insured_usd) as double) as state_tiv_usd, count(*) as state_policy_count
      from b_pol join s_geo using (geo_id) group by all""",
    "g_solv_in": """select (select cast(sum(market_value_usd) as double) from b_asset) as mv, (select cast(sum(incurred_amount_usd) as double) from s_clm) as cl,
        (select cast(sum(gross_premium_usd) as double) from s_prem) as pr""",
    "g_solv_w": """select *, pr * 0.18::double + cl * 0.10::double as uw, mv * 0.07::double as mk, mv * 0.015::double as cp, pr * 0.03::double as op, mv * 0.35::double as own from g_solv_in""",
    "g_solvency": """select metric, value_usd from (select *, uw + mk + cp + op as scr from g_solv_w) w, lateral (values
        ('Underwriting Risk', uw), ('Market Risk', mk), ('Counterparty Risk', cp), ('Operational Risk', op), ('SCR (Total)', scr),
        ('MCR (Minimum)', scr * 0.45::double), ('Own Funds', own), ('Solvency Ratio', case when scr > 0 then own / scr else 0 end), ('Market Value', mv)) v(metric, value_usd)""",
    "g_assets": """select asset_class, rating, cast(sum(market_value_usd) as double) as market_value_usd, cast(sum(book_value_usd) as double) as book_value_usd,
        cast(sum(yield_pct) as double) / count(yield_pct) as avg_yield_pct, cast(sum(duration_yrs) as double) / count(duration_yrs) as avg_duration_yrs,
        cast(sum(esg_score) as double) / count(esg_score) as avg_esg_score, count(*) as position_count from b_asset group by all""",
    "g_reins": """select line_of_business, reinsurer, treaty_type, cast(sum(limit_usd) as double) as total_limit_usd,
        cast(sum(premium_ceded_usd) as double) as premium_ceded_usd, cast(sum(cession_pct) as double) / count(cession_pct) as avg_cession_pct,
        count(*) as treaty_count from b_treaty group by all""",
    "g_alerts": """select alert_id, event_type, severity, urgency, effective_utc, expires_utc, t.state_code, t.state_name,
        x.state_tiv_usd as exposed_tiv_usd, x.state_policy_count as exposed_policy_count
      from s_alert a join (select distinct state_code, state_name from s_geo) t
        on contains(a.area_desc, t.state_name) or contains(a.area_desc, t.state_code)
      left join g_state x on x.state_code = t.state_code""",
    "g_factor": """select * from (values ('Earthquake', 0.18::double), ('TropicalCyclone', 0.22::double), ('Flood', 0.12::double), ('Wildfire', 0.08::double),
        ('Drought', 0.03::double), ('Volcanic', 0.10::double), ('Other', 0.02::double)) f(event_type, severity_factor)""",
    "g_pml": """select event_id, title, e.event_type, severity, event_time_utc, latitude, longitude, state_code, state_tiv_usd, severity_factor,
        state_tiv_usd * severity_factor as pml_estimate_usd
      from s_cat e left join g_factor f on e.event_type = f.event_type cross join g_state""",
    "g_pol360": """select policy_id, line_of_business, product, lob_code, policy_status, p.channel, effective_date, expiration_date,
        cast(annual_premium_usd as double) as annual_premium_usd, cast(sum_insured_usd as double) as sum_insured_usd, cast(deductible_usd as double) as deductible_usd,
        reinsured, cast(underwriter_score as double) as underwriter_score, c.customer_id, customer_name, customer_type, loyalty_tier, income_bracket, credit_score,
        state_code, state_name, region, cresta_zone, flood_zone, windstorm_zone, a.agent_id, agent_name, a.channel as agent_channel, a.specialty_lob as agent_specialty_lob
      from s_pol p left join s_cust c on p.customer_id = c.customer_id left join s_geo g on p.geo_id = g.geo_id left join s_agent a on p.agent_id = a.agent_id""",
    "g_clm360": """select claim_id, cl.policy_id, cl.line_of_business, cl.product, peril, claim_status, loss_date, report_date,
        cast(date_diff('day', loss_date, report_date) as int) as report_lag_days, cast(incurred_amount_usd as double) as incurred_amount_usd,
        cast(paid_amount_usd as double) as paid_amount_usd, cast(reserve_amount_usd as double) as reserve_amount_usd, cast(net_paid_usd as double) as net_paid_usd,
        cast(salvage_recovery_usd as double) as salvage_recovery_usd, cast(subrogation_recovery_usd as double) as subrogation_recovery_usd, fraud_flag, catastrophe_code, is_cat,
        case when sum_insured_usd > 0 then cast(incurred_amount_usd as double) / cast(sum_insured_usd as double) end as severity_pct_of_sum_insured,
        cast(annual_premium_usd as double) as annual_premium_usd, cast(sum_insured_usd as double) as sum_insured_usd, channel, customer_name, customer_type, loyalty_tier,
        state_code, state_name, region, cresta_zone, flood_zone
      from s_clm cl left join s_pol p on cl.policy_id = p.policy_id left join s_cust c on p.customer_id = c.customer_id left join s_geo g on cl.geo_id = g.geo_id""",
    "g_seg_p": """select f.line_of_business, f.product, state_code, p.channel, customer_type, sum(gross_premium_usd) as gross, sum(net_premium_usd) as net, sum(f.commission_usd) as comm
      from s_prem f join s_pol p on f.policy_id = p.policy_id join s_cust c on p.customer_id = c.customer_id join s_geo g on p.geo_id = g.geo_id group by all""",
    "g_seg_c": """select f.line_of_business, f.product, state_code, p.channel, customer_type, sum(incurred_amount_usd) as inc, count(*) as n
      from s_clm f join s_pol p on f.policy_id = p.policy_id join s_cust c on p.customer_id = c.customer_id join s_geo g on p.geo_id = g.geo_id group by all""",
    "g_segments": """select *, loss_ratio + expense_ratio as combined_ratio from (
        select line_of_business, product, state_code, channel, customer_type, cast(gross as double) as gross_premium_usd, cast(net as double) as net_premium_usd,
          cast(comm as double) as commission_usd, cast(coalesce(inc,0) as double) as incurred_loss_usd, coalesce(n,0) as claim_count,
          case when gross > 0 then cast(coalesce(inc,0) as double) / cast(gross as double) else 0.0::double end as loss_ratio,
          case when gross > 0 then cast(comm as double) / cast(gross as double) else 0.0::double end as expense_ratio
        from g_seg_p left join g_seg_c using (line_of_business, product, state_code, channel, customer_type)) t""",
    "g_book": """select line_of_business, product, active_policy_count, inforce_premium_usd, inforce_sum_insured_usd, avg_underwriter_score,
        coalesce(claim_count,0) as claim_count, coalesce(incurred_loss_usd,0.0::double) as incurred_loss_usd, coalesce(avg_severity_usd,0.0::double) as avg_severity_usd,
        coalesce(cat_claim_count,0) as cat_claim_count, coalesce(fraud_claim_count,0) as fraud_claim_count,
        cast(coalesce(claim_count,0)*100 as double) / cast(active_policy_count as double) as claim_frequency_per_100,
        case when inforce_premium_usd > 0 then coalesce(incurred_loss_usd,0.0::double) / inforce_premium_usd else 0.0::double end as loss_ratio,
        inforce_premium_usd / active_policy_count as avg_premium_per_policy
      from (select line_of_business, product, count(*) as active_policy_count, cast(sum(annual_premium_usd) as double) as inforce_premium_usd,
          cast(sum(sum_insured_usd) as double) as inforce_sum_insured_usd, cast(sum(underwriter_score) as double) / count(underwriter_score) as avg_underwriter_score
        from s_pol where policy_status = 'Active' group by all) p
      left join (select line_of_business, product, count(*) as claim_count, cast(sum(incurred_amount_usd) as double) as incurred_loss_usd,
          cast(sum(incurred_amount_usd) as double) / count(incurred_amount_usd) as avg_severity_usd, count(*) filter (where is_cat) as cat_claim_count,
          count(*) filter (where fraud_flag) as fraud_claim_count from s_clm group by all) c using (line_of_business, product)""",
    "g_perils": """select *, case when total_incurred_usd > 0 then cat_incurred_usd / total_incurred_usd else 0.0::double end as cat_share_of_loss from (
        select peril, count(*) as claim_count, cast(sum(incurred_amount_usd) as double) as total_incurred_usd,
          cast(sum(incurred_amount_usd) as double) / count(incurred_amount_usd) as avg_severity_usd,
          cast(quantile_disc(incurred_amount_usd, 0.95) as double) as p95_severity_usd, count(*) filter (where is_cat) as cat_claim_count,
          cast(sum(case when is_cat then incurred_amount_usd else 0 end) as double) as cat_incurred_usd, count(distinct line_of_business) as distinct_lobs
        from s_clm group by peril) t""",
}


def needed(sql: str) -> list[str]:
    """CTE names a query uses, directly or through other CTEs, in definition order."""
    found: set[str] = set()

    def visit(text: str):
        for word in set(re.findall(r"\b[bsgx]_\w+\b", text)):
            if word in CTES and word not in found:
                found.add(word)
                visit(CTES[word])

    visit(sql)
    order: list[str] = []

    def place(name: str):
        if name in order:
            return
        for word in re.findall(r"\b[bsgx]_\w+\b", CTES[name]):
            if word in CTES and word != name:
                place(word)
        order.append(name)

    for name in CTES:
        if name in found:
            place(name)
    return order


def query(sql: str) -> str:
    """Complete statement: the CTEs the text refers to, then the text."""
    names = needed(sql)
    if not names:
        return sql.strip()
    head = ",\n".join(f"{n} as ({CTES[n]})" for n in names)
    return f"with {head}\n{sql.strip()}"
