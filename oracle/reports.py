"""Oracle queries for reports, dashboard, event report, examples, snippets and questions."""

from oracle.base import CTES

AS_OF = "date '2001-11-04'"


def m(expr: str) -> str:
    """Exact total of a mart money column."""
    return f"cast(sum(cast({expr} as decimal(30,2))) as double)"


def fine(expr: str) -> str:
    """Exact total of a column in millions."""
    return f"cast(cast(sum(cast(cast({expr} as varchar) as decimal(28,10))) as varchar) as double)"


def half_up(expr: str, digits: int) -> str:
    """Spark's ROUND: half up on the shortest decimal form of the double."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,18)), {digits}) as double)"


CTES["x_benchmark"] = """select * from (values ('Auto',104.0::double),('Home',110.0::double),('Liability',95.0::double),('Property',95.0::double),('Marine',92.0::double),
  ('Aviation',98.0::double),('Cyber',105.0::double),('WorkersComp',85.0::double)) t(sub_line, bar)"""

CTES["x_tri"] = f"""select accident_year, development_period, line_of_business, incremental_paid_eur_m, case_reserves_eur_m,
    sum(incremental_paid_eur_m) over (partition by accident_year, line_of_business order by development_period) as paid
  from b_pc_triangle where accident_year + development_period - 1 <= year({AS_OF})"""
CTES["x_factor"] = """select a.line_of_business, a.development_period, cast(sum(b.paid) as double) / cast(sum(a.paid) as double) as factor
  from x_tri a join x_tri b on a.accident_year = b.accident_year and a.line_of_business = b.line_of_business and b.development_period = a.development_period + 1
  group by 1, 2"""
CTES["x_latest"] = """select accident_year, line_of_business, max(development_period) as last_dev, cast(arg_max(paid, development_period) as double) as last_paid from x_tri group by 1, 2"""
CTES["x_steps"] = """select l.accident_year, l.line_of_business, l.last_paid,
    list_prepend(l.last_paid, coalesce(list(f.factor order by f.development_period) filter (where f.factor is not null), [])) as steps
  from x_latest l left join x_factor f on f.line_of_business = l.line_of_business and f.development_period >= l.last_dev
  group by l.accident_year, l.line_of_business, l.last_paid"""
CTES["g_triangle"] = f"""select t.accident_year, t.development_period, t.line_of_business, cast(incremental_paid_eur_m as double) as incremental_paid_eur_m,
    cast(paid as double) as cumulative_paid_eur_m, cast(case_reserves_eur_m as double) as case_reserves_eur_m, u.ult as ultimate_loss_eur_m,
    {half_up('(u.ult - cast(paid as double) - cast(case_reserves_eur_m as double))', 6)} as ibnr_eur_m
  from x_tri t join (select accident_year, line_of_business, {half_up('list_reduce(steps, lambda a, f: a * f)', 6)} as ult from x_steps) u
    on t.accident_year = u.accident_year and t.line_of_business = u.line_of_business"""
CTES["x_newest"] = """select accident_year, line_of_business, arg_max(ibnr_eur_m, development_period) as ibnr, arg_max(ultimate_loss_eur_m, development_period) as ult from g_triangle group by 1, 2"""

PML_COLS = """round(state_tiv_usd / 1e9, 2) as state_tiv_busd, round(severity_factor * 100, 1) as severity_factor_pct, round(pml_estimate_usd / 1e6, 1) as pml_musd"""
PML_TOP = "where pml_estimate_usd is not null order by pml_estimate_usd desc, event_id, state_code"
ALERT_TOP = "where exposed_tiv_usd is not null order by exposed_tiv_usd desc, alert_id, state_code"
SEG = "line_of_business, product, state_code, channel, customer_type"

QUERIES: dict[str, str] = {
    "sql_01_underwriting_kpis": f"""select month as period_month, line_of_business, round({m('gross_written_premium_usd')}/1e6, 2) as gwp_musd,
        round({m('net_written_premium_usd')}/1e6, 2) as nwp_musd, round({m('incurred_loss_usd')}/1e6, 2) as incurred_loss_musd, cast(sum(claim_count) as bigint) as claims,
        round(avg(loss_ratio)*100, 1) as loss_ratio_pct, round(avg(expense_ratio)*100, 1) as expense_ratio_pct, round(avg(combined_ratio)*100, 1) as combined_ratio_pct
      from g_kpis group by 1, 2""",
    "sql_02_book_health": """select line_of_business, product, active_policy_count, round(inforce_premium_usd/1e6, 2) as inforce_gwp_musd, round(avg_premium_per_policy, 0) as avg_premium_usd,
        round(claim_frequency_per_100, 2) as freq_per_100_policies, round(avg_severity_usd, 0) as avg_severity_usd, round(loss_ratio*100, 1) as loss_ratio_pct,
        cat_claim_count, fraud_claim_count, round(avg_underwriter_score, 1) as avg_underwriter_score from g_book""",
    "sql_03_loss_triangle": """select accident_year, development_period as dev_period_yrs, line_of_business, incremental_paid_eur_m, cumulative_paid_eur_m, case_reserves_eur_m, ibnr_eur_m,
        ultimate_loss_eur_m, round(cumulative_paid_eur_m / nullif(ultimate_loss_eur_m, 0) * 100, 1) as pct_paid_to_ultimate from g_triangle""",
    "sql_04_solvency_ii": """select reporting_date, round(total_scr_eur_m,1) as total_scr_eur_m, round(scr_market_risk,1) as market_risk, round(scr_underwriting_non_life,1) as uw_non_life,
        round(scr_underwriting_life,1) as uw_life, round(scr_underwriting_health,1) as uw_health, round(scr_credit_risk,1) as credit_risk, round(scr_operational_risk,1) as operational_risk,
        round(diversification_benefit,1) as diversification_benefit, round(own_funds_eur_m,1) as own_funds_eur_m, round(mcr_eur_m,1) as mcr_eur_m, round(solvency_ratio_pct,1) as solvency_ratio_pct,
        case when solvency_ratio_pct >= 150 then 'Healthy' when solvency_ratio_pct >= 100 then 'Recovery plan' else 'Intervention' end as regulatory_status from b_pc_solvency""",
    "sql_05_cat_pml_exposure": f"""select p.event_type, p.severity, p.title, p.state_code, n.state_name, n.region, {PML_COLS}, p.event_time_utc
      from (select * from g_pml {PML_TOP} limit 50) p left join (select state_code, max(state_name) as state_name, max(region) as region from s_geo group by 1) n using (state_code)""",
    "sql_06_segment_loss_ratio": f"""select {SEG}, round(gross_premium_usd/1e6, 2) as gwp_musd, round(incurred_loss_usd/1e6, 2) as losses_musd, claim_count, round(loss_ratio*100, 1) as loss_ratio_pct,
        round(expense_ratio*100, 1) as expense_ratio_pct, round(combined_ratio*100, 1) as combined_ratio_pct
      from g_segments where gross_premium_usd > 50000 order by combined_ratio_pct desc, {SEG} limit 30""",
    "sql_07_claim_360": f"""select claim_id, line_of_business, product, peril, claim_status, loss_date, report_date, report_lag_days, round(incurred_amount_usd, 0) as incurred_usd,
        round(paid_amount_usd, 0) as paid_usd, round(reserve_amount_usd, 0) as reserve_usd, round(severity_pct_of_sum_insured*100, 1) as severity_pct_of_si, is_cat, fraud_flag, catastrophe_code,
        customer_name, customer_type, loyalty_tier, state_code, region, cresta_zone, flood_zone, channel
      from g_clm360 where report_date >= {AS_OF} - interval 12 months order by loss_date desc, claim_id limit 100""",
    "sql_08_reinsurance_recoveries": f"""select * from (
        select 'USD_synthetic' as source, treaty_type, reinsurer, line_of_business, round({m('total_limit_usd')}/1e6, 1) as total_limit_musd, round({m('premium_ceded_usd')}/1e6, 1) as ceded_premium_musd,
          round(avg(avg_cession_pct)*100, 1) as avg_cession_pct, cast(sum(treaty_count) as bigint) as treaty_count from g_reins group by all
        union all select 'EUR_pc', treaty_type, reinsurer, line_of_business, round(cast(sum(limit_eur_m) as double), 1), round(cast(sum(ceded_premium_eur_m) as double), 1),
          round(cast(sum(cession_pct) as double)/count(cession_pct), 1), count(*) from b_pc_treaty group by all) u
      order by ceded_premium_musd desc, source, treaty_type, reinsurer, line_of_business limit 30""",
    "sql_09_combined_ratio_vs_benchmark": """select reporting_quarter, line_of_business, c.sub_line, loss_ratio_pct, expense_ratio_pct, combined_ratio_pct, bar as benchmark_pct,
        round(combined_ratio_pct - coalesce(bar, 100), 1) as delta_vs_benchmark_pts,
        case when combined_ratio_pct < 100 then 'Profitable' when combined_ratio_pct < coalesce(bar, 100) then 'Worse than market — review' else 'Worse than market and unprofitable — rate action' end as underwriting_signal,
        case when bar is null then 'No benchmark' when combined_ratio_pct < bar then 'Better than market' when combined_ratio_pct > bar then 'Worse than market' else 'At market' end as benchmark_position
      from b_pc_combined c left join x_benchmark x on x.sub_line = c.sub_line""",
    "sql_10_realtime_event_risk": f"""select event_type, severity, urgency, state_code, state_name, effective_utc, expires_utc, round(exposed_tiv_usd/1e9, 2) as exposed_tiv_busd, exposed_policy_count
      from g_alerts {ALERT_TOP} limit 50""",
    # dashboard
    "dsh_uw_kpis": "select month, line_of_business, gross_written_premium_usd, net_written_premium_usd, incurred_loss_usd, claim_count, loss_ratio, expense_ratio, combined_ratio from g_kpis",
    "dsh_kpi_totals": f"""select {m('gross_written_premium_usd')} as total_gwp, {m('net_written_premium_usd')} as total_nwp, {m('incurred_loss_usd')} as total_losses, cast(sum(claim_count) as bigint) as total_claims,
        case when sum(gross_written_premium_usd) > 0 then {m('incurred_loss_usd')} / {m('gross_written_premium_usd')} end as overall_loss_ratio from g_kpis""",
    "dsh_claims_summary": "select * from g_claims",
    "dsh_exposure": "select * from g_exposure",
    "dsh_solvency": "select * from g_solvency",
    "dsh_solvency_kpi": """select max(value_usd) filter (where metric = 'Solvency Ratio') as solvency_ratio, max(value_usd) filter (where metric = 'SCR (Total)') as scr_total,
        max(value_usd) filter (where metric = 'Own Funds') as own_funds, max(value_usd) filter (where metric = 'Market Value') as market_value from g_solvency""",
    "dsh_assets": "select * from g_assets",
    "dsh_event_risk": "select * from g_alerts",
    "dsh_cat_events": "select event_id, title, event_type, severity, event_time_utc, latitude, longitude, state_code, pml_estimate_usd from g_pml",
    "dsh_event_risk_totals": f"""select count(*) as active_alerts, count(distinct state_code) as states_with_alerts, {m('exposed_tiv_usd')} as total_exposed_tiv,
        cast(sum(exposed_policy_count) as bigint) as total_exposed_policies, count(distinct alert_id) as distinct_alerts from g_alerts""",
    "wdg_gwp_by_lob": f"select line_of_business, {m('gross_written_premium_usd')} as gwp_usd from g_kpis group by 1",
    "wdg_combined_ratio_trend": "select month, line_of_business, avg(combined_ratio) as avg_combined_ratio from g_kpis group by 1, 2",
    "wdg_claims_table": "select line_of_business, product, peril, claim_count, total_incurred_usd, avg_severity_usd, cat_claim_count from g_claims",
    "wdg_tiv_by_state": f"select state_code, {m('total_insured_value_usd')} as tiv_usd from g_exposure group by 1",
    "wdg_tiv_by_cresta_region": f"select cresta_zone, region, {m('total_insured_value_usd')} as tiv_usd from g_exposure group by 1, 2",
    "wdg_premium_by_product_lob": f"select product, line_of_business, {m('annual_premium_usd')} as premium_usd from g_exposure group by 1, 2",
    "wdg_solvency_components": "select metric, sum(value_usd) as value_usd from g_solvency group by 1",
    "wdg_assets_by_class": f"select asset_class, {m('market_value_usd')} as mv_usd from g_assets group by 1",
    "wdg_mv_by_rating_class": f"select rating, asset_class, {m('market_value_usd')} as mv_usd from g_assets group by 1, 2",
    "wdg_alerts_by_type_severity": "select event_type, severity, count(alert_id) as alerts from g_alerts group by 1, 2",
    "wdg_exposed_tiv_by_state": f"select state_code, {m('exposed_tiv_usd')} as tiv_usd from g_alerts group by 1",
    "wdg_pml_table": "select title, event_type, severity, state_code, pml_estimate_usd, event_time_utc from g_pml",
    "wdg_counters": f"""select 'executive' as page, 'total_gwp' as counter, {m('gross_written_premium_usd')} as value from g_kpis
      union all select 'executive', 'total_nwp', {m('net_written_premium_usd')} from g_kpis
      union all select 'executive', 'total_claims', cast(sum(claim_count) as double) from g_kpis
      union all select 'solvency', case metric when 'Solvency Ratio' then 'solvency_ratio' when 'Own Funds' then 'own_funds' else 'scr_total' end, value_usd
        from g_solvency where metric in ('Solvency Ratio', 'Own Funds', 'SCR (Total)')
      union all select 'realtime', 'active_alerts', cast(count(*) as double) from g_alerts
      union all select 'realtime', 'states_with_alerts', cast(count(distinct state_code) as double) from g_alerts
      union all select 'realtime', 'total_exposed_tiv', {m('exposed_tiv_usd')} from g_alerts""",
    # event report
    "rpt_counts": """select 'NOAA active alerts' as source, count(*) as n from b_alert union all select 'GDACS catastrophes', count(*) from b_cat
      union all select 'USGS earthquakes', count(*) from b_quake union all select 'Weather obs', count(*) from b_weather union all select 'News items', count(*) from b_news""",
    "rpt_alerts_by_severity": "select coalesce(severity, 'Unknown') as severity, count(*) as alerts, count(distinct event_type) as distinct_event_types from b_alert group by b_alert.severity",
    "inc_alerts_by_severity": "select coalesce(severity, 'Unknown') as severity, count(*) as alerts, count(distinct event_type) as distinct_event_types from b_alert group by b_alert.severity",
    "rpt_top_exposed_alerts": f"""select event_type, severity, state_code, state_name, round(exposed_tiv_usd/1e9, 2) as exposed_tiv_busd, exposed_policy_count, effective_utc, expires_utc
      from g_alerts {ALERT_TOP} limit 20""",
    "rpt_top_pml_events": f"select title, event_type, severity, state_code, event_time_utc, {PML_COLS} from g_pml {PML_TOP} limit 15",
    "rpt_earthquakes": "select place, magnitude, depth_km, event_time_utc, severity from s_quake order by magnitude desc nulls last, event_id limit 10",
    "rpt_weather_extremes": """select city, round(temperature_f,1) as temp_f, round(wind_speed_mph,1) as wind_mph, round(wind_gust_mph,1) as gust_mph, round(precipitation_in,2) as precip_in,
        round(humidity_pct,0) as humidity_pct, observed_time_utc from s_weather order by coalesce(wind_gust_mph, 0) desc, observation_id limit 15""",
    "rpt_news": "select title, category, published_utc, link from s_news order by published_ts desc, news_id limit 12",
    "rpt_text_trim": "select news_id, case when length(summary) > 120 then substring(summary, 1, 119) || '…' else coalesce(summary, '') end as summary from s_news",
    # examples
    "ex_gwp_by_lob_ytd": f"select line_of_business, round({m('gross_written_premium_usd')}/1e6, 1) as gwp_musd from g_kpis where month >= date '2001-01-01' group by 1",
    "ex_combined_ratio_12m": f"select month as m, line_of_business, round(avg(combined_ratio)*100, 1) as combined_ratio_pct from g_kpis where month >= {AS_OF} - interval 12 months group by 1, 2",
    "ex_top10_perils": """select peril, claim_count, round(total_incurred_usd/1e6, 1) as incurred_musd, round(p95_severity_usd, 0) as p95_severity_usd, round(cat_share_of_loss*100, 1) as cat_share_pct
      from g_perils order by total_incurred_usd desc, peril limit 10""",
    "ex_book_health_personal": """select product, active_policy_count, round(claim_frequency_per_100, 2) as freq_per_100, round(avg_severity_usd, 0) as avg_severity_usd, round(loss_ratio*100, 1) as loss_ratio_pct
      from g_book where line_of_business = 'Personal'""",
    "ex_segments_over_100": f"""select {SEG}, round(combined_ratio*100, 1) as combined_ratio_pct, round(gross_premium_usd/1e6, 1) as gwp_musd
      from g_segments where combined_ratio > 1 and gross_premium_usd > 50000 order by combined_ratio desc, {SEG} limit 20""",
    "ex_tiv_by_state": f"select state_code, round({m('total_insured_value_usd')}/1e9, 2) as tiv_busd, cast(sum(policy_count) as bigint) as policies from g_exposure group by 1",
    "ex_solvency_breakdown": "select metric, round(value_usd, 2) as value_usd from g_solvency",
    "ex_asset_breakdown": f"""select asset_class, rating, round({m('market_value_usd')}/1e6, 1) as mv_musd, round(avg(avg_yield_pct)*100, 2) as avg_yield_pct, {half_up('avg(avg_duration_yrs)', 2)} as avg_duration_yrs
      from g_assets group by 1, 2""",
    "ex_ceded_by_reinsurer": f"""select reinsurer, treaty_type, round({m('premium_ceded_usd')}/1e6, 1) as ceded_musd, round(avg(avg_cession_pct)*100, 1) as avg_cession_pct,
        cast(sum(treaty_count) as bigint) as treaty_count from g_reins group by 1, 2""",
    "ex_active_alerts": f"""select event_type, severity, urgency, state_code, state_name, round(exposed_tiv_usd/1e9, 2) as exposed_tiv_busd, exposed_policy_count, effective_utc, expires_utc
      from g_alerts {ALERT_TOP} limit 20""",
    "ex_pml_events": f"select event_type, severity, title, state_code, {PML_COLS} from g_pml {PML_TOP} limit 20",
    "ex_claims_by_report_lag": """select claim_id, line_of_business, product, peril, state_code, report_lag_days, round(incurred_amount_usd/1e3, 1) as incurred_kusd, claim_status, loss_date, report_date
      from g_clm360 order by report_lag_days desc, claim_id limit 20""",
    "bm_active_policies": "select cast(sum(active_policy_count) as bigint) as active_policies from g_book",
    "bm_combined_ratio_personal": f"select round(avg(combined_ratio)*100, 1) as combined_ratio_pct from g_kpis where line_of_business = 'Personal' and month >= {AS_OF} - interval 12 months",
    "bm_top5_states_tiv": f"select state_code, round({m('total_insured_value_usd')}/1e9, 2) as tiv_busd from g_exposure group by 1 order by tiv_busd desc, state_code limit 5",
    "bm_cat_claims": "select count(*) as cat_claims from b_clm where catastrophe_code is not null",
    "bm_cyber_severity": "select round(cast(sum(incurred_amount_usd) as double)/count(*), 0) as avg_severity_usd from b_clm where product = 'Cyber'",
    "bm_solvency_ratio": "select value_usd as solvency_ratio from g_solvency where metric = 'Solvency Ratio'",
    "bm_ceded_one_reinsurer": f"select round({m('premium_ceded_usd')}/1e6, 1) as ceded_musd from g_reins where reinsurer = 'Reinsurer 1'",
    "bm_aaa_yield": "select round(avg(avg_yield_pct)*100, 2) as avg_yield_pct from g_assets where rating = 'AAA'",
    "bm_alert_count": "select count(*) as alerts from g_alerts where exposed_tiv_usd is not null",
    "bm_top5_perils_p95": "select peril, round(p95_severity_usd, 0) as p95_severity_usd from g_perils order by g_perils.p95_severity_usd desc, peril limit 5",
    # snippets
    "snp_worst_segments": f"select * from g_segments where gross_premium_usd > 50000 order by combined_ratio desc, {SEG} limit 20",
    "snp_active_cat": f"""select event_type, severity, state_code, round(exposed_tiv_usd/1e9, 2) as exposed_tiv_busd, exposed_policy_count, effective_utc from g_alerts {ALERT_TOP} limit 20""",
    "snp_solvency_trend": """select reporting_date, solvency_ratio_pct, case when solvency_ratio_pct >= 200 then 'Strong' when solvency_ratio_pct >= 150 then 'Adequate'
        when solvency_ratio_pct >= 100 then 'Recovery plan' else 'Intervention' end as status from b_pc_solvency""",
    "snp_ibnr_by_ay": f"""select accident_year, line_of_business, {fine('case_reserves_eur_m')} as case_reserves_eur_m, {fine('ibnr_eur_m')} as ibnr_eur_m, {fine('ultimate_loss_eur_m')} as ultimate_loss_eur_m
      from g_triangle group by 1, 2""",
    "snp_non_ig_share": f"""select round({m("case when rating in ('BB','B','CCC','NotRated') then market_value_usd else 0 end")} * 100 / {m('market_value_usd')}, 2) as pct_non_ig from g_assets""",
    "faq_latest_quarter": "select sub_line, combined_ratio_pct from b_pc_combined where reporting_quarter = (select max(reporting_quarter) from b_pc_combined)",
    "faq_ytd_vs_pytd": f"""select case when d >= date '2001-01-01' then 'YTD' else 'PYTD' end as period, line_of_business, coalesce(cast(sum(p) as double), 0.0::double) as gwp_usd,
        coalesce(cast(sum(i) as double), 0.0::double) as incurred_usd, count(c) as claims
      from (select billing_month as d, line_of_business, gross_premium_usd as p, null as i, null as c from s_prem
        union all select loss_date, line_of_business, null, incurred_amount_usd, 1 from s_clm) t
      where d between date '2001-01-01' and {AS_OF} or d between date '2000-01-01' and date '2000-11-04' group by 1, 2""",
    # questions
    "cq_01": f"""select line_of_business, round((inc + com) / gwp * 100, 1) as combined_ratio_pct, 101.0::double as benchmark_pct, round(round((inc + com) / gwp * 100, 1) - 101.0::double, 1) as delta_pts
      from (select line_of_business, {m('gross_written_premium_usd')} as gwp, {m('incurred_loss_usd')} as inc, {m('commission_usd')} as com from g_kpis where month between date '2001-10-01' and date '2001-12-31' group by 1) t""",
    "cq_02": f"select month, line_of_business, round({m('gross_written_premium_usd')}/1e6, 1) as gwp_musd from g_kpis where month >= {AS_OF} - interval 12 months group by 1, 2",
    "cq_03": "select reporting_quarter, line_of_business, sub_line, combined_ratio_pct from b_pc_combined where combined_ratio_pct > 100",
    "cq_04": """select p.quarter, premium_usd, coalesce(incurred_usd, 0.0::double) as incurred_usd, round(coalesce(incurred_usd, 0.0::double) / premium_usd * 100, 1) as loss_ratio_pct
      from (select cast(date_trunc('quarter', billing_month) as date) as quarter, cast(sum(gross_premium_usd) as double) as premium_usd from b_prem where product = 'Auto' group by 1) p
      left join (select cast(date_trunc('quarter', loss_date) as date) as quarter, cast(sum(incurred_amount_usd) as double) as incurred_usd from b_clm where product = 'Auto' group by 1) c using (quarter)
      where p.quarter >= date '2001-01-01'""",
    "cq_06": "select count(*) as cat_claims, cast(sum(incurred_amount_usd) as double) as incurred_usd from b_clm where catastrophe_code is not null and year(loss_date) = 2001",
    "cq_07": "select line_of_business, product, round(claim_frequency_per_100, 2) as freq_per_100 from g_book",
    "cq_08": """select claim_id, line_of_business, product, peril, state_code, reserve_amount_usd, incurred_amount_usd from g_clm360 where claim_status = 'Open'
      order by reserve_amount_usd desc, claim_id limit 20""",
    "cq_09": "select line_of_business, round(sum(report_lag_days) / count(report_lag_days), 2) as avg_report_lag_days from g_clm360 group by 1",
    "cq_10": "select count(*) as fraud_claims, cast(sum(incurred_amount_usd) as double) / count(*) as avg_severity_usd from b_clm where fraud_flag",
    "cq_12": f"select region, round({m('total_insured_value_usd')}/1e9, 2) as tiv_busd, cast(sum(policy_count) as bigint) as policies from g_exposure where product = 'Cyber' group by 1",
    "cq_13": f"select cresta_zone, {m('total_insured_value_usd')} as tiv_usd from g_exposure where product in ('Property', 'Marine') group by 1 order by 2 desc, 1 limit 10",
    "cq_14": "select reporting_date, solvency_ratio_pct, solvency_ratio_pct >= 150 as healthy from b_pc_solvency order by 1 desc limit 4",
    "cq_15": """select reporting_date, v.module, v.scr_eur_m from b_pc_solvency, lateral (values ('Market', scr_market_risk), ('Underwriting non-life', scr_underwriting_non_life),
        ('Underwriting life', scr_underwriting_life), ('Underwriting health', scr_underwriting_health), ('Credit', scr_credit_risk), ('Operational', scr_operational_risk)) v(module, scr_eur_m)""",
    "cq_16": """select reporting_date, diversification_benefit, g as gross_scr_eur_m, round(-diversification_benefit * 100 / g, 1) as benefit_pct_of_gross from (
        select *, scr_market_risk + scr_underwriting_non_life + scr_underwriting_life + scr_underwriting_health + scr_credit_risk + scr_operational_risk as g from b_pc_solvency) t""",
    "cq_17": "select line_of_business, development_period, cumulative_paid_eur_m from g_triangle where accident_year = 1997",
    "cq_18": f"select line_of_business, {fine('ibnr')} as ibnr_eur_m from x_newest group by 1",
    "cq_19": f"select accident_year, {fine('ult')} as ultimate_loss_eur_m from x_newest where accident_year = 2000 group by 1",
    "cq_20": """select reinsurer, round(cast(sum(premium_ceded_usd) as double)/1e6, 2) as ceded_musd, count(*) as treaties from b_treaty
      where treaty_start < date '2002-01-01' and treaty_end >= date '2001-01-01' group by 1""",
    "cq_21": """select treaty_id, treaty_type, reinsurer, line_of_business, round(cast(cession_pct as double)*100, 1) as cession_pct from b_treaty
      order by b_treaty.cession_pct desc, treaty_id limit 20""",
    "cq_22": """select treaty_type, cast(sum(premium_ceded_usd) as double) as ceded_usd, cast(sum(limit_usd) as double) as limit_usd,
        case when sum(limit_usd) > 0 then cast(sum(premium_ceded_usd) as double) / cast(sum(limit_usd) as double) end as utilisation from b_treaty group by 1""",
    "cq_23": """select cast(sum(market_value_usd * duration_yrs) as double) / cast(sum(market_value_usd) as double) as weighted_duration_yrs,
        cast(sum(market_value_usd * yield_pct) as double) / cast(sum(market_value_usd) as double) as weighted_yield,
        cast(sum(duration_yrs) as double) / count(*) as simple_duration_yrs, cast(sum(yield_pct) as double) / count(*) as simple_yield from b_asset""",
    "cq_24": f"select rating, asset_class, {m('market_value_usd')} as market_value_usd, cast(sum(position_count) as bigint) as positions from g_assets group by 1, 2",
    "cq_28": f"""select channel, incurred_usd, premium_usd, incurred_usd / premium_usd as loss_ratio from (
        select channel, {m('incurred_loss_usd')} as incurred_usd, {m('gross_premium_usd')} as premium_usd from g_segments group by 1) t order by 4 desc, 1 limit 1""",
    "cq_29": """select loyalty_tier, count(*) as policies, cast(sum(annual_premium_usd) as double) / count(*) as avg_premium_usd from s_pol join s_cust using (customer_id)
      where loyalty_tier in ('Platinum', 'Bronze') group by 1""",
}

SAME_AS = {
    "snp_ytd_gwp": "ex_gwp_by_lob_ytd", "snp_cr_trend": "ex_combined_ratio_12m", "snp_top_perils": "ex_top10_perils",
    "cq_05": "ex_top10_perils", "cq_11": "ex_tiv_by_state", "cq_25": "snp_non_ig_share", "cq_26": "ex_active_alerts",
    "cq_27": "ex_pml_events",
}
QUERIES |= {alias: QUERIES[of] for alias, of in SAME_AS.items()}
