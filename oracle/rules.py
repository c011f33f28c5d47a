"""Oracle queries for the semantic layer, business rules and analytics over time."""

from oracle.base import CTES
from oracle.reports import AS_OF, m

CTES["x_bench"] = """select * from (values ('Auto',99.0::double,6.0::double,5000.0::double),('Home',108.0,5.0,15000.0),('Property',93.0,3.0,60000.0),('GeneralLiability',98.0,2.0,25000.0),
  ('WorkersComp',88.0,3.0,40000.0),('DandO',104.0,null,null),('ProfessionalLiability',99.0,null,null),('Cyber',95.0,1.5,200000.0),('Marine',92.0,2.0,40000.0),('Aviation',98.0,0.4,1200000.0)) t(product, cr, freq, sev)"""
CTES["x_climate_y"] = """select line_of_business, sub_line, exposure_year, cast(sum(climate_risk_factor) as double) / count(*) as climate_factor, cast(sum(pml_eur) as double) as exposure_eur
  from b_pc_risk join b_pc_pol using (policy_id) group by 1, 2, 3"""
CTES["x_climate"] = """select y.*, b.exposure_eur as exposure_before_eur, coalesce(y.climate_factor > 0.30::double and y.exposure_eur > b.exposure_eur, false) as flagged
  from x_climate_y y left join x_climate_y b on b.line_of_business = y.line_of_business and b.sub_line = y.sub_line and b.exposure_year = y.exposure_year - 1"""
CTES["x_cession"] = """select treaty_id, line_of_business, round(cast(cession_pct as double)*100, 1) as cession_pct from b_treaty"""
CTES["x_freq"] = """select line_of_business, b.product, claim_frequency_per_100, avg_severity_usd, x.freq as frequency_benchmark, x.sev as severity_benchmark,
    claim_frequency_per_100 > x.freq * 2 as frequency_flag, avg_severity_usd > x.sev * 2 as severity_flag from g_book b left join x_bench x on x.product = b.product"""
CTES["x_monthly"] = """select line_of_business, cast(date_trunc('month', loss_date) as date) as month, count(*) as claim_count, sum(incurred_amount_usd) as incurred from b_clm group by 1, 2"""
CTES["x_base"] = """select a.line_of_business, a.month, a.claim_count, cast(a.incurred as double) as incurred_usd, count(b.month) as baseline_months,
    cast(sum(b.claim_count) as double) / nullif(count(b.month), 0) as baseline_count, cast(sum(b.incurred) as double) / nullif(count(b.month), 0) as baseline_incurred_usd
  from x_monthly a left join x_monthly b on a.line_of_business = b.line_of_business and b.month < a.month and b.month >= a.month - interval 36 months group by all"""
CTES["x_lrq"] = """select p.line_of_business, p.quarter, premium_usd, coalesce(incurred_usd, 0.0::double) as incurred_usd, coalesce(incurred_usd, 0.0::double) / premium_usd as loss_ratio
  from (select line_of_business, cast(date_trunc('quarter', billing_month) as date) as quarter, cast(sum(gross_premium_usd) as double) as premium_usd from b_prem group by 1, 2) p
  left join (select line_of_business, cast(date_trunc('quarter', loss_date) as date) as quarter, cast(sum(incurred_amount_usd) as double) as incurred_usd from b_clm group by 1, 2) c using (line_of_business, quarter)"""
CTES["x_cycle"] = """select line_of_business, cast(date_trunc('quarter', loss_date) as date) as quarter, count(*) as open_claims,
    cast(sum(date_diff('day', loss_date, report_date)) as double) / count(*) as avg_cycle_days from b_clm where claim_status in ('Open', 'InvestigationInProgress', 'Litigation') group by 1, 2"""

PERIODS = {
    "current_year": "month between date '2001-01-01' and date '2001-12-31'",
    "ytd": "month between date '2001-01-01' and date '2001-10-31'",
    "pytd": "month between date '2000-01-01' and date '2000-10-31'",
    "this_quarter": "month between date '2001-10-01' and date '2001-12-31'",
    "last_quarter": "month between date '2001-08-01' and date '2001-10-31'",
    "last_12_months": "month >= date '2000-11-04'",
}

QUERIES: dict[str, str] = {
    "sem_measures": f"""select 'total_gwp_musd' as measure, round({m('gross_written_premium_usd')}/1e6, 1) as value from g_kpis
      union all select 'total_incurred_musd', round({m('incurred_loss_usd')}/1e6, 1) from g_kpis
      union all select 'avg_combined_ratio_pct', round(avg(combined_ratio)*100, 1) from g_kpis
      union all select 'total_claim_count', cast(sum(claim_count) as double) from g_perils
      union all select 'total_tiv_busd', round({m('total_insured_value_usd')}/1e9, 2) from g_exposure""",
    "sem_filters": f"""select 'current_year' as filter, count(*) as kept from g_kpis where month >= date '2001-01-01'
      union all select 'last_12_months', count(*) from g_kpis where month >= {AS_OF} - interval 12 months
      union all select 'active_policies', count(*) from g_pol360 where policy_status = 'Active'
      union all select 'catastrophe_claims', count(*) from g_clm360 where is_cat
      union all select 'personal_lines', count(*) from g_pol360 where line_of_business = 'Personal'""",
    "sem_expressions": """select 'policy_year' as expression, cast(year(effective_date) as double) as value, count(*) as n from g_pol360 group by 2
      union all select 'loss_ratio_pct', round(loss_ratio*100, 1), count(*) from g_kpis group by 2
      union all select 'severity_pct', round(severity_pct_of_sum_insured*100, 1), count(*) from g_clm360 group by 2""",
    "sem_joins": """select 'claim_policy' as name, 'N:1' as relationship, (select count(*) from g_clm360 c join g_pol360 p on c.policy_id = p.policy_id) as joined_rows,
        (select count(*) from g_clm360 where policy_id not in (select policy_id from g_pol360)) as unmatched_left, (select count(*) = count(distinct policy_id) from g_pol360) as right_unique
      union all select 'event_exposure', 'N:M', (select count(*) from g_alerts a join g_exposure e on a.state_code = e.state_code),
        (select count(*) from g_alerts where state_code not in (select state_code from g_exposure)), (select count(*) = count(distinct state_code) from g_exposure)
      union all select 'pml_exposure', 'N:M', (select count(*) from g_pml a join g_exposure e on a.state_code = e.state_code),
        (select count(*) from g_pml where state_code not in (select state_code from g_exposure)), (select count(*) = count(distinct state_code) from g_exposure)""",
    "sem_query": f"""select line_of_business, round({m('gross_written_premium_usd')}/1e6, 1) as total_gwp_musd, round({m('incurred_loss_usd')}/1e6, 1) as total_incurred_musd,
        round(avg(combined_ratio)*100, 1) as avg_combined_ratio_pct from g_kpis where month >= {AS_OF} - interval 12 months group by 1""",
    "sem_synonyms": f"select state_code, line_of_business, round({m('total_insured_value_usd')}/1e9, 2) as total_tiv_busd from g_exposure group by 1, 2",
    "rule_cr_benchmark": """select reporting_quarter, line_of_business, sub_line, combined_ratio_pct, coalesce(cr, 101.0::double) as benchmark_pct, round(combined_ratio_pct - coalesce(cr, 101.0::double), 1) as delta_pts
      from b_pc_combined left join x_bench on product = sub_line""",
    "rule_freq_sev_benchmark": "select * from x_freq",
    "rule_solvency_band": """select reporting_date, solvency_ratio_pct, case when solvency_ratio_pct > 200 then 'Strong' when solvency_ratio_pct >= 150 then 'Adequate'
        when solvency_ratio_pct >= 100 then 'Recovery plan required' else 'Regulatory intervention' end as band from b_pc_solvency""",
    "rule_cession_band": """select treaty_id, c.line_of_business, cession_pct, case when cession_pct between lo and hi then 'Within' when cession_pct < lo then 'Below' else 'Above' end as band, cession_pct > 80 as heavy_reliance
      from x_cession c join (values ('Personal', 10, 30), ('Commercial', 30, 60), ('Specialty', 60, 80)) r(line, lo, hi) on r.line = c.line_of_business""",
    "rule_esg_band": """select asset_class, case when esg_score > 70 then 'Strong' when esg_score >= 50 then 'Average' else 'Weak' end as band, count(*) as positions, cast(sum(market_value_usd) as double) as market_value_usd
      from b_asset group by 1, 2""",
    "rule_climate_flag": "select * from x_climate",
    "rule_anomaly_flags": """select 'combined_ratio' as kpi, reporting_quarter || '/' || line_of_business || '/' || sub_line as key, combined_ratio_pct as value, 110.0::double as threshold from b_pc_combined where combined_ratio_pct > 110
      union all select 'solvency_ratio', cast(reporting_date as varchar), solvency_ratio_pct, 150.0 from b_pc_solvency where solvency_ratio_pct < 150
      union all select 'frequency', line_of_business || '/' || product, claim_frequency_per_100, frequency_benchmark * 2 from x_freq where frequency_flag
      union all select 'severity', line_of_business || '/' || product, avg_severity_usd, severity_benchmark * 2 from x_freq where severity_flag
      union all select 'climate', line_of_business || '/' || sub_line || '/' || cast(exposure_year as varchar), climate_factor, 0.30::double from x_climate where climate_factor > 0.30::double
      union all select 'cession', cast(treaty_id as varchar), cession_pct, 80.0 from x_cession where cession_pct > 80""",
    "rule_periods": " union all ".join(
        f"""select '{name}' as period, count(*) as cells, min(month) as first_month, max(month) as last_month, {m('gross_written_premium_usd')} as gwp_usd, {m('incurred_loss_usd')} as incurred_usd from g_kpis where {cond}"""
        for name, cond in PERIODS.items()
    ),
    "ext_baseline_36m": """select *, abs(frequency_index - severity_index) > 0.25::double as decoupled from (select *, loss_index / frequency_index as severity_index from (
        select *, claim_count / baseline_count as frequency_index, incurred_usd / baseline_incurred_usd as loss_index from x_base) a) b""",
    "ext_lr_qoq": "select *, (loss_ratio - lag(loss_ratio) over (partition by line_of_business order by quarter)) * 100 as change_pts from x_lrq",
    "ext_cycle_time": """select line_of_business, quarter, open_claims, avg_cycle_days, (avg_cycle_days - before) / before * 100 as change_pct
      from (select *, lag(avg_cycle_days) over (partition by line_of_business order by quarter) as before from x_cycle) t""",
    "ext_triangle_build": "select * from g_triangle",
    "ext_exposure_as_of": f"""select state_code, line_of_business, cast(sum(sum_insured_usd) as double) as tiv_usd, count(*) as policies from b_pol join s_geo using (geo_id)
      where effective_date <= {AS_OF} and expiration_date > {AS_OF} group by 1, 2""",
}
