"""Oracle queries for silver tables, quality rules and gold marts."""

from oracle.base import public

QUERIES: dict[str, str] = {
    "slv_dim_geography": "select * from s_geo",
    "slv_dim_customer": "select * from s_cust",
    "slv_dim_agent": public("s_agent", "ytd_commission_usd"),
    "slv_dim_policy": public("s_pol", "annual_premium_usd sum_insured_usd deductible_usd underwriter_score"),
    "slv_fact_premium": public("s_prem", "gross_premium_usd commission_usd tax_usd ceded_to_reinsurance_usd net_premium_usd"),
    "slv_fact_claim": public("s_clm", "incurred_amount_usd paid_amount_usd reserve_amount_usd salvage_recovery_usd subrogation_recovery_usd net_paid_usd"),
    "slv_fact_exposure": """select policy_id, customer_id, geo_id, line_of_business, product, cast(sum_insured_usd as double) as total_insured_value_usd,
        cast(annual_premium_usd as double) as annual_premium_usd, reinsured, effective_date, expiration_date from b_pol""",
    "slv_dim_reinsurance_treaty": public("b_treaty", "cession_pct limit_usd retention_usd premium_ceded_usd"),
    "slv_dim_asset": public("s_asset", "market_value_usd book_value_usd yield_pct duration_yrs esg_score"),
    "slv_weather_observations": "select * from s_weather",
    "slv_catastrophe_events": "select * from s_cat",
    "slv_earthquake_events": "select * from s_quake",
    "slv_noaa_alerts": "select * from s_alert",
    "slv_news_events": "select * from s_news",
    "slv_pc_policies": public("s_pc_pol", "gwp_eur"),
    "slv_pc_claims": public("s_pc_clm", "paid_amount reserved_amount net_paid_usd"),
    "slv_pc_investment_assets": public("s_pc_asset", "market_value_eur yield_pct duration_yrs esg_score"),
    "slv_pc_reinsurance_treaties": public("s_pc_treaty", "limit_eur_m ceded_premium_eur_m cession_pct"),
    "slv_pc_weather_events": public("s_pc_weather", "insured_loss_eur_m"),
    "slv_pc_realtime_events": public("s_pc_realtime", "relevance_score"),
    "slv_pc_combined_ratios": "select * from b_pc_combined",
    "slv_pc_loss_development": public("b_pc_triangle", "incremental_paid_eur_m case_reserves_eur_m"),
    "slv_pc_risk_exposure": public("b_pc_risk", "pml_eur climate_risk_factor"),
    "slv_pc_solvency_metrics": "select * from b_pc_solvency",
    "dq_report": """
      select 'dim_geography' as table_name, 'valid_geo_id' as rule, 'drop' as action, count(geo_id) as passed, count(*) - count(geo_id) as failed from b_geo
      union all select 'dim_geography', 'valid_lat', 'warn', count(*) filter (where latitude between -90 and 90), count(*) filter (where (latitude between -90 and 90) is not true) from b_geo
      union all select 'dim_customer', 'valid_customer', 'drop', count(customer_id), count(*) - count(customer_id) from b_cust
      union all select 'dim_policy', 'valid_policy', 'drop', count(policy_id), count(*) - count(policy_id) from b_pol
      union all select 'dim_policy', 'premium_positive', 'warn', count(*) filter (where annual_premium_usd >= 0), count(*) filter (where (annual_premium_usd >= 0) is not true) from b_pol
      union all select 'fact_premium', 'premium_amount_valid', 'warn', count(*) filter (where gross_premium_usd >= 0), count(*) filter (where (gross_premium_usd >= 0) is not true) from b_prem
      union all select 'fact_claim', 'amount_positive', 'warn', count(*) filter (where incurred_amount_usd >= 0), count(*) filter (where (incurred_amount_usd >= 0) is not true) from b_clm
      union all select 'weather_observations', 'valid_lat', 'warn', count(*) filter (where latitude between -90 and 90), count(*) filter (where (latitude between -90 and 90) is not true) from b_weather""",
    "dq_expect_warn": """select 'dim_geography' as table_name, count(*) as kept, count(*) filter (where (latitude between -90 and 90) is not true) as flagged from b_geo
      union all select 'weather_observations', count(*), count(*) filter (where (latitude between -90 and 90) is not true) from b_weather
      union all select 'dim_policy', count(*), count(*) filter (where (annual_premium_usd >= 0) is not true) from b_pol
      union all select 'fact_premium', count(*), count(*) filter (where (gross_premium_usd >= 0) is not true) from b_prem
      union all select 'fact_claim', count(*), count(*) filter (where (incurred_amount_usd >= 0) is not true) from b_clm""",
    "dq_expect_or_drop": "select customer_id, customer_name, geo_id from b_cust where customer_id is not null",
    "gld_underwriting_kpis": "select * from g_kpis",
    "gld_claims_summary": "select * from g_claims",
    "gld_exposure_accumulation": "select * from g_exposure",
    "gld_solvency_capital": "select * from g_solvency",
    "gld_asset_portfolio_summary": "select * from g_assets",
    "gld_reinsurance_summary": "select * from g_reins",
    "gld_event_risk_correlation": "select * from g_alerts",
    "inc_event_risk_correlation": "select * from g_alerts",
    "gld_cat_event_pml": "select * from g_pml",
    "gld_policy_customer_360": "select * from g_pol360",
    "gld_claim_360": "select * from g_clm360",
    "gld_loss_ratio_by_segment": "select * from g_segments",
    "gld_book_health": "select * from g_book",
    "gld_peril_loss_summary": "select * from g_perils",
}
