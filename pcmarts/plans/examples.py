"""Example queries, benchmark queries and the snippet library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.functions.bands import NON_INVESTMENT_GRADE, solvency_tier
from pcmarts.functions.dates import period_filter, since_months
from pcmarts.functions.money import FINE, billions, in_units, mean, millions, percent, retotal, rounded, total
from pcmarts.operators.shapes import stack
from pcmarts.plans import gold
from pcmarts.plans.registry import high, low, query, top
from pcmarts.plans.reports import (
    by_exposed_tiv, SEGMENT, pml_figures, sizeable_segments, with_exposed_tiv,
)
from pcmarts.workspace import Workspace


def this_year_on(ws: Workspace, c: str):
    """From the first day of the reporting year, open ended."""
    return F.col(c) >= F.trunc(F.lit(ws.as_of), "year")


@query("ex_gwp_by_lob_ytd", "snp_ytd_gwp")
def gwp_by_lob(ws: Workspace) -> DataFrame:
    return (
        ws.table("underwriting_kpis").filter(this_year_on(ws, "month")).groupBy("line_of_business")
        .agg(millions(retotal("gross_written_premium_usd")).alias("gwp_musd")).orderBy(high("gwp_musd"))
    )


@query("ex_combined_ratio_12m", "snp_cr_trend")
def combined_ratio_trend(ws: Workspace) -> DataFrame:
    return (
        ws.table("underwriting_kpis").filter(since_months("month", ws.as_of, 12))
        .groupBy(F.col("month").alias("m"), "line_of_business")
        .agg(percent(F.avg("combined_ratio")).alias("combined_ratio_pct")).orderBy("m", "line_of_business")
    )


@query("ex_top10_perils", "snp_top_perils", "cq_05")
def top_perils(ws: Workspace) -> DataFrame:
    return top(ws.table("peril_loss_summary"), 10, high("total_incurred_usd"), low("peril")).select(
        "peril", "claim_count", millions("total_incurred_usd").alias("incurred_musd"),
        rounded("p95_severity_usd", 0).alias("p95_severity_usd"), percent("cat_share_of_loss").alias("cat_share_pct"),
    )


@query("ex_book_health_personal")
def personal_book(ws: Workspace) -> DataFrame:
    return (
        ws.table("book_health").filter(F.col("line_of_business") == "Personal")
        .select(
            "product", "active_policy_count", rounded("claim_frequency_per_100", 2).alias("freq_per_100"),
            rounded("avg_severity_usd", 0).alias("avg_severity_usd"), percent("loss_ratio").alias("loss_ratio_pct"),
        )
        .orderBy(high("active_policy_count"), low("product"))
    )


@query("ex_segments_over_100")
def loss_making_segments(ws: Workspace) -> DataFrame:
    bad = sizeable_segments(ws).filter(F.col("combined_ratio") > 1)
    return top(bad, 20, high("combined_ratio"), *map(low, SEGMENT)).select(
        *SEGMENT, percent("combined_ratio").alias("combined_ratio_pct"), millions("gross_premium_usd").alias("gwp_musd")
    )


@query("ex_tiv_by_state", "cq_11")
def tiv_by_state(ws: Workspace) -> DataFrame:
    return (
        ws.table("exposure_accumulation").groupBy("state_code")
        .agg(billions(retotal("total_insured_value_usd")).alias("tiv_busd"), F.sum("policy_count").alias("policies"))
        .orderBy(high("tiv_busd"), low("state_code"))
    )


@query("ex_solvency_breakdown")
def solvency_breakdown(ws: Workspace) -> DataFrame:
    return ws.table("solvency_capital").select("metric", rounded("value_usd", 2).alias("value_usd")).orderBy(
        high("value_usd"), low("metric")
    )


@query("ex_asset_breakdown")
def asset_breakdown(ws: Workspace) -> DataFrame:
    return (
        ws.table("asset_portfolio_summary").groupBy("asset_class", "rating")
        .agg(
            millions(retotal("market_value_usd")).alias("mv_musd"), percent(F.avg("avg_yield_pct"), 2).alias("avg_yield_pct"),
            rounded(F.avg("avg_duration_yrs"), 2).alias("avg_duration_yrs"),
        )
        .orderBy(high("mv_musd"), low("asset_class"), low("rating"))
    )


@query("ex_ceded_by_reinsurer")
def ceded_by_reinsurer(ws: Workspace) -> DataFrame:
    """The cession is an average of the averages per line, as published."""
    return (
        ws.table("reinsurance_summary").groupBy("reinsurer", "treaty_type")
        .agg(
            millions(retotal("premium_ceded_usd")).alias("ceded_musd"),
            percent(F.avg("avg_cession_pct")).alias("avg_cession_pct"), F.sum("treaty_count").alias("treaty_count"),
        )
        .orderBy(high("ceded_musd"), low("reinsurer"), low("treaty_type"))
    )


@query("ex_active_alerts", "cq_26")
def active_alerts(ws: Workspace) -> DataFrame:
    return top(with_exposed_tiv(ws), 20, *by_exposed_tiv()).select(
        "event_type", "severity", "urgency", "state_code", "state_name",
        billions("exposed_tiv_usd").alias("exposed_tiv_busd"), "exposed_policy_count", "effective_utc", "expires_utc",
    )


@query("snp_active_cat")
def active_exposure(ws: Workspace) -> DataFrame:
    return active_alerts(ws).select(
        "event_type", "severity", "state_code", "exposed_tiv_busd", "exposed_policy_count", "effective_utc"
    )


@query("ex_pml_events", "cq_27")
def pml_events(ws: Workspace) -> DataFrame:
    return gold.worst_pml(ws, 20).select("event_type", "severity", "title", "state_code", *pml_figures())


@query("ex_claims_by_report_lag")
def slowest_reports(ws: Workspace) -> DataFrame:
    lag = F.datediff("report_date", "loss_date")
    latest = top(ws.table("fact_claim").withColumn("_lag", lag), 20, high("_lag"), low("claim_id")).drop("_lag")
    return top(gold.claims_360(ws, latest), 20, high("report_lag_days"), low("claim_id")).select(
        "claim_id", "line_of_business", "product", "peril", "state_code", "report_lag_days",
        in_units("incurred_amount_usd", 1e3, 1).alias("incurred_kusd"), "claim_status", "loss_date", "report_date",
    )


# --- benchmark questions ------------------------------------------------------------------------


@query("bm_active_policies")
def active_policies(ws: Workspace) -> DataFrame:
    return ws.table("book_health").agg(F.sum("active_policy_count").alias("active_policies"))


@query("bm_combined_ratio_personal")
def personal_combined_ratio(ws: Workspace) -> DataFrame:
    rows = ws.table("underwriting_kpis").filter(
        (F.col("line_of_business") == "Personal") & since_months("month", ws.as_of, 12)
    )
    return rows.agg(percent(F.avg("combined_ratio")).alias("combined_ratio_pct"))


@query("bm_top5_states_tiv")
def top_states(ws: Workspace) -> DataFrame:
    return tiv_by_state(ws).drop("policies").limit(5)


@query("bm_cat_claims")
def cat_claims(ws: Workspace) -> DataFrame:
    return ws.table("fact_claim").filter("is_cat").agg(F.count(F.lit(1)).alias("cat_claims"))


@query("bm_cyber_severity")
def cyber_severity(ws: Workspace) -> DataFrame:
    cyber = ws.table("fact_claim").filter(F.col("product") == "Cyber")
    return cyber.agg(rounded(mean("incurred_amount_usd"), 0).alias("avg_severity_usd"))


@query("bm_solvency_ratio")
def solvency_ratio(ws: Workspace) -> DataFrame:
    return ws.table("solvency_capital").filter(F.col("metric") == "Solvency Ratio").select(
        F.col("value_usd").alias("solvency_ratio")
    )


def ceded_to(ws: Workspace, reinsurer: str) -> DataFrame:
    rows = ws.table("reinsurance_summary").filter(F.col("reinsurer") == reinsurer)
    return rows.agg(millions(retotal("premium_ceded_usd")).alias("ceded_musd"))


@query("bm_ceded_one_reinsurer")
def ceded_to_one(ws: Workspace) -> DataFrame:
    return ceded_to(ws, "Reinsurer 1")


@query("bm_aaa_yield")
def aaa_yield(ws: Workspace) -> DataFrame:
    rows = ws.table("asset_portfolio_summary").filter(F.col("rating") == "AAA")
    return rows.agg(percent(F.avg("avg_yield_pct"), 2).alias("avg_yield_pct"))


@query("bm_alert_count")
def alert_count(ws: Workspace) -> DataFrame:
    return with_exposed_tiv(ws).agg(F.count(F.lit(1)).alias("alerts"))


@query("bm_top5_perils_p95")
def top_perils_p95(ws: Workspace) -> DataFrame:
    return top(ws.table("peril_loss_summary"), 5, high("p95_severity_usd"), low("peril")).select(
        "peril", rounded("p95_severity_usd", 0).alias("p95_severity_usd")
    )


# --- snippets -----------------------------------------------------------------------------------


@query("snp_worst_segments")
def worst_segments(ws: Workspace) -> DataFrame:
    return top(sizeable_segments(ws), 20, high("combined_ratio"), *map(low, SEGMENT))


@query("snp_solvency_trend")
def solvency_trend(ws: Workspace) -> DataFrame:
    return ws.table("pc_solvency_metrics").select(
        "reporting_date", "solvency_ratio_pct", solvency_tier("solvency_ratio_pct").alias("status")
    ).orderBy(high("reporting_date"))


@query("snp_ibnr_by_ay")
def ibnr_by_accident_year(ws: Workspace) -> DataFrame:
    figures = ("case_reserves_eur_m", "ibnr_eur_m", "ultimate_loss_eur_m")
    return (
        ws.table("loss_triangle").groupBy("accident_year", "line_of_business")
        .agg(*[total(c, FINE).alias(c) for c in figures]).orderBy(high("accident_year"), low("line_of_business"))
    )


@query("snp_non_ig_share", "cq_25")
def non_investment_grade(ws: Workspace) -> DataFrame:
    value = F.col("market_value_usd")
    weak = F.when(F.col("rating").isin(*NON_INVESTMENT_GRADE), value).otherwise(0.0)
    return ws.table("asset_portfolio_summary").agg(
        F.round(F.try_divide(retotal(weak) * 100, retotal(value)), 2).alias("pct_non_ig")
    )


@query("faq_latest_quarter")
def latest_quarter(ws: Workspace) -> DataFrame:
    ratios = ws.table("pc_combined_ratios")
    latest = ratios.agg(F.max("reporting_quarter"))
    return ratios.filter(F.col("reporting_quarter") == latest.scalar()).select("sub_line", "combined_ratio_pct")


@query("faq_ytd_vs_pytd")
def ytd_vs_pytd(ws: Workspace) -> DataFrame:
    """The running year and the same days of the year before, by line of business: facts by day, in one pass each."""

    def dated(name: str, day: str, amount: str, result: str) -> DataFrame:
        period = F.when(period_filter(day, "ytd", ws.as_of), "YTD").when(period_filter(day, "pytd", ws.as_of), "PYTD")
        rows = ws.table(name).select(period.alias("period"), "line_of_business", F.col(amount).alias(result))
        return rows.filter(F.col("period").isNotNull())

    premium = dated("fact_premium", "billing_month", "gross_premium_usd", "premium")
    claims = dated("fact_claim", "loss_date", "incurred_amount_usd", "incurred").withColumn("claimed", F.lit(1))
    zero = F.lit(0).cast("double")
    return (
        stack(premium, claims).groupBy("period", "line_of_business")
        .agg(
            F.coalesce(total("premium"), zero).alias("gwp_usd"), F.coalesce(total("incurred"), zero).alias("incurred_usd"),
            F.count("claimed").alias("claims"),
        )
    )
