"""Curated analyst questions (those equal to an example query share its builder there)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.functions import bands
from pcmarts.functions.dates import period_filter
from pcmarts.functions.money import FINE, billions, mean, millions, percent, ratio, retotal, rounded, total
from pcmarts.plans import gold
from pcmarts.plans.extras import quarterly_loss_ratio
from pcmarts.plans.registry import high, low, query, top
from pcmarts.workspace import Workspace


@query("cq_01")
def combined_ratio_this_quarter(ws: Workspace) -> DataFrame:
    rows = ws.table("underwriting_kpis").filter(period_filter("month", "this_quarter", ws.as_of))
    sums = rows.groupBy("line_of_business").agg(
        retotal("gross_written_premium_usd").alias("gwp"), retotal("incurred_loss_usd").alias("inc"),
        retotal("commission_usd").alias("com"),
    )
    combined = percent(ratio(F.col("inc") + F.col("com"), "gwp"))
    return sums.select(
        "line_of_business", combined.alias("combined_ratio_pct"), F.lit(bands.INDUSTRY_BENCHMARK).alias("benchmark_pct"),
        F.round(combined - bands.INDUSTRY_BENCHMARK, 1).alias("delta_pts"),
    )


@query("cq_02")
def gwp_last_year(ws: Workspace) -> DataFrame:
    rows = ws.table("underwriting_kpis").filter(period_filter("month", "last_12_months", ws.as_of))
    return rows.groupBy("month", "line_of_business").agg(
        millions(retotal("gross_written_premium_usd")).alias("gwp_musd")
    )


@query("cq_03")
def unprofitable_sublines(ws: Workspace) -> DataFrame:
    return ws.table("pc_combined_ratios").filter(F.col("combined_ratio_pct") > 100).select(
        "reporting_quarter", "line_of_business", "sub_line", "combined_ratio_pct"
    )


@query("cq_04")
def auto_loss_ratio(ws: Workspace) -> DataFrame:
    """Quarter by quarter from the facts; the running quarter and the three before it."""
    start = F.add_months(F.trunc(F.lit(ws.as_of), "quarter"), -9)
    rows = quarterly_loss_ratio(ws, "product").filter((F.col("product") == "Auto") & (F.col("quarter") >= start))
    return rows.select("quarter", "premium_usd", "incurred_usd", percent("loss_ratio").alias("loss_ratio_pct"))


@query("cq_06")
def cat_claims_this_year(ws: Workspace) -> DataFrame:
    claims = ws.table("fact_claim").filter(F.col("is_cat") & period_filter("loss_date", "current_year", ws.as_of))
    return claims.agg(F.count(F.lit(1)).alias("cat_claims"), total("incurred_amount_usd").alias("incurred_usd"))


@query("cq_07")
def frequency_by_product(ws: Workspace) -> DataFrame:
    return ws.table("book_health").select(
        "line_of_business", "product", rounded("claim_frequency_per_100", 2).alias("freq_per_100")
    )


@query("cq_08")
def largest_open_claims(ws: Workspace) -> DataFrame:
    still_open = ws.table("fact_claim").filter(F.col("claim_status") == "Open")
    largest = gold.claims_360(ws, top(still_open, 20, high("reserve_amount_usd"), low("claim_id")))  # cut, then looked up
    return top(largest, 20, high("reserve_amount_usd"), low("claim_id")).select(
        "claim_id", "line_of_business", "product", "peril", "state_code", "reserve_amount_usd", "incurred_amount_usd"
    )


@query("cq_09")
def report_lag_by_line(ws: Workspace) -> DataFrame:
    lag = F.datediff("report_date", "loss_date")  # both dates are the claim's: no other table is read
    return ws.table("fact_claim").groupBy("line_of_business").agg(
        F.round(F.try_divide(F.sum(lag), F.count(lag)), 2).alias("avg_report_lag_days")
    )


@query("cq_10")
def fraud_claims(ws: Workspace) -> DataFrame:
    return ws.table("fact_claim").filter("fraud_flag").agg(
        F.count(F.lit(1)).alias("fraud_claims"), mean("incurred_amount_usd").alias("avg_severity_usd")
    )


@query("cq_12")
def cyber_by_region(ws: Workspace) -> DataFrame:
    rows = ws.table("exposure_accumulation").filter(F.col("product") == "Cyber")
    return rows.groupBy("region").agg(
        billions(retotal("total_insured_value_usd")).alias("tiv_busd"), F.sum("policy_count").alias("policies")
    )


@query("cq_13")
def top_zones(ws: Workspace) -> DataFrame:
    rows = ws.table("exposure_accumulation").filter(F.col("product").isin("Property", "Marine"))
    zones = rows.groupBy("cresta_zone").agg(retotal("total_insured_value_usd").alias("tiv_usd"))
    return top(zones, 10, high("tiv_usd"), low("cresta_zone"))


@query("cq_14")
def recent_solvency(ws: Workspace) -> DataFrame:
    return top(ws.table("pc_solvency_metrics"), 4, high("reporting_date")).select(
        "reporting_date", "solvency_ratio_pct", (F.col("solvency_ratio_pct") >= bands.SOLVENCY_LIMIT).alias("healthy")
    )


# Column -> risk module
MODULES = {
    "scr_market_risk": "Market", "scr_underwriting_non_life": "Underwriting non-life",
    "scr_underwriting_life": "Underwriting life", "scr_underwriting_health": "Underwriting health",
    "scr_credit_risk": "Credit", "scr_operational_risk": "Operational",
}


@query("cq_15")
def scr_by_module(ws: Workspace) -> DataFrame:
    named = ws.table("pc_solvency_metrics").select("reporting_date", *[F.col(c).alias(m) for c, m in MODULES.items()])
    return named.unpivot("reporting_date", list(MODULES.values()), "module", "scr_eur_m")


@query("cq_16")
def diversification(ws: Workspace) -> DataFrame:
    gross = reduce(add, [F.col(c) for c in MODULES])
    return ws.table("pc_solvency_metrics").select(
        "reporting_date", "diversification_benefit", gross.alias("gross_scr_eur_m"),
        F.round(F.try_divide(-F.col("diversification_benefit") * 100, gross), 1).alias("benefit_pct_of_gross"),
    )


def triangle_of(ws: Workspace, accident_year: int) -> DataFrame:
    """Cumulative payments of one year, a row per line and development period that the data have."""
    rows = ws.table("loss_triangle").filter(F.col("accident_year") == accident_year)
    return rows.select("line_of_business", "development_period", "cumulative_paid_eur_m")


@query("cq_17")
def triangle_one_year(ws: Workspace) -> DataFrame:
    return triangle_of(ws, 1997)


def latest_development(ws: Workspace) -> DataFrame:
    """The newest development period of each accident year and line."""
    figures = ("ibnr_eur_m", "ultimate_loss_eur_m")
    return ws.table("loss_triangle").groupBy("accident_year", "line_of_business").agg(
        *[F.max_by(c, "development_period").alias(c) for c in figures]
    )


@query("cq_18")
def ibnr_by_line(ws: Workspace) -> DataFrame:
    return latest_development(ws).groupBy("line_of_business").agg(total("ibnr_eur_m", FINE).alias("ibnr_eur_m"))


@query("cq_19")
def ultimate_one_year(ws: Workspace) -> DataFrame:
    rows = latest_development(ws).filter(F.col("accident_year") == 2000)
    return rows.groupBy("accident_year").agg(total("ultimate_loss_eur_m", FINE).alias("ultimate_loss_eur_m"))


@query("cq_20")
def ceded_this_year(ws: Workspace) -> DataFrame:
    """Treaties whose term touches the reporting year."""
    start = F.trunc(F.lit(ws.as_of), "year")
    live = ws.table("dim_reinsurance_treaty").filter(
        (F.col("treaty_start") < F.add_months(start, 12)) & (F.col("treaty_end") >= start)
    )
    return live.groupBy("reinsurer").agg(
        millions(total("premium_ceded_usd"), 2).alias("ceded_musd"), F.count(F.lit(1)).alias("treaties")
    )


@query("cq_21")
def highest_cessions(ws: Workspace) -> DataFrame:
    return top(ws.table("dim_reinsurance_treaty"), 20, high("cession_pct"), low("treaty_id")).select(
        "treaty_id", "treaty_type", "reinsurer", "line_of_business", percent("cession_pct").alias("cession_pct")
    )


@query("cq_22")
def utilisation(ws: Workspace) -> DataFrame:
    sums = ws.table("dim_reinsurance_treaty").groupBy("treaty_type").agg(
        total("premium_ceded_usd").alias("ceded_usd"), total("limit_usd").alias("limit_usd")
    )
    return sums.withColumn("utilisation", ratio("ceded_usd", "limit_usd", None))


@query("cq_23")
def duration_and_yield(ws: Workspace) -> DataFrame:
    """Weighted by market value, and the simple averages that the mart publishes."""
    value = F.col("market_value_usd").cast("decimal(18,2)")

    def weighted(c: str):
        w = F.col(c).cast("decimal(9,4)")
        return F.try_divide(F.sum(value * w).cast("double"), F.sum(F.when(w.isNotNull(), value)).cast("double"))

    return ws.table("dim_asset").agg(
        weighted("duration_yrs").alias("weighted_duration_yrs"), weighted("yield_pct").alias("weighted_yield"),
        mean("duration_yrs", "decimal(18,6)").alias("simple_duration_yrs"), mean("yield_pct", "decimal(18,6)").alias("simple_yield"),
    )


@query("cq_24")
def assets_by_rating(ws: Workspace) -> DataFrame:
    return ws.table("asset_portfolio_summary").groupBy("rating", "asset_class").agg(
        retotal("market_value_usd").alias("market_value_usd"), F.sum("position_count").alias("positions")
    )


@query("cq_28")
def worst_channel(ws: Workspace) -> DataFrame:
    sums = ws.table("loss_ratio_by_segment").groupBy("channel").agg(
        retotal("incurred_loss_usd").alias("incurred_usd"), retotal("gross_premium_usd").alias("premium_usd")
    )
    return top(sums.withColumn("loss_ratio", ratio("incurred_usd", "premium_usd")), 1, high("loss_ratio"), low("channel"))


@query("cq_29")
def premium_by_tier(ws: Workspace) -> DataFrame:
    rows = ws.table("policy_customer_360").filter(F.col("loyalty_tier").isin("Platinum", "Bronze"))
    return rows.groupBy("loyalty_tier").agg(
        F.count(F.lit(1)).alias("policies"), mean("annual_premium_usd").alias("avg_premium_usd")
    )
