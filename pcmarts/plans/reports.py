"""The ten standing reports over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.functions.bands import solvency_status, subline_benchmark
from pcmarts.functions.dates import since_months
from pcmarts.functions.money import FINE, RATE, billions, mean, millions, percent, retotal, rounded, total
from pcmarts.operators.shapes import stack
from pcmarts.plans import gold
from pcmarts.plans.registry import high, low, query, top
from pcmarts.workspace import Workspace

MICRO_SEGMENT = 50_000  # premium at or below which a segment is ignored


@query("sql_01_underwriting_kpis")
def monthly_kpis(ws: Workspace) -> DataFrame:
    kpis = ws.table("underwriting_kpis")
    return (
        kpis.groupBy(F.col("month").alias("period_month"), "line_of_business")
        .agg(
            millions(retotal("gross_written_premium_usd"), 2).alias("gwp_musd"),
            millions(retotal("net_written_premium_usd"), 2).alias("nwp_musd"),
            millions(retotal("incurred_loss_usd"), 2).alias("incurred_loss_musd"),
            F.sum("claim_count").alias("claims"),
            *[percent(F.avg(r)).alias(f"{r}_pct") for r in ("loss_ratio", "expense_ratio", "combined_ratio")],
        )
        .orderBy(high("period_month"), low("line_of_business"))
    )


@query("sql_02_book_health")
def book(ws: Workspace) -> DataFrame:
    return ws.table("book_health").select(
        "line_of_business", "product", "active_policy_count",
        millions("inforce_premium_usd", 2).alias("inforce_gwp_musd"),
        rounded("avg_premium_per_policy", 0).alias("avg_premium_usd"),
        rounded("claim_frequency_per_100", 2).alias("freq_per_100_policies"),
        rounded("avg_severity_usd", 0).alias("avg_severity_usd"),
        percent("loss_ratio").alias("loss_ratio_pct"),
        "cat_claim_count", "fraud_claim_count",
        rounded("avg_underwriter_score", 1).alias("avg_underwriter_score"),
    ).orderBy(high("inforce_gwp_musd"))


@query("sql_03_loss_triangle")
def triangle(ws: Workspace) -> DataFrame:
    paid_share = F.try_divide("cumulative_paid_eur_m", F.nullif("ultimate_loss_eur_m", F.lit(0.0)))
    return ws.table("loss_triangle").select(
        "accident_year", F.col("development_period").alias("dev_period_yrs"), "line_of_business",
        "incremental_paid_eur_m", "cumulative_paid_eur_m", "case_reserves_eur_m", "ibnr_eur_m", "ultimate_loss_eur_m",
        percent(paid_share).alias("pct_paid_to_ultimate"),
    ).orderBy(high("accident_year"), low("dev_period_yrs"))


@query("sql_04_solvency_ii")
def solvency(ws: Workspace) -> DataFrame:
    shown = {
        "total_scr_eur_m": "total_scr_eur_m", "scr_market_risk": "market_risk",
        "scr_underwriting_non_life": "uw_non_life", "scr_underwriting_life": "uw_life",
        "scr_underwriting_health": "uw_health", "scr_credit_risk": "credit_risk",
        "scr_operational_risk": "operational_risk", "diversification_benefit": "diversification_benefit",
        "own_funds_eur_m": "own_funds_eur_m", "mcr_eur_m": "mcr_eur_m", "solvency_ratio_pct": "solvency_ratio_pct",
    }
    return ws.table("pc_solvency_metrics").select(
        "reporting_date", *[rounded(c, 1).alias(name) for c, name in shown.items()],
        solvency_status("solvency_ratio_pct").alias("regulatory_status"),
    ).orderBy(high("reporting_date"))


def with_exposed_tiv(ws: Workspace) -> DataFrame:
    return ws.table("event_risk_correlation").filter(F.col("exposed_tiv_usd").isNotNull())


def by_pml() -> tuple[Column, ...]:
    return high("pml_estimate_usd"), low("event_id"), low("state_code")


def by_exposed_tiv() -> tuple[Column, ...]:
    return high("exposed_tiv_usd"), low("alert_id"), low("state_code")


def pml_figures() -> tuple[Column, ...]:
    return (
        billions("state_tiv_usd").alias("state_tiv_busd"), percent("severity_factor").alias("severity_factor_pct"),
        millions("pml_estimate_usd").alias("pml_musd"),
    )


@query("sql_05_cat_pml_exposure")
def cat_pml(ws: Workspace) -> DataFrame:
    # the fifty rows are chosen before the state names are looked up
    worst = gold.worst_pml(ws, 50)
    names = ws.table("dim_geography").groupBy("state_code").agg(
        F.max("state_name").alias("state_name"), F.max("region").alias("region")
    )
    return (
        worst.join(names, "state_code", "left")
        .orderBy(*by_pml())
        .select("event_type", "severity", "title", "state_code", "state_name", "region", *pml_figures(),
                "event_time_utc")
    )


SEGMENT = ("line_of_business", "product", "state_code", "channel", "customer_type")


def sizeable_segments(ws: Workspace) -> DataFrame:
    return ws.table("loss_ratio_by_segment").filter(F.col("gross_premium_usd") > MICRO_SEGMENT)


@query("sql_06_segment_loss_ratio")
def worst_segments(ws: Workspace) -> DataFrame:
    shown = sizeable_segments(ws).select(
        *SEGMENT, millions("gross_premium_usd", 2).alias("gwp_musd"), millions("incurred_loss_usd", 2).alias("losses_musd"),
        "claim_count", *[percent(r).alias(f"{r}_pct") for r in ("loss_ratio", "expense_ratio", "combined_ratio")],
    )
    return top(shown, 30, high("combined_ratio_pct"), *map(low, SEGMENT))


@query("sql_07_claim_360")
def recent_claims(ws: Workspace) -> DataFrame:
    recent = ws.table("fact_claim").filter(since_months("report_date", ws.as_of, 12))
    latest = gold.claims_360(ws, top(recent, 100, high("loss_date"), low("claim_id")))  # the claims are cut before the lookups
    return top(latest, 100, high("loss_date"), low("claim_id")).select(
        "claim_id", "line_of_business", "product", "peril", "claim_status", "loss_date", "report_date",
        "report_lag_days", rounded("incurred_amount_usd", 0).alias("incurred_usd"),
        rounded("paid_amount_usd", 0).alias("paid_usd"), rounded("reserve_amount_usd", 0).alias("reserve_usd"),
        percent("severity_pct_of_sum_insured").alias("severity_pct_of_si"),
        "is_cat", "fraud_flag", "catastrophe_code", "customer_name", "customer_type", "loyalty_tier",
        "state_code", "region", "cresta_zone", "flood_zone", "channel",
    )


@query("sql_08_reinsurance_recoveries")
def recoveries(ws: Workspace) -> DataFrame:
    """Both books side by side; the column names keep the USD wording for either source."""
    key = ("treaty_type", "reinsurer", "line_of_business")
    usd = ws.table("reinsurance_summary").groupBy(*key).agg(
        F.lit("USD_synthetic").alias("source"),
        millions(retotal("total_limit_usd")).alias("total_limit_musd"),
        millions(retotal("premium_ceded_usd")).alias("ceded_premium_musd"),
        percent(F.avg("avg_cession_pct")).alias("avg_cession_pct"),
        F.sum("treaty_count").alias("treaty_count"),
    )
    eur = ws.table("pc_reinsurance_treaties").groupBy(*key).agg(
        F.lit("EUR_pc").alias("source"),
        rounded(total("limit_eur_m", FINE), 1).alias("total_limit_musd"),
        rounded(total("ceded_premium_eur_m", FINE), 1).alias("ceded_premium_musd"),
        rounded(mean("cession_pct", RATE), 1).alias("avg_cession_pct"),
        F.count(F.lit(1)).alias("treaty_count"),
    )
    return top(stack(usd, eur), 30, high("ceded_premium_musd"), low("source"), *map(low, key))


@query("sql_09_combined_ratio_vs_benchmark")
def versus_benchmark(ws: Workspace) -> DataFrame:
    ratio, benchmark = F.col("combined_ratio_pct"), F.col("benchmark_pct")
    bar = F.coalesce(benchmark, F.lit(100.0))
    # the second label is kept as published although such a line beats its market;
    # benchmark_position says which side of the benchmark the line is on
    signal = (
        F.when(ratio < 100, "Profitable")
        .when(ratio < bar, "Worse than market — review")
        .otherwise("Worse than market and unprofitable — rate action")
    )
    position = (
        F.when(benchmark.isNull(), "No benchmark").when(ratio < benchmark, "Better than market")
        .when(ratio > benchmark, "Worse than market").otherwise("At market")
    )
    return (
        ws.table("pc_combined_ratios")
        .withColumn("benchmark_pct", subline_benchmark("sub_line"))
        .select(
            "reporting_quarter", "line_of_business", "sub_line", "loss_ratio_pct", "expense_ratio_pct",
            "combined_ratio_pct", "benchmark_pct", F.round(ratio - bar, 1).alias("delta_vs_benchmark_pts"),
            signal.alias("underwriting_signal"), position.alias("benchmark_position"),
        )
        .orderBy(high("reporting_quarter"), high("combined_ratio_pct"))
    )


@query("sql_10_realtime_event_risk")
def alerts_at_risk(ws: Workspace) -> DataFrame:
    return top(with_exposed_tiv(ws), 50, *by_exposed_tiv()).select(
        "event_type", "severity", "urgency", "state_code", "state_name", "effective_utc", "expires_utc",
        billions("exposed_tiv_usd").alias("exposed_tiv_busd"), "exposed_policy_count",
    )
