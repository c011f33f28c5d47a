"""Dashboard datasets and the aggregations of their widgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.functions.money import ratio, retotal
from pcmarts.operators.shapes import stack
from pcmarts.plans.registry import QUERIES, high, low, query
from pcmarts.workspace import Workspace

# Datasets that are a plain column selection of one mart.
SELECTIONS: dict[str, tuple[str, str]] = {
    "dsh_uw_kpis": ("underwriting_kpis", "month line_of_business gross_written_premium_usd net_written_premium_usd "
                    "incurred_loss_usd claim_count loss_ratio expense_ratio combined_ratio"),
    "dsh_claims_summary": ("claims_summary", "line_of_business product peril claim_count total_incurred_usd "
                           "avg_severity_usd max_severity_usd cat_claim_count fraud_flag_count"),
    "dsh_exposure": ("exposure_accumulation", "state_code cresta_zone region line_of_business product "
                     "total_insured_value_usd annual_premium_usd policy_count"),
    "dsh_solvency": ("solvency_capital", "metric value_usd"),
    "dsh_assets": ("asset_portfolio_summary", "asset_class rating market_value_usd book_value_usd avg_yield_pct "
                   "avg_duration_yrs avg_esg_score position_count"),
    "dsh_event_risk": ("event_risk_correlation", "alert_id event_type severity urgency effective_utc expires_utc "
                       "state_code state_name exposed_tiv_usd exposed_policy_count"),
    "dsh_cat_events": ("cat_event_pml", "event_id title event_type severity event_time_utc latitude longitude "
                       "state_code pml_estimate_usd"),
    "wdg_claims_table": ("claims_summary", "line_of_business product peril claim_count total_incurred_usd "
                         "avg_severity_usd cat_claim_count"),
    "wdg_pml_table": ("cat_event_pml", "title event_type severity state_code pml_estimate_usd event_time_utc"),
}

# Bar and pie widgets: mart, group columns, money column, result name; largest first.
SUMS: dict[str, tuple[str, tuple[str, ...], str, str]] = {
    "wdg_gwp_by_lob": ("underwriting_kpis", ("line_of_business",), "gross_written_premium_usd", "gwp_usd"),
    "wdg_tiv_by_state": ("exposure_accumulation", ("state_code",), "total_insured_value_usd", "tiv_usd"),
    "wdg_tiv_by_cresta_region": ("exposure_accumulation", ("cresta_zone", "region"), "total_insured_value_usd", "tiv_usd"),
    "wdg_premium_by_product_lob": ("exposure_accumulation", ("product", "line_of_business"), "annual_premium_usd", "premium_usd"),
    "wdg_assets_by_class": ("asset_portfolio_summary", ("asset_class",), "market_value_usd", "mv_usd"),
    "wdg_mv_by_rating_class": ("asset_portfolio_summary", ("rating", "asset_class"), "market_value_usd", "mv_usd"),
    "wdg_exposed_tiv_by_state": ("event_risk_correlation", ("state_code",), "exposed_tiv_usd", "tiv_usd"),
}


def selection(ws: Workspace, name: str) -> DataFrame:
    mart, columns = SELECTIONS[name]
    return ws.table(mart).select(*columns.split())


def summed(ws: Workspace, name: str) -> DataFrame:
    mart, by, money, result = SUMS[name]
    return ws.table(mart).groupBy(*by).agg(retotal(money).alias(result)).orderBy(high(result), *map(low, by))


for _name in SELECTIONS:
    QUERIES[_name] = lambda ws, n=_name: selection(ws, n)
for _name in SUMS:
    QUERIES[_name] = lambda ws, n=_name: summed(ws, n)


@query("dsh_kpi_totals")
def kpi_totals(ws: Workspace) -> DataFrame:
    return ws.table("underwriting_kpis").agg(
        retotal("gross_written_premium_usd").alias("total_gwp"),
        retotal("net_written_premium_usd").alias("total_nwp"),
        retotal("incurred_loss_usd").alias("total_losses"),
        F.sum("claim_count").alias("total_claims"),
    ).withColumn("overall_loss_ratio", ratio("total_losses", "total_gwp", None))


# Metric name -> dataset column
SOLVENCY_COLUMNS = {
    "Solvency Ratio": "solvency_ratio", "SCR (Total)": "scr_total",
    "Own Funds": "own_funds", "Market Value": "market_value",
}


@query("dsh_solvency_kpi")
def solvency_kpi(ws: Workspace) -> DataFrame:
    wide = ws.table("solvency_capital").groupBy().pivot("metric", list(SOLVENCY_COLUMNS)).agg(F.max("value_usd"))
    return wide.select(*[F.col(f"`{m}`").alias(c) for m, c in SOLVENCY_COLUMNS.items()])


@query("dsh_event_risk_totals")
def event_risk_totals(ws: Workspace) -> DataFrame:
    """Rows are alert x state pairs; the distinct variants count alerts and exposed states once."""
    return ws.table("event_risk_correlation").agg(
        F.count(F.lit(1)).alias("active_alerts"),
        F.countDistinct("state_code").alias("states_with_alerts"),
        retotal("exposed_tiv_usd").alias("total_exposed_tiv"),
        F.sum("exposed_policy_count").alias("total_exposed_policies"),
        F.countDistinct("alert_id").alias("distinct_alerts"),
    )


@query("wdg_combined_ratio_trend")
def combined_ratio_trend(ws: Workspace) -> DataFrame:
    return (
        ws.table("underwriting_kpis").groupBy("month", "line_of_business")
        .agg(F.avg("combined_ratio").alias("avg_combined_ratio"))
        .orderBy("month", "line_of_business")
    )


@query("wdg_solvency_components")
def solvency_components(ws: Workspace) -> DataFrame:
    return (
        ws.table("solvency_capital").groupBy("metric").agg(F.sum("value_usd").alias("value_usd"))
        .orderBy(high("value_usd"))
    )


@query("wdg_alerts_by_type_severity")
def alerts_by_type(ws: Workspace) -> DataFrame:
    return (
        ws.table("event_risk_correlation").groupBy("event_type", "severity")
        .agg(F.count("alert_id").alias("alerts")).orderBy(high("alerts"), low("event_type"), low("severity"))
    )


# Page -> counters read off its one-row dataset
COUNTERS = {
    "executive": (kpi_totals, ("total_gwp", "total_nwp", "total_claims")),
    "solvency": (solvency_kpi, ("solvency_ratio", "scr_total", "own_funds")),
    "realtime": (event_risk_totals, ("active_alerts", "states_with_alerts", "total_exposed_tiv")),
}


@query("wdg_counters")
def counters(ws: Workspace) -> DataFrame:
    """The nine counters as rows (page, counter, value)."""

    def page(name: str) -> DataFrame:
        build, columns = COUNTERS[name]
        cells = [
            F.struct(F.lit(name).alias("page"), F.lit(c).alias("counter"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
        return build(ws).select(F.inline(F.array(*cells)))

    return stack(*[page(name) for name in COUNTERS])
