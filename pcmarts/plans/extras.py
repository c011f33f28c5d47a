"""Analytics over time: rolling baselines, quarterly changes, loss development, exposure at a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.functions.dates import day, month_of, quarter_of
from pcmarts.functions.money import CENTS, FINE, ratio, total
from pcmarts.operators.shapes import stack
from pcmarts.plans.registry import query
from pcmarts.workspace import Workspace, table

OPEN_STATES = ("Open", "InvestigationInProgress", "Litigation")


def _month_index(c: str) -> Column:
    return F.year(c) * 12 + F.month(c)


@query("ext_baseline_36m")
def baseline(ws: Workspace) -> DataFrame:
    """Monthly losses per line against the mean of the 36 months before.

    Claims become one row per line and month before the window runs. A month counts towards the
    baseline by its calendar distance, so a month without claims does not stretch the window.
    """
    monthly = (
        ws.table("fact_claim").groupBy("line_of_business", month_of("loss_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.sum(F.col("incurred_amount_usd").cast(CENTS)).alias("incurred"))
        .filter(F.col("month").isNotNull())
    )
    before = Window.partitionBy("line_of_business").orderBy(_month_index("month")).rangeBetween(-36, -1)
    months = F.count(F.lit(1)).over(before)

    def base(c: str) -> Column:
        return F.try_divide(F.sum(c).over(before).cast("double"), months)

    indexed = monthly.select(
        "line_of_business", "month", "claim_count", F.col("incurred").cast("double").alias("incurred_usd"),
        months.alias("baseline_months"), base("claim_count").alias("baseline_count"),
        base("incurred").alias("baseline_incurred_usd"),
    ).withColumns(
        {
            "frequency_index": F.try_divide("claim_count", "baseline_count"),
            "loss_index": F.try_divide("incurred_usd", "baseline_incurred_usd"),
        }
    )
    # severity and frequency move together while their indices stay within a quarter of each other
    severity = F.try_divide("loss_index", "frequency_index")
    return indexed.withColumn("severity_index", severity).withColumn(
        "decoupled", F.abs(F.col("frequency_index") - F.col("severity_index")) > 0.25
    )


def quarterly_loss_ratio(ws: Workspace, *by: str) -> DataFrame:
    """Premium and losses by calendar quarter straight from the facts (no mart has this grain)."""
    premium = ws.table("fact_premium").select(*by, quarter_of("billing_month").alias("quarter"), "gross_premium_usd")
    claim = ws.table("fact_claim").select(*by, quarter_of("loss_date").alias("quarter"), "incurred_amount_usd")
    return (
        stack(premium, claim.dropna(subset=[*by, "quarter"])).groupBy(*by, "quarter")
        .agg(
            total("gross_premium_usd").alias("premium_usd"),
            F.coalesce(total("incurred_amount_usd"), F.lit(0.0)).alias("incurred_usd"),
        )
        .filter(F.col("premium_usd").isNotNull())
        .withColumn("loss_ratio", ratio("incurred_usd", "premium_usd"))
    )


@query("ext_lr_qoq")
def loss_ratio_change(ws: Workspace) -> DataFrame:
    """Loss ratio by line and quarter with its change on the quarter before, in points."""
    by_quarter = Window.partitionBy("line_of_business").orderBy("quarter")
    change = (F.col("loss_ratio") - F.lag("loss_ratio").over(by_quarter)) * 100
    return quarterly_loss_ratio(ws, "line_of_business").withColumn("change_pts", change)


@query("ext_cycle_time")
def cycle_time(ws: Workspace) -> DataFrame:
    """Open claims by line and loss quarter: mean days from loss to report, and its relative change."""
    claims = ws.table("fact_claim").filter(F.col("claim_status").isin(*OPEN_STATES))
    quarterly = claims.groupBy("line_of_business", quarter_of("loss_date").alias("quarter")).agg(
        F.count(F.lit(1)).alias("open_claims"),
        F.try_divide(
            F.sum(F.datediff("report_date", "loss_date")), F.count(F.datediff("report_date", "loss_date"))
        ).alias("avg_cycle_days"),
    )
    by_quarter = Window.partitionBy("line_of_business").orderBy("quarter")
    previous = F.lag("avg_cycle_days").over(by_quarter)
    return quarterly.withColumn("change_pct", F.try_divide(F.col("avg_cycle_days") - previous, previous) * 100)


@table("loss_triangle", "gold", ["pc_loss_development"])
def loss_triangle(ws: Workspace) -> DataFrame:
    """Cumulative paid, case reserves, IBNR and ultimate per accident year, line and development period.

    A development table that already carries the ultimates passes through. Otherwise they are
    projected by the chain-ladder method: an age-to-age factor per line and period is the ratio of
    the summed cumulatives of the years that have both periods; the ultimate of a year is its latest
    cumulative times the remaining factors. All steps run on one row per cell of the triangle.
    """
    cells = ws.table("pc_loss_development")
    if "ultimate_loss_eur_m" in cells.columns:
        return cells
    line, year, period = "line_of_business", "accident_year", "development_period"
    cells = cells.filter(F.col(year) + F.col(period) - 1 <= ws.as_of.year)  # what is known at the date
    along = Window.partitionBy(year, line).orderBy(period)
    paid = F.sum(F.col("incremental_paid_eur_m").cast(FINE)).over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = cells.select(
        year, period, line, "incremental_paid_eur_m", "case_reserves_eur_m", paid.alias("paid"),
    ).withColumns({"next_paid": F.lead("paid").over(along), "next_period": F.lead(period).over(along)})
    factors = (
        known.filter(F.col("next_period") == F.col(period) + 1)
        .groupBy(line, period)
        .agg(F.try_divide(F.sum("next_paid").cast("double"), F.sum("paid").cast("double")).alias("factor"))
        .groupBy(line)
        .agg(F.sort_array(F.collect_list(F.struct(period, "factor"))).alias("factors"))  # one entry per period
    )
    latest = known.groupBy(year, line).agg(
        F.max(period).alias("latest_period"), F.max_by(F.col("paid").cast("double"), period).alias("latest_paid")
    )
    remaining = F.filter("factors", lambda f: f[period] >= F.col("latest_period"))
    ultimate = F.aggregate(remaining, F.col("latest_paid"), lambda value, f: value * f["factor"])
    projected = (
        latest.join(factors, line, "left")
        .select(year, line, F.round(F.coalesce(ultimate, "latest_paid"), 6).alias("ultimate_loss_eur_m"))
    )
    figures = known.select(
        year, period, line, F.col("incremental_paid_eur_m").cast("double").alias("incremental_paid_eur_m"),
        F.col("paid").cast("double").alias("cumulative_paid_eur_m"),
        F.col("case_reserves_eur_m").cast("double").alias("case_reserves_eur_m"),
    )
    ibnr = F.col("ultimate_loss_eur_m") - F.col("cumulative_paid_eur_m") - F.col("case_reserves_eur_m")
    return figures.join(projected, [year, line]).withColumn("ibnr_eur_m", F.round(ibnr, 6))


@query("ext_triangle_build")
def built_triangle(ws: Workspace) -> DataFrame:
    return ws.table("loss_triangle")


@query("ext_exposure_as_of")
def exposure_as_of(ws: Workspace) -> DataFrame:
    """Insured value in force on the reporting date, by state and line."""
    at = day(ws.as_of)
    live = ws.table("fact_exposure").filter((F.col("effective_date") <= at) & (F.col("expiration_date") > at))
    zones = live.groupBy("geo_id", "line_of_business").agg(
        F.sum(F.col("total_insured_value_usd").cast(CENTS)).alias("tiv"), F.count(F.lit(1)).alias("policies")
    )
    return (
        zones.join(ws.table("dim_geography").select("geo_id", "state_code"), "geo_id")
        .groupBy("state_code", "line_of_business")
        .agg(F.sum("tiv").cast("double").alias("tiv_usd"), F.sum("policies").alias("policies"))
    )
