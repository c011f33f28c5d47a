"""Business rules: benchmark deltas, bands and anomaly flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.functions import bands
from pcmarts.functions.dates import period_filter
from pcmarts.functions.money import RATE, mean, percent, retotal, total
from pcmarts.operators.shapes import stack
from pcmarts.plans.registry import query
from pcmarts.workspace import Workspace

PERIODS = ("current_year", "ytd", "pytd", "this_quarter", "last_quarter", "last_12_months")


@query("rule_cr_benchmark")
def combined_ratio_delta(ws: Workspace) -> DataFrame:
    """Combined ratio of each sub-line against its benchmark, in points; the industry figure fills gaps."""
    return ws.table("pc_combined_ratios").select(
        "reporting_quarter", "line_of_business", "sub_line", "combined_ratio_pct",
        bands.rule_benchmark("sub_line").alias("benchmark_pct"),
        F.round(F.col("combined_ratio_pct") - bands.rule_benchmark("sub_line"), 1).alias("delta_pts"),
    )


@query("rule_freq_sev_benchmark")
def frequency_severity(ws: Workspace) -> DataFrame:
    """Frequency and severity of each product against its benchmark; flagged above twice the benchmark."""
    frequency, severity = F.col("claim_frequency_per_100"), F.col("avg_severity_usd")
    return ws.table("book_health").select(
        "line_of_business", "product", "claim_frequency_per_100", "avg_severity_usd",
        bands.looked_up(bands.FREQUENCY_BENCHMARKS, "product").alias("frequency_benchmark"),
        bands.looked_up(bands.SEVERITY_BENCHMARKS, "product").alias("severity_benchmark"),
    ).withColumns(
        {
            "frequency_flag": frequency > F.col("frequency_benchmark") * bands.BENCHMARK_MULTIPLE,
            "severity_flag": severity > F.col("severity_benchmark") * bands.BENCHMARK_MULTIPLE,
        }
    )


@query("rule_solvency_band")
def solvency_bands(ws: Workspace) -> DataFrame:
    return ws.table("pc_solvency_metrics").select(
        "reporting_date", "solvency_ratio_pct", bands.solvency_band("solvency_ratio_pct").alias("band")
    )


def _cession() -> Column:
    """USD treaties carry the cession as a fraction."""
    return percent("cession_pct")


@query("rule_cession_band")
def cession_bands(ws: Workspace) -> DataFrame:
    return ws.table("dim_reinsurance_treaty").select(
        "treaty_id", "line_of_business", _cession().alias("cession_pct"),
        bands.cession_band("line_of_business", _cession()).alias("band"),
        (_cession() > bands.CESSION_LIMIT).alias("heavy_reliance"),
    )


@query("rule_esg_band")
def esg_bands(ws: Workspace) -> DataFrame:
    return (
        ws.table("dim_asset").groupBy("asset_class", bands.esg_band(F.col("esg_score").cast("double")).alias("band"))
        .agg(F.count(F.lit(1)).alias("positions"), total("market_value_usd").alias("market_value_usd"))
    )


@query("rule_climate_flag")
def climate_flags(ws: Workspace) -> DataFrame:
    """Sub-line and year: mean climate factor, exposure, and its change on the year before.

    Exposure is summed per sub-line and year before the window, so a window partition holds one
    row per year.
    """
    yearly = (
        ws.table("pc_risk_exposure").select("policy_id", "exposure_year", "pml_eur", "climate_risk_factor")
        .join(ws.table("pc_policies").select("policy_id", "line_of_business", "sub_line"), "policy_id")
        .groupBy("line_of_business", "sub_line", "exposure_year")
        .agg(mean("climate_risk_factor", RATE).alias("climate_factor"), total("pml_eur").alias("exposure_eur"))
    )
    by_year = Window.partitionBy("line_of_business", "sub_line").orderBy("exposure_year")
    before = F.when(
        F.lag("exposure_year").over(by_year) == F.col("exposure_year") - 1, F.lag("exposure_eur").over(by_year)
    )
    flagged = (F.col("climate_factor") > bands.CLIMATE_LIMIT) & (F.col("exposure_eur") > F.col("exposure_before_eur"))
    return yearly.withColumn("exposure_before_eur", before).withColumn("flagged", F.coalesce(flagged, F.lit(False)))


@query("rule_anomaly_flags")
def anomalies(ws: Workspace) -> DataFrame:
    """Everything beyond a limit, in one long table (kpi, key, value, threshold)."""

    def entry(kpi: str, key: Column, value: Column, threshold: Column, hit: Column) -> Column:
        return F.struct(
            hit.alias("hit"), F.lit(kpi).alias("kpi"), key.alias("key"), value.cast("double").alias("value"),
            threshold.cast("double").alias("threshold"),
        )

    def hits(df: DataFrame, *entries: Column) -> DataFrame:
        """One pass over a table, whatever the number of its rules."""
        return df.select(F.inline(F.array(*entries))).filter("hit").drop("hit")

    def limit(value: float) -> Column:
        return F.lit(value)

    product = F.concat_ws("/", "line_of_business", "product")
    combined, solvency = F.col("combined_ratio_pct"), F.col("solvency_ratio_pct")
    climate, cession = F.col("climate_factor"), F.col("cession_pct")
    frequency_bar = F.col("frequency_benchmark") * bands.BENCHMARK_MULTIPLE
    severity_bar = F.col("severity_benchmark") * bands.BENCHMARK_MULTIPLE
    year = F.col("exposure_year").cast("string")
    return stack(
        hits(
            ws.table("pc_combined_ratios"),
            entry("combined_ratio", F.concat_ws("/", "reporting_quarter", "line_of_business", "sub_line"), combined,
                  limit(bands.COMBINED_RATIO_LIMIT), combined > bands.COMBINED_RATIO_LIMIT),
        ),
        hits(
            ws.table("pc_solvency_metrics"),
            entry("solvency_ratio", F.col("reporting_date").cast("string"), solvency, limit(bands.SOLVENCY_LIMIT),
                  solvency < bands.SOLVENCY_LIMIT),
        ),
        hits(
            frequency_severity(ws),
            entry("frequency", product, F.col("claim_frequency_per_100"), frequency_bar, F.col("frequency_flag")),
            entry("severity", product, F.col("avg_severity_usd"), severity_bar, F.col("severity_flag")),
        ),
        hits(
            climate_flags(ws),
            entry("climate", F.concat_ws("/", "line_of_business", "sub_line", year), climate, limit(bands.CLIMATE_LIMIT),
                  climate > bands.CLIMATE_LIMIT),
        ),
        hits(
            cession_bands(ws),
            entry("cession", F.col("treaty_id").cast("string"), cession, limit(bands.CESSION_LIMIT), F.col("heavy_reliance")),
        ),
    )


@query("rule_periods")
def premium_by_period(ws: Workspace) -> DataFrame:
    """Premium and losses of every reporting period, in one pass over the monthly mart."""
    month = F.col("month")
    aggregates = []
    for p in PERIODS:
        inside = period_filter(month, p, ws.as_of, months=True)
        aggregates += [
            F.count(F.when(inside, 1)).alias(f"{p}_rows"), F.min(F.when(inside, month)).alias(f"{p}_from"),
            F.max(F.when(inside, month)).alias(f"{p}_to"),
            retotal(F.when(inside, F.col("gross_written_premium_usd"))).alias(f"{p}_gwp"),
            retotal(F.when(inside, F.col("incurred_loss_usd"))).alias(f"{p}_inc"),
        ]
    one = ws.table("underwriting_kpis").agg(*aggregates)
    cells = [
        F.struct(
            F.lit(p).alias("period"), F.col(f"{p}_rows").alias("cells"), F.col(f"{p}_from").alias("first_month"),
            F.col(f"{p}_to").alias("last_month"), F.col(f"{p}_gwp").alias("gwp_usd"), F.col(f"{p}_inc").alias("incurred_usd"),
        )
        for p in PERIODS
    ]
    return one.select(F.inline(F.array(*cells)))
