"""Gold marts.

Facts are reduced to the grain of the mart before anything is joined, and facts that share a grain
are stacked and aggregated together. A stacked mart keeps the groups of its leading fact only,
which is what a left join of two aggregates yields; rows of the second fact with a NULL key are
removed first because they could never have met a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.functions.dates import month_of
from pcmarts.functions.money import CENTS, RATE, mean, peak, ratio, total
from pcmarts.operators import ranks
from pcmarts.operators.shapes import mentions, stack, with_every
from pcmarts.workspace import Workspace, table

# Share of a state's insured value at risk, by catastrophe type.
PERIL_FACTORS = {
    "Earthquake": 0.18, "TropicalCyclone": 0.22, "Flood": 0.12, "Wildfire": 0.08,
    "Drought": 0.03, "Volcanic": 0.10, "Other": 0.02,
}

# Simplified Solvency II charges.
CHARGES = {
    "premium": 0.18, "claims": 0.10, "market": 0.07, "counterparty": 0.015,
    "operational": 0.03, "mcr_of_scr": 0.45, "funds_of_market_value": 0.35,
}


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("double"))


def _hits(flag: str) -> Column:
    return F.count(F.when(F.col(flag), 1))


def _keyed(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def _three_ratios(df: DataFrame, premium: str) -> DataFrame:
    """Loss, expense and combined ratio against a premium column."""
    return df.withColumns(
        {"loss_ratio": ratio("incurred_loss_usd", premium), "expense_ratio": ratio("commission_usd", premium)}
    ).withColumn("combined_ratio", F.col("loss_ratio") + F.col("expense_ratio"))


@table("underwriting_kpis", "gold", ["fact_premium", "fact_claim"])
def underwriting_kpis(ws: Workspace) -> DataFrame:
    """Month x line of business: premium, losses and ratios. Months without premium do not appear."""
    grain = ("month", "line_of_business")
    premium = ws.table("fact_premium").select(
        month_of("billing_month").alias("month"), "line_of_business",
        F.lit(1).alias("billed"), "gross_premium_usd", "net_premium_usd", "commission_usd", "ceded_to_reinsurance_usd",
    )
    claim = ws.table("fact_claim").select(
        month_of("loss_date").alias("month"), "line_of_business",
        F.lit(1).alias("claimed"), "incurred_amount_usd", "paid_amount_usd",
    )
    sums = {
        "gross_written_premium_usd": "gross_premium_usd", "net_written_premium_usd": "net_premium_usd",
        "commission_usd": "commission_usd", "ceded_premium_usd": "ceded_to_reinsurance_usd",
        "incurred_loss_usd": "incurred_amount_usd", "paid_loss_usd": "paid_amount_usd",
    }
    cells = (
        stack(premium, _keyed(claim, *grain))
        .groupBy(*grain)
        .agg(
            F.count("billed").alias("billed"),
            *[_zero(total(source)).alias(name) for name, source in sums.items()],
            F.count("claimed").alias("claim_count"),
        )
        .filter("billed > 0")
        .drop("billed")
    )
    return _three_ratios(cells, "gross_written_premium_usd")


@table("claims_summary", "gold", ["fact_claim"])
def claims_summary(ws: Workspace) -> DataFrame:
    """Line x product x peril: claim counts and severity."""
    loss = "incurred_amount_usd"
    return ws.table("fact_claim").groupBy("line_of_business", "product", "peril").agg(
        F.count(F.lit(1)).alias("claim_count"),
        total(loss).alias("total_incurred_usd"),
        mean(loss).alias("avg_severity_usd"),
        peak(loss).alias("max_severity_usd"),
        _hits("is_cat").alias("cat_claim_count"),
        _hits("fraud_flag").alias("fraud_flag_count"),
    )


@table("exposure_by_zone", "gold", ["fact_exposure", "dim_geography"])
def exposure_by_zone(ws: Workspace) -> DataFrame:
    """Exposure reduced to geography x line x product, with the geography attached (DECIMAL sums).

    Policies are summed per geography key before the join, so the join sees at most one row per
    zone and product whatever the size of the book or the weight of one zone.
    """
    sums = (
        ws.table("fact_exposure")
        .groupBy("geo_id", "line_of_business", "product")
        .agg(
            F.sum(F.col("total_insured_value_usd").cast(CENTS)).alias("tiv"),
            F.sum(F.col("annual_premium_usd").cast(CENTS)).alias("premium"),
            F.count(F.lit(1)).alias("policies"),
        )
    )
    zones = ws.table("dim_geography").select("geo_id", "state_code", "cresta_zone", "region")
    return sums.join(zones, "geo_id")


@table("exposure_accumulation", "gold", ["exposure_by_zone"])
def exposure_accumulation(ws: Workspace) -> DataFrame:
    """State x CRESTA x region x line x product: insured value, premium, policies."""
    return (
        ws.table("exposure_by_zone")
        .groupBy("state_code", "cresta_zone", "region", "line_of_business", "product")
        .agg(
            F.sum("tiv").cast("double").alias("total_insured_value_usd"),
            F.sum("premium").cast("double").alias("annual_premium_usd"),
            F.sum("policies").alias("policy_count"),
        )
    )


@table("exposure_by_state", "gold", ["exposure_by_zone"])
def exposure_by_state(ws: Workspace) -> DataFrame:
    """State: insured value and policies. Shared by the alert and catastrophe marts."""
    return (
        ws.table("exposure_by_zone")
        .groupBy("state_code")
        .agg(F.sum("tiv").cast("double").alias("state_tiv_usd"), F.sum("policies").alias("state_policy_count"))
    )


@table("solvency_capital", "gold", ["dim_asset", "fact_claim", "fact_premium"])
def solvency_capital(ws: Workspace) -> DataFrame:
    """Nine rows (metric, value) of a simplified Solvency II balance."""
    amounts = stack(
        ws.table("dim_asset").select(F.col("market_value_usd").cast(CENTS).alias("assets")),
        ws.table("fact_claim").select(F.col("incurred_amount_usd").cast(CENTS).alias("claims")),
        ws.table("fact_premium").select(F.col("gross_premium_usd").cast(CENTS).alias("premium")),
    )
    totals = amounts.agg(*[total(c).alias(c) for c in ("assets", "claims", "premium")])
    k = {name: F.lit(v) for name, v in CHARGES.items()}
    risks = totals.select(
        "assets",
        (F.col("premium") * k["premium"] + F.col("claims") * k["claims"]).alias("underwriting"),
        (F.col("assets") * k["market"]).alias("market"),
        (F.col("assets") * k["counterparty"]).alias("counterparty"),
        (F.col("premium") * k["operational"]).alias("operational"),
        (F.col("assets") * k["funds_of_market_value"]).alias("funds"),
    ).withColumn("scr", F.col("underwriting") + F.col("market") + F.col("counterparty") + F.col("operational"))
    # Metric names
    values = {
        "Underwriting Risk": F.col("underwriting"),
        "Market Risk": F.col("market"),
        "Counterparty Risk": F.col("counterparty"),
        "Operational Risk": F.col("operational"),
        "SCR (Total)": F.col("scr"),
        "MCR (Minimum)": F.col("scr") * k["mcr_of_scr"],
        "Own Funds": F.col("funds"),
        "Solvency Ratio": ratio("funds", "scr"),
        "Market Value": F.col("assets"),
    }
    rows = [F.struct(F.lit(m).alias("metric"), v.alias("value_usd")) for m, v in values.items()]
    return risks.select(F.inline(F.array(*rows)))


@table("asset_portfolio_summary", "gold", ["dim_asset"])
def asset_portfolio_summary(ws: Workspace) -> DataFrame:
    """Asset class x rating: values and simple (unweighted) averages."""
    return ws.table("dim_asset").groupBy("asset_class", "rating").agg(
        total("market_value_usd").alias("market_value_usd"),
        total("book_value_usd").alias("book_value_usd"),
        mean("yield_pct", RATE).alias("avg_yield_pct"),
        mean("duration_yrs", RATE).alias("avg_duration_yrs"),
        mean("esg_score", RATE).alias("avg_esg_score"),
        F.count(F.lit(1)).alias("position_count"),
    )


@table("reinsurance_summary", "gold", ["dim_reinsurance_treaty"])
def reinsurance_summary(ws: Workspace) -> DataFrame:
    """Line x reinsurer x treaty type: limits, ceded premium, cession."""
    return ws.table("dim_reinsurance_treaty").groupBy("line_of_business", "reinsurer", "treaty_type").agg(
        total("limit_usd").alias("total_limit_usd"),
        total("premium_ceded_usd").alias("premium_ceded_usd"),
        mean("cession_pct", RATE).alias("avg_cession_pct"),
        F.count(F.lit(1)).alias("treaty_count"),
    )


def states_of(ws: Workspace) -> DataFrame:
    return ws.table("dim_geography").select("state_code", "state_name").distinct()


def alert_exposure(ws: Workspace, alerts: DataFrame, at: Column | None = None) -> DataFrame:
    """Alerts (batch or stream) with each state their area text names and the exposure there.

    With an instant ``at``, alerts that had expired by then are left out; one without an end never expires.
    """
    if at is not None:
        alerts = alerts.filter(F.coalesce(F.col("expires_utc") > at, F.lit(True)))
    exposure = ws.table("exposure_by_state").select(
        "state_code", F.col("state_tiv_usd").alias("exposed_tiv_usd"),
        F.col("state_policy_count").alias("exposed_policy_count"),
    )
    # the exposure is attached to the state list first: one lookup per alert instead of two
    places = states_of(ws).join(exposure, "state_code", "left")
    shown = ("alert_id", "event_type", "severity", "urgency", "effective_utc", "expires_utc")
    hits = mentions(
        alerts.select(*shown, "area_desc"), "area_desc", places, "state_name", "state_code"
    )
    return hits.select(*shown, "state_code", "state_name", "exposed_tiv_usd", "exposed_policy_count")


@table("event_risk_correlation", "gold", ["noaa_alerts", "dim_geography", "exposure_by_state"])
def event_risk_correlation(ws: Workspace) -> DataFrame:
    """One row per alert and state named in its area text (by name or code), with the exposure."""
    return alert_exposure(ws, ws.table("noaa_alerts"))


def peril_factor(event_type: Column | str) -> Column:
    event_type = F.col(event_type) if isinstance(event_type, str) else event_type
    lookup = F.create_map(*[F.lit(x) for pair in PERIL_FACTORS.items() for x in pair])
    return F.try_element_at(lookup, event_type)


@table("cat_event_pml", "gold", ["catastrophe_events", "exposure_by_state", "dim_geography"])
def cat_event_pml(ws: Workspace) -> DataFrame:
    """Every catastrophe event against every state with exposure: probable maximum loss."""
    return _pml(with_every(_factored(ws), ws.table("exposure_by_state").select("state_code", "state_tiv_usd")))


def _factored(ws: Workspace) -> DataFrame:
    return ws.table("catastrophe_events").select(
        "event_id", "title", "event_type", "severity", "event_time_utc", "latitude", "longitude",
        peril_factor("event_type").alias("severity_factor"),
    )


def worst_pml(ws: Workspace, n: int) -> DataFrame:
    """The n pairs of event and state with the largest PML, by event and state where equal; exact for any n.

    Among events of one factor a pair is beaten by the same state with a lower event id, and among states by the same event
    with a larger (or equal and earlier) state. So n events per factor and n states hold the answer: n * n pairs a factor.
    """
    by_factor = Window.partitionBy("severity_factor").orderBy("event_id")
    events = _factored(ws).filter(F.col("severity_factor").isNotNull())
    events = events.withColumn("_place", F.row_number().over(by_factor)).filter(F.col("_place") <= n).drop("_place")
    states = ws.table("exposure_by_state").filter(F.col("state_tiv_usd").isNotNull()).select("state_code", "state_tiv_usd")
    states = states.orderBy(F.desc("state_tiv_usd"), "state_code").limit(n)
    pairs = _pml(with_every(events, states))
    return pairs.orderBy(F.desc("pml_estimate_usd"), "event_id", "state_code").limit(n)


def _pml(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "event_id", "title", "event_type", "severity", "event_time_utc", "latitude", "longitude",
        "state_code", "state_tiv_usd", "severity_factor",
        (F.col("state_tiv_usd") * F.col("severity_factor")).alias("pml_estimate_usd"),
    )


@table("policy_customer_360", "gold", ["dim_policy", "dim_customer", "dim_geography", "dim_agent"])
def policy_customer_360(ws: Workspace) -> DataFrame:
    """One row per policy of any status, with customer, place (of the policy) and agent."""
    policy = ws.table("dim_policy").select(
        "policy_id", "line_of_business", "product", "lob_code", "policy_status", "channel",
        "effective_date", "expiration_date",
        *[F.col(c).cast("double").alias(c) for c in ("annual_premium_usd", "sum_insured_usd", "deductible_usd")],
        "reinsured", F.col("underwriter_score").cast("double").alias("underwriter_score"),
        F.col("customer_id").alias("_customer"), F.col("geo_id").alias("_geo"), F.col("agent_id").alias("_agent"),
    )
    customer = ws.table("dim_customer").select(
        "customer_id", "customer_name", "customer_type", "loyalty_tier", "income_bracket", "credit_score"
    )
    place = ws.table("dim_geography").select(
        F.col("geo_id").alias("_geo"), "state_code", "state_name", "region", "cresta_zone", "flood_zone",
        "windstorm_zone",
    )
    agent = ws.table("dim_agent").select(
        "agent_id", "agent_name", F.col("channel").alias("agent_channel"),
        F.col("specialty_lob").alias("agent_specialty_lob"),
    )
    return (
        policy.join(place, "_geo", "left")
        .join(agent, F.col("_agent") == F.col("agent_id"), "left")
        .join(customer, F.col("_customer") == F.col("customer_id"), "left")
        .select(
            *[c for c in policy.columns if not c.startswith("_")], *customer.columns,
            *[c for c in place.columns if not c.startswith("_")], *agent.columns,
        )
    )


@table("claim_360", "gold", ["fact_claim", "dim_policy", "dim_customer", "dim_geography"])
def claim_360(ws: Workspace) -> DataFrame:
    """One row per claim with its policy, that policy's customer, and the place of the claim."""
    return claims_360(ws, ws.table("fact_claim"))


def claims_360(ws: Workspace, claims: DataFrame) -> DataFrame:
    """The 360 view of the given claims: a reader that wants a few cuts them first."""
    money = ("incurred_amount_usd", "paid_amount_usd", "reserve_amount_usd", "net_paid_usd",
             "salvage_recovery_usd", "subrogation_recovery_usd")
    claim = claims.select(
        "claim_id", "policy_id", "line_of_business", "product", "peril", "claim_status", "loss_date", "report_date",
        F.datediff("report_date", "loss_date").alias("report_lag_days"),
        *[F.col(c).cast("double").alias(c) for c in money],
        "fraud_flag", "catastrophe_code", "is_cat", F.col("geo_id").alias("_geo"),
    )
    policy = ws.table("dim_policy").select(
        F.col("policy_id").alias("_policy"), F.col("customer_id").alias("_customer"), "channel",
        F.col("annual_premium_usd").cast("double").alias("annual_premium_usd"),
        F.col("sum_insured_usd").cast("double").alias("sum_insured_usd"),
    )
    customer = ws.table("dim_customer").select("customer_id", "customer_name", "customer_type", "loyalty_tier")
    place = ws.table("dim_geography").select(
        F.col("geo_id").alias("_geo"), "state_code", "state_name", "region", "cresta_zone", "flood_zone"
    )
    # claims are fewer than policies: the policy table crosses the network once, in five columns, or
    # not at all if both tables are bucketed by the policy key (which is why that join comes first)
    return (
        claim.join(policy, F.col("policy_id") == F.col("_policy"), "left")
        .join(place, "_geo", "left")
        .join(customer, F.col("_customer") == F.col("customer_id"), "left")
        .select(
            *[c for c in claim.columns if not c.startswith("_")],
            ratio("incurred_amount_usd", "sum_insured_usd", None).alias("severity_pct_of_sum_insured"),
            "annual_premium_usd", "sum_insured_usd", "channel", "customer_name", "customer_type", "loyalty_tier",
            *[c for c in place.columns if not c.startswith("_")],
        )
    )


@table("loss_ratio_by_segment", "gold", ["fact_premium", "fact_claim", "dim_policy", "dim_customer", "dim_geography"])
def loss_ratio_by_segment(ws: Workspace) -> DataFrame:
    """Line x product x state x channel x customer type: premium, losses, ratios.

    Both facts are stacked and summed per policy first, so the join with the policy spine sees one
    row per policy and product even if one policy carries a third of all rows, and the spine
    (policy, customer, place) is joined once instead of once per fact.
    """
    amounts = ("gross_premium_usd", "net_premium_usd", "commission_usd", "incurred_amount_usd")
    line = ("line_of_business", "product")
    premium = ws.table("fact_premium").select("policy_id", *line, *amounts[:3], F.lit(1).alias("billed"))
    claim = ws.table("fact_claim").select("policy_id", *line, amounts[3], F.lit(1).alias("claimed"))
    per_policy = (
        stack(premium, _keyed(claim, *line))
        .groupBy("policy_id", *line)
        .agg(
            *[F.sum(F.col(a).cast(CENTS)).alias(a) for a in amounts],
            F.count("billed").alias("billed"), F.count("claimed").alias("claimed"),
        )
    )
    spine = (
        ws.table("dim_policy").select("policy_id", "customer_id", "geo_id", "channel")
        .join(ws.table("dim_geography").select("geo_id", "state_code"), "geo_id")
        .join(ws.table("dim_customer").select("customer_id", "customer_type"), "customer_id")
        .select("policy_id", "state_code", "channel", "customer_type")
    )
    segment = (*line, "state_code", "channel", "customer_type")
    # a claim whose segment has an unknown part meets no premium segment
    known = F.col("state_code").isNotNull() & F.col("channel").isNotNull() & F.col("customer_type").isNotNull()
    cells = (
        per_policy.join(spine, "policy_id")
        .groupBy(*segment)
        .agg(
            F.sum("billed").alias("billed"),
            *[F.sum(a).cast("double").alias(a) for a in amounts[:3]],
            _zero(F.sum(F.when(known, F.col(amounts[3]))).cast("double")).alias("incurred_loss_usd"),
            F.coalesce(F.sum(F.when(known, F.col("claimed"))), F.lit(0)).alias("claim_count"),
        )
        .filter("billed > 0")
        .drop("billed")
    )
    return _three_ratios(cells, "gross_premium_usd")


@table("book_health", "gold", ["dim_policy", "fact_claim"])
def book_health(ws: Workspace) -> DataFrame:
    """Line x product: active policies against all claims; frequency, severity, loss ratio."""
    grain = ("line_of_business", "product")
    policy = (
        ws.table("dim_policy")
        .filter(F.col("policy_status") == "Active")
        .select(*grain, F.lit(1).alias("active"), "annual_premium_usd", "sum_insured_usd", "underwriter_score")
    )
    claim = ws.table("fact_claim").select(
        *grain, F.lit(1).alias("claimed"), "incurred_amount_usd", "is_cat", "fraud_flag"
    )
    cells = (
        stack(policy, _keyed(claim, *grain))
        .groupBy(*grain)
        .agg(
            F.count("active").alias("active_policy_count"),
            _zero(total("annual_premium_usd")).alias("inforce_premium_usd"),
            _zero(total("sum_insured_usd")).alias("inforce_sum_insured_usd"),
            _zero(mean("underwriter_score", RATE)).alias("avg_underwriter_score"),
            F.count("claimed").alias("claim_count"),
            _zero(total("incurred_amount_usd")).alias("incurred_loss_usd"),
            _zero(mean("incurred_amount_usd")).alias("avg_severity_usd"),
            _hits("is_cat").alias("cat_claim_count"),
            _hits("fraud_flag").alias("fraud_claim_count"),
        )
        .filter("active_policy_count > 0")
    )
    return cells.withColumns(
        {
            "claim_frequency_per_100": ratio(F.col("claim_count") * 100, "active_policy_count"),
            "loss_ratio": ratio("incurred_loss_usd", "inforce_premium_usd"),
            "avg_premium_per_policy": ratio("inforce_premium_usd", "active_policy_count"),
        }
    )


@table("peril_loss_summary", "gold", ["fact_claim"])
def peril_loss_summary(ws: Workspace) -> DataFrame:
    """Peril: frequency, severity with its 95th percentile, catastrophe share.

    Claims are read once and counted per peril, line, catastrophe flag and amount; a frequent amount is one row. The counts are
    dealt by range over peril and amount into a table of the workspace. All sums come from it, and of a peril's ranges, many if
    it is hot, only the one that holds the rank of its percentile is read for that.
    """
    claims = ws.table("fact_claim").select("peril", "line_of_business", "is_cat", F.col("incurred_amount_usd").cast(CENTS).alias("amount"))
    cells = claims.groupBy(*claims.columns).agg(F.count(F.lit(1)).alias("n"))
    ranged = ws.staged("peril_loss_summary", lambda folder: ranks.dealt(cells, folder, "peril", "amount"))
    known = F.when(F.col("amount").isNotNull(), F.col("n")).otherwise(F.lit(0))
    high = ranks.at_share(ranged, "peril", "amount", known, 95)
    high = high.select(F.col("peril").alias("_peril"), F.col("amount").cast("double").alias("p95_severity_usd"))
    loss = F.col("amount") * F.col("n").cast("decimal(18,0)")
    sums = ranged.groupBy("peril").agg(
        F.sum("n").alias("claim_count"),
        F.sum(loss).cast("double").alias("total_incurred_usd"),
        F.sum(known).alias("_known"),
        F.coalesce(F.sum(F.when(F.col("is_cat"), F.col("n"))), F.lit(0)).alias("cat_claim_count"),
        F.sum(F.when(F.col("is_cat"), loss).otherwise(F.lit(0))).cast("double").alias("cat_incurred_usd"),
        F.countDistinct("line_of_business").alias("distinct_lobs"),
    )
    return sums.join(high, F.col("peril").eqNullSafe(F.col("_peril")), "left").select(
        "peril", "claim_count", "total_incurred_usd", F.try_divide("total_incurred_usd", "_known").alias("avg_severity_usd"), "p95_severity_usd",
        "cat_claim_count", "cat_incurred_usd", "distinct_lobs",
        ratio("cat_incurred_usd", "total_incurred_usd").alias("cat_share_of_loss"),
    )


MARTS = (
    "underwriting_kpis", "claims_summary", "exposure_accumulation", "solvency_capital", "asset_portfolio_summary",
    "reinsurance_summary", "event_risk_correlation", "cat_event_pml", "policy_customer_360", "claim_360",
    "loss_ratio_by_segment", "book_health", "peril_loss_summary",
)
