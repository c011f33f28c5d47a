"""Silver: typed, conformed tables over bronze.

A silver table is a declaration: its bronze input, which text columns become dates or instants,
derived columns, an optional fixed column list, and its quality rules. Money stays DECIMAL here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pcmarts.functions.dates import as_date, as_instant, as_mail_instant
from pcmarts.operators.quality import DROP, Rule, enforce, report
from pcmarts.workspace import Workspace, table


@dataclass(frozen=True)
class Silver:
    bronze: str
    dates: tuple[str, ...] = ()
    instants: tuple[str, ...] = ()
    derive: dict[str, Callable[[], Column]] = field(default_factory=dict)
    columns: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    def typed(self, raw: DataFrame) -> DataFrame:
        present = set(raw.columns)
        parsed = {c: as_date(c) for c in self.dates if c in present}
        parsed |= {c: as_instant(c) for c in self.instants if c in present}
        if parsed:
            raw = raw.withColumns(parsed)
        if self.derive:
            raw = raw.withColumns({name: make() for name, make in self.derive.items()})
        return raw.select(*self.columns) if self.columns else raw


LATITUDE = Rule("valid_lat", "latitude BETWEEN -90 AND 90")


def _lob_code() -> Column:
    lob = F.col("line_of_business")
    return F.when(lob == "Personal", "PL").when(lob == "Commercial", "CL").otherwise("SP")


def _cents(*terms: str) -> Column:
    """First column minus the others, in cents; NULL if any of them is NULL."""
    first, *rest = (F.col(t).cast("decimal(18,2)") for t in terms)
    for term in rest:
        first = (first - term).cast("decimal(18,2)")
    return first


TABLES: dict[str, Silver] = {
    "dim_geography": Silver(
        "geography",
        derive={c: (lambda c=c: F.col(c).try_cast("double")) for c in ("latitude", "longitude")},
        columns=("geo_id", "state_code", "state_name", "region", "zip_code", "cresta_zone", "country",
                 "latitude", "longitude", "windstorm_zone", "flood_zone"),
        rules=(Rule("valid_geo_id", "geo_id IS NOT NULL", DROP), LATITUDE),
    ),
    "dim_customer": Silver(
        "customers",
        dates=("date_of_birth", "signup_date"),
        columns=("customer_id", "customer_name", "customer_type", "email", "phone", "date_of_birth", "geo_id",
                 "income_bracket", "credit_score", "loyalty_tier", "marketing_consent", "signup_date"),
        rules=(Rule("valid_customer", "customer_id IS NOT NULL", DROP),),
    ),
    "dim_agent": Silver(
        "agents",
        dates=("hire_date",),
        columns=("agent_id", "agent_name", "channel", "license_state", "specialty_lob", "ytd_commission_usd",
                 "hire_date", "active"),
    ),
    "dim_policy": Silver(
        "policies",
        dates=("effective_date", "expiration_date"),
        derive={"lob_code": _lob_code},
        rules=(Rule("valid_policy", "policy_id IS NOT NULL", DROP),
               Rule("premium_positive", "annual_premium_usd >= 0")),
    ),
    "fact_premium": Silver(
        "premiums",
        dates=("billing_month",),
        derive={"net_premium_usd": lambda: _cents("gross_premium_usd", "ceded_to_reinsurance_usd")},
        rules=(Rule("premium_amount_valid", "gross_premium_usd >= 0"),),
    ),
    "fact_claim": Silver(
        "claims",
        dates=("loss_date", "report_date"),
        derive={
            "net_paid_usd": lambda: _cents("paid_amount_usd", "salvage_recovery_usd", "subrogation_recovery_usd"),
            "is_cat": lambda: F.col("catastrophe_code").isNotNull(),
        },
        rules=(Rule("amount_positive", "incurred_amount_usd >= 0"),),
    ),
    "fact_exposure": Silver(
        "policies",
        dates=("effective_date", "expiration_date"),
        derive={"total_insured_value_usd": lambda: F.col("sum_insured_usd")},
        columns=("policy_id", "customer_id", "geo_id", "line_of_business", "product", "total_insured_value_usd",
                 "annual_premium_usd", "reinsured", "effective_date", "expiration_date"),
    ),
    "dim_reinsurance_treaty": Silver("reinsurance_treaties", dates=("treaty_start", "treaty_end")),
    "dim_asset": Silver("asset_portfolio", dates=("purchase_date", "maturity_date")),
    "weather_observations": Silver(
        "weather_obs", instants=("observed_time_utc", "fetched_at_utc"), rules=(LATITUDE,)
    ),
    "catastrophe_events": Silver(
        "catastrophe_events", derive={"event_time_utc": lambda: as_mail_instant("event_time_utc")}
    ),
    "earthquake_events": Silver("earthquakes", instants=("event_time_utc",)),
    "noaa_alerts": Silver("noaa_alerts", instants=("effective_utc", "expires_utc", "sent_utc")),
    # published_utc stays text as delivered; published_ts is its typed form
    "news_events": Silver("news", derive={"published_ts": lambda: as_mail_instant("published_utc")}),
    "pc_policies": Silver("pc_policies", dates=("inception_date", "expiry_date")),
    "pc_claims": Silver(
        "pc_claims",
        dates=("loss_date", "report_date"),
        # equals the paid amount, but is unknown while no reserve has been set
        derive={"net_paid_usd": lambda: F.when(F.col("reserved_amount").isNotNull(), F.col("paid_amount"))},
    ),
    "pc_investment_assets": Silver("pc_investment_assets", dates=("maturity_date",)),
    "pc_reinsurance_treaties": Silver("pc_reinsurance_treaties", dates=("inception_date", "expiry_date")),
    "pc_weather_events": Silver("pc_weather_events", dates=("event_date",)),
    "pc_realtime_events": Silver("pc_realtime_events", instants=("event_timestamp",)),
    "pc_combined_ratios": Silver("pc_combined_ratios"),
    "pc_loss_development": Silver("pc_loss_development"),
    "pc_risk_exposure": Silver("pc_risk_exposure"),
    "pc_solvency_metrics": Silver("pc_solvency_metrics"),
}

# the four reference tables that are copied into silver without any change
STATIC = ("pc_combined_ratios", "pc_loss_development", "pc_risk_exposure", "pc_solvency_metrics")


def silver(ws: Workspace, name: str, observation: Observation | str | None = None) -> DataFrame:
    """A silver table with its drop rules applied; violations are counted on the observation."""
    spec = TABLES[name]
    return enforce(spec.typed(ws.bronze(spec.bronze)), spec.rules, observation)


for _name in TABLES:
    _counted = (lambda ws, seen, n=_name: silver(ws, n, seen)) if TABLES[_name].rules else None
    table(_name, "silver", counted=_counted)(lambda ws, n=_name: silver(ws, n))


def dq_report(ws: Workspace) -> DataFrame:
    """Passed and failed rows of every rule of every silver table, before anything is dropped."""
    return report(
        {n: (s.typed(ws.bronze(s.bronze)), s.rules) for n, s in TABLES.items() if s.rules}
    )
