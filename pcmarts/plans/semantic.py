"""Semantic layer: named measures, filters, expressions and joins over the marts.

``metric_query`` combines them; names may be the registered ones, column names, or the words users
have for a column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.functions.dates import since_months
from pcmarts.functions.money import billions, millions, percent, retotal
from pcmarts.operators.shapes import stack
from pcmarts.plans.registry import query
from pcmarts.workspace import Workspace


@dataclass(frozen=True)
class Named:
    mart: str
    label: str
    build: Callable[..., Column]


MEASURES: dict[str, Named] = {
    "total_gwp_musd": Named("underwriting_kpis", "Total GWP ($M)", lambda: millions(retotal("gross_written_premium_usd"))),
    "total_incurred_musd": Named("underwriting_kpis", "Total Incurred Loss ($M)", lambda: millions(retotal("incurred_loss_usd"))),
    "avg_combined_ratio_pct": Named("underwriting_kpis", "Combined Ratio %", lambda: percent(F.avg("combined_ratio"))),
    "total_claim_count": Named("peril_loss_summary", "Total Claims", lambda: F.sum("claim_count")),
    "total_tiv_busd": Named("exposure_accumulation", "Total Insured Value ($B)", lambda: billions(retotal("total_insured_value_usd"))),
}

FILTERS: dict[str, Named] = {
    "current_year": Named("underwriting_kpis", "Current calendar year", lambda as_of: F.col("month") >= F.trunc(F.lit(as_of), "year")),
    "last_12_months": Named("underwriting_kpis", "Last 12 months", lambda as_of: since_months("month", as_of, 12)),
    "active_policies": Named("policy_customer_360", "Active policies only", lambda as_of: F.col("policy_status") == "Active"),
    "catastrophe_claims": Named("claim_360", "Catastrophe claims only", lambda as_of: F.col("is_cat")),
    "personal_lines": Named("policy_customer_360", "Personal Lines only", lambda as_of: F.col("line_of_business") == "Personal"),
}

EXPRESSIONS: dict[str, Named] = {
    "policy_year": Named("policy_customer_360", "Policy Year", lambda: F.year("effective_date")),
    "loss_ratio_pct": Named("underwriting_kpis", "Loss Ratio %", lambda: percent("loss_ratio")),
    "severity_pct": Named("claim_360", "Severity % of Sum Insured", lambda: percent("severity_pct_of_sum_insured")),
}


@dataclass(frozen=True)
class JoinSpec:
    left: str
    right: str
    key: str
    relationship: str  # "N:1" or "N:M"


JOINS: dict[str, JoinSpec] = {
    "claim_policy": JoinSpec("claim_360", "policy_customer_360", "policy_id", "N:1"),
    "event_exposure": JoinSpec("event_risk_correlation", "exposure_accumulation", "state_code", "N:M"),
    "pml_exposure": JoinSpec("cat_event_pml", "exposure_accumulation", "state_code", "N:M"),
}

# Words users have for a column that its name does not give away, a start to which a deployment adds its own
# (``words`` of ``resolve`` and ``metric_query``). Plain forms of the name itself (without unit, with spaces, as
# initials) are derived by rule in ``terms_for``.
USER_WORDS: dict[str, tuple[str, ...]] = {
    "gross_written_premium_usd": ("premium",),
    "incurred_loss_usd": ("losses", "incurred"),
    "paid_loss_usd": ("paid",),
    "reserve_amount_usd": ("reserves", "outstanding"),
    "claim_count": ("claims", "number of claims"),
    "active_policy_count": ("active policies", "in-force policies"),
    "policy_count": ("policies", "number of policies"),
    "loss_ratio": ("LR",),
    "expense_ratio": ("ER",),
    "combined_ratio": ("CR",),
    "claim_frequency_per_100": ("frequency",),
    "avg_severity_usd": ("severity", "average severity"),
    "total_insured_value_usd": ("sum insured", "exposure"),
    "exposed_tiv_usd": ("TIV at risk",),
    "exposed_policy_count": ("affected policies",),
    "deductible_usd": ("excess",),
    "line_of_business": ("line", "business line"),
    "product": ("sub-line",),
    "channel": ("distribution channel",),
    "customer_type": ("client type",),
    "loyalty_tier": ("customer tier",),
    "credit_score": ("FICO",),
    "state_code": ("state",),
    "cresta_zone": ("accumulation zone", "CRESTA"),
    "peril": ("cause of loss", "hazard"),
    "fraud_flag": ("fraud", "SIU referral"),
    "is_cat": ("cat claim",),
    "effective_date": ("start date", "inception date"),
    "expiration_date": ("expiry date",),
    "loss_date": ("date of loss", "DOL"),
    "report_date": ("notification date", "DOR"),
    "report_lag_days": ("reporting lag",),
    "rating": ("credit rating",),
    "avg_yield_pct": ("yield", "return"),
    "avg_duration_yrs": ("duration",),
    "avg_esg_score": ("ESG",),
    "metric": ("component",),
    "reinsurer": ("carrier",),
    "treaty_type": ("treaty",),
    "avg_cession_pct": ("cession rate",),
    "event_type": ("alert type", "peril type"),
    "effective_utc": ("alert start",),
    "expires_utc": ("alert end",),
    "pml_estimate_usd": ("PML", "probable maximum loss"),
    "policy_id": ("policy number", "contract number"),
    "reinsured": ("RI",),
    "underwriter_score": ("UW score",),
    "p95_severity_usd": ("p95",),
    "claim_id": ("claim number",),
    "customer_id": ("client id",),
    "agent_id": ("broker id",),
}

_UNITS = ("usd", "pct", "yrs", "utc", "days")


def _key(term: str) -> str:
    return " ".join(term.lower().replace("_", " ").replace("-", " ").split())


Words = Mapping[str, Sequence[str]]


def terms_for(column: str, words_of: Words | None = None) -> set[str]:
    """The words a column answers to: its name, its name without unit, its initials, user words."""
    words = column.split("_")
    bare = words[:-1] if words[-1] in _UNITS and len(words) > 1 else words
    forms = {" ".join(words), " ".join(bare), *USER_WORDS.get(column, ()), *(words_of or {}).get(column, ())}
    if len(bare) > 1:
        forms.add("".join(w[0] for w in bare))
    return {_key(f) for f in forms}


def resolve(term: str, columns: Sequence[str], words: Words | None = None) -> str:
    """The one column of a mart a term means; an exact column name always wins."""
    if term in columns:
        return term
    hits = [c for c in columns if _key(term) in terms_for(c, words)]
    if len(hits) != 1:
        raise ValueError(f"{term!r} means {hits or 'no column'} here")
    return hits[0]


def metric_query(
    ws: Workspace, mart: str, measures: Sequence[str], by: Sequence[str] = (), filters: Sequence[str] = (),
    words: Words | None = None,
) -> DataFrame:
    """Measures of one mart, grouped and filtered. All names are checked against the mart first."""
    for kind, names, registry in (("measure", measures, MEASURES), ("filter", filters, FILTERS)):
        for n in names:
            if registry[n].mart != mart:
                raise ValueError(f"{kind} {n!r} belongs to {registry[n].mart}, not {mart}")
    rows = ws.table(mart)
    keys = [resolve(b, rows.columns, words) for b in by]
    for f in filters:
        rows = rows.filter(FILTERS[f].build(ws.as_of))
    return rows.groupBy(*keys).agg(*[MEASURES[m].build().alias(m) for m in measures])


def is_unique(df: DataFrame, key: str) -> DataFrame:
    """One row: does no key occur twice?"""
    twice = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return twice.agg((F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("right_unique"))


def joined(ws: Workspace, name: str, check: bool = True) -> DataFrame:
    """Two marts along a declared join. For N:1 the right key is checked to be unique first."""
    spec = JOINS[name]
    right = ws.table(spec.right)
    if check and spec.relationship == "N:1" and not is_unique(right, spec.key).first()[0]:
        raise ValueError(f"{spec.right}.{spec.key} is not unique: the join would multiply {spec.left}")
    clash = [c for c in right.columns if c in ws.table(spec.left).columns and c != spec.key]
    right = right.withColumnsRenamed({c: f"{spec.right}_{c}" for c in clash})
    return ws.table(spec.left).join(right, spec.key)


@query("sem_measures")
def all_measures(ws: Workspace) -> DataFrame:
    """Every measure over its whole mart, one pass per mart."""

    def of(mart: str) -> DataFrame:
        names = [n for n, m in MEASURES.items() if m.mart == mart]
        one = ws.table(mart).agg(*[MEASURES[n].build().cast("double").alias(n) for n in names])
        return one.select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in names]))
        )

    return stack(*[of(m) for m in dict.fromkeys(x.mart for x in MEASURES.values())])


@query("sem_filters")
def all_filters(ws: Workspace) -> DataFrame:
    """Rows each filter keeps, one pass per mart."""

    def of(mart: str) -> DataFrame:
        names = [n for n, m in FILTERS.items() if m.mart == mart]
        one = ws.table(mart).agg(*[F.count(F.when(FILTERS[n].build(ws.as_of), 1)).alias(n) for n in names])
        return one.select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("filter"), F.col(n).alias("kept")) for n in names]))
        )

    return stack(*[of(m) for m in dict.fromkeys(x.mart for x in FILTERS.values())])


@query("sem_expressions")
def all_expressions(ws: Workspace) -> DataFrame:
    """Distribution of each expression over its mart."""
    return stack(
        *[
            ws.table(e.mart).groupBy(e.build().cast("double").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("expression"), "value", "n")
            for name, e in EXPRESSIONS.items()
        ]
    )


# marts that only look columns up: they have the rows of the table they start from
ROWS_OF = {"claim_360": "fact_claim", "policy_customer_360": "dim_policy"}


def key_counts(ws: Workspace, mart: str, key: str, name: str) -> DataFrame:
    """Rows of a mart per key, without building the mart where its rows are known."""
    if mart == "cat_event_pml":  # every event with every state
        events = ws.table("catastrophe_events").agg(F.count(F.lit(1)).alias("n"))
        return ws.table("exposure_by_state").groupBy(key).agg((F.count(F.lit(1)) * events.scalar()).alias(name)).filter(F.col(name) > 0)
    return ws.table(ROWS_OF.get(mart, mart)).groupBy(key).agg(F.count(F.lit(1)).alias(name))


@query("sem_joins")
def join_report(ws: Workspace) -> DataFrame:
    """Cardinality of each declared join, from key counts: neither the joins nor the wide marts are built."""

    def of(name: str) -> DataFrame:
        spec = JOINS[name]
        left = key_counts(ws, spec.left, spec.key, "l")
        right = key_counts(ws, spec.right, spec.key, "r")
        return left.join(right, spec.key, "full").agg(
            F.lit(name).alias("name"), F.lit(spec.relationship).alias("relationship"),
            F.sum(F.coalesce(F.col("l") * F.col("r"), F.lit(0))).alias("joined_rows"),
            F.sum(F.when(F.col("r").isNull(), F.col("l")).otherwise(0)).alias("unmatched_left"),
            (F.max("r") <= 1).alias("right_unique"),
        )

    return stack(*[of(name) for name in JOINS])


@query("sem_query")
def gwp_and_ratio_by_line(ws: Workspace) -> DataFrame:
    return metric_query(
        ws, "underwriting_kpis", ["total_gwp_musd", "total_incurred_musd", "avg_combined_ratio_pct"],
        by=["line_of_business"], filters=["last_12_months"],
    )


@query("sem_synonyms")
def exposure_in_user_words(ws: Workspace) -> DataFrame:
    """The same mechanism with a user's words for the columns."""
    return metric_query(ws, "exposure_accumulation", ["total_tiv_busd"], by=["state", "LOB"])
