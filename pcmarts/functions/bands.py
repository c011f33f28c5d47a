"""Benchmarks and rating bands as column expressions.

Lookup values are small fixed tables; they become literal maps inside the expression, so a lookup
is part of the projection and needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Combined ratio benchmarks (percent) of the benchmark report.
REPORT_BENCHMARKS = {
    "Auto": 104.0, "Home": 110.0, "Liability": 95.0, "Property": 95.0,
    "Marine": 92.0, "Aviation": 98.0, "Cyber": 105.0, "WorkersComp": 85.0,
}

# Combined ratio benchmarks (percent) of the business rules, 2024, by product.
RULE_BENCHMARKS = {
    "Auto": 99.0, "Home": 108.0, "Property": 93.0, "GeneralLiability": 98.0, "WorkersComp": 88.0,
    "DandO": 104.0, "ProfessionalLiability": 99.0, "Cyber": 95.0, "Marine": 92.0, "Aviation": 98.0,
}
INDUSTRY_BENCHMARK = 101.0

# Claims per 100 policies and average severity (USD), by product.
FREQUENCY_BENCHMARKS = {
    "Auto": 6.0, "Home": 5.0, "Property": 3.0, "WorkersComp": 3.0,
    "GeneralLiability": 2.0, "Cyber": 1.5, "Aviation": 0.4, "Marine": 2.0,
}
SEVERITY_BENCHMARKS = {
    "Auto": 5_000.0, "Home": 15_000.0, "Property": 60_000.0, "WorkersComp": 40_000.0,
    "GeneralLiability": 25_000.0, "Cyber": 200_000.0, "Aviation": 1_200_000.0, "Marine": 40_000.0,
}

# Usual cession range (percent of premium) by line.
CESSION_RANGES = {"Personal": (10.0, 30.0), "Commercial": (30.0, 60.0), "Specialty": (60.0, 80.0)}

# Thresholds of the anomaly rules.
COMBINED_RATIO_LIMIT = 110.0
SOLVENCY_LIMIT = 150.0
BENCHMARK_MULTIPLE = 2.0
CLIMATE_LIMIT = 0.30
CESSION_LIMIT = 80.0

NON_INVESTMENT_GRADE = ("BB", "B", "CCC", "NotRated")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def looked_up(table: dict[str, float], key: Column | str) -> Column:
    """Value of a fixed table, NULL for an unknown or NULL key."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, _col(key))


def subline_benchmark(sub_line: Column | str) -> Column:
    return looked_up(REPORT_BENCHMARKS, sub_line)


def rule_benchmark(product: Column | str) -> Column:
    """Benchmark of the product, or the industry figure where the product has none."""
    return F.coalesce(looked_up(RULE_BENCHMARKS, product), F.lit(INDUSTRY_BENCHMARK))


def _steps(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold the value reaches."""
    (bar, label), *rest = steps
    chain = F.when(value >= bar, label)
    for bar, label in rest:
        chain = chain.when(value >= bar, label)
    return chain.otherwise(otherwise)


def solvency_status(ratio_pct: Column | str) -> Column:
    """Three tiers of the regulatory report."""
    return _steps(_col(ratio_pct), [(150, "Healthy"), (100, "Recovery plan")], "Intervention")


def solvency_tier(ratio_pct: Column | str) -> Column:
    """Four tiers of the solvency trend."""
    return _steps(_col(ratio_pct), [(200, "Strong"), (150, "Adequate"), (100, "Recovery plan")], "Intervention")


def solvency_band(ratio_pct: Column | str) -> Column:
    """Benchmark wording: strong only above 200."""
    r = _col(ratio_pct)
    return F.when(r > 200, "Strong").otherwise(
        _steps(r, [(150, "Adequate"), (100, "Recovery plan required")], "Regulatory intervention")
    )


def esg_band(score: Column | str) -> Column:
    s = _col(score)
    return F.when(s > 70, "Strong").when(s >= 50, "Average").when(s < 50, "Weak")


def cession_band(line: Column | str, cession_pct: Column | str) -> Column:
    """Position of a cession (percent) against the usual range of its line."""
    low = looked_up({k: v[0] for k, v in CESSION_RANGES.items()}, line)
    high = looked_up({k: v[1] for k, v in CESSION_RANGES.items()}, line)
    c = _col(cession_pct)
    return F.when(c.between(low, high), "Within").when(c < low, "Below").when(c > high, "Above")
