"""Fills the query registry: silver, gold, quality, reports, rules, questions, feeds and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.functions.money import as_public
from pcmarts.plans import gold, silver
from pcmarts.plans import dashboard, event_report, examples, extras, questions, reports, rules, semantic  # noqa: F401
from pcmarts.plans import feeds, increments  # noqa: F401
from pcmarts.plans.registry import QUERIES, query
from pcmarts.workspace import Workspace

for _name in silver.TABLES:
    QUERIES[f"slv_{_name}"] = lambda ws, n=_name: as_public(ws.table(n))

for _name in gold.MARTS:
    QUERIES[f"gld_{_name}"] = lambda ws, n=_name: ws.table(n)

QUERIES["dq_report"] = silver.dq_report


@query("dq_expect_warn")
def flagged_rows(ws: Workspace) -> DataFrame:
    """Rows kept and rows flagged by each warning rule."""
    warnings = silver.dq_report(ws).filter("action = 'warn'")
    return warnings.select(
        "table_name", (F.col("passed") + F.col("failed")).alias("kept"), F.col("failed").alias("flagged")
    )


@query("dq_expect_or_drop")
def surviving_customers(ws: Workspace) -> DataFrame:
    return silver.silver(ws, "dim_customer").select("customer_id", "customer_name", "geo_id")
