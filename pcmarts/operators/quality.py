"""Data-quality rules: keep-and-count or drop-and-count.

A rule is a named boolean expression. A row passes only if the rule is TRUE; NULL counts as a
violation. Counting happens inside the job that reads the table (``Observation``), never as an
extra pass, except in ``report``, which is a table of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP = "warn", "drop"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = WARN

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def watch(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """Attach passed / failed counters that fill while the table is being read."""
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count(F.when(~r.holds(), 1)).alias(f"{r.name}__failed") for r in rules]
    return df.observe(observation, *counters)


def enforce(df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None) -> DataFrame:
    """Count every violation (if asked to) and remove the rows that break a drop rule."""
    if observation is not None:
        df = watch(df, rules, observation)
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(rule.holds())
    return df


def report(tables: dict[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """One row per table and rule: action, rows passed, rows failed. One pass per table."""

    def one(name: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(F.when(~r.holds(), 1)).alias(f"f{i}") for i, r in enumerate(rules)],
        )
        rows = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                (F.col("n") - F.col(f"f{i}")).alias("passed"), F.col(f"f{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
        return counts.select(F.inline(F.array(*rows)))

    return reduce(DataFrame.unionByName, [one(n, df, rules) for n, (df, rules) in tables.items()])
