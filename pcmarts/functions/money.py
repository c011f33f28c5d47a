"""Exact money arithmetic.

Money is summed as DECIMAL so a total does not depend on the order in which partitions are
merged (a retried task or a different shuffle width gives the same bits); the finished total is
published as DOUBLE. Division always happens on doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CENTS = "decimal(18,2)"
RATE = "decimal(18,6)"
WIDE = "decimal(30,2)"  # money that is already a total
FINE = "decimal(28,10)"  # money in millions: a unit is worth a million


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str, unit: str = CENTS) -> Column:
    """Order-independent SUM, as double (NULL over no rows)."""
    return F.sum(_col(c).cast(unit)).cast("double")


def retotal(c: Column | str) -> Column:
    """Order-independent SUM of a mart's money column (totals of totals)."""
    return total(c, WIDE)


def mean(c: Column | str, unit: str = CENTS) -> Column:
    """Order-independent AVG over the non-NULL values."""
    return F.try_divide(total(c, unit), F.count(c))


def peak(c: Column | str) -> Column:
    return F.max(_col(c)).cast("double")


def ratio(top: Column | str, bottom: Column | str, otherwise: float | None = 0.0) -> Column:
    """top / bottom where bottom is positive, else the given constant (None gives NULL)."""
    top, bottom = _col(top), _col(bottom)
    share = F.when(bottom > 0, F.try_divide(top.cast("double"), bottom.cast("double")))
    return share if otherwise is None else share.otherwise(F.lit(otherwise))


def in_units(c: Column | str, unit: float, digits: int) -> Column:
    """Money in thousands, millions or billions, rounded for display."""
    return F.round(_col(c).cast("double") / F.lit(float(unit)), digits)


def millions(c: Column | str, digits: int = 1) -> Column:
    return in_units(c, 1e6, digits)


def billions(c: Column | str, digits: int = 2) -> Column:
    return in_units(c, 1e9, digits)


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.round(_col(c).cast("double") * F.lit(100.0), digits)


def rounded(c: Column | str, digits: int) -> Column:
    return F.round(_col(c).cast("double"), digits)


def as_public(df: DataFrame) -> DataFrame:
    """Publish every DECIMAL column as DOUBLE; other columns pass through."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
