"""Query ids and their builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.workspace import Workspace

QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}


def query(*ids: str):
    """Register one builder ``(workspace) -> DataFrame`` under one or more ids."""

    def register(build):
        for i in ids:
            QUERIES[i] = build
        return build

    return register


def high(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def low(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; the order must end in a key so that the cut is the same on every run."""
    return df.orderBy(*order).limit(n)
