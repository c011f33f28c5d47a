from __future__ import annotations

import os
import sys
from datetime import date

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pcmarts.sources.schemas import SCHEMAS  # noqa: E402
from pcmarts.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("pcmarts-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frames(spark):
    """Bronze tables from literal rows: table name -> list of dicts; columns left out are NULL."""

    def make(**tables) -> Workspace:
        def read(name: str):
            schema = SCHEMAS[name]
            columns = [c.split()[0] for c in schema.split(",")]
            rows = [tuple(r.get(c) for c in columns) for r in tables.get(name, [])]
            return spark.createDataFrame(rows, schema)

        return Workspace(spark, read, as_of=date(2024, 6, 15))

    return make


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def rows():
    return rows_of
