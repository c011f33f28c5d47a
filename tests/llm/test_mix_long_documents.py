"""The mix with documents that are much longer than the others of their block."""

from __future__ import annotations

import pytest

from pcmarts.llm import mixing


@pytest.mark.parametrize("long", [500, 900])
def test_a_long_document_does_not_end_the_draw(spark, long):
    rows = [(1000 * s + k, f"s{s:02d}", "w " * (long if k == 0 else 10)) for s in range(18) for k in range(201)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(rows)
    got["taken"] = [n * len(d) for n, d in zip(got["size"], got.draws, strict=True)]
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (by.target % (2000 + long) > 0).any() and ((by.taken - by.target).abs() < 10).all(), by
    assert all(len({x["pass"] for x in d}) == len(d) for d in got.draws)
