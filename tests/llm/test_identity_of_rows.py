"""Ids of 64 bits through the archives, and columns of documents that are named like those of the operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pcmarts.llm import common, mixing, quality, simhash, warc


def test_ids_above_53_bits_come_back(spark, tmp_path):
    big, html = 2**53 + 1, "<p>" + "x" * 200
    rows = [(big, html), (big + 2, html), (big + 4, "y" * 150), (2**60 + 1, "z" * 150), (2**62 + 3, "z" * 150), (None, html), (None, "n"), (-(2**61) - 1, "short")]
    pages = spark.createDataFrame([(i, "u", h, "e") for i, h in rows], "page_id long, url string, html string, digest string").coalesce(1)
    folder = f"file://{tmp_path}/warc"
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read(warc.write(pages, folder), folder).collect()}
    assert got == {
        (big, "response", None), (big + 2, "revisit", big), (big + 4, "response", None), (2**60 + 1, "response", None), (2**62 + 3, "revisit", 2**60 + 1),
        (None, "revisit", big), (None, "response", None), (-(2**61) - 1, "response", None),
    }


CLASHING = ("_id", "_digest", "_text_digest", "_row_id", "_row_digest", "size", "source_size", "target", "draws", "_size", "_key", "_draw", "_order", "host", "path", "digest")


def test_stages_return_the_columns_of_documents_as_they_came(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of the same words again and again " * 9, "en", f"s{i % 3}", 7, *(f"{c}{i}" for c in CLASHING)) for i in range(30)],
                                 ["doc_id", "text", "lang", "source", "n_chars", *CLASHING])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    given = {r.doc_id: r for r in docs.collect()}
    site = (F.col("source"), F.concat_ws("/", "source", "lang"))
    for out in (simhash.keep_first(docs), mixing.mixed(docs), quality.keep_good(docs, labels, *site)):
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r == given[r.doc_id] for r in rows)
    empty = docs.limit(0)
    assert simhash.keep_first(empty).count() == mixing.mixed(empty).count() == quality.keep_good(empty, labels, *site).count() == 0


def test_posteriors_are_the_plain_moments(spark):
    """Rates of hosts and paths by the formulas written out in plain Python."""
    rng = np.random.default_rng(3)
    sites = [(f"h{h}", f"h{h}/{p}", float(rng.normal(h - 2, 1) + p / 3)) for h in range(5) for p in range(4) for _ in range(rng.integers(1, 40))]
    sites += [(None, None, 0.3), (None, "p", -1.0)]
    frame = spark.createDataFrame(sites, "host string, path string, evidence double")
    prior, clip = 0.7, lambda x: min(max(x, quality.RATES[0]), quality.RATES[1])
    p = {k: 1 / (1 + np.exp(-(e + np.log(prior / (1 - prior))))) for k, (_, _, e) in enumerate(sites)}
    hosts, paths = ({key: [p[k] for k, s in enumerate(sites) if s[:n] == key] for key in {s[:n] for s in sites}} for n in (1, 2))
    n, mean = len(sites), float(np.mean(list(p.values())))
    within = max(clip(mean) * (1 - clip(mean)), 1e-6)

    def weight(groups, square, size):
        between = (square - (groups - 1) * within) / size
        return within / between if between > 1e-6 else 1e6

    k_host = weight(len(hosts), sum(len(v) * np.mean(v) ** 2 for v in hosts.values()) - n * mean**2, n - sum(len(v) ** 2 for v in hosts.values()) / n)
    k_path = weight(len(paths) - len(hosts) + 1, sum(len(v) * (np.mean(v) - np.mean(hosts[k[:1]])) ** 2 for k, v in paths.items()), n)
    rate = {h: (sum(v) + k_host * clip(mean)) / (len(v) + k_host) for h, v in hosts.items()}
    got = {(r._host, r._path): r for r in quality.posteriors(frame, prior).collect()}
    assert set(got) == set(paths)
    for key, v in paths.items():
        assert got[key].host_rate == pytest.approx(rate[key[:1]]) and got[key].site_rows == len(v)
        assert got[key].path_rate == pytest.approx((sum(v) + k_path * rate[key[:1]]) / (len(v) + k_path))


def test_identity_keeps_odd_column_names(spark):
    docs = spark.createDataFrame([(1, "t", 2)], ["doc_id", "text", "a.b"])
    assert common.with_identity(docs).select("_row.*").columns == docs.columns
