from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pcmarts.functions import bands, classify
from pcmarts.functions.dates import as_date, as_instant, as_mail_instant, period_filter
from pcmarts.functions.money import as_public, mean, ratio, total
from pcmarts.functions.textscan import is_sql, sql_lines
from pcmarts.plans.event_report import trimmed


def values(spark, texts, build, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(build("t")).collect()]


def test_instants_of_every_spelling(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04", "Tue, 02 Jan 2024 03:04:05 GMT", "2 Jan 2024 03:04:05 GMT", "junk", None]
    assert values(spark, texts, as_mail_instant) == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4), datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5), None, None,
    ]
    assert values(spark, ["junk", None, "2024-02-30"], as_instant) == [None, None, None]
    assert values(spark, ["2024-02-29", "2024-02-30", "x", None], as_date) == [date(2024, 2, 29), None, None, None]


def test_catastrophe_rules_keep_their_order(spark):
    titles = ["Red EQ 6.1", "TC FREDDY", "Flood after cyclone", "hurricane", "DR Kenya", "WF 12", "VOLCANO", "", None]
    assert values(spark, titles, classify.catastrophe_type) == [
        "Earthquake", "TropicalCyclone", "TropicalCyclone", "TropicalCyclone", "Drought", "Wildfire", "Volcanic", "Other", "Other",
    ]


def test_alert_colour_is_a_substring_rule(spark):
    titles = ["Red EQ", "TC FREDDY", "orange alert", "PREDICTED", "Green", "", None]
    assert values(spark, titles, classify.alert_colour) == ["high", "high", "moderate", "high", "low", "low", "low"]


def test_news_rules_keep_their_order(spark):
    titles = ["Storm warning", "Cyber flood", "Ransomware", "Covid", "Peace talks", None]
    assert values(spark, titles, classify.news_category) == ["Conflict", "Catastrophe", "Cyber", "Health", "General", "General"]


def test_magnitude_limit(spark):
    assert values(spark, [6.5, 6.49, None], classify.earthquake_severity, "double") == ["high", "moderate", "moderate"]


@pytest.mark.parametrize(
    "line,expected",
    [
        ("Do not join X to Y", False), ("Use: SELECT a FROM t", True), ("group by urgency", False), ("WHERE a = 1", True),
        ("SELECT t.a, HAVING x", True), ("Never select t.a having x", False), ("order by priority, not date", False),
        ("order by priority desc", True), ("having count(x) > 1", True), ("join a on b", True), ("join us on Monday", True),
        ("from t where", True), ("In the morning, where possible", False), ("SELECT x. FROM y", False), ("", False),
        ("élan.vital select WHERE", True),
    ],
)
def test_sql_structure(spark, line, expected):
    assert values(spark, [line], lambda c: is_sql(F.col(c))) == [expected]


def test_sql_lines_split_on_every_line_break(spark):
    text = "one\r\nselect a from b\rWHERE a = 1 three\nfour"
    assert values(spark, [text, None, "no keyword"], sql_lines) == [["select a from b", "WHERE a = 1"], [], []]


def test_trim(spark):
    assert values(spark, ["abcdef", "abc", None, "abcd"], lambda c: trimmed(c, 4)) == ["abc…", "abc", "", "abcd"]


def test_ratio_needs_a_positive_base(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [tuple(r) for r in df.select(ratio("a", "b"), ratio("a", "b", None)).collect()] == [
        (0.5, 0.5), (0.0, None), (0.0, None), (0.0, None), (None, None),
    ]


def test_totals_do_not_depend_on_order(spark):
    cents = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9, 0.4] * 50
    one = spark.createDataFrame([(c,) for c in cents], "x double")
    two = spark.createDataFrame([(c,) for c in sorted(cents)], "x double").repartition(3)
    assert one.agg(total("x"), mean("x")).first() == two.agg(total("x"), mean("x")).first()
    assert one.agg(total("x")).first()[0] == 50.5 + 0.0
    assert spark.createDataFrame([], "x double").agg(total("x"), mean("x")).first() == (None, None)


def test_public_columns_are_double(spark):
    df = spark.sql("select cast(1.50 as decimal(18,2)) as m, 'x' as s, 3 as n")
    assert dict(as_public(df).dtypes) == {"m": "double", "s": "string", "n": "int"}


def test_bands(spark):
    assert values(spark, [99.9, 100.0, 149.9, 150.0, 200.0, 201.0], bands.solvency_band, "double") == [
        "Regulatory intervention", "Recovery plan required", "Recovery plan required", "Adequate", "Adequate", "Strong",
    ]
    assert values(spark, [99.0, 100.0, 150.0, 200.0], bands.solvency_tier, "double") == [
        "Intervention", "Recovery plan", "Adequate", "Strong",
    ]
    assert values(spark, [99.0, 100.0, 150.0], bands.solvency_status, "double") == ["Intervention", "Recovery plan", "Healthy"]
    assert values(spark, [70.0, 70.1, 50.0, 49.9, None], bands.esg_band, "double") == ["Average", "Strong", "Average", "Weak", None]
    assert values(spark, [5.0, 10.0, 30.0, 31.0], lambda c: bands.cession_band(F.lit("Personal"), c), "double") == [
        "Below", "Within", "Within", "Above",
    ]
    assert values(spark, ["Auto", "Nothing", None], bands.subline_benchmark) == [104.0, None, None]
    assert values(spark, ["Auto", "Nothing", None], bands.rule_benchmark) == [99.0, 101.0, 101.0]


@pytest.mark.parametrize(
    "period,inside,outside",
    [
        ("current_year", ["2024-01-01", "2024-12-31"], ["2023-12-31", "2025-01-01"]),
        ("ytd", ["2024-01-01", "2024-06-15"], ["2024-06-16", "2023-06-01"]),
        ("pytd", ["2023-01-01", "2023-06-15"], ["2023-06-16", "2024-01-01"]),
        ("this_quarter", ["2024-04-01", "2024-06-30"], ["2024-03-31", "2024-07-01"]),
        ("last_quarter", ["2024-03-01", "2024-05-31"], ["2024-02-29", "2024-06-01"]),
        ("last_12_months", ["2023-06-15", "2024-08-01"], ["2023-06-14"]),
    ],
)
def test_periods(spark, period, inside, outside):
    df = spark.createDataFrame([(d,) for d in inside + outside], "d string").select(F.col("d").cast("date").alias("d"))
    kept = [r.d.isoformat() for r in df.filter(period_filter("d", period, date(2024, 6, 15))).collect()]
    assert sorted(kept) == sorted(inside)


def test_unknown_period():
    with pytest.raises(ValueError):
        from pyspark.sql import SparkSession

        assert SparkSession.getActiveSession() is not None
        period_filter("d", "someday", date(2024, 1, 1))
