"""Shapes of physical plans, and every registered query against its oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from pcmarts.plans import gold, semantic
from pcmarts.plans.library import QUERIES
from tools.check import TABLES, canonical

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ws(spark):
    return entry.workspace(spark, SMALL)


@pytest.mark.parametrize("mart", gold.MARTS)
def test_no_mart_multiplies_tables(ws, mart):
    text = plan(ws.table(mart))
    assert "CartesianProduct" not in text
    # the only nested loop is the containment test against the short state list (and the test tables' own zones)
    loops = [line for line in text.splitlines() if "NestedLoopJoin" in line and "Contains" not in line]
    assert all("z#" in line for line in loops), loops


@pytest.mark.parametrize("name", ["sql_05_cat_pml_exposure", "sql_06_segment_loss_ratio", "sql_07_claim_360", "ex_active_alerts", "rpt_news"])
def test_top_k_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](entry.workspace(spark, SMALL)))


def test_stacked_marts_shuffle_once(spark):
    # one exchange for the aggregation; the facts' own joins with the policies are broadcast here
    text = plan(entry.workspace(spark, SMALL).table("underwriting_kpis"))
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.workspace(spark, SMALL).table("fact_claim").groupBy("peril").agg({"incurred_amount_usd": "sum"}))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "EqualTo(l_returnflag,R)" in scan
    assert "l_tax" not in scan and "l_shipdate" not in scan


def test_the_percentile_reads_the_claims_once(spark):
    # the ranges of counted amounts are written from the claims; sums, offsets and the rank read those ranges only
    text = plan(entry.workspace(spark, SMALL).table("peril_loss_summary"))
    assert "lineitem.parquet" not in text and text.count("FileScan parquet") <= 4
    assert "dynamicpruning" in text  # of the ranges, the ones with a rank


def test_a_hot_policy_is_split_across_tasks(spark):
    """A third of all claims on one policy: the adaptive join splits that policy's partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    kept = {k: spark.conf.get(k, None) for k in conf}
    from datetime import date

    from pcmarts.workspace import Workspace

    def bronze(name):
        if name == "claims":
            return spark.range(30000, numPartitions=8).selectExpr(
                "cast(id as string) claim_id", "cast(case when id % 3 = 0 then 0 else id end as string) policy_id", "'Personal' line_of_business",
                "'Auto' product", "'Wind' peril", "'g' geo_id", "'2024-01-01' loss_date", "'2024-01-02' report_date", "'Open' claim_status",
                "1.0D incurred_amount_usd", "1.0D paid_amount_usd", "0.0D reserve_amount_usd", "0.0D salvage_recovery_usd",
                "0.0D subrogation_recovery_usd", "false fraud_flag", "cast(null as string) catastrophe_code")
        if name == "policies":
            return spark.range(30000, numPartitions=4).selectExpr(
                "cast(id as string) policy_id", "cast(id % 100 as string) customer_id", "'g' geo_id", "'a' agent_id", "'Personal' line_of_business",
                "'Auto' product", "'Active' policy_status", "'Direct' channel", "'2024-01-01' effective_date", "'2025-01-01' expiration_date",
                "1.0D annual_premium_usd", "10.0D sum_insured_usd", "0.0D deductible_usd", "true reinsured", "1.0D underwriter_score")
        if name == "customers":
            return spark.range(100).selectExpr(
                "cast(id as string) customer_id", "'n' customer_name", "'Individual' customer_type", "'e' email", "'p' phone", "'1980-01-01' date_of_birth",
                "'g' geo_id", "'x' income_bracket", "1L credit_score", "'Gold' loyalty_tier", "true marketing_consent", "'2020-01-01' signup_date")
        return spark.sql("select 'g' geo_id, 'TX' state_code, 'Texas' state_name, 'S' region, 'z' zip_code, 'Z' cresta_zone, 'USA' country, "
                         "1.0D latitude, 1.0D longitude, 1L windstorm_zone, 'X' flood_zone")

    try:
        work = Workspace(spark, bronze, as_of=date(2024, 6, 15))
        for k, v in conf.items():
            spark.conf.set(k, v)
        mart = work.table("claim_360")
        assert mart.count() == 30000
        got = mart.select("claim_id", "sum_insured_usd", "channel")
        got.collect()
        assert "skew=true" in plan(got)
        assert got.filter("sum_insured_usd is null").count() == 0
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_metric_queries_check_their_names(spark, ws):
    with pytest.raises(ValueError, match="belongs to"):
        semantic.metric_query(ws, "underwriting_kpis", ["total_tiv_busd"])
    with pytest.raises(ValueError, match="means"):
        semantic.metric_query(ws, "underwriting_kpis", ["total_gwp_musd"], by=["shoe size"])
    assert semantic.metric_query(ws, "underwriting_kpis", ["total_gwp_musd"], by=["LOB"]).columns == ["line_of_business", "total_gwp_musd"]


@pytest.mark.parametrize(
    "term,columns,expected",
    [
        ("GWP", ["gross_written_premium_usd", "net_written_premium_usd"], "gross_written_premium_usd"),
        ("NWP", ["gross_written_premium_usd", "net_written_premium_usd"], "net_written_premium_usd"),
        ("TIV", ["total_insured_value_usd", "policy_count"], "total_insured_value_usd"),
        ("lr", ["loss_ratio", "expense_ratio"], "loss_ratio"), ("cause of loss", ["peril"], "peril"),
        ("loss ratio", ["loss_ratio", "combined_ratio"], "loss_ratio"), ("market value", ["market_value_usd", "book_value_usd"], "market_value_usd"),
        ("state", ["state_code"], "state_code"), ("PML", ["pml_estimate_usd"], "pml_estimate_usd"),
    ],
)
def test_user_words(term, columns, expected):
    assert semantic.resolve(term, columns) == expected


def test_a_deployment_adds_its_words():
    with pytest.raises(ValueError):
        semantic.resolve("booked", ["gross_written_premium_usd", "peril"])
    assert semantic.resolve("booked", ["gross_written_premium_usd", "peril"], {"gross_written_premium_usd": ("booked",)}) == "gross_written_premium_usd"
    assert semantic.resolve("DOL", ["loss_date", "report_date"]) == "loss_date"


def test_declared_join_checks_its_cardinality(spark, frames):
    rows = [{"policy_id": "p1"}, {"policy_id": "p1"}]
    work = frames(policies=rows, claims=[{"claim_id": "1", "policy_id": "p1"}])
    with pytest.raises(ValueError, match="not unique"):
        semantic.joined(work, "claim_policy")
    work = frames(policies=rows[:1], claims=[{"claim_id": "1", "policy_id": "p1"}])
    assert semantic.joined(work, "claim_policy").count() == 1


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(set(entry.oracle_sql()) & set(QUERIES)) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


SAMPLE = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
