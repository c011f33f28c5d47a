"""Silver and gold on literal rows: the cases the generated tables cannot show."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pcmarts.plans import extras, gold, library, questions, reports, rules  # noqa: F401
from pcmarts.sources.tables import current, exists, publish
from pcmarts.workspace import CATALOG, Workspace, build_order, downstream

GEO = [
    {"geo_id": "g1", "state_code": "TX", "state_name": "Texas", "region": "South", "cresta_zone": "Z1", "latitude": 30.0},
    {"geo_id": "g2", "state_code": "FL", "state_name": "Florida", "region": "South", "cresta_zone": "Z2", "latitude": -91.0},
    {"geo_id": "g3", "state_code": "CA", "state_name": "California", "region": "West", "cresta_zone": "Z3"},
    {"geo_id": None, "state_code": "XX", "state_name": "Nowhere"},
]
CUSTOMERS = [
    {"customer_id": "c1", "customer_name": "Ann", "customer_type": "Individual", "geo_id": "g1", "date_of_birth": "1980-02-30",
     "signup_date": "2020-01-05", "loyalty_tier": "Gold"},
    {"customer_id": None, "customer_name": "Ghost"},
]


def policy(pid, **more):
    base = {"policy_id": pid, "customer_id": "c1", "geo_id": "g2", "agent_id": "a1", "line_of_business": "Personal", "product": "Auto",
            "policy_status": "Active", "channel": "Direct", "effective_date": "2024-01-01", "expiration_date": "2024-12-31",
            "annual_premium_usd": 100.0, "sum_insured_usd": 1000.0, "underwriter_score": 50.0, "reinsured": True}
    return base | more


def premium(pid, gross, month="2024-01-15", **more):
    base = {"policy_id": pid, "line_of_business": "Personal", "product": "Auto", "billing_month": month,
            "gross_premium_usd": gross, "commission_usd": 10.0, "ceded_to_reinsurance_usd": 20.0}
    return base | more


def claim(cid, pid, incurred, loss="2024-01-20", **more):
    base = {"claim_id": cid, "policy_id": pid, "line_of_business": "Personal", "product": "Auto", "peril": "Wind", "geo_id": "g3",
            "loss_date": loss, "report_date": "2024-02-01", "claim_status": "Open", "incurred_amount_usd": incurred,
            "paid_amount_usd": 5.0, "salvage_recovery_usd": 1.0, "subrogation_recovery_usd": 1.0, "fraud_flag": False}
    return base | more


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    got = df.collect()
    assert len(got) == 1, got
    return got[0].asDict()


def test_dimensions_drop_rows_without_key(frames, rows):
    ws = frames(geography=GEO, customers=CUSTOMERS)
    assert rows(ws.table("dim_geography"), "geo_id", "latitude") == [("g1", 30.0), ("g2", -91.0), ("g3", None)]
    assert rows(ws.table("dim_customer"), "customer_id", "date_of_birth", "signup_date") == [("c1", None, date(2020, 1, 5))]


def test_lob_codes(frames, rows):
    lobs = ["Personal", "Commercial", "Specialty", "Marine cargo", None]
    ws = frames(policies=[policy(str(i), line_of_business=x) for i, x in enumerate(lobs)])
    assert rows(ws.table("dim_policy"), "policy_id", "lob_code") == [("0", "PL"), ("1", "CL"), ("2", "SP"), ("3", "SP"), ("4", "SP")]


def test_net_amounts_are_null_if_a_part_is(frames, rows):
    ws = frames(
        premiums=[premium("p", 100.0), premium("p", 100.0, ceded_to_reinsurance_usd=None)],
        claims=[claim("1", "p", 9.0), claim("2", "p", 9.0, salvage_recovery_usd=None, catastrophe_code="CAT")],
    )
    assert rows(ws.table("fact_premium").select(F.col("net_premium_usd").cast("double"))) == [(80.0,), (None,)]
    assert rows(ws.table("fact_claim").select("claim_id", F.col("net_paid_usd").cast("double"), "is_cat")) == [
        ("1", 3.0, False), ("2", None, True),
    ]


def test_kpis_keep_premium_months_only(frames, rows):
    ws = frames(
        premiums=[premium("p", 100.0), premium("p", 0.0, "2024-03-01"), premium("p", 50.0, None), premium("p", None, "2024-04-01")],
        claims=[claim("1", "p", 60.0), claim("2", "p", 10.0, "2024-02-01"), claim("3", "p", 7.0, None), claim("4", "p", 5.0, "2024-03-02")],
    )
    kpis = ws.table("underwriting_kpis")
    assert rows(kpis, "month", "gross_written_premium_usd", "incurred_loss_usd", "claim_count", "loss_ratio") == sorted([
        (date(2024, 1, 1), 100.0, 60.0, 1, 0.6),
        (date(2024, 3, 1), 0.0, 5.0, 1, 0.0),     # no premium amount: ratio 0
        (date(2024, 4, 1), 0.0, 0.0, 0, 0.0),     # unknown premium counts as 0
        (None, 50.0, 0.0, 0, 0.0),                # claims without a month meet nothing
    ], key=repr)
    assert one(kpis, month=date(2024, 1, 1))["combined_ratio"] == pytest.approx(0.7)


def test_360_marts_use_the_right_place(frames):
    ws = frames(
        geography=GEO, customers=CUSTOMERS, agents=[{"agent_id": "a1", "agent_name": "Bo", "channel": "Broker"}],
        policies=[policy("p1"), policy("p2", customer_id="nobody", agent_id="none", policy_status="Lapsed"), policy("p3", sum_insured_usd=0.0)],
        claims=[claim("1", "p1", 250.0), claim("2", "lost", 1.0), claim("3", "p3", 1.0)],
    )
    p360 = ws.table("policy_customer_360")
    assert len(p360.columns) == 29 and p360.count() == 3
    row = one(p360, policy_id="p1")
    assert (row["state_code"], row["customer_name"], row["agent_channel"], row["channel"]) == ("FL", "Ann", "Broker", "Direct")
    ghost = one(p360, policy_id="p2")
    assert (ghost["customer_id"], ghost["agent_id"], ghost["state_code"], ghost["policy_status"]) == (None, None, "FL", "Lapsed")
    c360 = ws.table("claim_360")
    assert len(c360.columns) == 30 and c360.count() == 3
    row = one(c360, claim_id="1")
    assert (row["state_code"], row["customer_type"], row["severity_pct_of_sum_insured"], row["report_lag_days"]) == ("CA", "Individual", 0.25, 12)
    lost = one(c360, claim_id="2")
    assert (lost["state_code"], lost["channel"], lost["severity_pct_of_sum_insured"]) == ("CA", None, None)
    assert one(c360, claim_id="3")["severity_pct_of_sum_insured"] is None


def test_segments_join_inner_and_left(frames, rows):
    ws = frames(
        geography=GEO, customers=CUSTOMERS,
        policies=[policy("p1"), policy("p2", product="Home"), policy("p3", channel=None), policy("p4", customer_id="nobody")],
        premiums=[premium("p1", 100.0), premium("p1", 50.0), premium("p3", 10.0), premium("p4", 70.0), premium("x", 5.0)],
        claims=[claim("1", "p1", 30.0), claim("2", "p2", 30.0, product="Home"), claim("3", "p3", 8.0), claim("4", "p4", 1.0)],
    )
    got = rows(ws.table("loss_ratio_by_segment"), "product", "state_code", "channel", "gross_premium_usd", "incurred_loss_usd", "claim_count")
    # p2 has claims but no premium, p4 no customer; p3's NULL channel matches no claims
    assert got == sorted([("Auto", "FL", "Direct", 150.0, 30.0, 1), ("Auto", "FL", None, 10.0, 0.0, 0)], key=repr)


def test_book_health_counts_active_policies_and_all_claims(frames):
    ws = frames(
        policies=[policy("p1"), policy("p2", annual_premium_usd=300.0), policy("p3", policy_status="Cancelled"), policy("p4", product="Home"),
                  policy("p5", product="Life", policy_status="Lapsed")],
        claims=[claim("1", "p3", 40.0, fraud_flag=True), claim("2", "p1", 60.0, catastrophe_code="C"), claim("3", "p5", 1.0, product="Life")],
    )
    book = ws.table("book_health")
    auto = one(book, product="Auto")
    assert (auto["active_policy_count"], auto["inforce_premium_usd"], auto["claim_count"]) == (2, 400.0, 2)
    assert (auto["claim_frequency_per_100"], auto["loss_ratio"], auto["avg_premium_per_policy"]) == (100.0, 0.25, 200.0)
    assert (auto["cat_claim_count"], auto["fraud_claim_count"], auto["avg_severity_usd"]) == (1, 1, 50.0)
    home = one(book, product="Home")
    assert (home["claim_count"], home["incurred_loss_usd"], home["avg_severity_usd"], home["loss_ratio"]) == (0, 0.0, 0.0, 0.0)
    assert book.filter("product = 'Life'").count() == 0


def test_solvency_is_nine_metrics_that_add_up(frames):
    ws = frames(
        asset_portfolio=[{"asset_id": "1", "market_value_usd": 1000.0}], premiums=[premium("p", 100.0)], claims=[claim("1", "p", 50.0)],
    )
    value = {r.metric: r.value_usd for r in ws.table("solvency_capital").collect()}
    assert len(value) == 9
    assert value["Underwriting Risk"] == pytest.approx(23.0)
    modules = ("Underwriting Risk", "Market Risk", "Counterparty Risk", "Operational Risk")
    assert value["SCR (Total)"] == pytest.approx(sum(value[m] for m in modules))
    assert value["Solvency Ratio"] == pytest.approx(350.0 / value["SCR (Total)"])


def test_solvency_of_an_empty_book(frames):
    value = {r.metric: r.value_usd for r in frames().table("solvency_capital").collect()}
    assert len(value) == 9 and value["Solvency Ratio"] == 0.0 and value["SCR (Total)"] is None


def test_alerts_and_catastrophes_against_states(frames, rows):
    ws = frames(
        geography=GEO,
        policies=[policy("p1"), policy("p2", geo_id="g1"), policy("p3", geo_id="gone")],
        noaa_alerts=[
            {"alert_id": "1", "area_desc": "Harris, TX; Dade, Florida"}, {"alert_id": "2", "area_desc": "Los Angeles, California"},
            {"alert_id": "3", "area_desc": "offshore"}, {"alert_id": "4"},
        ],
        catastrophe_events=[{"event_id": "e1", "event_type": "Flood", "title": "Flood"}, {"event_id": "e2", "event_type": "Meteor"}],
    )
    alerts = ws.table("event_risk_correlation")
    assert len(alerts.columns) == 10
    assert rows(alerts, "alert_id", "state_code", "exposed_tiv_usd", "exposed_policy_count") == [
        ("1", "FL", 1000.0, 1), ("1", "TX", 1000.0, 1), ("2", "CA", None, None),  # no exposure in CA
    ]
    pml = ws.table("cat_event_pml")
    assert rows(pml, "event_id", "state_code", "pml_estimate_usd") == [
        ("e1", "FL", 120.0), ("e1", "TX", 120.0), ("e2", "FL", None), ("e2", "TX", None),
    ]


def test_alerts_that_have_expired_can_be_left_out(frames, rows):
    alerts = [{"alert_id": str(k), "area_desc": "Texas", "expires_utc": e} for k, e in enumerate(["2024-01-01T00:00:00Z", "2024-01-03T00:00:00Z", None])]
    ws = frames(geography=GEO, policies=[policy("p", geo_id="g1")], noaa_alerts=alerts)
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert rows(gold.alert_exposure(ws, ws.table("noaa_alerts"), at), "alert_id") == [("1",), ("2",)]
    assert ws.table("event_risk_correlation").count() == 3


def test_worst_pml_is_the_head_of_the_whole_product(frames, monkeypatch):
    geo = [{"geo_id": f"g{k}", "state_code": f"S{k}", "state_name": f"State {k}"} for k in range(9)]
    ws = frames(
        geography=geo, policies=[policy(f"p{k}", geo_id=f"g{k % 9}", sum_insured_usd=float(100 + k % 4)) for k in range(30)],
        catastrophe_events=[{"event_id": f"e{k}", "event_type": t} for k, t in enumerate(["Flood", "Earthquake", "Odd", "Wildfire", "Other"] * 4)],
    )
    every = sorted(((-r.pml_estimate_usd, r.event_id, r.state_code) for r in ws.table("cat_event_pml").collect() if r.pml_estimate_usd is not None))
    products = []
    real = gold.with_every
    monkeypatch.setattr(gold, "with_every", lambda left, right: products.append(real(left, right)) or products[-1])
    for n in (1, 3, 7, 15):
        assert [(-r.pml_estimate_usd, r.event_id, r.state_code) for r in gold.worst_pml(ws, n).collect()] == every[:n]
        assert products[-1].count() <= 7 * n * n


@pytest.mark.parametrize("width", [1, 13])
def test_p95_is_exact_for_any_shuffle_width(spark, frames, width):
    rng = random.Random(width)
    amounts = [round(rng.choice((rng.random() * 100, rng.random() * 1e9, -5.0)), 2) for _ in range(777)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        ws = frames(claims=[claim(str(k), "p", a) for k, a in enumerate(amounts)] + [claim("x", "p", None)])
        assert one(ws.table("peril_loss_summary"), peril="Wind")["p95_severity_usd"] == sorted(amounts)[-(-777 * 95 // 100) - 1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_millions_are_not_rounded(spark, frames):
    usd = frames()
    eur = spark.createDataFrame([("XL", "R", "L", 0.004, 0.1234567, 1.0)] * 1000, "treaty_type string, reinsurer string, line_of_business string, limit_eur_m double, ceded_premium_eur_m double, cession_pct double")
    ws = Workspace(spark, lambda name: eur if name == "pc_reinsurance_treaties" else usd.bronze(name), as_of=date(2024, 6, 15))
    got = [r for r in library.QUERIES["sql_08_reinsurance_recoveries"](ws).collect() if r.source == "EUR_pc"]
    assert [(r.total_limit_musd, r.ceded_premium_musd) for r in got] == [(4.0, 123.5)]


def test_exposure_totals_equal_the_book(frames):
    ws = frames(geography=GEO, policies=[policy(f"p{i}", geo_id=f"g{1 + i % 3}", sum_insured_usd=float(i)) for i in range(20)])
    assert ws.table("exposure_accumulation").agg(F.sum("total_insured_value_usd")).first()[0] == sum(range(20))


def test_perils(frames):
    ws = frames(claims=[claim(str(i), "p", float(i), catastrophe_code="C" if i > 90 else None) for i in range(1, 101)])
    wind = one(ws.table("peril_loss_summary"), peril="Wind")
    assert (wind["claim_count"], wind["p95_severity_usd"], wind["cat_claim_count"], wind["distinct_lobs"]) == (100, 95.0, 10, 1)
    assert wind["cat_share_of_loss"] == pytest.approx(sum(range(91, 101)) / 5050)


def test_loss_triangle_by_hand(spark, rows):
    from pcmarts.workspace import Workspace

    cells = spark.createDataFrame(
        [(2022, 1, "P", 100.0, 5.0), (2022, 2, "P", 50.0, 4.0), (2022, 3, "P", 30.0, 0.0), (2023, 1, "P", 200.0, 6.0), (2023, 2, "P", 100.0, 3.0),
         (2024, 1, "P", 120.0, 9.0), (2024, 2, "P", 999.0, 0.0)],
        "accident_year int, development_period int, line_of_business string, incremental_paid_eur_m double, case_reserves_eur_m double",
    )
    ws = Workspace(spark, lambda name: cells, as_of=date(2024, 6, 15))
    got = {(r.accident_year, r.development_period): r for r in ws.table("loss_triangle").collect()}
    assert (2024, 2) not in got  # not known at the date
    f1, f2 = (150 + 300) / (100 + 200), 180 / 150
    assert got[2024, 1].ultimate_loss_eur_m == pytest.approx(120 * f1 * f2)
    assert got[2023, 2].cumulative_paid_eur_m == 300.0
    assert got[2023, 2].ultimate_loss_eur_m == pytest.approx(300 * f2)
    assert got[2023, 2].ibnr_eur_m == pytest.approx(300 * f2 - 300 - 3)
    assert got[2022, 3].ultimate_loss_eur_m == 180.0


def test_complete_development_tables_pass_through(spark):
    from pcmarts.workspace import Workspace

    cells = spark.createDataFrame([(2030, 1, "P", 7.0)], "accident_year int, development_period int, line_of_business string, ultimate_loss_eur_m double")
    ws = Workspace(spark, lambda name: cells, as_of=date(2024, 6, 15))
    assert ws.table("loss_triangle").count() == 1


def test_unprofitable_sublines(spark, rows):
    from pcmarts.workspace import Workspace

    ratios = spark.createDataFrame([("2024-Q1", "Personal", "Auto", 60.0, 45.0, 105.0), ("2024-Q1", "Personal", "Home", 60.0, 40.0, 100.0)],
                                   "reporting_quarter string, line_of_business string, sub_line string, loss_ratio_pct double, expense_ratio_pct double, combined_ratio_pct double")
    ws = Workspace(spark, lambda name: ratios, as_of=date(2024, 6, 15))
    assert rows(questions.unprofitable_sublines(ws), "sub_line") == [("Auto",)]
    auto = one(reports.versus_benchmark(ws), sub_line="Auto")
    assert (auto["benchmark_pct"], auto["delta_vs_benchmark_pts"], auto["benchmark_position"]) == (104.0, 1.0, "Worse than market")
    assert one(rules.combined_ratio_delta(ws), sub_line="Auto")["delta_pts"] == 6.0


def test_catalog_is_a_dag():
    order = build_order(list(CATALOG))
    assert sorted(order) == sorted(CATALOG)
    for i, name in enumerate(order):
        assert set(CATALOG[name].needs) <= set(order[:i])
    hit = downstream(["noaa_alerts", "catastrophe_events"])
    assert hit == ["noaa_alerts", "event_risk_correlation", "catastrophe_events", "cat_event_pml"] or set(hit) == {
        "noaa_alerts", "event_risk_correlation", "catastrophe_events", "cat_event_pml"}


def test_refresh_writes_and_reads_back(frames, rows, tmp_path):
    ws = frames(policies=[policy("p1")], claims=[claim("1", "p1", 40.0)])
    before = rows(ws.table("book_health"))
    ws.root = str(tmp_path)
    assert ws.refresh(["book_health"]) == ["dim_policy", "fact_claim", "book_health"]
    assert rows(ws.table("book_health")) == before
    again = frames()
    again.root = str(tmp_path)
    assert rows(again.attach(["book_health"]).table("book_health")) == before


def test_a_table_can_be_refreshed_again(frames, rows, tmp_path):
    ws = frames(claims=[claim("1", "p", 5.0)], policies=[policy("p"), policy(None)])
    ws.root = str(tmp_path)
    ws.refresh(["claims_summary", "dim_policy"])
    first = rows(ws.table("claims_summary"))
    reader = ws.table("book_health")
    ws.refresh(["fact_claim", "dim_policy"])
    assert rows(ws.table("claims_summary")) == first and reader.count() == 1
    counts = ws.spark.read.parquet(f"{tmp_path}/rule_counts").filter("table_name = 'dim_policy'").collect()
    assert len({r.run for r in counts}) == 2 and max(r.failed for r in counts) == 1


def test_a_failed_write_leaves_the_table_readable(spark, tmp_path):
    folder = f"{tmp_path}/t"
    publish(spark.range(3).toDF("n"), folder)
    with pytest.raises(Exception, match="DIVIDE|divide"):
        publish(spark.range(3).selectExpr("1 / (id - 1) as n"), folder)
    assert spark.read.parquet(current(spark, folder)).count() == 3
    for k in range(4):
        publish(spark.range(k).toDF("n"), folder)
    assert spark.read.parquet(current(spark, folder)).count() == 3
    assert len([d for d in os.listdir(folder) if d.startswith("version=") and os.path.exists(f"{folder}/{d}/_SUCCESS")]) == 2


def test_hourly_refresh_touches_only_the_event_marts(frames, rows, tmp_path):
    from pcmarts.workspace import EVENT_TABLES

    base = dict(geography=GEO, policies=[policy("p1")], catastrophe_events=[{"event_id": "e1", "event_type": "Flood"}])
    ws = frames(noaa_alerts=[{"alert_id": "1", "area_desc": "FL"}], **base)
    ws.root = str(tmp_path)
    ws.refresh(["event_risk_correlation", "cat_event_pml"])
    # next hour: another alert, and a policy change that must wait for the full refresh
    later = frames(noaa_alerts=[{"alert_id": "1", "area_desc": "FL"}, {"alert_id": "2", "area_desc": "Florida"}],
                   **(base | {"policies": [policy("p1", sum_insured_usd=5.0)]}))
    later.root = str(tmp_path)
    written = later.refresh(downstream(EVENT_TABLES), upstream=False)
    assert set(written) == {*EVENT_TABLES, "event_risk_correlation", "cat_event_pml"}
    assert rows(later.table("event_risk_correlation"), "alert_id", "exposed_tiv_usd") == [("1", 1000.0), ("2", 1000.0)]


def test_bucketed_tables_join_without_a_shuffle(spark, frames, rows, tmp_path):
    tables = dict(
        policies=[policy(f"p{i}") for i in range(20)], claims=[claim(str(i), f"p{i % 25}", float(i)) for i in range(40)], geography=GEO,
        customers=CUSTOMERS, premiums=[premium(f"p{i % 20}", 10.0 * i) for i in range(30)],
    )
    plain, bucketed = frames(**tables), frames(**tables)
    bucketed.root = str(tmp_path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        bucketed.refresh_bucketed(4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        claims, policies = (bucketed.table(t).select("policy_id") for t in ("fact_claim", "dim_policy"))
        assert "Exchange" not in claims.join(policies, "policy_id")._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for mart in ("claim_360", "loss_ratio_by_segment"):
            assert rows(bucketed.table(mart)) == rows(plain.table(mart))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        bucketed.drop_bucketed()
        assert not spark.catalog.listTables(pattern="pcmarts_*")


def test_bucketed_tables_are_replaced_behind_their_views(spark, frames, rows, tmp_path, monkeypatch):
    ws = frames(policies=[policy(f"p{i}") for i in range(20)], claims=[claim("1", "p1", 5.0)], geography=GEO, customers=CUSTOMERS)
    ws.root = str(tmp_path)
    names = ("dim_policy", "fact_claim")
    try:
        ws.refresh_bucketed(4, names)
        reader = ws.table("fact_claim").select("claim_id", "incurred_amount_usd")
        real = ws.bronze_reader
        ws.bronze_reader = lambda name: real(name).union(real(name).withColumn("claim_id", F.lit("2"))) if name == "claims" else real(name)
        ws._memo.clear()
        ws.refresh_bucketed(4, names)  # reads the inputs, not the tables that it replaces
        assert rows(ws.table("fact_claim"), "claim_id") == [("1",), ("2",)] == rows(spark.table("pcmarts_fact_claim"), "claim_id")
        assert rows(reader) == [("1", 5.0)]  # opened before, read after

        def broken(name):
            return real(name).withColumn("policy_id", F.raise_error(F.lit("gone"))) if name == "claims" else real(name)

        ws.bronze_reader = broken
        ws._memo.pop("bronze.claims")
        with pytest.raises(Exception, match="gone"):
            ws.refresh_bucketed(4, names)
        assert rows(ws.table("fact_claim"), "claim_id") == [("1",), ("2",)]  # as it was
        assert len(list((tmp_path / "silver").glob("*_bucketed/version=*"))) == 4
    finally:
        ws.drop_bucketed(names)


def test_staged_tables_go_when_their_table_is_written(spark, frames, tmp_path, monkeypatch):
    ws = frames(claims=[claim(str(i), "p", float(i)) for i in range(1, 101)])
    ws.root = str(tmp_path)
    folders = lambda: [f for fs in ws._staged.values() for f in fs if exists(spark, f)]
    ws.table("peril_loss_summary").collect()
    assert len(folders()) == 1
    ws.refresh(["peril_loss_summary"])
    assert len(folders()) == 1 and ws.table("peril_loss_summary").first().p95_severity_usd == 95.0
    ws.close()
    assert folders() == [] and ws.table("peril_loss_summary").first().p95_severity_usd == 95.0
