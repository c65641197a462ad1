from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.operators import detectors, history, hybrid

SCHEMA = ("transaction_id string, customer_id string, transaction_date timestamp, amount double, currency string, merchant_name string, "
          "merchant_category string, transaction_type string, location_country string, location_city string, is_online boolean")


def tx(spark, rows):
    full = [(i, c, t, a, "USD", m, "GENERAL", "PURCHASE", country, city, False) for i, c, t, a, m, country, city in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture()
def five(spark, ts):
    return tx(spark, [
        ("TXN001", "CUST001", ts(-3600), 1000.0, "Merchant A", "US", "New York"),
        ("TXN002", "CUST001", ts(-3600), 2000.0, "Merchant B", "US", "New York"),
        ("TXN003", "CUST001", ts(0), 8000.0, "Merchant C", "CN", "Shanghai"),
        ("TXN004", "CUST002", ts(0), 500.0, "Merchant A", "US", "Boston"),
        ("TXN005", "CUST003", ts(-8.5 * 3600), 15000.0, "Unknown", "RU", "Moscow")])


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_five_row_fixture(five):
    assert ids(detectors.high_value(five)) == ["TXN003", "TXN005"]
    assert ids(detectors.velocity(five)) == ["TXN003"]
    assert ids(detectors.statistical(five)) == []
    assert ids(detectors.unusual_time(five)) == ["TXN005"]
    assert ids(detectors.geographic(five)) == ["TXN003"]
    assert detectors.customer_profiles(five).count() == 3
    report = {r["transaction_id"]: r for r in detectors.fraud_report(five).collect()}
    assert report["TXN003"]["total_risk_score"] == 65.0 and report["TXN003"]["risk_level"] == "HIGH"
    assert report["TXN003"]["risk_factors"] == ["GEOGRAPHIC_ANOMALY", "HIGH_VALUE", "HIGH_VELOCITY"]
    assert report["TXN005"]["risk_level"] == "MEDIUM"


def test_velocity_tiers_peers_and_both_ends(spark, ts):
    rows = [(f"T{i}", "C", ts(i * 600), 10.0, "M", "US", "X") for i in range(7)]  # 0..3600 s: the end is inside
    scores = {r["transaction_id"]: (r["transaction_count_1h"], r["risk_score"]) for r in detectors.velocity(tx(spark, rows)).collect()}
    assert scores["T2"] == (3, 20.0) and scores["T4"] == (5, 30.0) and scores["T6"] == (7, 30.0) and "T1" not in scores
    peers = tx(spark, [(f"P{i}", "C", ts(0.1 * i), 10.0, "M", "US", "X") for i in range(3)])
    assert {r["transaction_count_1h"] for r in detectors.velocity(peers).collect()} == {3}


def test_repeated_rows_add_up_in_the_report(spark, ts):
    row = ("T1", "C", ts(0), 9000.0, "M", "US", "X")
    out = detectors.fraud_report(tx(spark, [row, row])).collect()
    assert len(out) == 1 and out[0]["total_risk_score"] == 50.0 and out[0]["risk_factors"] == ["HIGH_VALUE"]


def test_geographic_ignores_null_country_and_long_gaps(spark, ts):
    rows = [("A", "C", ts(0), 1.0, "M", "US", "X"), ("B", "C", ts(60), 1.0, "M", None, "X"), ("D", "C", ts(120), 1.0, "M", "CN", "X"),
            ("E", "C", ts(120 + 6 * 3600), 1.0, "M", "US", "X"), ("F", "C", ts(119 + 12 * 3600), 1.0, "M", "CN", "X")]
    assert ids(detectors.geographic(tx(spark, rows))) == ["F"]


def test_statistical_scores(spark, ts):
    rows = [(f"T{i}", "C", ts(i * 90000), 100.0 + i % 2, "M", "US", "X") for i in range(20)] + [("OUT", "C", ts(-1), 5000.0, "M", "US", "X")]
    out = detectors.statistical(tx(spark, rows)).collect()
    assert [(r["transaction_id"], r["risk_score"]) for r in out] == [("OUT", 25.0)]


def scored(spark, rows):
    return {r["transaction_id"]: r for r in history.scored_against_history(tx(spark, rows)).collect()}


def test_history_scorer_cases(spark, ts):
    day = timedelta(days=1)
    alone = scored(spark, [("A", "C1", ts(9000), 6000.0, "M", "US", "X")])["A"]
    assert (alone["score"], alone["rules"], alone["risk_level"]) == (35.0, ["HIGH_VALUE_TRANSACTION", "NEW_MERCHANT"], "LOW")
    past = [(f"H{i}", "C2", ts(0) - day * (i + 1), v, "Shop", "US", "X") for i, v in enumerate((45.0, 50.0, 55.0))]
    big = scored(spark, [*past, ("BIG", "C2", ts(-8.5 * 3600), 10000.0, "Other", "US", "X")])["BIG"]
    assert (big["score"], big["risk_level"]) == (75.0, "HIGH")
    assert big["rules"] == ["HIGH_VALUE_TRANSACTION", "UNUSUAL_TIME", "AMOUNT_DEVIATION", "NEW_MERCHANT"]


def test_history_velocity_edges(spark, ts):
    two_hours = 7200
    rows = [("EXACT", "C", ts(0), 1.0, "M", "US", "X"), ("IN1", "C", ts(0.000001), 1.0, "M", "US", "X"), ("IN2", "C", ts(900), 1.0, "M", "US", "X"),
            ("IN3", "C", ts(1800), 1.0, "M", "US", "X"), ("PEER", "C", ts(two_hours), 1.0, "M", "US", "X"), ("NOW", "C", ts(two_hours), 1.0, "M", "US", "X")]
    got = {r["transaction_id"]: (r["recent"], r["velocity_score"]) for r in history.with_velocity(tx(spark, rows)).collect()}
    assert got["NOW"] == (3, 20.0) and got["PEER"] == (3, 20.0) and got["EXACT"] == (0, 0.0)
    many = [(f"T{i}", "C", ts(i), 1.0, "M", "US", "X") for i in range(6)]
    assert {r["transaction_id"]: r["velocity_score"] for r in history.with_velocity(tx(spark, many)).collect()}["T5"] == 30.0


def test_new_merchant_null_and_ties(spark, ts):
    rows = [("A", "C", ts(0), 1.0, None, "US", "X"), ("B", "C", ts(0), 1.0, None, "US", "X"), ("D", "C", ts(5), 1.0, None, "US", "X"), ("E", "C", ts(6), 1.0, "M", "US", "X")]
    got = {r["transaction_id"]: r["new_merchant"] for r in history.with_new_merchant(tx(spark, rows)).collect()}
    assert got == {"A": True, "B": True, "D": False, "E": True}


def test_equal_history_amounts_have_no_deviation(spark, ts):
    rows = [(f"T{i}", "C", ts(i), 0.1, "M", "US", "X") for i in range(7)] + [("BIG", "C", ts(60), 999.0, "M", "US", "X")]
    got = {r["transaction_id"]: r for r in history.with_amount_deviation(tx(spark, rows)).collect()}
    assert got["BIG"]["z_score"] == 0.0 and got["BIG"]["deviation_score"] == 0.0


def test_rule_score_and_blend(spark, ts):
    busy = [(f"B{i:02d}", "C", ts(i), 1.0, "M", "US", "X") for i in range(11)]
    rows = [*busy, ("N", "D", ts(-9 * 3600), 9000.0, "Unknown Shop", "US", "X"), ("T", "E", ts(0), 1.0, "latest", "US", "X"), ("Z", "F", ts(0), 1.0, None, "US", "X")]
    scores = {r["transaction_id"]: r["rule_score"] for r in hybrid.rule_scored(tx(spark, rows)).collect()}
    assert scores["B10"] == 0.3 and scores["B09"] == 0.0 and scores["N"] == 0.7 and scores["T"] == 0.2 and scores["Z"] == 0.2
    external = spark.createDataFrame([("N", 0.9), ("T", 0.9)], "transaction_id string, external_score double")
    out = {r["transaction_id"]: r for r in hybrid.blended(hybrid.rule_scored(tx(spark, rows)), external).collect()}
    assert out["N"]["final_score"] == 0.78 and out["N"]["method"] == "HYBRID_RULE_LLM"
    assert out["T"]["final_score"] == 0.2 and out["T"]["method"] == "RULE_BASED"
    evidence = spark.createDataFrame([("N", 2, "b"), ("N", 1, "a")], "transaction_id string, position int, source string")
    alerts = {r["transaction_id"]: r for r in hybrid.alert_rows(hybrid.blended(hybrid.rule_scored(tx(spark, rows)), external), evidence).collect()}
    assert alerts["N"]["rules_triggered"] == ["RULE_BASED_DETECTION", "LLM_ENHANCED_ANALYSIS", "DOCUMENT_EVIDENCE: a", "DOCUMENT_EVIDENCE: b"]
    assert alerts["N"]["risk_level"] == "HIGH" and alerts["T"]["rules_triggered"] is None


def test_upsert_changes_only_score_and_description(spark):
    schema = "transaction_id string, status string, fraud_score double, description string"
    out = hybrid.upsert_alerts(
        spark.createDataFrame([("A", "CONFIRMED", 10.0, "old"), ("B", "PENDING", 20.0, "keep")], schema),
        spark.createDataFrame([("A", "PENDING", 99.0, None), ("C", "PENDING", 5.0, "new")], schema))
    got = {r["transaction_id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {"A": ("CONFIRMED", 99.0, None), "B": ("PENDING", 20.0, "keep"), "C": ("PENDING", 5.0, "new")}


def test_profile_score(spark, ts):
    rows = [(f"T{i}", "C", ts(i), 1.0, "M", c, "X") for i, c in enumerate(("US", "CN", "RU", "GB", "BR", "DE"))] + [("BIG", "C", ts(9), 50000.0, "M", "US", "X")]
    assert detectors.customer_profiles(tx(spark, rows)).first()["customer_risk_score"] == 45.0


def test_batch_summary(spark, ts):
    rows = [("A", "C1", ts(0), 100.0, "M", "US", "X"), ("B", "C1", ts(-10 * 3600), 200.0, "M", "US", "X"), ("D", "C2", ts(0), 150.0, "M", "US", "X")]
    r = history.batch_summary(tx(spark, rows)).first()
    assert (r["total_transactions"], r["total_customers"], r["total_volume"], r["night_transactions"]) == (3, 2, 450.0, 1)
    assert history.top_merchants(tx(spark, rows)).select(F.max("transactions")).first()[0] == 3
