from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskweave.operators import normalize

NOW = "2024-02-01 00:00:00"
CARD = {"User": "12345", "Card": "9876", "Year": "2024", "Month": "3", "Day": "15", "Time": "14:30:00", "Amount": "$125.50",
        "Merchant Name": "Shop", "Merchant City": "New York", "Merchant State": "NY", "Zip": "10001", "MCC": "5411", "Is Fraud?": "No"}


def columns(spark, *records):
    names = list(records[0])
    return spark.createDataFrame([[r.get(n) for n in names] for r in records], ", ".join(f"`{n}` string" for n in names))


def maps(spark, *records):
    return spark.createDataFrame([(r,) for r in records], "record map<string,string>")


@pytest.mark.parametrize("make", [columns, maps])
def test_card_layout(spark, make):
    r = normalize.accepted(normalize.normalise(make(spark, CARD), "CSV", NOW)).first()
    assert (r["transaction_id"], r["customer_id"], r["amount"], r["location"]) == ("12345", "9876", Decimal("125.50"), "New York, NY 10001")
    assert r["transaction_date"] == datetime(2024, 3, 15, 14, 30) and r["fraud_flag"] is False and r["date_fallback"] is False
    assert (r["merchant_category"], r["source_system"], r["status"]) == ("5411", "CSV", "PENDING")


def test_first_present_key_wins_even_when_empty(spark):
    out = normalize.normalise(maps(spark, {"transaction_id": "", "id": "7", "amount": "1"}, {"id": "7", "amount": None, "Amount": "2"}), "JSON", NOW).collect()
    assert [r["reject_reason"] for r in out] == ["MISSING_ID", "INVALID_AMOUNT"]


def test_rejects(spark):
    base = {"transaction_id": "1", "amount": "5", "transaction_date": "2024-01-15"}
    rows = columns(spark, base, {**base, "transaction_id": ""}, {**base, "transaction_id": None}, {**base, "amount": "not_a_number"}, {**base, "amount": " "}, {**base, "amount": "1-2"})
    out = normalize.normalise(rows, "CSV", NOW)
    assert normalize.accepted(out).count() == 1
    assert sorted(r["reject_reason"] for r in normalize.rejected(out).collect()) == ["INVALID_AMOUNT"] * 3 + ["MISSING_ID"] * 2


@pytest.mark.parametrize("text,want", [("$1,234.50", "1234.50"), ("USD -7", "-7.00"), ("1.2.3", None), ("", None), ("  ", None), ("abc", None), (None, None)])
def test_amounts(spark, text, want):
    got = spark.createDataFrame([(text,)], "a string").select(normalize.parse_amount(F.col("a"))).first()[0]
    assert got == (Decimal(want) if want else None)


@pytest.mark.parametrize("text,want", [
    ("2024-01-15T10:30:00", datetime(2024, 1, 15, 10, 30)), ("2024-01-15T10:30:00.25", datetime(2024, 1, 15, 10, 30, 0, 250000)),
    ("2024-01-15 10:30:00", datetime(2024, 1, 15, 10, 30)), ("2024-01-15", datetime(2024, 1, 15)), ("03/04/2024", datetime(2024, 3, 4)),
    ("25/12/2024", datetime(2024, 12, 25)), ("2024/01/15", datetime(2024, 1, 15)), ("2024-01-15T10:30:00Z", None), ("junk", None), ("02/30/2024", None)])
def test_dates(spark, text, want):
    df = columns(spark, {"transaction_date": text})
    assert df.select(normalize.parse_date(F.col("transaction_date"), normalize.column_lookup(df))).first()[0] == want


def test_date_parts(spark):
    def parsed(**parts):
        df = columns(spark, {"Year": "2024", **parts})
        return df.select(normalize.parse_date(F.col("Year"), normalize.column_lookup(df))).first()[0]
    assert parsed(Month="3", Day="5") == datetime(2024, 3, 5)
    assert parsed(Month="3", Day="5", Time="") == datetime(2024, 3, 5)
    assert parsed(Month="3", Day="5", Time="14:30") is None
    assert parsed(Month="x", Day="5") is None
    assert parsed() is None


def test_unparsed_date_takes_ingest_time(spark):
    r = normalize.normalise(columns(spark, {"id": "1", "amount": "1", "date": "soon"}), "CSV", NOW).first()
    assert r["transaction_date"] == datetime(2024, 2, 1) and r["date_fallback"]


@pytest.mark.parametrize("text,want", [("Yes", True), ("true", True), ("1", True), (" NO ", False), ("0", False), ("'Yes'", True), ("unknown", False), ("maybe", None), ("", None), (None, None)])
def test_fraud_words(spark, text, want):
    assert spark.createDataFrame([(text,)], "f string").select(normalize.parse_fraud_flag(F.col("f"))).first()[0] is want


def test_fraud_aliases(spark):
    rows = maps(spark, {"id": "1", "amount": "1", "Is Fraud?": "Yes"}, {"id": "2", "amount": "1", "is_fraud": "true"}, {"id": "3", "amount": "1", "fraud_flag": "1"}, {"id": "4", "amount": "1"})
    assert [r["fraud_flag"] for r in normalize.normalise(rows, "JSON", NOW).orderBy("transaction_id").collect()] == [True, True, True, False]


@pytest.mark.parametrize("parts,want", [(("A", "B", "C"), "A, B C"), (("A", "", "C"), "A C"), (("", "B", None), "B"), (("", None, "9"), "9"), (("", "", ""), None)])
def test_location(spark, parts, want):
    df = spark.createDataFrame([parts], "c string, s string, z string")
    assert df.select(normalize.location(F.col("c"), F.col("s"), F.col("z"))).first()[0] == want


def test_nested_layout_is_rejected_unless_flattened(spark):
    item = ("J1", "ACC1", "2024-11-01T08:30:00Z", (156.75, "USD"), ("Shop", "ONLINE"), ("San Francisco",))
    nested = spark.createDataFrame([item], "txnId string, accountId string, timestamp string, transactionAmount struct<value:double,currencyCode:string>, "
                                           "merchant struct<name:string,category:string>, location struct<city:string>")
    assert normalize.accepted(normalize.normalise(nested.select("txnId", "accountId", "timestamp"), "JSON", NOW)).count() == 0
    r = normalize.accepted(normalize.normalise(normalize.flatten_nested(nested), "JSON", NOW)).first()
    assert (r["transaction_id"], r["amount"], r["location"]) == ("J1", Decimal("156.75"), "San Francisco")
    assert r["transaction_date"] == datetime(2024, 11, 1, 8, 30)


def test_flags_on_nulls(spark):
    df = spark.createDataFrame([(None, None, None)], "amount double, location_country string, transaction_date timestamp")
    r = normalize.transaction_flags(df, "US").first()
    assert (r["is_high_value"], r["is_international"], r["is_unusual_hours"]) == (False, False, False)


def test_domain_checks_let_nulls_pass(spark):
    alerts = spark.createDataFrame([(50.0, "LOW", "PENDING"), (101.0, "low", "OPEN"), (None, None, None)], "fraud_score double, severity string, status string")
    customers = spark.createDataFrame([("HIGH",), ("NONE",), (None,)], "risk_level string")
    imports = spark.createDataFrame([("DONE",), ("PARTIAL",)], "status string")
    got = {r["rule"]: r["violations"] for r in normalize.domain_violations(alerts, customers, imports).collect()}
    assert got == {"alert_score": 1, "alert_level": 1, "alert_status": 1, "customer_level": 1, "import_status": 1}


def test_parts_of_a_date_have_two_digits(spark):
    rows = [("2024", "3", "5"), ("2024", "100", "1"), ("2024", "1", "123"), ("2024", "12", "31")]
    df = spark.createDataFrame(rows, "Year string, Month string, Day string")
    get = {"year": F.col("Year"), "month": F.col("Month"), "day": F.col("Day"), "time": F.lit("")}.__getitem__
    got = [r[0] for r in df.select(normalize.parse_date(F.lit(None).cast("string"), get)).collect()]
    assert [g and (g.month, g.day) for g in got] == [(3, 5), None, None, (12, 31)]
