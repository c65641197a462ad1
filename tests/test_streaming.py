"""Streaming results equal their batch twins however the rows are cut into batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions.ordered import prior_moments
from riskweave.operators import detectors as batch
from riskweave.streaming import detectors, messages

SCHEMA = "transaction_id bigint, customer_id string, transaction_date timestamp, amount double, location_country string, location_city string"


def rows_of(ts, n=240, seed=0):
    rnd = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"c{rnd.randrange(4)}", ts(i * 120 + rnd.random() * 100), float(rnd.choice([10, 11, 12, 900])),
             rnd.choice(["US", "CN"]), "X") for i in range(n)]


def feed(spark, tmp_path, parts, run):
    """Append each part to the source and drain the stream after it."""
    source = str(tmp_path / "in")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = run(spark.readStream.schema(SCHEMA).parquet(source))
        query.awaitTermination()
        assert query.exception() is None


def shuffled_parts(ts):
    """Three feeds; rows change places within a few minutes, less than the delay."""
    rows = rows_of(ts)
    rnd = random.Random(9)
    jittered = sorted(rows, key=lambda r: r[2].timestamp() + rnd.uniform(0, 1200))
    return rows, [jittered[:80], jittered[80:81], jittered[81:]]


@pytest.mark.parametrize("make,twin", [
    (detectors.geographic_detector, lambda df: batch.geographic(df).select("transaction_id")),
    (detectors.statistical_detector, lambda df: detectors._score_moments(df, None).select("transaction_id"))])
def test_event_time_detector_equals_batch(spark, tmp_path, ts, make, twin):
    """Each feed is a start of its own on the same checkpoint, so the state outlives its query."""
    rows, parts = shuffled_parts(ts)
    detector, mark, out = make(1800), str(tmp_path / "mark"), str(tmp_path / "out")
    feed(spark, tmp_path, parts, lambda df: messages.write_files(detector.alerts(df), out, mark, (), every=None))
    last = max(r[2] for r in rows)
    whole = spark.createDataFrame(rows, SCHEMA)
    due = F.col("transaction_date") <= F.lit(last) - F.expr("INTERVAL 1800 SECONDS")
    want = sorted(r[0] for r in twin(whole).join(whole.where(due).select("transaction_id"), "transaction_id").collect())
    given = spark.read.parquet(out)
    assert sorted(r["transaction_id"] for r in given.collect()) == want and want
    rest = detector.rest(spark, mark)
    assert rest.columns == given.columns
    assert sorted(r["transaction_id"] for r in given.unionByName(rest).collect()) == sorted(r[0] for r in twin(whole).collect())
    waiting = spark.read.format("statestore").load(mark).select(F.sum(F.size("value.groupState._at"))).first()[0]
    assert waiting == whole.where(~due).count()  # what the watermark has passed has left the state


def test_ties_nulls_and_late_rows_of_keyed_state(spark, tmp_path, ts):
    detector, mark, out = detectors.statistical_detector(3600), str(tmp_path / "mark"), str(tmp_path / "out")
    early = [(i, None if i % 2 else "c", ts(i), float(10 + i % 3), "US", "X") for i in range(40)]
    tied = [(100 + i, "c", ts(50), 500.0, "US", "X") for i in range(3)] + [(200, "c", ts(60), None, "US", "X"), (201, "c", None, 900.0, "US", "X")]
    later = [(300, "c", ts(99_999), 1.0, "US", "X"), (301, "d", ts(99_999), 1.0, "US", "X")]
    late = [(400, "c", ts(55), 9000.0, "US", "X"), (401, "d", ts(99_990), 1.0, "US", "X")]
    feed(spark, tmp_path, [early + tied, later, late], lambda df: messages.write_files(detector.alerts(df), out, mark, (), every=None))
    got = {r.transaction_id: r for r in spark.read.parquet(out).collect() if r.transaction_id >= 100}
    assert set(got) == {100, 101, 102} and len({r.z_score for r in got.values()}) == 1  # none counts for another of its instant
    twin = {r.transaction_id: r.z_score for r in detectors._score_moments(spark.createDataFrame(early + tied, SCHEMA).where("customer_id = 'c' AND transaction_date IS NOT NULL"), None).collect()}
    assert {i: r.z_score for i, r in got.items()} == pytest.approx({i: twin[i] for i in got}, rel=1e-9)


def test_late_rows_are_dropped(spark, tmp_path, ts):
    detector = detectors.geographic_detector(3600)
    on_time = [(1, "c", ts(0), 1.0, "US", "X"), (2, "c", ts(9000), 1.0, "US", "X")]
    late = [(3, "c", ts(60), 1.0, "CN", "X"), (4, "c", ts(99999), 1.0, "US", "X")]
    feed(spark, tmp_path, [on_time, late], lambda df: messages.write_files(detector.alerts(df), str(tmp_path / "out"), str(tmp_path / "mark"), (), every=None))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 0 and detector.rest(spark, str(tmp_path / "mark")).count() == 0


def test_engine_drops_late_rows_and_counts_them(spark, tmp_path, ts):
    dropped = []

    def run(df):
        query = messages.write_files(detectors.within_watermark(df, "30 minutes").select("transaction_id"), str(tmp_path / "out"), str(tmp_path / "mark"), (), every=None)
        query.awaitTermination()
        dropped.append(detectors.late_rows(query))
        return query
    feed(spark, tmp_path, [[(1, "c", ts(9000), 1.0, "US", "X")], [(2, "c", ts(0), 1.0, "US", "X"), (3, "c", ts(9000), 1.0, "US", "X"), (1, "c", ts(9000), 1.0, "US", "X")]], run)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 1, 3]
    assert dropped == [0, 1]


def test_count_windows_over_batches(spark, tmp_path, ts):
    rows = rows_of(ts, 95)
    def joined(name):
        return F.sort_array(F.flatten(F.collect_list(name)))
    windows = detectors.CountWindows(
        str(tmp_path / "state"), str(tmp_path / "out"), 10, {"ids": F.sort_array(F.collect_list("transaction_id")), "n": F.count("*")}, {"ids": joined})
    feed(spark, tmp_path, [rows[:37], rows[37:40], rows[40:]], lambda df: messages.write_batches(df, windows, str(tmp_path / "mark"), every=None))

    def found(windows_now):
        return {r["window_no"]: r["ids"] for r in windows_now.collect() if r["n"] == len(r["ids"])}
    assert found(windows.closed(spark)) == {i: list(range(i * 10, i * 10 + 10)) for i in range(9)}
    assert found(windows.every(spark))[9] == list(range(90, 95))
    twin = detectors.count_windows(spark.createDataFrame(rows, SCHEMA), 10, windows.measures)
    assert found(twin) == found(windows.every(spark))
    last = spark.createDataFrame(rows[40:], SCHEMA)  # the last batch comes again after a failure
    before = found(windows.every(spark))
    windows(last, 2)
    assert found(windows.every(spark)) == before
    partial = spark.read.parquet(windows.output)
    assert partial.count() == 4 + 1 + 6  # one row for each window a batch touches, and no rows of the stream


def test_velocity_windows_equal_batch(spark, tmp_path, ts):
    rows, parts = shuffled_parts(ts)
    feed(spark, tmp_path, parts, lambda df: messages.write_files(detectors.velocity_windows(df), str(tmp_path / "out"), str(tmp_path / "mark"), (), every=None))
    got = {(r["customer_id"], r["window_start"], r["transaction_count"], r["risk_score"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    whole = spark.createDataFrame(rows, SCHEMA)
    twin = whole.groupBy(F.window("transaction_date", "1 hour", "10 minutes"), "customer_id").agg(F.count("*").alias("n")).where("n >= 3")
    due = F.col("window.end") <= F.lit(max(r[2] for r in rows)) - F.expr("INTERVAL 30 MINUTES")
    assert got == {(r["customer_id"], r["window"]["start"], r["n"], 30.0 if r["n"] >= 5 else 20.0) for r in twin.where(due).collect()}


def test_decode_and_encode(spark):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("a INT, b STRING")
    df = spark.createDataFrame([(b'{"a": 1, "b": "x"}',), (b"junk",)], "value binary")
    assert [tuple(r) for r in messages.decode(df, schema).collect()] == [(1, "x"), (None, None)]
    again = messages.decode(messages.encode(spark.createDataFrame([(1, "x")], "a int, b string")), schema)
    assert [tuple(r) for r in again.collect()] == [(1, "x")]


def test_alert_levels(spark):
    df = spark.createDataFrame([(30.0,), (25.0,), (20.0,), (15.0,), (10.0,)], "s double")
    assert [r[0] for r in df.select(detectors.alert_level(F.col("s"))).collect()] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_steps_match_prior_moments(spark, ts):
    rows = spark.createDataFrame(rows_of(ts, 60), SCHEMA)
    want = {r["transaction_id"]: r["z_score"] for r in detectors._score_moments(rows.where("customer_id = 'hot'"), None).collect()}
    mine = [(round(r[2].timestamp() * 1e6), r[0], r[3]) for r in rows_of(ts, 60) if r[1] == "hot"]
    summary, first = detectors._step_moments(None, mine[:7])
    _, second = detectors._step_moments(summary, mine[7:])
    assert {name: round(abs(z - want[name]), 9) for _, name, _, z in first + second} == dict.fromkeys(want, 0.0)


def test_python_is_called_for_buckets_of_customers(spark):
    """One state holds many customers; each is scored from its own rows."""
    class State:
        value, exists, at = None, False, 0
        get = property(lambda self: self.value)

        def getCurrentWatermarkMs(self):
            return self.at

        def update(self, value):
            self.value, self.exists = value, True

        def setTimeoutTimestamp(self, at):
            self.timeout = at

    visit, state = detectors.geographic_detector()._visit(), State()
    rows = pd.DataFrame([("a", 1_000_000, 1, "US"), (None, 2_000_000, 2, "US"), ("b", 3_000_000, 3, "GB"), ("a", 9_000_000, 4, "CN"), (None, 8_000_000, 5, "US"), ("b", 7_000_000, 6, "RU")],
                        columns=["_who", "_at", "_id", "location_country"])
    assert list(visit((0,), iter([rows]), state)) == [] and state.timeout == 1000
    state.at = 8000
    found = [x for part in visit((0,), iter([]), state) for x in part.itertuples(index=False, name=None)]
    assert found == [("b", 7_000_000, 6, "GB", "RU", 4 / 3600)] and state.timeout == 9000
    state.at = 9000
    found = [x for part in visit((0,), iter([]), state) for x in part.itertuples(index=False, name=None)]
    assert found == [("a", 9_000_000, 4, "US", "CN", 8 / 3600)]
