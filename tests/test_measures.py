import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import hybrid, monitoring, oplog, quality, relational, statistics
from riskweave.plans.registry import SQL  # noqa: F401 - keeps the registry importable on its own


def series(spark, values, ts):
    return spark.createDataFrame([(i, ts(i * 45), float(v)) for i, v in enumerate(values)], "id int, ts timestamp, v double").repartition(3)


def test_describe(spark, ts):
    r = statistics.describe(series(spark, [4, 1, 3, 2], ts), "v").first()
    assert (r["count"], r["sum"], r["mean"], r["median"], r["min"], r["max"], r["variance"]) == (4, 10.0, 2.5, 2.5, 1.0, 4.0, 1.25)
    empty = statistics.describe(series(spark, [1], ts).where("v > 5"), "v").first()
    assert (empty["count"], empty["sum"], empty["mean"], empty["median"], empty["std_dev"], empty["variance"]) == (0, 0.0, 0.0, 0.0, 0.0, None)


def test_nearest_rank_percentiles(spark, ts):
    got = {r["percentile"]: r["value"] for r in statistics.percentiles(series(spark, range(1, 11), ts), "v", (0, 25, 50, 95, 100)).collect()}
    assert got == {0: 1.0, 25: 3.0, 50: 5.0, 95: 10.0, 100: 10.0}
    sketch = statistics.approximate_percentiles(series(spark, range(1, 11), ts), "v", (50,)).first()["values"]
    assert sketch[0] in (5.0, 6.0)


def test_outliers(spark, ts):
    assert [r["v"] for r in statistics.outliers(series(spark, [1, 2, 3, 4, 100], ts), "v").collect()] == [100.0]
    assert statistics.outliers(series(spark, [1, 2, 100], ts), "v").count() == 0


@pytest.mark.parametrize("window,block", [(3, 4), (4, 4), (9, 2), (1, 5)])
def test_moving_average_over_block_edges(spark, ts, window, block):
    values = [(i * 37) % 11 for i in range(25)]
    got = {r["id"]: r["moving_average"] for r in statistics.moving_average(series(spark, values, ts), "ts", "id", "v", window, block).collect()}
    assert got == {i: pytest.approx(sum(values[i - window + 1:i + 1]) / window) for i in range(window - 1, 25)}
    assert statistics.moving_average(series(spark, [1, 2], ts), "ts", "id", "v", 3).count() == 0


@pytest.mark.parametrize("values,want", [([1, 2, 3], "INCREASING"), ([3, 2, 1], "DECREASING"), ([100, 101, 102], "STABLE"), ([5], "INSUFFICIENT_DATA"), ([], "INSUFFICIENT_DATA"), ([-10, -10, -10], "INCREASING")])
def test_trend(spark, ts, values, want):
    df = series(spark, values, ts) if values else series(spark, [1], ts).where("v < 0")
    assert statistics.trend(df, "ts", "id", "v").first()["trend"] == want


def test_correlation(spark):
    def corr(rows):
        return statistics.correlation(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()[0]
    assert corr([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == pytest.approx(1.0)
    assert corr([(1.0, 2.0), (1.0, 4.0)]) == 0.0


def test_quality_score(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None)], "n int, s string")
    expected = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.StringType())])
    r = quality.quality_score(df, expected).first()
    assert (r["total_rows"], r["duplicates"], r["schema_issues"], r["quality_score"]) == (4, 1, 2, 100 - 10 - 20 - 10)
    assert quality.schema_issues(df, expected) == ["Type mismatch for n: expected bigint, got int", "Missing column: x"]


def test_failing_batches_are_skipped(spark):
    def fn(batch):
        if (batch["id"] == 3).any():
            raise ValueError("bad batch")
        return batch
    df = spark.range(0, 8, 1, 8)
    assert sorted(r["id"] for r in quality.apply_in_batches(df, fn, "id bigint").collect()) == [0, 1, 2, 4, 5, 6, 7]


def test_ks(spark):
    same = spark.createDataFrame([(float(i % 7),) for i in range(70)], "x double")
    moved = spark.createDataFrame([(float(i % 7) + 3,) for i in range(70)], "x double")
    t = monitoring.data_drift(same, same, ["x"]).first()
    assert t["statistic"] == 0.0 and t["p_value"] == 1.0 and not t["drifted"]
    t = monitoring.data_drift(same, moved, ["x"]).first()
    assert t["statistic"] == pytest.approx(3 / 7) and t["drifted"]
    x = math.sqrt(35) * 3 / 7
    assert t["p_value"] == pytest.approx(2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 20)), abs=1e-12)


def test_kolmogorov_series_meet(spark):
    """Both forms of the series give the textbook values."""
    df = spark.createDataFrame([(0.5,), (0.8276,), (1.0,), (1.1799,), (1.1801,), (1.3581,), (1.6276,)], "x double")
    two = F.lit(2.0)  # n = m = 2 makes the scale sqrt(n m / (n + m)) = 1
    got = [r[0] for r in df.select(monitoring._kolmogorov_tail(F.col("x"), two, two)).collect()]
    assert got == pytest.approx([0.963945, 0.5, 0.269999, 0.1236, 0.1235, 0.05, 0.01], abs=2e-4)


def predictions(spark, ts, pairs):
    return spark.createDataFrame([(i, ts(i), 0.1, t, p) for i, (t, p) in enumerate(pairs)], "prediction_id int, logged_at timestamp, latency double, ground_truth int, prediction int")


def test_accuracy_drift(spark, ts):
    df = predictions(spark, ts, [(1, 1)] * 10 + [(None, 1)] * 3 + [(1, 0)] * 10)
    r = monitoring.accuracy_drift(df, 10).first()
    assert (r["judged"], r["baseline_accuracy"], r["recent_accuracy"], r["drift_detected"]) == (20, 1.0, 0.0, True)
    short = monitoring.accuracy_drift(df, 11).first()
    assert (short["drift_detected"], short["reason"]) == (False, "Insufficient data")


def test_realtime_metrics_skip_missing_truth(spark, ts):
    r = monitoring.realtime_metrics(predictions(spark, ts, [(1, 1), (1, 0), (None, 1)]), recent=1).first()
    assert (r["total_predictions"], r["overall_accuracy"], r["current_accuracy"]) == (3, 0.5, 0.0)


def test_class_never_predicted_scores_zero(spark, ts):
    df = predictions(spark, ts, [(0, 0), (0, 0), (1, 0), (2, 2)])
    rows = {r["label"]: r for r in monitoring.class_report(df, "ground_truth", "prediction").collect()}
    assert rows["1"]["precision"] == rows["1"]["recall"] == rows["1"]["f1"] == 0.0
    assert rows["accuracy"]["precision"] == 0.75 and rows["macro avg"]["recall"] == pytest.approx(2 / 3)


def test_regression_of_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "t double, p double")
    assert monitoring.regression_metrics(df, "t", "p").first()["r2_score"] == 1.0


def test_model_comparison(spark):
    def compare(rows):
        return monitoring.compare_models(spark.createDataFrame(rows, "arm string, hit double, latency double")).first()
    r = compare([("A", 0.0, 1.0), ("A", 1.0, 1.0), ("B", 1.0, 1.05)])
    assert (r["recommendation"], r["accuracy_improvement_pct"]) == ("Deploy Model B", 100.0)
    assert compare([("A", 0.0, 1.0), ("B", 1.0, 2.0)])["recommendation"] == "Keep Model A"
    assert compare([("A", 0.0, 1.0)])["recommendation"] == "Insufficient data for comparison"


def test_dashboard_uses_the_newest_hundred(spark, ts):
    df = spark.createDataFrame([("m", ts(i), i, float(i)) for i in range(150)], "metric string, at timestamp, id int, value double")
    r = monitoring.metric_dashboard(df, "at", "id").first()
    assert (r["current"], r["min"], r["max"], r["count"], r["p95"]) == (149.0, 50.0, 149.0, 150, pytest.approx(144.05))


def test_empty_log(spark):
    df = spark.createDataFrame([], "tokens int, latency double")
    assert tuple(oplog.kpis(df).first()) == (0, 0, 0.0)


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (1000.0, None), (None, 5.0)]
    assert statistics.correlation(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()[0] == pytest.approx(1.0)


def test_drift_of_an_empty_sample(spark):
    some = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    r = monitoring.data_drift(some, some.limit(0), ["x"]).first()
    assert (r["statistic"], r["p_value"], r["drifted"]) == (0.0, 1.0, False)


def test_batches_that_do_not_fit_are_skipped(spark):
    df = spark.range(10).repartition(1).sortWithinPartitions("id")
    skipped = spark.sparkContext.accumulator(0)
    got = quality.apply_in_batches(df, lambda b: b.assign(x="text") if b["id"].iloc[0] >= 0 else b, "id bigint, x bigint", skipped)
    assert got.count() == 0 and skipped.value == 10


def test_repeated_keys_change_a_row_once(spark):
    stored = spark.createDataFrame([(1, 5.0, "a", 1), (2, 6.0, "b", 1)], "transaction_id int, fraud_score double, description string, created_at int")
    incoming = spark.createDataFrame([(1, 7.0, "old", 1), (1, 8.0, "new", 2), (3, 1.0, "c", 1), (3, 2.0, "d", 2)], stored.schema)
    got = {r["transaction_id"]: (r["fraud_score"], r["description"]) for r in hybrid.upsert_alerts(stored, incoming).collect()}
    assert got == {1: (8.0, "new"), 2: (6.0, "b"), 3: (2.0, "d")} and hybrid.upsert_alerts(stored, incoming).count() == 3
    people = spark.createDataFrame([(1, "x")], "customer_id int, name string")
    more = spark.createDataFrame([(1, "y"), (2, "z"), (2, "zz")], people.schema)
    assert sorted(map(tuple, relational.insert_new(people, more).collect())) == [(1, "x"), (2, "zz")]
