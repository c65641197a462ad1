"""H, I, J and M: statistics, quality, monitoring, operation log."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import monitoring, oplog, quality, statistics
from riskweave.plans.registry import query
from riskweave.plans.tables import Tables, cte
from riskweave.session import scratch


def rounded(df, places, *columns):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("H1_statistics", cte("tx", """
SELECT count(amount) AS count, round(sum(amount), 2) AS sum, round(avg(amount), 6) AS mean, round(median(amount), 6) AS median,
       min(amount) AS min, max(amount) AS max, round(stddev_pop(amount), 4) AS std_dev, round(var_pop(amount), 2) AS variance FROM tx"""))
def h1(spark, d):
    out = statistics.describe(Tables(spark, d).tx, "amount")
    return rounded(rounded(rounded(out, 2, "sum", "variance"), 6, "mean", "median"), 4, "std_dev")


@query("H2_percentiles", cte("tx", """
SELECT p AS percentile, quantile_disc(amount, p / 100.0) AS value
FROM tx, (SELECT unnest([25, 50, 75, 95, 99]) AS p) GROUP BY p""").replace("quantile_disc(amount, p / 100.0) AS value", """
  (list_sort(list(amount)))[CAST(greatest(1, ceil(p / 100.0::DOUBLE * count(*))) AS BIGINT)] AS value"""))
def h2(spark, d):
    return statistics.percentiles(Tables(spark, d).tx, "amount")


@query("H3_outliers", cte("tx", """
WITH s AS (SELECT list_sort(list(amount)) AS v FROM tx),
q AS (SELECT v[1 + CAST(floor(len(v) * 0.25::DOUBLE) AS BIGINT)] AS q1, v[1 + CAST(floor(len(v) * 0.75::DOUBLE) AS BIGINT)] AS q3 FROM s)
SELECT transaction_id, amount FROM tx, q WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)"""))
def h3(spark, d):
    return statistics.outliers(Tables(spark, d).tx, "amount").select("transaction_id", "amount")


@query("H4_moving_average", cte("tx", """
SELECT transaction_id, round(avg(amount) OVER (ORDER BY transaction_date, transaction_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_average
FROM tx QUALIFY row_number() OVER (ORDER BY transaction_date, transaction_id) >= 7"""))
def h4(spark, d):
    out = statistics.moving_average(Tables(spark, d).tx, "transaction_date", "transaction_id", "amount", 7)
    return rounded(out, 4, "moving_average").select("transaction_id", "moving_average")


@query("H5_time_buckets", cte("tx", """
SELECT CAST(epoch_ms(transaction_date) // 86400000 * 86400000 AS BIGINT) AS bucket, count(*) AS count, round(sum(amount), 2) AS sum,
       round(avg(amount), 4) AS mean, round(median(amount), 4) AS median, min(amount) AS min, max(amount) AS max,
       round(stddev_pop(amount), 4) AS std_dev, round(var_pop(amount), 2) AS variance FROM tx GROUP BY bucket"""))
def h5(spark, d):
    out = statistics.time_buckets(Tables(spark, d).tx, "transaction_date", "amount", 24)
    return rounded(rounded(out, 4, "mean", "median", "std_dev"), 2, "sum", "variance")


@query("H6_trend", cte("tx", """
WITH x AS (SELECT count(*) AS n, avg(amount) AS mean,
                  (arg_max(amount, transaction_id) - arg_min(amount, transaction_id)) / nullif(count(*) - 1, 0) AS step FROM tx)
SELECT n, round(step, 6) AS mean_difference, CASE WHEN n < 2 THEN 'INSUFFICIENT_DATA' WHEN step > mean * 0.05 THEN 'INCREASING'
       WHEN step < -mean * 0.05 THEN 'DECREASING' ELSE 'STABLE' END AS trend FROM x"""))
def h6(spark, d):
    return rounded(statistics.trend(Tables(spark, d).tx, "transaction_date", "transaction_id", "amount"), 6, "mean_difference")


@query("H7_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem")
def h7(spark, d):
    return rounded(statistics.correlation(Tables(spark, d).base("lineitem"), "l_quantity", "l_extendedprice"), 6, "correlation")


_DIRTY_TYPES = {"transaction_id": "bigint", "customer_id": "bigint", "transaction_date": "timestamp", "amount": "double",
                "merchant_name": "string", "source_system": "string", "is_fraud": "boolean"}
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(*) - count({c}) AS missing, "
    f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM dirty" for c, t in _DIRTY_TYPES.items())


@query("I1_missing_values", cte("dirty", _MISSING))
def i1(spark, d):
    return quality.missing_values(Tables(spark, d).dirty)


EXPECTED = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("currency", T.StringType())])


@query("I2_column_types", cte("dirty", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS filled, {e} AS expected, '{t}' AS actual, '{v}' AS verdict FROM dirty" for c, t, e, v in (
        ("transaction_id", "bigint", "'bigint'", "OK"), ("customer_id", "bigint", "'string'", "TYPE_MISMATCH"),
        ("transaction_date", "timestamp", "NULL", "EXTRA"), ("amount", "double", "'double'", "OK"),
        ("merchant_name", "string", "NULL", "EXTRA"), ("source_system", "string", "NULL", "EXTRA"), ("is_fraud", "boolean", "NULL", "EXTRA"),
    )) + " UNION ALL SELECT 'currency', 0, 'string', NULL, 'MISSING'"))
def i2(spark, d):
    return quality.column_types(Tables(spark, d).dirty, EXPECTED)


@query("I3_duplicate_rows", cte("dirty", """
SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicates FROM dirty"""))
def i3(spark, d):
    return quality.duplicate_rows(Tables(spark, d).dirty)


@query("I4_quality_score", cte("dirty", f"""
WITH m AS ({_MISSING}), t AS (SELECT count(*) AS n, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS dup FROM dirty)
SELECT n AS total_rows, dup AS duplicates, 2 AS schema_issues,
       round(greatest(0, 100 - (SELECT sum(least(missing * 100.0::DOUBLE / n / 2, 10)) FROM m) - least(dup * 100.0::DOUBLE / n, 20) - 10), 6) AS quality_score FROM t"""))
def i4(spark, d):
    return rounded(quality.quality_score(Tables(spark, d).dirty, EXPECTED), 6, "quality_score")


def _band(batch):
    return batch.assign(band=(batch["amount"] // 1000).clip(upper=20).astype("int64"))[["transaction_id", "band"]]


@query("I5_batch_function", cte("tx", "SELECT transaction_id, CAST(least(floor(amount / 1000), 20) AS BIGINT) AS band FROM tx"))
def i5(spark, d):
    return quality.apply_in_batches(Tables(spark, d).tx.select("transaction_id", "amount"), _band, "transaction_id bigint, band bigint")


def _event_band(batch):
    return batch.assign(band=(batch["value"] // 10).clip(upper=20).astype("int64"))[["event_id", "band"]]


@query("I5_process_dataset", "SELECT count(*) AS total_rows, count(*) AS processed_rows, count(*) AS output_rows FROM events")
def i5_dataset(spark, d):
    stats = quality.process_dataset(spark, f"{d}/events.parquet", scratch(spark, "i5"), _event_band, "event_id bigint, band bigint")
    return spark.createDataFrame([(stats.total_rows, stats.processed_rows, stats.output_rows)], "total_rows bigint, processed_rows bigint, output_rows bigint")


def _merchant_number(name):
    number = int(name[1:])
    if number % 3 == 0:
        raise ValueError(name)
    return number * 2


@query("I6_parallel_map", cte("tx", """
SELECT transaction_id, CASE WHEN CAST(substr(merchant_name, 2) AS BIGINT) % 3 <> 0 THEN CAST(substr(merchant_name, 2) AS BIGINT) * 2 END AS result FROM tx"""))
def i6(spark, d):
    return quality.parallel_map(Tables(spark, d).tx, "merchant_name", _merchant_number, "bigint").select("transaction_id", "result")


@query("J1_prediction_log", cte("predictions", """
SELECT prediction_id, substr(text, 1, 200) AS input, prediction, ground_truth, latency, model_version, prediction = ground_truth AS correct
FROM predictions JOIN documents ON doc_id = prediction_id"""))
def j1(spark, d):
    t = Tables(spark, d)
    texts = t.base("documents").select(F.col("doc_id").alias("prediction_id"), F.col("text").alias("input"))
    return monitoring.prediction_log(t.predictions.join(texts, "prediction_id")).select(
        "prediction_id", "input", "prediction", "ground_truth", "latency", "model_version", "correct")


@query("J2_realtime_metrics", cte("predictions", """
SELECT count(*) AS total_predictions, round(count(*) / ((max(epoch_us(logged_at)) - min(epoch_us(logged_at))) / 1e6), 8) AS throughput,
       round(avg(latency), 8) AS avg_latency, round(avg((prediction = ground_truth)::INT), 8) AS overall_accuracy,
       round(quantile_cont(latency, 0.95), 8) AS p95_latency, round(quantile_cont(latency, 0.99), 8) AS p99_latency,
       (SELECT round(avg(h), 8) FROM (SELECT (prediction = ground_truth)::INT AS h FROM predictions ORDER BY logged_at DESC, prediction_id DESC LIMIT 100)) AS current_accuracy
FROM predictions"""))
def j2(spark, d):
    return rounded(monitoring.realtime_metrics(Tables(spark, d).predictions), 8, "throughput", "avg_latency", "overall_accuracy",
                   "p95_latency", "p99_latency", "current_accuracy")


@query("J3_metric_rows", cte("predictions", """
WITH w AS (SELECT model_version AS model, round(avg((prediction = ground_truth)::INT), 8) AS accuracy, round(avg(latency), 8) AS latency FROM predictions GROUP BY 1)
SELECT model || '_accuracy' AS metric, accuracy AS value, 'model=' || model AS tags, TIMESTAMP '2024-02-01' AS recorded_at FROM w
UNION ALL SELECT model || '_latency', latency, 'model=' || model, TIMESTAMP '2024-02-01' FROM w"""))
def j3(spark, d):
    wide = Tables(spark, d).predictions.groupBy(F.col("model_version").alias("model")).agg(
        F.round(F.avg(monitoring.hits()), 8).alias("accuracy"), F.round(F.avg("latency"), 8).alias("latency"))
    rows = monitoring.metric_rows(wide, "model", ["accuracy", "latency"], "2024-02-01 00:00:00")
    return rows.withColumn("tags", F.concat(F.lit("model="), F.col("tags")["model"]))


_KS = """
WITH s AS (SELECT 'amount' AS feature, amount AS value, transaction_date < TIMESTAMP '2024-01-16' AS ref FROM tx
           UNION ALL SELECT 'hour', hour(transaction_date), transaction_date < TIMESTAMP '2024-01-16' FROM tx),
v AS (SELECT feature, value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM s GROUP BY feature, value),
t AS (SELECT feature, sum(r) AS nr, sum(c) AS nc FROM v GROUP BY feature),
g AS (SELECT feature, nr, nc, abs(sum(r) OVER w / nr - sum(c) OVER w / nc) AS gap FROM v JOIN t USING (feature)
      WINDOW w AS (PARTITION BY feature ORDER BY value)),
k AS (SELECT feature, max(gap) AS statistic, any_value(nr)::DOUBLE AS nr, any_value(nc)::DOUBLE AS nc FROM g GROUP BY feature),
x AS (SELECT *, sqrt(nr * nc / (nr + nc)) * statistic AS x FROM k),
p AS (SELECT *, CASE WHEN x < 1.18 THEN 1 - sqrt(2 * pi()) / x * list_sum(list_transform(range(1, 101), lambda j: exp(-((2 * j - 1) ** 2) * pi() ** 2 / (8 * x * x))))
                ELSE 2 * list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE * exp(-2.0 * j * j * x * x))) END AS p_value FROM x)
"""


def _halves(spark, d):
    rows = Tables(spark, d).tx.select("transaction_date", "amount", F.hour("transaction_date").alias("hour"))
    before = F.col("transaction_date") < F.lit("2024-01-16").cast("timestamp")
    return rows.where(before), rows.where(~before)


@query("J4_data_drift", cte("tx", _KS + """
SELECT feature, round(statistic, 8) AS statistic, CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur,
       round(greatest(0, least(1, p_value)), 6) AS p_value, p_value < 0.05 AS drifted FROM p"""))
def j4(spark, d):
    return rounded(rounded(monitoring.data_drift(*_halves(spark, d), ["amount", "hour"]), 8, "statistic"), 6, "p_value")


@query("J4_drift_summary", cte("tx", _KS + """
SELECT coalesce(bool_or(p_value < 0.05), FALSE) AS drift_detected, count(*) FILTER (p_value < 0.05) AS num_features_drifted, count(*) AS total_features,
       string_agg(printf('%s %.6f %.4f', feature, statistic, greatest(0, least(1, p_value))), '; ' ORDER BY feature) AS drift_scores FROM p"""))
def j4_summary(spark, d):
    found = monitoring.drift_summary(monitoring.data_drift(*_halves(spark, d), ["amount", "hour"]))
    shown = F.transform("drift_scores", lambda s: F.format_string("%s %.6f %.4f", s["feature"], s["statistic"], s["p_value"]))
    return found.withColumn("drift_scores", F.array_join(shown, "; "))


@query("J5_accuracy_drift", cte("predictions", """
WITH o AS (SELECT (prediction = ground_truth)::INT AS h, row_number() OVER (ORDER BY logged_at, prediction_id) AS i, count(*) OVER () AS n FROM predictions),
a AS (SELECT max(n) AS judged, CASE WHEN max(n) >= 100 THEN avg(h) FILTER (i <= 50) END AS b,
             CASE WHEN max(n) >= 100 THEN avg(h) FILTER (i > n - 50) END AS r FROM o)
SELECT judged, round(b, 6) AS baseline_accuracy, round(r, 6) AS recent_accuracy, round(b - r, 6) AS "drop", coalesce(b - r > 0.05, FALSE) AS drift_detected,
       CASE WHEN judged < 100 THEN 'Insufficient data' END AS reason FROM a"""))
def j5(spark, d):
    return rounded(monitoring.accuracy_drift(Tables(spark, d).predictions, window=50), 6, "baseline_accuracy", "recent_accuracy", "drop")


_CLASSES = """
WITH l AS (SELECT ground_truth AS label FROM predictions UNION SELECT prediction FROM predictions),
c AS (SELECT label, (SELECT count(*) FROM predictions WHERE ground_truth = label) AS support,
             (SELECT count(*) FROM predictions WHERE prediction = label) AS named,
             (SELECT count(*) FROM predictions WHERE prediction = label AND ground_truth = label) AS hit FROM l),
r AS (SELECT label, support, hit, coalesce(hit / nullif(named, 0), 0)::DOUBLE AS precision, coalesce(hit / nullif(support, 0), 0)::DOUBLE AS recall FROM c),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM r)
"""


@query("J6_classification_metrics", cte("predictions", _CLASSES + """
SELECT round(sum(hit) / sum(support), 8) AS accuracy, round(sum(precision * support) / sum(support), 8) AS precision,
       round(sum(recall * support) / sum(support), 8) AS recall, round(sum(f1 * support) / sum(support), 8) AS f1_score,
       CAST(sum(support) AS BIGINT) AS num_samples FROM f"""))
def j6(spark, d):
    return rounded(monitoring.classification_metrics(Tables(spark, d).predictions, "ground_truth", "prediction"), 8,
                   "accuracy", "precision", "recall", "f1_score")


@query("J7_confusion_matrix", cte("predictions", "SELECT ground_truth AS truth, prediction AS predicted, count(*) AS n FROM predictions GROUP BY ALL"))
def j7(spark, d):
    return monitoring.confusion(Tables(spark, d).predictions, "ground_truth", "prediction")


@query("J8_class_report", cte("predictions", _CLASSES + """
SELECT CAST(label AS VARCHAR) AS label, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8),
                 round(sum(f1 * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f"""))
def j8(spark, d):
    return rounded(monitoring.class_report(Tables(spark, d).predictions, "ground_truth", "prediction"), 8, "precision", "recall", "f1")


@query("J9_regression_metrics", """
WITH e AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
SELECT round(avg((y - p) ** 2), 2) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
       round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2_score FROM e""")
def j9(spark, d):
    rows = Tables(spark, d).base("lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return rounded(rounded(rounded(monitoring.regression_metrics(rows, "y", "p"), 2, "mse"), 4, "rmse", "mae"), 6, "r2_score")


@query("J10_error_totals", cte("predictions", """
SELECT count(*) FILTER (ground_truth <> prediction) AS total_errors, round(count(*) FILTER (ground_truth <> prediction) / count(*), 8) AS error_rate FROM predictions"""))
def j10(spark, d):
    return rounded(monitoring.error_totals(Tables(spark, d).predictions, "ground_truth", "prediction"), 8, "error_rate")


@query("J10_sample_errors", cte("predictions", """
SELECT prediction_id, ground_truth AS true_label, prediction AS predicted_label, substr(text, 1, 200) AS text
FROM predictions JOIN documents ON doc_id = prediction_id WHERE ground_truth <> prediction ORDER BY prediction_id LIMIT 10"""))
def j10_samples(spark, d):
    t = Tables(spark, d)
    rows = t.predictions.join(t.base("documents").select(F.col("doc_id").alias("prediction_id"), "text"), "prediction_id")
    return monitoring.sample_errors(rows, "ground_truth", "prediction", ["prediction_id"], "text")


@query("J10_top_error_types", cte("predictions", """
SELECT ground_truth AS true_label, prediction AS predicted_label, count(*) AS count FROM predictions WHERE ground_truth <> prediction
GROUP BY ALL ORDER BY count DESC, true_label, predicted_label LIMIT 10"""))
def j10_types(spark, d):
    return monitoring.top_error_types(Tables(spark, d).predictions, "ground_truth", "prediction")


@query("J11_model_comparison", cte("predictions", """
WITH a AS (SELECT avg(h) FILTER (arm = 'A') AS aa, avg(h) FILTER (arm = 'B') AS ba, avg(latency) FILTER (arm = 'A') AS al, avg(latency) FILTER (arm = 'B') AS bl,
                  count(*) FILTER (arm = 'A') AS an, count(*) FILTER (arm = 'B') AS bn
           FROM (SELECT CASE model_version WHEN 'v1' THEN 'A' ELSE 'B' END AS arm, (prediction = ground_truth)::INT AS h, latency FROM predictions))
SELECT round(aa, 8) AS a_accuracy, round(ba, 8) AS b_accuracy, round(al, 8) AS a_latency, round(bl, 8) AS b_latency, an AS a_samples, bn AS b_samples,
       round(ba - aa, 8) AS accuracy_improvement, round((ba - aa) / aa * 100, 6) AS accuracy_improvement_pct,
       round(al - bl, 8) AS latency_improvement, round((al - bl) / al * 100, 6) AS latency_improvement_pct,
       CASE WHEN ba - aa > 0.01 AND bl - al < 0.1 THEN 'Deploy Model B' ELSE 'Keep Model A' END AS recommendation FROM a"""))
def j11(spark, d):
    rows = Tables(spark, d).predictions.select(
        F.when(F.col("model_version") == "v1", "A").otherwise("B").alias("arm"), monitoring.hits().alias("hit"), "latency")
    out = rounded(monitoring.compare_models(rows), 8, "a_accuracy", "b_accuracy", "a_latency", "b_latency", "accuracy_improvement", "latency_improvement")
    return rounded(out, 6, "accuracy_improvement_pct", "latency_improvement_pct")


@query("J12_metric_dashboard", cte("op_log", """
WITH n AS (SELECT operation AS metric, latency AS value, row_number() OVER (PARTITION BY operation ORDER BY logged_at DESC, op_id DESC) AS i,
                  count(*) OVER (PARTITION BY operation) AS total FROM op_log)
SELECT metric, max(value) FILTER (i = 1) AS current, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max,
       round(quantile_cont(value, 0.95), 6) AS p95, any_value(total) AS count FROM n WHERE i <= 100 GROUP BY metric"""))
def j12(spark, d):
    rows = Tables(spark, d).op_log.select(F.col("operation").alias("metric"), "logged_at", "op_id", F.col("latency").alias("value"))
    return rounded(monitoring.metric_dashboard(rows, "logged_at", "op_id"), 6, "avg", "p95")


@query("M1_operation_kpis", cte("op_log", """
SELECT count(*) AS operations, CAST(sum(tokens) AS BIGINT) AS total_tokens, round(avg(latency), 6) AS avg_latency FROM op_log"""))
def m1(spark, d):
    return rounded(oplog.kpis(Tables(spark, d).op_log), 6, "avg_latency")


@query("M2_operation_distribution", cte("op_log", """
SELECT operation, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM op_log GROUP BY operation"""))
def m2(spark, d):
    return rounded(oplog.distribution(Tables(spark, d).op_log), 6, "share")


@query("M3_latency_summary", cte("op_log", """
SELECT operation, min(latency) AS low, round(quantile_cont(latency, 0.25), 6) AS q1, round(quantile_cont(latency, 0.5), 6) AS median,
       round(quantile_cont(latency, 0.75), 6) AS q3, max(latency) AS high FROM op_log GROUP BY operation"""))
def m3(spark, d):
    return rounded(oplog.latency_summary(Tables(spark, d).op_log), 6, "q1", "median", "q3")


@query("M4_token_usage", cte("op_log", """
SELECT operation, CAST(sum(tokens) AS BIGINT) AS total, round(avg(tokens), 6) AS mean, min(tokens) AS min, max(tokens) AS max FROM op_log GROUP BY operation"""))
def m4(spark, d):
    return rounded(oplog.token_usage(Tables(spark, d).op_log), 6, "mean")


@query("M5_timeline", cte("op_log", """
SELECT date_trunc('hour', logged_at) AS period, CAST(sum(tokens) AS BIGINT) AS tokens, round(avg(latency), 6) AS avg_latency, count(*) AS operations
FROM op_log GROUP BY period"""))
def m5(spark, d):
    return rounded(oplog.timeline(Tables(spark, d).op_log), 6, "avg_latency")


@query("M6_provider_health", cte("op_log", """
SELECT provider, count(*) AS calls, count(*) FILTER (NOT success) AS failures, round(count(*) FILTER (success) / count(*), 6) AS success_rate,
       round(avg(latency), 6) AS avg_latency FROM op_log GROUP BY provider"""))
def m6(spark, d):
    return rounded(oplog.provider_health(Tables(spark, d).op_log), 6, "success_rate", "avg_latency")


@query("M7_latest_operations", cte("op_log", """
SELECT op_id, operation, latency FROM op_log ORDER BY logged_at DESC, op_id DESC LIMIT 20"""))
def m7(spark, d):
    return oplog.latest(Tables(spark, d).op_log).select("op_id", "operation", "latency")
