"""L and A21-A25: streaming operators run over the event table as a file stream."""

from pyspark.sql import functions as F

from riskweave.plans.fraud import _C5
from riskweave.plans.registry import query
from riskweave.plans.tables import Tables, cte, event_stream, transactions
from riskweave.session import scratch
from riskweave.streaming import detectors, messages


def _drain(streaming_query):
    streaming_query.awaitTermination()
    if streaming_query.exception() is not None:
        raise streaming_query.exception()


def _through_files(spark, df, label, partition_by=()):
    path, mark = scratch(spark, label), scratch(spark, f"{label}-mark")
    _drain(messages.write_files(df, path, mark, partition_by, every=None))
    return spark.read.schema(df.schema).parquet(path)


_PAYLOAD = "transaction_id BIGINT, customer_id BIGINT, amount DOUBLE, merchant_name STRING"


def _message_stream(spark, d):
    """Messages with a binary value; the error events carry broken JSON."""
    path = scratch(spark, "messages")
    rows = Tables(spark, d).tx.select("is_fraud", F.to_json(F.struct("transaction_id", "customer_id", "amount", "merchant_name")).alias("j"))
    rows.select(F.when(F.col("is_fraud"), F.concat(F.lit("broken "), "j")).otherwise(F.col("j")).cast("binary").alias("value")).write.parquet(path)
    return spark.readStream.schema("value BINARY").parquet(path)


@query("A21_message_decode", cte("tx", """
SELECT CASE WHEN NOT is_fraud THEN transaction_id END AS transaction_id, CASE WHEN NOT is_fraud THEN customer_id END AS customer_id,
       CASE WHEN NOT is_fraud THEN amount END AS amount, CASE WHEN NOT is_fraud THEN merchant_name END AS merchant_name FROM tx"""))
def a21(spark, d):
    from pyspark.sql.types import StructType
    return _through_files(spark, messages.decode(_message_stream(spark, d), StructType.fromDDL(_PAYLOAD)), "a21")


@query("A22_message_encode", cte("tx", "SELECT transaction_id, customer_id, amount FROM tx WHERE amount > 5000"))
def a22(spark, d):
    path = scratch(spark, "a22")
    rows = Tables(spark, d).tx_stream.where("amount > 5000").select("transaction_id", "customer_id", "amount")
    _drain(messages.write_messages(rows, "text", scratch(spark, "a22-mark"), every=None, path=path))
    sent = spark.read.text(path)
    return sent.select(F.from_json("value", "transaction_id BIGINT, customer_id BIGINT, amount DOUBLE").alias("v")).select("v.*")


@query("A23_batch_sink", cte("tx", "SELECT transaction_id, amount, 25.0::DOUBLE AS risk_score FROM tx WHERE amount > 5000"))
def a23(spark, d):
    path = scratch(spark, "a23")
    alerts = detectors.high_value_alerts(Tables(spark, d).tx_stream).select("transaction_id", "amount", "risk_score")
    _drain(messages.write_batches(alerts, messages.parquet_batches(path), scratch(spark, "a23-mark"), every=None))
    return spark.read.parquet(path).drop("batch_id")


@query("A24_partitioned_sink", cte("tx", """
SELECT 'HIGH' AS risk_level, count(*) AS n, round(sum(amount), 2) AS total FROM tx WHERE amount > 5000"""))
def a24(spark, d):
    alerts = detectors.high_value_alerts(Tables(spark, d).tx_stream).withColumn("risk_level", detectors.alert_level(F.col("risk_score")))
    stored = _through_files(spark, alerts.select("transaction_id", "amount", "risk_level"), "a24", ("risk_level",))
    return stored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("A25_memory_sink", cte("tx", "SELECT merchant_category, count(*) AS n FROM tx GROUP BY merchant_category"))
def a25(spark, d):
    mark = scratch(spark, "a25")
    name = "memory_" + mark[-32:]
    counts = Tables(spark, d).tx_stream.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("n"))
    _drain(messages.write_memory(counts, name, mark))
    return spark.table(name)


@query("L1_stream_high_value", cte("tx", "SELECT transaction_id, customer_id, amount, risk_score FROM (SELECT *, 25.0::DOUBLE AS risk_score FROM tx WHERE amount > 5000)"))
def l1(spark, d):
    alerts = detectors.high_value_alerts(Tables(spark, d).tx_stream)
    return _through_files(spark, alerts, "l1").select("transaction_id", "customer_id", "amount", "risk_score")


_WINDOWS = """
SELECT customer_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS transaction_count, round(sum(amount), 2) AS total_amount,
       CASE WHEN count(*) >= 5 THEN 30.0 ELSE 20.0 END::DOUBLE AS risk_score
FROM (SELECT customer_id, amount, time_bucket(INTERVAL 10 MINUTES, transaction_date) - k * INTERVAL 10 MINUTES AS window_start FROM tx, range(6) AS r(k))
GROUP BY customer_id, window_start
HAVING count(*) >= 3 AND window_start + INTERVAL 1 HOUR <= (SELECT max(transaction_date) - INTERVAL 30 MINUTES FROM tx)"""


def _velocity(spark, d):
    return _through_files(spark, detectors.velocity_windows(Tables(spark, d).tx_stream), "l2")


@query("L2_stream_velocity", cte("tx", _WINDOWS))
def l2(spark, d):
    return _velocity(spark, d).drop("risk_factor").withColumn("total_amount", F.round("total_amount", 2))


@query("L2_window_members", cte("tx", f"""
WITH w AS ({_WINDOWS})
SELECT w.customer_id, w.window_start, transaction_id FROM w JOIN tx ON tx.customer_id = w.customer_id
  AND transaction_date >= w.window_start AND transaction_date < w.window_end"""))
def l2_members(spark, d):
    return detectors.window_members(_velocity(spark, d), Tables(spark, d).tx)


def _in_thirds(spark, d, label, start):
    """Feed the events in three parts in time order; the stream is started on its checkpoint for each of them."""
    source, mark = scratch(spark, f"{label}-in"), scratch(spark, f"{label}-mark")
    events = Tables(spark, d).base("events")
    size = events.agg(F.max("event_id") - F.min("event_id") + 1).scalar()
    third = F.floor((F.col("event_id") - events.agg(F.min("event_id")).scalar()) * 3 / size)
    for part in range(3):
        events.where(third == part).write.mode("append").parquet(source)
        _drain(start(transactions(event_stream(spark, source, events.schema, "*.parquet")), mark))
    return mark


def _event_time(spark, d, detector, label):
    """Alerts given by the stream and, at its end, of the rows that still wait."""
    path = scratch(spark, label)
    mark = _in_thirds(spark, d, label, lambda df, mark: messages.write_files(detector.alerts(df), path, mark, (), every=None))
    return spark.read.parquet(path).unionByName(detector.rest(spark, mark))


_EARLIER = "OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_L3 = f"""
SELECT transaction_id, customer_id, round(z, 4) AS z_score, CASE WHEN z >= 3 THEN 25.0 ELSE 15.0 END::DOUBLE AS risk_score
FROM (SELECT *, CASE WHEN sd > 0 THEN abs(amount - mean) / sd ELSE 0 END AS z
      FROM (SELECT *, avg(amount) {_EARLIER} AS mean, stddev_samp(amount) {_EARLIER} AS sd FROM tx))
WHERE z >= 2"""


@query("L3_stream_statistical", cte("tx", _L3))
def l3(spark, d):
    return _event_time(spark, d, detectors.statistical_detector(), "l3").select(
        "transaction_id", "customer_id", F.round("z_score", 4).alias("z_score"), "risk_score")


_L4 = f"SELECT c5.* FROM ({_C5}) c5"


@query("L4_stream_geographic", cte("tx", _L4))
def l4(spark, d):
    return _event_time(spark, d, detectors.geographic_detector(), "l4").select(
        "transaction_id", "customer_id", "prev_country", "location_country", F.round("time_diff_hours", 6).alias("time_diff_hours"))


@query("L5_stream_alert_levels", cte("tx", f"""
WITH a AS (SELECT 'HIGH_VALUE' AS risk_factor, 25.0 AS risk_score FROM tx WHERE amount > 5000
           UNION ALL SELECT 'HIGH_VELOCITY', risk_score FROM ({_WINDOWS})
           UNION ALL SELECT 'STATISTICAL_ANOMALY', risk_score FROM ({_L3})
           UNION ALL SELECT 'GEOGRAPHIC_ANOMALY', 20.0 FROM ({_L4}))
SELECT risk_factor, CASE WHEN risk_score >= 25 THEN 'HIGH' WHEN risk_score >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, count(*) AS n FROM a GROUP BY ALL"""))
def l5(spark, d):
    values = _through_files(spark, detectors.high_value_alerts(Tables(spark, d).tx_stream), "l5").withColumn("event_time", F.col("transaction_date"))
    windows = _velocity(spark, d).withColumns({"transaction_id": F.lit(None).cast("bigint"), "event_time": F.col("window_end")})
    every = detectors.union_alerts(
        values, windows, _event_time(spark, d, detectors.statistical_detector(), "l5s"), _event_time(spark, d, detectors.geographic_detector(), "l5g"))
    return every.groupBy("risk_factor", "risk_level").agg(F.count(F.lit(1)).alias("n"))


_COUNTED = """
SELECT window_no, count(*) AS n, round(sum(amount), 2) AS total, min(transaction_id) AS first_id, max(transaction_id) AS last_id
FROM (SELECT *, CAST((row_number() OVER (ORDER BY transaction_date, transaction_id) - 1) // 300 AS BIGINT) AS window_no FROM tx) GROUP BY window_no"""


def _measures():
    return {"n": F.count(F.lit(1)), "total": F.sum("amount"), "first_id": F.min("transaction_id"), "last_id": F.max("transaction_id")}


@query("L6_count_windows", cte("tx", _COUNTED))
def l6(spark, d):
    return detectors.count_windows(Tables(spark, d).tx, 300, _measures()).withColumn("total", F.round("total", 2))


@query("L6_stream_count_windows", cte("tx", _COUNTED))
def l6_stream(spark, d):
    windows = detectors.CountWindows(
        scratch(spark, "l6-state"), scratch(spark, "l6"), 300, _measures(), {"first_id": F.min, "last_id": F.max})
    _in_thirds(spark, d, "l6", lambda df, mark: messages.write_batches(df, windows, mark, every=None))
    return windows.every(spark).drop("_rows").withColumn("total", F.round("total", 2))


def _in_two_feeds(spark, d, label, build):
    """Run a stream over the view and click events, then resume it with the rest."""
    events = Tables(spark, d).base("events")
    source, target, mark = scratch(spark, f"{label}-in"), scratch(spark, label), scratch(spark, f"{label}-mark")
    early = F.col("event_type").isin("view", "click")
    for feed in (events.where(early), events.where(~early)):
        feed.write.mode("append").parquet(source)
        stream = build(transactions(event_stream(spark, source, events.schema, "*.parquet")))
        _drain(messages.write_files(stream, target, mark, (), every=None))
    return spark.read.parquet(target)


@query("L7_late_rows_dropped", cte("tx", """
WITH a AS (SELECT * FROM tx WHERE merchant_category IN ('view', 'click'))
SELECT transaction_id, merchant_category FROM a
UNION ALL SELECT transaction_id, merchant_category FROM tx WHERE merchant_category NOT IN ('view', 'click')
  AND transaction_date > (SELECT max(transaction_date) - INTERVAL 30 MINUTES FROM a)"""))
def l7(spark, d):
    return _in_two_feeds(spark, d, "l7", lambda df: detectors.within_watermark(df, "30 minutes").select("transaction_id", "merchant_category"))


@query("L8_checkpoint_resume", cte("tx", "SELECT transaction_id, amount, 25.0::DOUBLE AS risk_score FROM tx WHERE amount > 5000"))
def l8(spark, d):
    return _in_two_feeds(spark, d, "l8", lambda df: detectors.high_value_alerts(df).select("transaction_id", "amount", "risk_score"))
