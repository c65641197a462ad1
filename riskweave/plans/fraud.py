"""C and D: batch detectors and the history scorer."""

from pyspark.sql import functions as F

from riskweave.operators import detectors, history
from riskweave.plans.registry import query
from riskweave.plans.tables import Tables, cte

_C2 = """
SELECT transaction_id, customer_id, amount, transaction_count_1h,
       CASE WHEN transaction_count_1h >= 5 THEN 30.0 WHEN transaction_count_1h >= 3 THEN 20.0 ELSE 10.0 END::DOUBLE AS risk_score
FROM (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY floor(epoch_us(transaction_date) / 1000000)
              RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS transaction_count_1h FROM tx)
WHERE transaction_count_1h >= 3"""
_C3 = """
SELECT transaction_id, customer_id, amount, round(z, 6) AS z_score,
       CASE WHEN z >= 3 THEN 25.0 ELSE 15.0 END::DOUBLE AS risk_score
FROM (SELECT tx.*, CASE WHEN sd > 0 THEN abs(amount - mean) / sd ELSE 0 END AS z
      FROM tx JOIN (SELECT customer_id, avg(amount) AS mean, stddev_samp(amount) AS sd FROM tx GROUP BY customer_id) USING (customer_id))
WHERE z >= 2"""
_C5 = """
SELECT transaction_id, customer_id, prev_country, location_country, round(hours, 6) AS time_diff_hours
FROM (SELECT *, lag(location_country) OVER w AS prev_country,
             (floor(epoch_us(transaction_date) / 1000000) - floor(epoch_us(lag(transaction_date) OVER w) / 1000000)) / 3600 AS hours
      FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id))
WHERE location_country <> prev_country AND hours < 6"""


@query("C1_high_value_alerts", cte("tx", """
SELECT transaction_id, customer_id, amount, 'HIGH_VALUE' AS risk_factor, 25.0::DOUBLE AS risk_score FROM tx WHERE amount > 5000"""))
def c1(spark, d):
    return detectors.high_value(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "amount", "risk_factor", "risk_score")


@query("C2_velocity_alerts", cte("tx", _C2))
def c2(spark, d):
    return detectors.velocity(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "amount", "transaction_count_1h", "risk_score")


@query("C3_statistical_alerts", cte("tx", _C3))
def c3(spark, d):
    return detectors.statistical(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "amount", F.round("z_score", 6).alias("z_score"), "risk_score")


@query("C4_unusual_time_alerts", cte("tx", """
SELECT transaction_id, customer_id, hour(transaction_date)::INT AS hour_of_day, 15.0::DOUBLE AS risk_score
FROM tx WHERE hour(transaction_date) BETWEEN 2 AND 5"""))
def c4(spark, d):
    return detectors.unusual_time(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "hour_of_day", "risk_score")


@query("C5_geographic_alerts", cte("tx", _C5))
def c5(spark, d):
    return detectors.geographic(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "prev_country", "location_country",
        F.round("time_diff_hours", 6).alias("time_diff_hours"))


C6_SQL = cte("tx", f"""
WITH c2 AS ({_C2}), c3 AS ({_C3}), c5 AS ({_C5}),
alerts AS (
  SELECT transaction_id, 'HIGH_VALUE' AS factor, 25.0 AS score FROM tx WHERE amount > 5000
  UNION ALL SELECT transaction_id, 'HIGH_VELOCITY', risk_score FROM c2
  UNION ALL SELECT transaction_id, 'STATISTICAL_ANOMALY', risk_score FROM c3
  UNION ALL SELECT transaction_id, 'UNUSUAL_TIME', 15.0 FROM tx WHERE hour(transaction_date) BETWEEN 2 AND 5
  UNION ALL SELECT transaction_id, 'GEOGRAPHIC_ANOMALY', 20.0 FROM c5),
scored AS (
  SELECT transaction_id, customer_id, transaction_date, amount, merchant_name, sum(score)::DOUBLE AS total_risk_score,
         string_agg(DISTINCT factor, ',' ORDER BY factor) AS risk_factors
  FROM alerts JOIN tx USING (transaction_id) GROUP BY ALL)
SELECT *, CASE WHEN total_risk_score >= 80 THEN 'CRITICAL' WHEN total_risk_score >= 60 THEN 'HIGH'
               WHEN total_risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM scored""")


@query("C6_fraud_report", C6_SQL)
def c6(spark, d):
    return detectors.fraud_report(Tables(spark, d).tx).withColumn("risk_factors", F.array_join("risk_factors", ","))


@query("B11_severe_alerts", f"SELECT transaction_id, total_risk_score, risk_level FROM ({C6_SQL}) WHERE risk_level IN ('HIGH', 'CRITICAL')")
def b11(spark, d):
    return detectors.severe(detectors.scored_transactions(Tables(spark, d).tx)).select(
        "transaction_id", "total_risk_score", "risk_level")


@query("C7_customer_profiles", cte("tx", """
WITH p AS (
  SELECT customer_id, count(*) AS total_transactions, sum(amount) AS total_volume, avg(amount) AS avg_transaction,
         max(amount) AS max_transaction, min(amount) AS min_transaction, stddev_samp(amount) AS stddev_transaction,
         count(DISTINCT merchant_name) AS unique_merchants, count(DISTINCT location_country) AS countries_visited,
         min(transaction_date) AS first_transaction, max(transaction_date) AS last_transaction
  FROM tx GROUP BY customer_id)
SELECT customer_id, total_transactions, round(total_volume, 2) AS total_volume, round(avg_transaction, 4) AS avg_transaction,
       max_transaction, min_transaction, round(stddev_transaction, 4) AS stddev_transaction, unique_merchants,
       countries_visited, first_transaction, last_transaction,
       (CASE WHEN stddev_transaction / avg_transaction > 2 THEN 20.0 ELSE 0 END + CASE WHEN max_transaction > 10000 THEN 15.0 ELSE 0 END
        + CASE WHEN countries_visited > 5 THEN 10.0 ELSE 0 END)::DOUBLE AS customer_risk_score
FROM p"""))
def c7(spark, d):
    return detectors.customer_profiles(Tables(spark, d).tx).withColumns({
        "total_volume": F.round("total_volume", 2), "avg_transaction": F.round("avg_transaction", 4),
        "stddev_transaction": F.round("stddev_transaction", 4)})


_D1 = """count(*) OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date)
                    RANGE BETWEEN 7199999999 PRECEDING AND 1 PRECEDING)"""
_VELOCITY = "CASE WHEN recent >= 5 THEN 30.0 WHEN recent >= 3 THEN 20.0 WHEN recent >= 2 THEN 10.0 ELSE 0.0 END::DOUBLE"
_EARLIER = "OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_D2 = f"""SELECT *, CASE WHEN z >= 3 THEN 25.0 WHEN z >= 2 THEN 15.0 WHEN z >= 1.5 THEN 10.0 ELSE 0.0 END::DOUBLE AS deviation_score
FROM (SELECT *, CASE WHEN sd > 0 THEN abs(amount - mean) / sd ELSE 0 END AS z
      FROM (SELECT *, avg(amount) {_EARLIER} AS mean, stddev_pop(amount) {_EARLIER} AS sd FROM tx))"""
_D3 = """min(epoch_us(transaction_date)) OVER (PARTITION BY customer_id, merchant_name) = epoch_us(transaction_date)"""


@query("D1_velocity_tier", cte("tx", f"""
SELECT transaction_id, customer_id, recent, {_VELOCITY} AS velocity_score
FROM (SELECT *, {_D1} AS recent FROM tx)"""))
def d1(spark, d):
    return history.with_velocity(Tables(spark, d).tx).select("transaction_id", "customer_id", "recent", "velocity_score")


@query("D2_amount_deviation", cte("tx", f"""
SELECT transaction_id, customer_id, round(z, 4) AS z_score, deviation_score FROM ({_D2})"""))
def d2(spark, d):
    return history.with_amount_deviation(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", F.round("z_score", 4).alias("z_score"), "deviation_score")


@query("D3_new_merchant", cte("tx", f"SELECT transaction_id, customer_id, merchant_name, {_D3} AS new_merchant FROM tx"))
def d3(spark, d):
    return history.with_new_merchant(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "merchant_name", "new_merchant")


_D4 = f"""
WITH parts AS (
  SELECT transaction_id, customer_id, amount, deviation_score,
         CASE WHEN amount > 5000 THEN 25.0 ELSE 0 END AS s1,
         CASE WHEN hour(transaction_date) BETWEEN 2 AND 4 THEN 15.0 ELSE 0 END AS s2,
         {_D1} AS recent, CASE WHEN {_D3} THEN 10.0 ELSE 0 END AS s5
  FROM ({_D2})),
scored AS (
  SELECT transaction_id, customer_id, (s1 + s2 + {_VELOCITY} + deviation_score + s5)::DOUBLE AS score,
         concat_ws(',', CASE WHEN s1 > 0 THEN 'HIGH_VALUE_TRANSACTION' END, CASE WHEN s2 > 0 THEN 'UNUSUAL_TIME' END,
                   CASE WHEN recent >= 2 THEN 'HIGH_VELOCITY' END, CASE WHEN deviation_score > 0 THEN 'AMOUNT_DEVIATION' END,
                   CASE WHEN s5 > 0 THEN 'NEW_MERCHANT' END) AS rules
  FROM parts)"""


@query("D4_history_score", cte("tx", _D4 + """
SELECT *, CASE WHEN score >= 80 THEN 'CRITICAL' WHEN score >= 60 THEN 'HIGH' WHEN score >= 40 THEN 'MEDIUM'
               WHEN score >= 20 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level FROM scored"""))
def d4(spark, d):
    return history.scored_against_history(Tables(spark, d).tx).select(
        "transaction_id", "customer_id", "score", F.array_join("rules", ",").alias("rules"), "risk_level")


@query("D5_batch_summary", cte("tx", """
SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS total_customers, round(sum(amount), 2) AS total_volume,
       count(*) FILTER (amount > 5000) AS high_value_transactions,
       count(*) FILTER (hour(transaction_date) < 6) AS night_transactions FROM tx"""))
def d5(spark, d):
    return history.batch_summary(Tables(spark, d).tx).withColumn("total_volume", F.round("total_volume", 2))


@query("D6_top_merchants", cte("tx", """
SELECT merchant_name, count(*) AS transactions FROM tx GROUP BY merchant_name ORDER BY transactions DESC, merchant_name LIMIT 5"""))
def d6(spark, d):
    return history.top_merchants(Tables(spark, d).tx)


@query("D7_customer_risk", cte("tx", _D4 + """
SELECT customer_id, round(avg(score), 6) AS risk_score FROM scored GROUP BY customer_id"""))
def d7(spark, d):
    return history.customer_risk(Tables(spark, d).tx).withColumn("risk_score", F.round("risk_score", 6))
