"""B: normalisation, flags and text clean-up."""

from pyspark.sql import functions as F

from riskweave.functions import text
from riskweave.operators import normalize
from riskweave.plans.registry import query
from riskweave.plans.tables import AS_OF, Tables, cte

INGEST_TS = "2024-02-01 00:00:00"

_RECORD = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'T' || o_orderkey END
            ELSE 'I' || o_orderkey END AS transaction_id,
       CASE WHEN o_orderstatus = 'F' THEN 'C' || o_custkey ELSE 'K' || o_custkey END AS customer_id
FROM orders"""


@query("B1_alias_resolution", _RECORD)
def b1(spark, d):
    orders = Tables(spark, d).base("orders")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")

    def entry(name, value, present=F.lit(True)):
        return F.when(present, F.struct(F.lit(name).alias("key"), value.alias("value")))

    record = F.map_from_entries(F.array_compact(F.array(
        entry("transaction_id", F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.concat(F.lit("T"), key)), status != "P"),
        entry("id", F.concat(F.lit("I"), key)),
        entry("Card", F.concat(F.lit("C"), customer), status == "F"),
        entry("customer", F.concat(F.lit("K"), customer)))))
    get = normalize.map_lookup()
    return orders.withColumn("record", record).select(
        "o_orderkey", get("transaction_id").alias("transaction_id"), get("customer_id").alias("customer_id"))


_AMOUNT = "CASE WHEN trim(amount) <> '' THEN try_cast(regexp_replace(amount, '[^0-9.-]', '', 'g') AS DECIMAL(12,2)) END"
_DATE = """try_strptime(transaction_date, ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%m/%d/%Y', '%d/%m/%Y', '%Y/%m/%d'])"""
_LOCATION = """nullif(concat_ws(' ', nullif(concat_ws(', ', nullif(city, ''), nullif(state, '')), ''), nullif(zip, '')), '')"""
_FRAUD = """CASE WHEN lower(trim(is_fraud)) IN ('true', 'yes', '1') THEN TRUE WHEN lower(trim(is_fraud)) IN ('false', 'no', '0') THEN FALSE
  WHEN lower(is_fraud) LIKE '%yes%' THEN TRUE WHEN lower(is_fraud) LIKE '%no%' THEN FALSE END"""


@query("B2_amount_parsing", cte("raw_bank", f"SELECT customer_id, amount AS raw, CAST({_AMOUNT} AS DOUBLE) AS amount FROM raw_bank"))
def b2(spark, d):
    return Tables(spark, d).raw_bank.select(
        "customer_id", F.col("amount").alias("raw"), normalize.parse_amount(F.col("amount")).cast("double").alias("amount"))


@query("B3_date_parsing", cte("raw_bank", f"""
SELECT customer_id, transaction_date AS raw, coalesce({_DATE}, TIMESTAMP '{INGEST_TS}') AS parsed,
       {_DATE} IS NULL AS date_fallback FROM raw_bank"""))
def b3(spark, d):
    raw = Tables(spark, d).raw_bank
    parsed = normalize.parse_date(F.col("transaction_date"), normalize.column_lookup(raw))
    return raw.select(
        "customer_id", F.col("transaction_date").alias("raw"),
        F.coalesce(parsed, F.lit(INGEST_TS).cast("timestamp")).alias("parsed"), parsed.isNull().alias("date_fallback"))


@query("B4_location", cte("raw_bank", f"SELECT city, state, zip, {_LOCATION} AS location, count(*) AS n FROM raw_bank GROUP BY ALL"))
def b4(spark, d):
    return Tables(spark, d).raw_bank.withColumn(
        "location", normalize.location(F.col("city"), F.col("state"), F.col("zip"))
    ).groupBy("city", "state", "zip", "location").agg(F.count(F.lit(1)).alias("n"))


@query("B5_fraud_flag", cte("raw_bank", f"SELECT is_fraud AS raw, coalesce({_FRAUD}, FALSE) AS fraud_flag, count(*) AS n FROM raw_bank GROUP BY ALL"))
def b5(spark, d):
    flag = F.coalesce(normalize.parse_fraud_flag(F.col("is_fraud")), F.lit(False))
    return Tables(spark, d).raw_bank.groupBy(F.col("is_fraud").alias("raw"), flag.alias("fraud_flag")).agg(F.count(F.lit(1)).alias("n"))


@query("B6_normalised_bank", cte("raw_bank", f"""
SELECT transaction_id, customer_id, CAST({_AMOUNT} AS DOUBLE) AS amount, coalesce({_DATE}, TIMESTAMP '{INGEST_TS}') AS transaction_date,
       merchant_name, merchant_category, {_LOCATION} AS location, coalesce({_FRAUD}, FALSE) AS fraud_flag,
       'CSV' AS source_system, 'PENDING' AS status,
       CASE WHEN transaction_id = '' THEN 'MISSING_ID' WHEN {_AMOUNT} IS NULL THEN 'INVALID_AMOUNT' END AS reject_reason
FROM raw_bank"""))
def b6(spark, d):
    return normalize.normalise(Tables(spark, d).raw_bank, "CSV", INGEST_TS).withColumn(
        "amount", F.col("amount").cast("double")).drop("date_fallback")


@query("B6_normalised_card", """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS customer_id, value AS amount,
       CASE WHEN event_type = 'signup' THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END::TIMESTAMP AS transaction_date,
       event_type AS merchant_name, '5411' AS merchant_category, 'New York, NY 10001' AS location, event_type = 'error' AS fraud_flag,
       'CSV' AS source_system, 'PENDING' AS status FROM events""")
def b6_card(spark, d):
    return normalize.accepted(normalize.normalise(Tables(spark, d).raw_card, "CSV", INGEST_TS)).withColumn(
        "amount", F.col("amount").cast("double")).drop("date_fallback")


@query("B7_transaction_flags", cte("tx", """
SELECT transaction_id, amount > 10000 AS is_high_value, location_country <> 'US' AS is_international,
       hour(transaction_date) BETWEEN 2 AND 4 AS is_unusual_hours FROM tx"""))
def b7(spark, d):
    return normalize.transaction_flags(Tables(spark, d).tx, "us").select(
        "transaction_id", "is_high_value", "is_international", "is_unusual_hours")


@query("B8_customer_flags", cte("customers", """
SELECT customer_id, first_name || ' ' || last_name AS full_name, account_created_date > DATE '2024-01-01' AS is_new_customer,
       lifetime_value > 50000 AS is_high_value_customer FROM customers"""))
def b8(spark, d):
    return normalize.customer_flags(Tables(spark, d).customers, AS_OF).select(
        "customer_id", "full_name", "is_new_customer", "is_high_value_customer")


@query("B9_alert_review", cte("alerts", """
SELECT alert_id, fraud_score > 75 AS is_critical, (CASE WHEN severity = 'HIGH' THEN 'CONFIRMED' ELSE status END) = 'PENDING' AS is_pending,
       CASE WHEN severity = 'HIGH' THEN 'CONFIRMED' ELSE status END AS status,
       CASE WHEN severity = 'HIGH' THEN 'analyst' END AS reviewed_by,
       CASE WHEN severity = 'HIGH' THEN TIMESTAMP '2024-01-31 00:00:00' END AS reviewed_at FROM alerts"""))
def b9(spark, d):
    alerts = Tables(spark, d).alerts
    reviews = alerts.where("severity = 'HIGH'").select(
        "alert_id", F.lit("analyst").alias("reviewer"), F.lit("CONFIRMED").alias("new_status"))
    return normalize.alert_flags(normalize.mark_reviewed(alerts, reviews, AS_OF)).select(
        "alert_id", "is_critical", "is_pending", "status", "reviewed_by", "reviewed_at")


@query("B10_domain_checks", cte("alerts customers", """
SELECT 'alert_score' AS rule, count(*) FILTER (fraud_score * 1.2 NOT BETWEEN 0 AND 100) AS violations FROM alerts
UNION ALL SELECT 'alert_level', count(*) FILTER (severity NOT IN ('LOW','MEDIUM','HIGH','CRITICAL')) FROM alerts
UNION ALL SELECT 'alert_status', count(*) FILTER (status NOT IN ('PENDING','CONFIRMED','FALSE_POSITIVE','UNDER_REVIEW')) FROM alerts
UNION ALL SELECT 'customer_level', count(*) FILTER (lower(risk_level) = 'low') FROM customers
UNION ALL SELECT 'import_status', count(*) FILTER (severity = 'HIGH') FROM alerts"""))
def b10(spark, d):
    t = Tables(spark, d)
    spoiled = t.customers.withColumn("risk_level", F.when(F.col("risk_level") == "LOW", "low").otherwise(F.col("risk_level")))
    imports = t.alerts.select(F.when(F.col("severity") == "HIGH", "DONE").otherwise("COMPLETED").alias("status"))
    return normalize.domain_violations(t.alerts.withColumn("fraud_score", F.col("fraud_score") * 1.2), spoiled, imports)


@query("B12_calendar_features", cte("tx", """
SELECT transaction_id, year(transaction_date)::INT AS year, month(transaction_date)::INT AS month, day(transaction_date)::INT AS day,
       (isodow(transaction_date) - 1)::INT AS dayofweek, hour(transaction_date)::INT AS hour,
       CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM tx"""))
def b12(spark, d):
    return Tables(spark, d).tx.select(
        "transaction_id", *[c.alias(n) for n, c in text.calendar_features(F.col("transaction_date")).items()])


_WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: length(w) > 0)"


@query("B13_text_features", rf"""
SELECT doc_id, length(text)::INT AS text_length, len({_WORDS})::INT AS word_count,
       round(coalesce(length(array_to_string({_WORDS}, '')) / nullif(len({_WORDS}), 0), 0), 6) AS avg_word_length,
       round(coalesce(length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) / nullif(length(text), 0), 0), 6) AS uppercase_ratio,
       round(coalesce(length(regexp_replace(text, '[^\p{{Nd}}]', '', 'g')) / nullif(length(text), 0), 0), 6) AS digit_ratio
FROM documents""")
def b13(spark, d):
    features = text.text_features(Tables(spark, d).base("documents").select("doc_id", "text"), "text").drop("text")
    return features.withColumns({c: F.round(c, 6) for c in ("avg_word_length", "uppercase_ratio", "digit_ratio")})


@query("B14_preprocessed_text", r"""
SELECT doc_id, lower(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '[^a-zA-Z0-9\s.,!?;:\-()\[\]"'']+', '', 'g')) AS basic,
       regexp_replace(text, '[^a-zA-Z0-9\s]+', '', 'g') AS alphanumeric
FROM documents""")
def b14(spark, d):
    return Tables(spark, d).base("documents").select(
        "doc_id", text.preprocess(F.col("text"), ("lowercase", "clean_special", "normalize")).alias("basic"),
        text.remove_special(F.col("text"), keep_punctuation=False).alias("alphanumeric"))


@query("B15_sentences", r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]+'),
             lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0) AS parts FROM documents)
SELECT doc_id, CAST(i - 1 AS INT) AS pos, parts[i] AS sentence FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)""")
def b15(spark, d):
    return Tables(spark, d).base("documents").select("doc_id", F.posexplode_outer(text.sentences(F.col("text"))).alias("pos", "sentence")).where("pos IS NOT NULL")


@query("B16_truncated_text", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS short FROM documents""")
def b16(spark, d):
    return Tables(spark, d).base("documents").select("doc_id", text.truncate(F.col("text")).alias("short"))


@query("B17_token_estimate", """
SELECT source, CAST(sum(length(text) // 4) AS BIGINT) AS tokens FROM documents GROUP BY source""")
def b17(spark, d):
    return Tables(spark, d).base("documents").groupBy("source").agg(F.sum(text.token_estimate(F.col("text"))).alias("tokens"))
