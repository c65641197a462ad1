"""Logical tables derived from the given parquet tables, in Spark and in SQL.

``Tables`` builds them lazily from a folder; ``cte`` prefixes a SQL body with the
same definitions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AS_OF = "2024-01-31 00:00:00"


def event_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "events.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def transactions(events: DataFrame) -> DataFrame:
    """The transaction table from event rows, batch or streaming."""
    k = F.get_json_object("props", "$.k").cast("int")
    countries = F.array(*[F.lit(c) for c in ("US", "CN", "RU", "GB", "BR")])
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("transaction_date"),
        F.round(F.col("value") * 100, 2).alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("M"), (k % 20).cast("string")).alias("merchant_name"),
        F.col("event_type").alias("merchant_category"),
        F.get(countries, k % 5).alias("location_country"),
        F.concat(F.lit("City "), (k % 10).cast("string")).alias("location_city"),
        (F.col("event_type") == "error").alias("is_fraud"),
        F.get(F.array(F.lit("CSV"), F.lit("JSON"), F.lit("FIXED_WIDTH")), k % 3).alias("source_system"))


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def tx(self) -> DataFrame:
        return transactions(self.base("events"))

    @cached_property
    def tx_stream(self) -> DataFrame:
        """The same table as a file stream."""
        return transactions(event_stream(self.spark, self.folder, self.base("events").schema))

    @cached_property
    def dirty(self) -> DataFrame:
        """Transactions with missing values, negative amounts and repeated ids and rows."""
        i = F.col("transaction_id")
        holed = self.tx.select(
            (i - F.when(i % 50 == 49, 1).otherwise(0)).alias("transaction_id"),
            F.when(i % 13 != 0, F.col("customer_id")).alias("customer_id"),
            F.when(i % 17 != 0, F.col("transaction_date")).alias("transaction_date"),
            F.when(i % 11 != 0, F.when(i % 19 == 0, -F.col("amount")).otherwise(F.col("amount"))).alias("amount"),
            "merchant_name", "source_system", "is_fraud")
        copies = F.when(F.col("transaction_id") % 29 == 0, 2).otherwise(1)
        return holed.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")

    @cached_property
    def raw_bank(self) -> DataFrame:
        """Order table as an untyped bank export: mixed amount and date spellings, some unusable rows."""
        status, priority, day = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate").cast("timestamp")
        plain = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
        amount = (
            F.when((status == "P") & (priority == "4-NOT SPECIFIED"), "n/a")
            .when((status == "P") & (priority == "5-LOW"), "")
            .when(status == "F", F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
            .when(status == "O", F.concat(F.lit("USD "), plain)).otherwise(plain))
        formats = {
            "1-URGENT": "yyyy-MM-dd'T'HH:mm:ss", "2-HIGH": "yyyy-MM-dd", "3-MEDIUM": "MM/dd/yyyy",
            "4-NOT SPECIFIED": "yyyy/MM/dd"}
        date = F.when((status == "P") & (priority == "2-HIGH"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        date = date.when((status == "F") & (priority == "3-MEDIUM"), F.date_format(day, "dd/MM/yyyy"))
        for name, pattern in formats.items():
            date = date.when(priority == name, F.date_format(day, pattern))
        return self.base("orders").select(
            F.when((status == "P") & (priority == "1-URGENT"), "").otherwise(F.col("o_orderkey").cast("string")).alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            amount.alias("amount"),
            date.otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("transaction_date"),
            F.concat(F.lit("Shop "), status).alias("merchant_name"),
            F.substring(priority, 3, 20).alias("merchant_category"),
            F.when(status == "F", "Boston").otherwise("").alias("city"),
            F.when(priority == "1-URGENT", "").otherwise("MA").alias("state"),
            F.when(status == "O", "02101").otherwise("").alias("zip"),
            F.when(priority == "1-URGENT", "'Yes'").when(priority == "2-HIGH", "TRUE").when(priority == "3-MEDIUM", "0")
            .when(priority == "5-LOW", " no ").otherwise("maybe").alias("is_fraud"))

    @cached_property
    def raw_card(self) -> DataFrame:
        """Event table as a card export with split date parts."""
        ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
        return self.base("events").select(
            F.col("event_id").cast("string").alias("User"), F.col("user_id").cast("string").alias("Card"),
            F.date_format(ts, "yyyy").alias("Year"), F.month(ts).cast("string").alias("Month"),
            F.dayofmonth(ts).cast("string").alias("Day"),
            F.when(kind == "signup", "").otherwise(F.date_format(ts, "HH:mm:ss")).alias("Time"),
            F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)").cast("string")).alias("Amount"),
            kind.alias("Merchant Name"), F.lit("New York").alias("Merchant City"), F.lit("NY").alias("Merchant State"),
            F.lit("10001").alias("Zip"), F.lit("5411").alias("MCC"),
            F.when(kind == "error", "Yes").otherwise("No").alias("Is Fraud?"))

    @cached_property
    def customers(self) -> DataFrame:
        totals = self.base("orders").groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("value"))
        levels = F.array(*[F.lit(x) for x in ("LOW", "MEDIUM", "HIGH", "CRITICAL")])
        key = F.col("c_custkey")
        return self.base("customer").join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(
            key.alias("customer_id"),
            F.split("c_name", "#")[0].alias("first_name"), F.split("c_name", "#")[1].alias("last_name"),
            F.col("c_mktsegment").alias("segment"),
            F.get(levels, (key % 4).cast("int")).alias("risk_level"),
            F.date_add(F.lit("2023-01-01").cast("date"), (key % 400).cast("int")).alias("account_created_date"),
            F.coalesce("n", F.lit(0)).alias("total_transactions"),
            F.round(F.coalesce("value", F.lit(0.0)), 2).alias("lifetime_value"))

    @cached_property
    def profiles(self) -> DataFrame:
        key = F.col("customer_id")
        return self.customers.where(F.col("segment") != "HOUSEHOLD").select(
            key,
            F.col("segment").alias("business_type"),
            (F.lit(20000.0) * (1 + key % 5)).alias("expected_monthly_volume"),
            (F.lit(5000.0) + 1000 * (key % 10)).alias("expected_max_amount"),
            F.concat(F.lit("{"), F.col("segment"), F.lit(","), F.col("risk_level"), F.lit("}")).alias("risk_indicators"),
            (F.col("customer_id") % 10 / 10.0).alias("confidence_score"),
            F.concat(F.lit("kyc_"), key.cast("string"), F.lit(".pdf")).alias("kyc_document_source"),
            F.col("account_created_date").cast("timestamp").alias("last_updated"))

    @cached_property
    def alerts(self) -> DataFrame:
        i = F.col("transaction_id")
        amount = F.col("amount")
        severity = F.when(amount > 20000, "CRITICAL").when(amount > 15000, "HIGH").when(amount > 10000, "MEDIUM").otherwise("LOW")
        statuses = F.array(*[F.lit(x) for x in ("PENDING", "CONFIRMED", "FALSE_POSITIVE", "UNDER_REVIEW")])
        return self.tx.where(amount > 8000).select(
            (i + 1_000_000).alias("alert_id"), i, "customer_id",
            F.col("transaction_date").alias("created_at"),
            severity.alias("severity"),
            F.get(statuses, (i % 4).cast("int")).alias("status"),
            (i % 101).cast("double").alias("fraud_score"),
            F.concat(F.lit("alert on "), i.cast("string")).alias("description"))

    @cached_property
    def reports(self) -> DataFrame:
        return self.customers.select(
            "customer_id", (F.col("customer_id") % 4 == 1).alias("filed_with_regulator"))

    @cached_property
    def scores(self) -> DataFrame:
        i = F.col("transaction_id")
        return self.tx.where("merchant_category <> 'signup'").select(i, (i % 100 / 100.0).alias("external_score"))

    @cached_property
    def predictions(self) -> DataFrame:
        timing = self.base("events").select(
            F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("logged_at"),
            (F.col("value") / 1000).alias("latency"))
        return self.base("labels").join(timing, "doc_id").select(
            F.col("doc_id").alias("prediction_id"), "logged_at", "latency",
            F.col("quality").alias("ground_truth"), (1 - F.col("toxic")).alias("prediction"),
            F.concat(F.lit("v"), (F.col("doc_id") % 2 + 1).cast("string")).alias("model_version"))

    @cached_property
    def op_log(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.base("events").select(
            F.col("event_id").alias("op_id"), F.col("ts").cast("timestamp").alias("logged_at"),
            F.col("event_type").alias("operation"), k.alias("tokens"), F.col("value").alias("latency"),
            F.concat(F.lit("provider"), (k % 4).cast("string")).alias("provider"),
            (F.col("event_type") != "error").alias("success"))


_CTE = {
    "tx": """
  SELECT event_id AS transaction_id, user_id AS customer_id, ts AS transaction_date,
         round(value * 100, 2) AS amount, 'USD' AS currency,
         concat('M', CAST(json_extract_string(props, '$.k') AS INT) % 20) AS merchant_name,
         event_type AS merchant_category,
         ['US','CN','RU','GB','BR'][1 + CAST(json_extract_string(props, '$.k') AS INT) % 5] AS location_country,
         concat('City ', CAST(json_extract_string(props, '$.k') AS INT) % 10) AS location_city,
         event_type = 'error' AS is_fraud,
         ['CSV','JSON','FIXED_WIDTH'][1 + CAST(json_extract_string(props, '$.k') AS INT) % 3] AS source_system
  FROM events""",
    "dirty": """
  SELECT transaction_id, customer_id, transaction_date, amount, merchant_name, source_system, is_fraud FROM (
    SELECT transaction_id - CASE WHEN transaction_id % 50 = 49 THEN 1 ELSE 0 END AS transaction_id,
           CASE WHEN transaction_id % 13 <> 0 THEN customer_id END AS customer_id,
           CASE WHEN transaction_id % 17 <> 0 THEN transaction_date END AS transaction_date,
           CASE WHEN transaction_id % 11 <> 0 THEN CASE WHEN transaction_id % 19 = 0 THEN -amount ELSE amount END END AS amount,
           merchant_name, source_system, is_fraud
    FROM tx) AS holed,
    range(2) AS copies(n)
  WHERE n = 0 OR transaction_id % 29 = 0""",
    "raw_bank": """
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ''
              WHEN o_orderstatus = 'F' THEN '$' || format('{:,.2f}', o_totalprice)
              WHEN o_orderstatus = 'O' THEN 'USD ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
              WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
              WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_date,
         'Shop ' || o_orderstatus AS merchant_name, substr(o_orderpriority, 3, 20) AS merchant_category,
         CASE WHEN o_orderstatus = 'F' THEN 'Boston' ELSE '' END AS city,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'MA' END AS state,
         CASE WHEN o_orderstatus = 'O' THEN '02101' ELSE '' END AS zip,
         CASE o_orderpriority WHEN '1-URGENT' THEN '''Yes''' WHEN '2-HIGH' THEN 'TRUE' WHEN '3-MEDIUM' THEN '0'
              WHEN '5-LOW' THEN ' no ' ELSE 'maybe' END AS is_fraud
  FROM orders""",
    "customers": """
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         c_mktsegment AS segment, ['LOW','MEDIUM','HIGH','CRITICAL'][1 + c_custkey % 4] AS risk_level,
         DATE '2023-01-01' + CAST(c_custkey % 400 AS INT) AS account_created_date,
         coalesce(n, 0) AS total_transactions, round(coalesce(value, 0), 2) AS lifetime_value
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS value FROM orders GROUP BY o_custkey) AS t
    ON c_custkey = o_custkey""",
    "profiles": """
  SELECT customer_id, segment AS business_type, 20000.0::DOUBLE * (1 + customer_id % 5) AS expected_monthly_volume,
         5000.0::DOUBLE + 1000 * (customer_id % 10) AS expected_max_amount,
         '{' || segment || ',' || risk_level || '}' AS risk_indicators,
         (customer_id % 10) / 10.0::DOUBLE AS confidence_score, concat('kyc_', customer_id, '.pdf') AS kyc_document_source,
         CAST(account_created_date AS TIMESTAMP) AS last_updated
  FROM customers WHERE segment <> 'HOUSEHOLD'""",
    "alerts": """
  SELECT transaction_id + 1000000 AS alert_id, transaction_id, customer_id, transaction_date AS created_at,
         CASE WHEN amount > 20000 THEN 'CRITICAL' WHEN amount > 15000 THEN 'HIGH' WHEN amount > 10000 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         ['PENDING','CONFIRMED','FALSE_POSITIVE','UNDER_REVIEW'][1 + transaction_id % 4] AS status,
         CAST(transaction_id % 101 AS DOUBLE) AS fraud_score, concat('alert on ', transaction_id) AS description
  FROM tx WHERE amount > 8000""",
    "reports": "SELECT customer_id, customer_id % 4 = 1 AS filed_with_regulator FROM customers",
    "scores": """
  SELECT transaction_id, (transaction_id % 100) / 100.0::DOUBLE AS external_score FROM tx WHERE merchant_category <> 'signup'""",
    "predictions": """
  SELECT doc_id AS prediction_id, ts AS logged_at, value / 1000 AS latency, quality AS ground_truth, 1 - toxic AS prediction,
         concat('v', doc_id % 2 + 1) AS model_version
  FROM labels JOIN events ON event_id = doc_id""",
    "op_log": """
  SELECT event_id AS op_id, ts AS logged_at, event_type AS operation,
         CAST(json_extract_string(props, '$.k') AS INT) AS tokens, value AS latency,
         concat('provider', CAST(json_extract_string(props, '$.k') AS INT) % 4) AS provider,
         event_type <> 'error' AS success
  FROM events""",
}
_NEEDS = {"dirty": ["tx"], "profiles": ["customers"], "alerts": ["tx"], "reports": ["customers"], "scores": ["tx"]}


def cte(names: str, body: str) -> str:
    """``WITH`` clause defining the named tables (and what they need) before ``body``."""
    ordered: list[str] = []
    for name in names.split():
        for need in [*_NEEDS.get(name, []), name]:
            if need not in ordered:
                ordered.append(need)
    head = ",\n".join(f"{n} AS ({_CTE[n]})" for n in ordered)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
