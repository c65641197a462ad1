"""Fixed schemas of the transaction side."""

from pyspark.sql import types as T

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("location_country", T.StringType()),
    T.StructField("location_city", T.StringType()),
    T.StructField("is_online", T.BooleanType()),
])

# Fixed value domains of the master, alert and import-log tables.
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ALERT_STATUSES = ("PENDING", "CONFIRMED", "FALSE_POSITIVE", "UNDER_REVIEW")
IMPORT_STATUSES = ("IN_PROGRESS", "COMPLETED", "FAILED", "PARTIAL")
