"""Raw string records to one transaction layout, with accepted and rejected rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.relational import last_per_key
from riskweave.schemas import ALERT_STATUSES, IMPORT_STATUSES, RISK_LEVELS

# Source field names in the order they are tried.
ALIASES = {
    "transaction_id": ("transaction_id", "User", "id"),
    "customer_id": ("customer_id", "Card", "customer"),
    "amount": ("amount", "Amount"),
    "transaction_date": ("transaction_date", "Year", "date", "timestamp"),
    "merchant_name": ("merchant_name", "Merchant Name", "merchant"),
    "merchant_category": ("merchant_category", "MCC", "category"),
    "is_fraud": ("is_fraud", "Is Fraud?", "fraud_flag"),
    "city": ("merchant_city", "Merchant City", "city"),
    "state": ("merchant_state", "Merchant State", "state"),
    "zip": ("zip", "Zip"),
    "year": ("Year",),
    "month": ("Month",),
    "day": ("Day",),
    "time": ("Time",),
}
# Timestamp patterns in the order they are tried, each with the shape
# a text needs to match it at all. A failed parse costs an exception per row, the
# shape test a few comparisons.
DATE_FORMATS = (
    ("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]", "%-__-__T__:__%"),
    ("yyyy-MM-dd", "%-__-__"),
    ("yyyy-MM-dd HH:mm:ss", "%-__-__ __:__:__"),
    ("MM/dd/yyyy", "__/__/%"),
    ("dd/MM/yyyy", "__/__/%"),
    ("yyyy/MM/dd", "%/__/__"),
)

Lookup = Callable[[str], Column]


def column_lookup(df: DataFrame) -> Lookup:
    """Field access for a table of string columns: the first alias that is a column."""
    def get(field: str) -> Column:
        present = [n for n in ALIASES[field] if n in df.columns]
        return F.col(f"`{present[0]}`") if present else F.lit(None).cast("string")
    return get


def map_lookup(record: str = "record") -> Lookup:
    """Field access for a map column: the first alias that is a key, even with an empty value."""
    def get(field: str) -> Column:
        found = None
        for name in ALIASES[field]:
            has, value = F.map_contains_key(record, name), F.col(record)[name]
            found = F.when(has, value) if found is None else found.when(has, value)
        return found
    return get


def parse_amount(text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9.-]", "")
    return F.when(F.length(F.trim(text)) > 0, digits.try_cast("decimal(12,2)"))


def parse_date(text: Column, get: Lookup, extra_formats: tuple[str, ...] = ()) -> Column:
    """First matching format; then Year/Month/Day with optional Time; else null."""
    single = [F.when(text.like(shape), F.try_to_timestamp(text, F.lit(f))) for f, shape in DATE_FORMATS]
    single += [F.try_to_timestamp(text, F.lit(f)) for f in extra_formats]

    def two(part: Column) -> Column:
        number = part.try_cast("int")
        return F.when(number.between(0, 99), F.lpad(number.cast("string"), 2, "0"))

    day = F.concat(get("year"), F.lit("-"), two(get("month")), F.lit("-"), two(get("day")))
    time = get("time")
    parts = F.when(
        F.length(time) > 0,
        F.try_to_timestamp(F.concat(day, F.lit(" "), time), F.lit("yyyy-MM-dd HH:mm:ss")),
    ).otherwise(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")))
    return F.coalesce(*single, parts)


def location(city: Column, state: Column, zip_code: Column) -> Column:
    """``city, state zip`` without the blank parts; null when all are blank."""
    def given(part: Column) -> Column:
        return F.when(F.length(part) > 0, part)
    place = F.nullif(F.concat_ws(", ", given(city), given(state)), F.lit(""))
    return F.nullif(F.concat_ws(" ", place, given(zip_code)), F.lit(""))


def parse_fraud_flag(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return (
        F.when(F.coalesce(F.length(word), F.lit(0)) == 0, F.lit(None).cast("boolean"))
        .when(word.isin("true", "yes", "1"), True)
        .when(word.isin("false", "no", "0"), False)
        .when(word.contains("yes"), True)
        .when(word.contains("no"), False)
    )


def normalise(
    df: DataFrame, source: str, ingest_ts: str, get: Lookup | None = None, extra_formats: tuple[str, ...] = ()
) -> DataFrame:
    """All records in the common layout; ``reject_reason`` is null for usable ones."""
    get = get or (map_lookup() if "record" in df.columns else column_lookup(df))
    identity, amount = get("transaction_id"), parse_amount(get("amount"))
    parsed = parse_date(get("transaction_date"), get, extra_formats)
    reason = (
        F.when(F.coalesce(F.length(identity), F.lit(0)) == 0, "MISSING_ID").when(amount.isNull(), "INVALID_AMOUNT"))
    return df.select(
        identity.alias("transaction_id"),
        get("customer_id").alias("customer_id"),
        amount.alias("amount"),
        F.coalesce(parsed, F.lit(ingest_ts).cast("timestamp")).alias("transaction_date"),
        parsed.isNull().alias("date_fallback"),
        get("merchant_name").alias("merchant_name"),
        get("merchant_category").alias("merchant_category"),
        location(get("city"), get("state"), get("zip")).alias("location"),
        F.coalesce(parse_fraud_flag(get("is_fraud")), F.lit(False)).alias("fraud_flag"),
        F.lit(source).alias("source_system"),
        F.lit("PENDING").alias("status"),
        reason.alias("reject_reason"))


def accepted(normalised: DataFrame) -> DataFrame:
    return normalised.where("reject_reason IS NULL").drop("reject_reason")


def rejected(normalised: DataFrame) -> DataFrame:
    return normalised.where("reject_reason IS NOT NULL")


def flatten_nested(df: DataFrame) -> DataFrame:
    """Opt-in projection of the nested JSON layout onto the alias names."""
    return df.select(
        F.col("txnId").alias("transaction_id"), F.col("accountId").alias("customer_id"),
        F.col("transactionAmount.value").cast("string").alias("amount"),
        F.regexp_replace("timestamp", "Z$", "").alias("transaction_date"),
        F.col("merchant.name").alias("merchant_name"), F.col("merchant.category").alias("merchant_category"),
        F.col("location.city").alias("city"))


def transaction_flags(df: DataFrame, home_country: str, threshold: float = 10000.0) -> DataFrame:
    hour = F.hour("transaction_date")
    return df.withColumns({
        "is_high_value": F.coalesce(F.col("amount") > threshold, F.lit(False)),
        "is_international": F.coalesce(F.lower("location_country") != home_country.lower(), F.lit(False)),
        "is_unusual_hours": F.coalesce((hour >= 2) & (hour < 5), F.lit(False))})


def customer_flags(df: DataFrame, as_of: str, new_days: int = 30, high_value: float = 50000.0) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), new_days)
    return df.withColumns({
        "full_name": F.concat_ws(" ", "first_name", "last_name"),
        "is_new_customer": F.coalesce(F.col("account_created_date") > since, F.lit(False)),
        "is_high_value_customer": F.coalesce(F.col("lifetime_value") > high_value, F.lit(False))})


def alert_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_critical": F.coalesce(F.col("fraud_score") > 75, F.lit(False)),
        "is_pending": F.coalesce(F.col("status") == "PENDING", F.lit(False))})


def mark_reviewed(alerts: DataFrame, reviews: DataFrame, reviewed_at: str) -> DataFrame:
    """Apply ``(alert_id, reviewer, new_status)`` to the alerts they name; of repeated ids the highest row counts."""
    hit = F.col("new_status").isNotNull()
    named = last_per_key(reviews.select("alert_id", "reviewer", "new_status"), "alert_id")
    return alerts.join(named, "alert_id", "left").select(
        *[F.when(hit, F.col("new_status")).otherwise(F.col("status")).alias("status") if c == "status" else F.col(c)
          for c in alerts.columns],
        F.when(hit, F.col("reviewer")).alias("reviewed_by"),
        F.when(hit, F.lit(reviewed_at).cast("timestamp")).alias("reviewed_at"))


def domain_violations(alerts: DataFrame, customers: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """Rows outside each fixed value domain, one row per rule. Nulls pass, as in a CHECK."""
    checks = [
        (alerts, "alert_score", ~F.col("fraud_score").between(0, 100)),
        (alerts, "alert_level", ~F.col("severity").isin(*RISK_LEVELS)),
        (alerts, "alert_status", ~F.col("status").isin(*ALERT_STATUSES)),
        (customers, "customer_level", ~F.col("risk_level").isin(*RISK_LEVELS)),
    ]
    if imports is not None:
        checks.append((imports, "import_status", ~F.col("status").isin(*IMPORT_STATUSES)))
    by_table: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for table, name, broken in checks:
        by_table.setdefault(id(table), (table, {}))[1][name] = broken
    parts = []
    for table, rules in by_table.values():
        counted = table.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
        parts.append(counted.unpivot([], list(rules), "rule", "violations"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
