"""Scoring each transaction against the customer's strictly earlier rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.ordered import MICROS, deviation_of, micros, prior_moments, strict_trailing_count
from riskweave.operators.detectors import tier

VELOCITY_SECONDS = 7200  # whole-hour difference of 0 or 1


def velocity_tier(count: Column) -> Column:
    return tier(F.coalesce(count, F.lit(0)), [(5, 30.0), (3, 20.0), (2, 10.0)], 0.0)


def busy_instants(df: DataFrame, at_least: int = 2) -> DataFrame:
    """(customer, instant) pairs with ``recent`` >= ``at_least`` earlier rows in two hours."""
    return strict_trailing_count(df, "customer_id", "transaction_date", VELOCITY_SECONDS).where(
        F.col("recent") >= at_least)


def with_velocity(df: DataFrame) -> DataFrame:
    """Add ``recent`` (earlier rows within two hours) and ``velocity_score``."""
    counts = strict_trailing_count(df, "customer_id", "transaction_date", VELOCITY_SECONDS)
    return df.withColumn(MICROS, micros("transaction_date")).join(
        counts, ["customer_id", MICROS], "left").drop(MICROS).withColumn("velocity_score", velocity_tier(F.col("recent")))


def with_amount_deviation(df: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Add ``z_score`` against earlier amounts (population deviation) and ``deviation_score``."""
    had = prior_moments(df, "customer_id", "transaction_date", "amount", slice_seconds)
    deviation = deviation_of(F.col("prior_n"), F.col("prior_m2"), F.col("prior_min"), F.col("prior_max"), sample=False)
    z = F.when(deviation > 0, F.abs(F.col("amount") - F.col("prior_mean")) / deviation).otherwise(F.lit(0.0))
    return had.withColumn("z_score", z).select(
        *df.columns, "z_score", tier(F.col("z_score"), [(3, 25.0), (2, 15.0), (1.5, 10.0)], 0.0).alias("deviation_score"))


def first_purchases(df: DataFrame) -> DataFrame:
    """Instant of a customer's first row at each merchant."""
    return df.groupBy("customer_id", "merchant_name").agg(F.min(micros("transaction_date")).alias(MICROS))


def with_new_merchant(df: DataFrame) -> DataFrame:
    """Add ``new_merchant``: no strictly earlier row names the merchant (null equals null)."""
    first = first_purchases(df).withColumnsRenamed(
        {"customer_id": "_c", "merchant_name": "_m", MICROS: "_first"})
    rows = df.withColumn(MICROS, micros("transaction_date"))
    # The instant is part of the key, so a hot customer spreads over the join.
    matched = (
        (rows["customer_id"].eqNullSafe(first["_c"]))
        & (rows["merchant_name"].eqNullSafe(first["_m"]))
        & (rows[MICROS] == first["_first"])
    )
    return rows.join(first, matched, "left").select(*df.columns, F.col("_first").isNotNull().alias("new_merchant"))


def scored_against_history(df: DataFrame) -> DataFrame:
    """Rule score, rules in rule order and level of every row."""
    busy = busy_instants(df)
    scored = with_new_merchant(with_amount_deviation(df)).withColumn(MICROS, micros("transaction_date"))
    scored = scored.join(busy, ["customer_id", MICROS], "left")
    hour = F.hour("transaction_date")
    rules = [
        ("HIGH_VALUE_TRANSACTION", F.when(F.col("amount") > 5000, 25.0).otherwise(0.0)),
        ("UNUSUAL_TIME", F.when((hour >= 2) & (hour < 5), 15.0).otherwise(0.0)),
        ("HIGH_VELOCITY", velocity_tier(F.col("recent"))),
        ("AMOUNT_DEVIATION", F.col("deviation_score")),
        ("NEW_MERCHANT", F.when(F.col("new_merchant"), 10.0).otherwise(0.0)),
    ]
    score = sum((points for _, points in rules), F.lit(0.0))
    names = F.array_compact(F.array(*[F.when(points > 0, F.lit(name)) for name, points in rules]))
    return scored.select(*df.columns, score.alias("score"), names.alias("rules")).withColumn(
        "risk_level",
        tier(F.col("score"), [(80, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM"), (20, "LOW")], "MINIMAL"))


def batch_summary(df: DataFrame) -> DataFrame:
    hour = F.hour("transaction_date")
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.countDistinct("customer_id").alias("total_customers"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_volume"),
        F.count_if(F.col("amount") > 5000).alias("high_value_transactions"),
        F.count_if((hour >= 0) & (hour < 6)).alias("night_transactions"))


def top_merchants(df: DataFrame, k: int = 5) -> DataFrame:
    return df.groupBy("merchant_name").agg(F.count(F.lit(1)).alias("transactions")).orderBy(
        F.desc("transactions"), "merchant_name").limit(k)


def customer_risk(df: DataFrame) -> DataFrame:
    return scored_against_history(df).groupBy("customer_id").agg(F.avg("score").alias("risk_score"))
