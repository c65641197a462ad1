"""Batch fraud detectors over a transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.ordered import previous_event, trailing_count, whole_seconds

GROUPING = ["transaction_id", "customer_id", "transaction_date", "amount", "merchant_name"]


def tier(value: Column, steps: list[tuple[float, object]], default: object) -> Column:
    """First step whose bound the value reaches, as a chained CASE."""
    expr = None
    for bound, result in steps:
        expr = F.when(value >= bound, F.lit(result)) if expr is None else expr.when(value >= bound, F.lit(result))
    return expr.otherwise(F.lit(default))


def risk_level(score: Column) -> Column:
    return tier(score, [(80, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM")], "LOW")


def high_value(df: DataFrame, threshold: float = 5000.0) -> DataFrame:
    return df.where(F.col("amount") > threshold).withColumns(
        {"risk_factor": F.lit("HIGH_VALUE"), "risk_score": F.lit(25.0)})


def velocity_score(count: Column) -> Column:
    return tier(count, [(5, 30.0), (3, 20.0)], 10.0)


def velocity_hits(df: DataFrame, window_minutes: int, threshold: int) -> DataFrame:
    return trailing_count(df, "customer_id", "transaction_date", window_minutes * 60).where(
        F.col("trailing") >= threshold).withColumnRenamed("trailing", "transaction_count_1h")


def velocity(df: DataFrame, window_minutes: int = 60, threshold: int = 3) -> DataFrame:
    hits = velocity_hits(df, window_minutes, threshold)
    return (
        df.withColumn("second", whole_seconds("transaction_date"))
        .join(hits, ["customer_id", "second"]).drop("second")
        .withColumn("risk_factor", F.lit("HIGH_VELOCITY"))
        .withColumn("risk_score", velocity_score(F.col("transaction_count_1h")))
    )


def customer_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        F.avg("amount").alias("avg_amount"),
        F.stddev("amount").alias("stddev_amount"),
        F.count(F.lit(1)).alias("transaction_count"))


def z_score(amount: Column, mean: Column, deviation: Column) -> Column:
    return F.when(deviation > 0, F.abs(amount - mean) / deviation).otherwise(F.lit(0.0))


def statistical(df: DataFrame) -> DataFrame:
    return (
        df.join(customer_statistics(df), "customer_id")
        .withColumn("z_score", z_score(F.col("amount"), F.col("avg_amount"), F.col("stddev_amount")))
        .where("z_score >= 2.0")
        .withColumn("risk_factor", F.lit("STATISTICAL_ANOMALY"))
        .withColumn("risk_score", tier(F.col("z_score"), [(3, 25.0)], 15.0))
    )


def unusual_time(df: DataFrame) -> DataFrame:
    """Hours 2 to 5, both included: this detector's own bounds."""
    return df.withColumn("hour_of_day", F.hour("transaction_date")).where("hour_of_day BETWEEN 2 AND 5").withColumns(
        {"risk_factor": F.lit("UNUSUAL_TIME"), "risk_score": F.lit(15.0)})


def with_previous_place(df: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    had = previous_event(
        df, "customer_id", "transaction_date", "transaction_id",
        ["location_country", "location_city", "transaction_date"], slice_seconds)
    seconds = whole_seconds("transaction_date") - F.unix_seconds(F.col("previous.transaction_date").cast("timestamp"))
    return had.select(
        *[F.col(c) for c in df.columns],
        F.col("previous.location_country").alias("prev_country"),
        F.col("previous.location_city").alias("prev_city"),
        F.col("previous.transaction_date").alias("prev_time"),
        (seconds / 3600).alias("time_diff_hours"))


def travelled(max_hours: float = 6.0) -> Column:
    return (F.col("location_country") != F.col("prev_country")) & (F.col("time_diff_hours") < max_hours)


def geographic(df: DataFrame, max_hours: float = 6.0, slice_seconds: int = 3600) -> DataFrame:
    return with_previous_place(df, slice_seconds).where(travelled(max_hours)).withColumns(
        {"risk_factor": F.lit("GEOGRAPHIC_ANOMALY"), "risk_score": F.lit(20.0)})


def scored_transactions(df: DataFrame) -> DataFrame:
    """All five detectors as columns of one pass, alerts folded per transaction.

    High value and hour are row expressions, travel is one sliced ordering, velocity
    joins only the seconds that reached the threshold, and the z-score joins one row
    per customer. Same result as a union of the five alert lists.
    """
    hits = velocity_hits(df, 60, 3)
    hour = F.hour("transaction_date")
    rows = (
        with_previous_place(df)
        .withColumn("second", whole_seconds("transaction_date"))
        .join(hits, ["customer_id", "second"], "left")
        .join(customer_statistics(df), "customer_id", "left")
    )
    z = z_score(F.col("amount"), F.col("avg_amount"), F.col("stddev_amount"))
    count = F.col("transaction_count_1h")

    # Alphabetical, so the factors come out sorted.
    alerts = {
        "GEOGRAPHIC_ANOMALY": (travelled(), F.lit(20.0)),
        "HIGH_VALUE": (F.col("amount") > 5000.0, F.lit(25.0)),
        "HIGH_VELOCITY": (count.isNotNull(), velocity_score(count)),
        "STATISTICAL_ANOMALY": (z >= 2.0, tier(z, [(3, 25.0)], 15.0)),
        "UNUSUAL_TIME": (hour.between(2, 5), F.lit(15.0)),
    }
    score, mask = F.lit(0.0), F.lit(0)
    for bit, (condition, points) in enumerate(alerts.values()):
        score = score + F.when(condition, points).otherwise(F.lit(0.0))
        mask = mask + F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0))
    flagged = rows.select(*GROUPING, score.alias("score"), mask.alias("mask")).where("mask > 0")
    # Rows repeating all five grouping columns fold into one. The factors travel as
    # bits, so this stays a hash aggregate with a buffer of two numbers.
    folded = flagged.groupBy(*GROUPING).agg(F.sum("score").alias("total_risk_score"), F.bit_or("mask").alias("mask"))
    factors = [F.when(F.col("mask").bitwiseAND(F.lit(1 << bit)) != 0, F.lit(name)) for bit, name in enumerate(alerts)]
    return folded.select(
        *GROUPING, "total_risk_score", F.array_compact(F.array(*factors)).alias("risk_factors"),
        risk_level(F.col("total_risk_score")).alias("risk_level"))


def fraud_report(df: DataFrame) -> DataFrame:
    return scored_transactions(df).orderBy(F.desc("total_risk_score"), "transaction_id")


def severe(df: DataFrame) -> DataFrame:
    return df.where(F.col("risk_level").isin("HIGH", "CRITICAL"))


def customer_profiles(df: DataFrame) -> DataFrame:
    score = (
        F.when(F.try_divide("stddev_transaction", "avg_transaction") > 2, 20.0).otherwise(0.0)
        + F.when(F.col("max_transaction") > 10000, 15.0).otherwise(0.0)
        + F.when(F.col("countries_visited") > 5, 10.0).otherwise(0.0)
    )
    return df.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_volume"),
        F.avg("amount").alias("avg_transaction"),
        F.max("amount").alias("max_transaction"),
        F.min("amount").alias("min_transaction"),
        F.stddev("amount").alias("stddev_transaction"),
        F.countDistinct("merchant_name").alias("unique_merchants"),
        F.countDistinct("location_country").alias("countries_visited"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"),
    ).withColumn("customer_risk_score", score)
