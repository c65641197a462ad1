"""Operation-log aggregates (M1-M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.ordered import linear_percentiles


def kpis(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count(F.lit(1)).alias("operations"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.avg("latency"), F.lit(0.0)).alias("avg_latency"))


def distribution(log: DataFrame) -> DataFrame:
    counts = log.groupBy("operation").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def latency_summary(log: DataFrame) -> DataFrame:
    """Exact five-number summary per operation."""
    return linear_percentiles(log, ["operation"], "latency", {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0})


def token_usage(log: DataFrame) -> DataFrame:
    return log.groupBy("operation").agg(
        F.sum("tokens").alias("total"), F.avg("tokens").alias("mean"), F.min("tokens").alias("min"), F.max("tokens").alias("max"))


def timeline(log: DataFrame, unit: str = "hour") -> DataFrame:
    return log.groupBy(F.date_trunc(unit, "logged_at").alias("period")).agg(
        F.sum("tokens").alias("tokens"), F.avg("latency").alias("avg_latency"), F.count(F.lit(1)).alias("operations"))


def provider_health(log: DataFrame) -> DataFrame:
    return log.groupBy("provider").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(~F.col("success")).alias("failures"),
        (F.count_if(F.col("success")) / F.count(F.lit(1))).alias("success_rate"), F.avg("latency").alias("avg_latency"))


def latest(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.desc("logged_at"), F.desc("op_id")).limit(n)
