"""Rule score, blend with an external score, decisions and profile checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.ordered import trailing_count, whole_seconds
from riskweave.operators.detectors import tier
from riskweave.operators.relational import last_per_key

DAY = 86400


def recent_counts(df: DataFrame, hours: int = 24) -> DataFrame:
    """(customer_id, second, trailing): rows in the trailing window of event time, self included."""
    return trailing_count(df, "customer_id", "transaction_date", hours * 3600)


def with_recent_count(df: DataFrame, hours: int = 24) -> DataFrame:
    return df.withColumn("second", whole_seconds("transaction_date")).join(
        recent_counts(df, hours), ["customer_id", "second"], "left").drop("second").withColumnRenamed("trailing", "recent_count")


def recent_count_as_of(df: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Rows per customer in the last ``hours`` before a fixed instant."""
    end = F.lit(as_of).cast("timestamp")
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.where((F.col("transaction_date") >= start) & (F.col("transaction_date") <= end)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("recent_count"))


def unusual_merchant(name: Column) -> Column:
    lowered = F.lower(name)
    return name.isNull() | lowered.contains("unknown") | lowered.contains("test")


def rule_scored(df: DataFrame, busy_above: int = 10) -> DataFrame:
    """Add ``rule_score`` in 0..1. Only the seconds above the bound reach the join."""
    busy = recent_counts(df).where(F.col("trailing") > busy_above)
    hour = F.hour("transaction_date")

    def points(condition: Column, value: float) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    score = (
        points(F.col("amount") > 5000, 0.3) + points(unusual_merchant(F.col("merchant_name")), 0.2)
        + points(F.col("trailing").isNotNull(), 0.3) + points((hour >= 2) & (hour < 5), 0.2))
    return df.withColumn("second", whole_seconds("transaction_date")).join(busy, ["customer_id", "second"], "left").select(
        *df.columns, F.round(F.least(score, F.lit(1.0)), 10).alias("rule_score"))


def blended(rule_scored_df: DataFrame, scores: DataFrame) -> DataFrame:
    """60/40 mix where the rules are above 0.5 and an external score exists."""
    mixed = (F.col("rule_score") > 0.5) & F.col("external_score").isNotNull()
    return rule_scored_df.join(scores, "transaction_id", "left").withColumns({
        "final_score": F.round(F.when(mixed, 0.6 * F.col("rule_score") + 0.4 * F.col("external_score")).otherwise(F.col("rule_score")), 10),
        "method": F.when(mixed, "HYBRID_RULE_LLM").otherwise("RULE_BASED")})


def level4(score: Column) -> Column:
    return tier(score, [(0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM")], "LOW")


def level3(score: Column) -> Column:
    return F.when(score > 0.7, "HIGH").when(score > 0.4, "MEDIUM").otherwise("LOW")


def decision(score: Column) -> Column:
    return F.when(score > 0.7, "BLOCK").when(score > 0.5, "FLAG").otherwise("APPROVE")


def alert_rows(blended_df: DataFrame, evidence: DataFrame) -> DataFrame:
    """One alert per transaction; ``rules_triggered`` only where evidence rows exist.

    ``evidence`` holds (transaction_id, position, source).
    """
    sources = evidence.groupBy("transaction_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "source"))).alias("found"))
    rules = F.when(F.col("found").isNotNull(), F.concat(
        F.array(F.lit("RULE_BASED_DETECTION"), F.lit("LLM_ENHANCED_ANALYSIS")),
        F.transform("found", lambda e: F.concat(F.lit("DOCUMENT_EVIDENCE: "), e["source"]))))
    return blended_df.join(sources, "transaction_id", "left").select(
        "transaction_id", "customer_id", F.round(F.col("final_score") * 100, 2).alias("fraud_score"),
        level4(F.col("final_score")).alias("risk_level"), F.col("method").alias("alert_type"),
        rules.alias("rules_triggered"), F.lit("PENDING").alias("status"))


def newest(df: DataFrame, n: int, key: str = "customer_id") -> DataFrame:
    """Newest ``n`` rows per key. The row limit is applied in each task before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.desc("transaction_date"), F.desc("transaction_id"))
    return df.withColumn("row_number", F.row_number().over(w)).where(F.col("row_number") <= n)


def deviation_from_recent(df: DataFrame, n: int = 5) -> DataFrame:
    """(a - mean) / mean against the customer's newest ``n`` rows; 0 without a positive mean."""
    mean = newest(df, n).groupBy("customer_id").agg(F.avg("amount").alias("recent_mean"))
    ratio = (F.col("amount") - F.col("recent_mean")) / F.col("recent_mean")
    return df.join(mean, "customer_id", "left").withColumn(
        "deviation", F.when(F.col("recent_mean") > 0, ratio).otherwise(F.lit(0.0)))


def profile_gate(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """NO_PROFILE, VERIFY, EXCEEDS_EXPECTED or OK per transaction."""
    gate = (
        F.when(F.col("confidence_score").isNull(), "NO_PROFILE")
        .when(F.col("confidence_score") < 0.5, "VERIFY")
        .when(F.col("amount") > 2 * F.col("expected_monthly_volume"), "EXCEEDS_EXPECTED")
        .otherwise("OK"))
    wanted = profiles.select("customer_id", "confidence_score", "expected_monthly_volume")
    return df.join(wanted, "customer_id", "left").withColumn("gate", gate)


def upsert_alerts(stored: DataFrame, incoming: DataFrame, order: Sequence[str] = ("created_at",)) -> DataFrame:
    """New alerts by transaction_id; for known ones only score and description change.

    Of several incoming rows with one id the last by ``order`` counts.
    """
    new = last_per_key(incoming, "transaction_id", [c for c in order if c in incoming.columns])
    new = new.select([F.col(c).alias(f"n_{c}") for c in incoming.columns])
    joined = stored.join(new, stored["transaction_id"] == new["n_transaction_id"], "full_outer")
    known = F.col("transaction_id").isNotNull() & F.col("n_transaction_id").isNotNull()
    replaced = ("fraud_score", "description")
    return joined.select(*[
        F.when(known, F.col(f"n_{c}")).otherwise(F.coalesce(c, f"n_{c}")).alias(c) if c in replaced
        else F.coalesce(c, f"n_{c}").alias(c)
        for c in stored.columns])


PROFILE_COLUMNS = (
    "customer_id", "business_type", "expected_monthly_volume", "expected_max_amount", "confidence_score", "kyc_document_source")


def enriched_profiles(profiles: DataFrame, keys: DataFrame) -> DataFrame:
    return profiles.select(*PROFILE_COLUMNS).join(keys.select("customer_id").distinct(), "customer_id", "left_semi")
