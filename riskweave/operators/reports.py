"""Risk dashboard, deviation check, compliance extract and validation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.hybrid import newest


def risk_dashboard(
    profiles: DataFrame, transactions: DataFrame, alerts: DataFrame, reports: DataFrame, as_of: str,
    days: int = 30, as_written: bool = False,
) -> DataFrame:
    """Profile with its recent transactions and alerts, each aggregated before the join.

    ``as_written`` reproduces the fan-out of joining both sides first: transaction
    count and volume are repeated once per alert of the customer.
    """
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")
    tx = transactions.where(F.col("transaction_date") >= since).groupBy("customer_id").agg(
        F.count("transaction_id").alias("n"), F.sum("amount").alias("volume"), F.avg("amount").alias("mean"))
    severity = F.col("severity")
    # One row per alert first: counting distinct ids five ways would multiply the alerts.
    each = alerts.where(F.col("created_at") >= since).groupBy("customer_id", "alert_id").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_or(severity == "CRITICAL").alias("critical"), F.bool_or(severity == "HIGH").alias("high"),
        F.bool_or(F.col("status") == "PENDING").alias("pending"))
    named = F.col("alert_id").isNotNull()
    al = each.groupBy("customer_id").agg(
        F.sum("rows").alias("alert_rows"), F.count("alert_id").alias("total_alerts"),
        F.count_if(named & (F.col("critical") | F.col("high"))).alias("critical_alerts"),
        F.count_if(named & F.col("pending")).alias("pending_alerts"),
        F.count_if(named & F.col("critical")).alias("_critical"), F.count_if(named & F.col("high")).alias("_high"))
    filed = reports.where("filed_with_regulator").select("customer_id", F.lit(True).alias("_filed")).distinct()
    repeat = F.greatest(F.coalesce("alert_rows", F.lit(0)), F.lit(1)) if as_written else F.lit(1)
    level = (
        F.when(F.col("_critical") > 0, "CRITICAL").when(F.col("_high") > 2, "HIGH")
        .when(F.col("total_alerts") > 5, "MEDIUM").otherwise("LOW"))

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    return (
        profiles.join(tx, "customer_id", "left").join(al, "customer_id", "left").join(filed, "customer_id", "left")
        .select(
            "customer_id", "business_type", "expected_monthly_volume", "risk_indicators",
            (zero("n") * repeat).alias("total_transactions"),
            (F.coalesce("volume", F.lit(0.0)) * repeat).alias("total_volume"),
            F.coalesce("mean", F.lit(0.0)).alias("avg_transaction"),
            zero("total_alerts").alias("total_alerts"), zero("critical_alerts").alias("critical_alerts"),
            zero("pending_alerts").alias("pending_alerts"), level.alias("overall_risk_level"),
            F.coalesce("_filed", F.lit(False)).alias("sar_filed"), F.col("last_updated").alias("profile_last_updated"))
    )


def deviation_check(candidates: DataFrame, transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Verdict for every (customer_id, amount); an absent limit leaves the z-score to decide."""
    money = F.col("amount").cast("decimal(12,2)")
    stats = transactions.groupBy("customer_id").agg(
        (F.sum(money) / F.count(money)).cast("decimal(15,2)").alias("mean"),
        F.round(F.stddev("amount"), 2).alias("deviation"))
    limits = profiles.select("customer_id", F.col("expected_max_amount").alias("limit"))
    z = F.when(F.col("deviation") > 0, F.round(F.abs((F.col("amount") - F.col("mean").cast("double")) / F.col("deviation")), 2)).otherwise(0.0)
    amount, limit = F.col("amount"), F.col("limit")
    severe = (amount > limit * 2) | (F.col("z_score") > 4)
    mild = (amount > limit) | (F.col("z_score") > 3)

    def pick(a: object, b: object, c: object) -> Column:
        return F.when(severe, a).when(mild, b).otherwise(c)

    return (
        candidates.join(stats, "customer_id", "left").join(limits, "customer_id", "left").withColumn("z_score", z)
        .select(
            *candidates.columns, "z_score",
            pick(True, True, False).alias("is_anomaly"),
            pick("CRITICAL_AMOUNT_ANOMALY", "AMOUNT_ANOMALY", "NORMAL").alias("deviation_type"),
            pick("BLOCK_TRANSACTION_IMMEDIATE_REVIEW", "MANUAL_REVIEW_REQUIRED", "APPROVE_TRANSACTION").alias("recommendation"))
    )


def compliance_rows(transactions: DataFrame, alerts: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` suspicious transactions of every customer."""
    severe = alerts.where(F.col("severity").isin("HIGH", "CRITICAL")).select("transaction_id", "alert_id", "severity", "description")
    return newest(transactions.join(severe, "transaction_id"), n)


def compliance_reports(transactions: DataFrame, alerts: DataFrame, report_type: str, stamp: str, n: int = 20) -> DataFrame:
    return compliance_rows(transactions, alerts, n).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount"),
    ).withColumn("report_id", F.concat_ws("_", F.lit(report_type), F.col("customer_id").cast("string"), F.lit(stamp)))


def completeness(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("amount", "customer_id", "transaction_date")])


def integrity(df: DataFrame, as_of: str) -> DataFrame:
    """Repeated ids, negative amounts and future dates as one row.

    Both counts come from one aggregation per id, so the table is read once.
    """
    per_id = df.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount") < 0).alias("negative"),
        F.count_if(F.col("transaction_date") > F.lit(as_of).cast("timestamp")).alias("future"))
    return per_id.agg(
        F.count_if((F.col("n") > 1) & F.col("transaction_id").isNotNull()).alias("duplicate_ids"),
        F.sum("negative").alias("negative_amounts"), F.sum("future").alias("future_dates"))


def quality_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.round(F.avg("amount"), 2).alias("average_amount"),
        F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"),
        F.round(100 * F.count_if(F.col("is_fraud")) / F.count(F.lit(1)), 2).alias("fraud_rate_pct"))


def source_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("source_system").agg(F.count(F.lit(1)).alias("transactions"))


def validation_report(df: DataFrame, top: int = 10) -> DataFrame:
    """Long (section, key, value) table; values are rounded to 2 places."""
    day = F.unix_date(F.col("transaction_date").cast("date"))
    measures = {
        "summary|total": F.count(F.lit(1)), "summary|fraudulent": F.count_if(F.col("is_fraud")),
        "summary|customers": F.countDistinct("customer_id"),
        "dates|first_day": F.min(day), "dates|last_day": F.max(day),
        "amounts|sum": F.sum("amount"), "amounts|avg": F.avg("amount"), "amounts|min": F.min("amount"), "amounts|max": F.max("amount")}
    whole = df.agg(*[F.round(m.cast("double"), 2).alias(n) for n, m in measures.items()]).unpivot([], list(measures), "name", "value")
    whole = whole.select(F.split_part("name", F.lit("|"), F.lit(1)).alias("section"), F.split_part("name", F.lit("|"), F.lit(2)).alias("key"), "value")
    by_source = df.groupBy("source_system").agg(F.count(F.lit(1)).cast("double").alias("count"), F.round(F.avg("amount"), 2).alias("avg"))
    sources = by_source.unpivot(["source_system"], ["count", "avg"], "name", "value").select(
        F.lit("sources").alias("section"), F.concat_ws(":", "source_system", "name").alias("key"), "value")
    merchants = df.where("merchant_name IS NOT NULL").groupBy("merchant_name").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "merchant_name").limit(top).select(
        F.lit("merchants").alias("section"), F.col("merchant_name").alias("key"), F.col("n").cast("double").alias("value"))
    return whole.unionByName(sources).unionByName(merchants)


def import_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_transactions"), F.count_if(F.col("is_fraud")).alias("fraud_transactions"))
