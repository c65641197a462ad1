"""Lookups and bulk changes on the transaction and customer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order``, ties by the remaining columns. Rows without a key stay as they are.

    A maximum folds in every task before the shuffle, so a key with many rows is no burden.
    """
    rest = [c for c in df.columns if c not in order and c != key]
    last = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(*[F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in df.columns]).unionByName(
        df.where(F.col(key).isNull()))


def find_by_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def customer_history(df: DataFrame, customers: DataFrame) -> DataFrame:
    return find_by_keys(df, customers, "customer_id").orderBy(F.desc("transaction_date"), F.desc("transaction_id"))


def in_date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Both ends included."""
    bounds = [F.lit(x).cast("timestamp") for x in (start, end)]
    return df.where(F.col("transaction_date").between(*bounds)).orderBy(F.desc("transaction_date"), F.desc("transaction_id"))


def fraudulent(df: DataFrame) -> DataFrame:
    return df.where("is_fraud").orderBy(F.desc("transaction_date"), F.desc("transaction_id"))


def update_status(df: DataFrame, updates: DataFrame, updated_at: str, key: str = "transaction_id") -> DataFrame:
    """``updates``: (key, new_status); of repeated keys the highest status counts."""
    hit = F.col("new_status").isNotNull()
    return df.join(last_per_key(updates.select(key, "new_status"), key), key, "left").withColumns({
        "status": F.coalesce("new_status", "status"),
        "updated_at": F.when(hit, F.lit(updated_at).cast("timestamp"))}).drop("new_status")


def delete_by_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def customers_newest_first(customers: DataFrame) -> DataFrame:
    return customers.orderBy(F.desc("account_created_date"), F.desc("customer_id"))


def customers_at_level(customers: DataFrame, level: str) -> DataFrame:
    return customers.where(F.col("risk_level") == level).orderBy(F.desc("lifetime_value"), "customer_id")


def insert_new(customers: DataFrame, incoming: DataFrame) -> DataFrame:
    """New customers are added once, however often they are named; of repeated ids the highest row counts."""
    return customers.unionByName(last_per_key(incoming, "customer_id").join(customers.select("customer_id"), "customer_id", "left_anti"))


def update_attributes(customers: DataFrame, updates: DataFrame, columns: list[str]) -> DataFrame:
    """Overwrite ``columns`` for the customers named in ``updates``; others stay, of repeated ids the highest row counts."""
    named = last_per_key(updates.select("customer_id", *columns), "customer_id").select("customer_id", *[F.col(c).alias(f"n_{c}") for c in columns], F.lit(True).alias("_hit"))
    return customers.join(named, "customer_id", "left").select(*[
        F.when(F.col("_hit"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in customers.columns])


def roll_up(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Add a batch of transactions to the customers' running totals."""
    delta = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("value"), F.max("transaction_date").alias("last_transaction_date"))
    return customers.join(delta, "customer_id", "left").withColumns({
        "total_transactions": F.col("total_transactions") + F.coalesce("n", F.lit(0)),
        "lifetime_value": F.col("lifetime_value") + F.coalesce("value", F.lit(0.0))}).drop("n", "value")
