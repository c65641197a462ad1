"""Descriptive statistics and time series (H1-H7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.ordered import row_index, values_at_ranks

BLOCK = "_block"


def _median_ranks(n: Column) -> list[Column]:
    return [F.floor((n - 1) / 2), F.floor(n / 2)]


def _measures(value: str) -> dict[str, Column]:
    v = F.col(value)
    return {
        "count": F.count(v), "sum": F.sum(v), "mean": F.avg(v), "min": F.min(v), "max": F.max(v),
        "std_dev": F.stddev_pop(v), "variance": F.var_pop(v)}


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, sum, mean, median, min, max and population deviation and variance.

    Without keys an empty input gives one row of zeros with no variance.
    """
    stats = df.groupBy(*keys).agg(*[m.alias(n) for n, m in _measures(value).items()])
    middle = values_at_ranks(df, keys, value, _median_ranks).select(
        *keys, ((F.get("values", F.lit(0)) + F.get("values", F.lit(1))) / 2).alias("median"))
    if keys:
        return stats.join(middle, list(keys), "left")
    with_median = stats.select("*", middle.select("median").scalar().alias("median"))
    return with_median.select(*[
        F.col(c) if c in ("count", "variance") else F.coalesce(c, F.lit(0.0)).alias(c) for c in with_median.columns])


def percentiles(df: DataFrame, value: str, points: Sequence[int] = (25, 50, 75, 95, 99)) -> DataFrame:
    """Nearest-rank percentiles as (percentile, value)."""
    def ranks(n: Column) -> list[Column]:
        return [F.greatest(F.lit(0), F.least(F.ceil(F.lit(p / 100.0) * n) - 1, n - 1)) for p in points]

    picked = values_at_ranks(df, [], value, ranks).where("size IS NOT NULL")
    return picked.select(F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in points]).alias("percentile"), F.col("values").alias("value"))).alias("p")).select(
        F.col("p.percentile").alias("percentile"), F.col("p.value").alias("value"))


def approximate_percentiles(df: DataFrame, value: str, points: Sequence[int] = (25, 50, 75, 95, 99), accuracy: int = 10000) -> DataFrame:
    """One-pass sketch for callers who accept a rank error of 1/accuracy."""
    sketch = F.approx_percentile(value, F.array(*[F.lit(p / 100.0) for p in points]), F.lit(accuracy))
    return df.agg(sketch.alias("values"))


def outliers(df: DataFrame, value: str, factor: float = 1.5, least_rows: int = 4) -> DataFrame:
    """Rows strictly outside the quartile fences; none below ``least_rows`` rows."""
    picked = values_at_ranks(df, [], value, lambda n: [F.floor(n * 0.25), F.floor(n * 0.75)]).where(F.col("size") >= least_rows)
    low, high = F.get("values", F.lit(0)), F.get("values", F.lit(1))
    fences = picked.select((low - factor * (high - low)).alias("low"), (high + factor * (high - low)).alias("high"))
    v = F.col(value)
    return df.where((v < fences.select("low").scalar()) | (v > fences.select("high").scalar()))


def moving_average(df: DataFrame, ts: str, tiebreak: str, value: str, window: int, block: int = 4096) -> DataFrame:
    """Mean of each full window of ``window`` rows in global order.

    Rows are numbered, cut into blocks and averaged block by block; a block also
    gets the last ``window - 1`` rows of the one before.
    """
    block = max(block, window)
    numbered = row_index(df, ts, tiebreak)
    place = F.pmod(F.col("row_index"), F.lit(block))
    lends = place > block - window
    copies = numbered.withColumn(
        "_lent", F.explode(F.when(lends, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).withColumn(BLOCK, F.floor(F.col("row_index") / block) + F.col("_lent"))
    w = Window.partitionBy(BLOCK).orderBy("row_index").rowsBetween(-(window - 1), 0)
    return copies.withColumn("moving_average", F.avg(value).over(w)).where(
        (F.col("_lent") == 0) & (F.col("row_index") >= window - 1)).drop("_lent", BLOCK)


def time_buckets(df: DataFrame, ts: str, value: str, hours: int = 24) -> DataFrame:
    """Statistics per bucket of ``hours``; ``bucket`` is its start in epoch milliseconds."""
    width = hours * 3_600_000
    start = (F.floor(F.unix_millis(F.col(ts).cast("timestamp")) / width) * width).cast("bigint")
    return describe(df.withColumn("bucket", start), value, ["bucket"])


def trend(df: DataFrame, ts: str, tiebreak: str, value: str) -> DataFrame:
    """Mean first difference against 5 % of the mean.

    The differences telescope, so only the first and last value are needed.
    """
    order = F.struct(ts, tiebreak)
    facts = df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
    step = F.try_divide(F.col("last") - F.col("first"), F.col("n") - 1)
    bound = F.col("mean") * 0.05
    return facts.select("n", step.alias("mean_difference"), (
        F.when(F.col("n") < 2, "INSUFFICIENT_DATA").when(step > bound, "INCREASING")
        .when(step < -bound, "DECREASING").otherwise("STABLE")).alias("trend"))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation over the rows where both are given; 0 for a constant or empty series."""
    df = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return df.agg(F.coalesce(F.try_divide(F.covar_pop(a, b), spread), F.lit(0.0)).alias("correlation"))
