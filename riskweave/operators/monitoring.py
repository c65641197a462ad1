"""Prediction logs, drift and model evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.ordered import linear_percentiles, running_totals

ORDER = ("logged_at", "prediction_id")


def _newest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in ORDER]).limit(n)


def _oldest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(*ORDER).limit(n)


def correct() -> Column:
    return F.when(F.col("ground_truth").isNotNull(), F.col("prediction").eqNullSafe(F.col("ground_truth")))


def hits() -> Column:
    return F.when(correct(), 1.0).when(correct().isNotNull(), 0.0)


def prediction_log(df: DataFrame, text: str = "input", limit: int = 200) -> DataFrame:
    return df.withColumn(text, F.substring(text, 1, limit)).withColumn("correct", correct())


def realtime_metrics(df: DataFrame, recent: int = 100) -> DataFrame:
    judged = df.withColumn("hit", hits())
    newest = _newest(judged.where("hit IS NOT NULL"), recent).agg(F.avg("hit").alias("a"))
    tails = linear_percentiles(df, [], "latency", {"p95": 0.95, "p99": 0.99})
    elapsed = (F.max(F.unix_micros("logged_at")) - F.min(F.unix_micros("logged_at"))) / 1e6
    zero = F.lit(0.0)
    return judged.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.try_divide(F.count(F.lit(1)), elapsed), zero).alias("throughput"),
        F.coalesce(F.avg("latency"), zero).alias("avg_latency"),
        F.avg("hit").alias("overall_accuracy"),
    ).select(
        "*", F.coalesce(tails.select("p95").scalar(), zero).alias("p95_latency"),
        F.coalesce(tails.select("p99").scalar(), zero).alias("p99_latency"),
        newest.scalar().alias("current_accuracy"))


def metric_rows(wide: DataFrame, model: str, metrics: Sequence[str], recorded_at: str) -> DataFrame:
    """Long (metric, value, tags, recorded_at) table from one column per metric."""
    return wide.unpivot([model], list(metrics), "name", "value").select(
        F.concat_ws("_", model, "name").alias("metric"), F.col("value").cast("double").alias("value"),
        F.create_map(F.lit("model"), F.col(model)).alias("tags"), F.lit(recorded_at).cast("timestamp").alias("recorded_at"))


def _kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value; the form of the series that converges is used."""
    x = F.sqrt(n * m / (n + m)) * statistic
    terms = F.sequence(F.lit(1), F.lit(100))
    upper = 2 * F.aggregate(terms, F.lit(0.0), lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * x * x))
    odd = lambda j: (2 * j - 1) * (2 * j - 1)
    lower = 1 - F.sqrt(F.lit(2 * 3.141592653589793)) / x * F.aggregate(
        terms, F.lit(0.0), lambda acc, j: acc + F.exp(-odd(j) * F.lit(3.141592653589793 ** 2) / (8 * x * x)))
    p = F.when(x <= 0, 1.0).when(x < 1.18, lower).otherwise(upper)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def data_drift(reference: DataFrame, current: DataFrame, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature.

    Both samples fold to counts per distinct value; the distribution functions are
    running totals over value slices, so no feature is sorted in one task. A feature
    without values on one side has statistic 0, p-value 1 and no drift.
    """
    def long(df: DataFrame, is_ref: int) -> DataFrame:
        wide = df.select(*[F.col(f).cast("double").alias(f) for f in features])
        return wide.unpivot([], list(features), "feature", "value").withColumn("is_ref", F.lit(is_ref))

    both = long(reference, 1).unionByName(long(current, 0))
    steps = running_totals(both, ["feature"], "value", {
        "ref": F.sum("is_ref"), "cur": F.sum(1 - F.col("is_ref"))})
    gap = F.abs(F.try_divide("ref", "all_ref") - F.try_divide("cur", "all_cur"))
    tested = steps.groupBy("feature").agg(
        F.coalesce(F.max(gap), F.lit(0.0)).alias("statistic"), F.max("all_ref").alias("n_ref"), F.max("all_cur").alias("n_cur"))
    return tested.withColumn(
        "p_value", _kolmogorov_tail(F.col("statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    ).withColumn("drifted", F.col("p_value") < alpha)


def drift_summary(tests: DataFrame, first: int = 5) -> DataFrame:
    """Any drift, how many features, and the first tests by feature name."""
    shown = F.slice(F.array_sort(F.collect_list(F.struct("feature", "statistic", "p_value"))), 1, first)
    return tests.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        F.count_if("drifted").alias("num_features_drifted"), F.count(F.lit(1)).alias("total_features"), shown.alias("drift_scores"))


def accuracy_drift(df: DataFrame, window: int = 100, threshold: float = 0.05) -> DataFrame:
    """Mean accuracy of the first against the last ``window`` judged predictions."""
    judged = df.withColumn("hit", hits()).where("hit IS NOT NULL")
    base = _oldest(judged, window).agg(F.avg("hit").alias("a"))
    recent = _newest(judged, window).agg(F.avg("hit").alias("a"))
    enough = F.col("judged") >= 2 * window
    out = judged.agg(F.count(F.lit(1)).alias("judged")).select(
        "judged", F.when(enough, base.scalar()).alias("baseline_accuracy"), F.when(enough, recent.scalar()).alias("recent_accuracy"))
    drop = F.col("baseline_accuracy") - F.col("recent_accuracy")
    return out.select(
        "*", drop.alias("drop"), F.coalesce(drop > threshold, F.lit(False)).alias("drift_detected"),
        F.when(~enough, "Insufficient data").alias("reason"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def _per_class(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class from the confusion cells."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("named"), hit.alias("hit")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("named"), F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    rates = sums.select(
        "label", "support", "hit",
        F.coalesce(F.try_divide("hit", "named"), zero).alias("precision"), F.coalesce(F.try_divide("hit", "support"), zero).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))


def _averages(classes: DataFrame) -> DataFrame:
    """One row: accuracy, macro and support-weighted means."""
    total = F.sum("support")
    measures = ("precision", "recall", "f1")
    return classes.agg(
        (F.sum("hit") / total).alias("accuracy"), total.alias("num_samples"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}") for m in measures])


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return _averages(_per_class(confusion(df, truth, predicted))).select(
        "accuracy", F.col("weighted_precision").alias("precision"), F.col("weighted_recall").alias("recall"),
        F.col("weighted_f1").alias("f1_score"), "num_samples")


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""
    classes = _per_class(confusion(df, truth, predicted))
    kinds = ("macro", "weighted")
    averages = _averages(classes).select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(m) for m in ("precision", "recall", "f1")], F.col("num_samples").alias("support")),
        *[F.struct(F.lit(f"{k} avg").alias("label"), *[F.col(f"{k}_{m}").alias(m) for m in ("precision", "recall", "f1")],
                   F.col("num_samples").alias("support")) for k in kinds],
    )).alias("a")).select("a.*")
    return classes.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support").unionByName(averages)


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    error = F.col(truth) - F.col(predicted)
    facts = df.agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(truth).alias("spread"))
    r2 = F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread")).when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return facts.select("mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2_score"))


def error_totals(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    wrong = F.col(truth) != F.col(predicted)
    return df.agg(
        F.count_if(wrong).alias("total_errors"), F.coalesce(F.try_divide(F.count_if(wrong), F.count(F.lit(1))), F.lit(0.0)).alias("error_rate"))


def sample_errors(df: DataFrame, truth: str, predicted: str, order: Sequence[str], text: str | None = None, k: int = 10) -> DataFrame:
    """First ``k`` wrong predictions, texts cut to 200 characters."""
    wrong = df.where(F.col(truth) != F.col(predicted)).orderBy(*order).limit(k)
    shown = [F.substring(text, 1, 200).alias("text")] if text else []
    return wrong.select(*order, F.col(truth).alias("true_label"), F.col(predicted).alias("predicted_label"), *shown)


def top_error_types(df: DataFrame, truth: str, predicted: str, k: int = 10) -> DataFrame:
    return df.where(F.col(truth) != F.col(predicted)).groupBy(
        F.col(truth).alias("true_label"), F.col(predicted).alias("predicted_label"),
    ).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "true_label", "predicted_label").limit(k)


def compare_models(df: DataFrame, arm: str = "arm", hit: str = "hit", latency: str = "latency") -> DataFrame:
    """Arms A and B side by side in one pass, with the recommendation."""
    def of(name: str, column: str) -> Column:
        return F.avg(F.when(F.col(arm) == name, F.col(column)))

    facts = df.agg(
        of("A", hit).alias("a_accuracy"), of("B", hit).alias("b_accuracy"), of("A", latency).alias("a_latency"), of("B", latency).alias("b_latency"),
        F.count_if(F.col(arm) == "A").alias("a_samples"), F.count_if(F.col(arm) == "B").alias("b_samples"))
    gain, slower = F.col("b_accuracy") - F.col("a_accuracy"), F.col("b_latency") - F.col("a_latency")
    both = (F.col("a_samples") > 0) & (F.col("b_samples") > 0)

    def percent(change: Column, base: str) -> Column:
        return F.when(F.col(base) > 0, change / F.col(base) * 100).otherwise(F.lit(0.0))

    return facts.select(
        "*", gain.alias("accuracy_improvement"), F.when(both, percent(gain, "a_accuracy")).alias("accuracy_improvement_pct"),
        (-slower).alias("latency_improvement"), F.when(both, percent(-slower, "a_latency")).alias("latency_improvement_pct"),
        F.when(~both, "Insufficient data for comparison").when((gain > 0.01) & (slower < 0.1), "Deploy Model B")
        .otherwise("Keep Model A").alias("recommendation"))


def metric_dashboard(metrics: DataFrame, ts: str, tiebreak: str, recent: int = 100) -> DataFrame:
    """Current value and mean, min, max, p95 of the newest rows per metric, with the total count.

    The row limit runs in every task before the shuffle, so the exact percentile
    sees at most ``recent`` rows per metric.
    """
    w = Window.partitionBy("metric").orderBy(F.desc(ts), F.desc(tiebreak))
    newest = metrics.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= recent)
    shown = newest.groupBy("metric").agg(
        F.min_by("value", "_n").alias("current"), F.avg("value").alias("avg"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.percentile("value", 0.95).alias("p95"))
    return shown.join(metrics.groupBy("metric").agg(F.count(F.lit(1)).alias("count")), "metric")
