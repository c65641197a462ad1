"""Streaming detectors.

High value and sliding-window velocity run on the built-in engine. The detectors
that need the history of a customer use its keyed state, event-time timeouts and
watermark. Count windows over all rows append the partial aggregates of a micro-batch
under its number, so a batch that is retried after a failure overwrites its own and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskweave.functions.ordered import deviation_of, merged_moments, previous_event, prior_moments, row_index, whole_seconds
from riskweave.operators.detectors import tier

ALERT = ["transaction_id", "customer_id", "event_time", "risk_factor", "risk_score"]


def high_value_alerts(df: DataFrame, threshold: float = 5000.0) -> DataFrame:
    return df.where(F.col("amount") > threshold).withColumns({
        "alert_timestamp": F.current_timestamp(), "risk_factor": F.lit("HIGH_VALUE"), "risk_score": F.lit(25.0)})


def velocity_windows(df: DataFrame, watermark: str = "30 minutes", length: str = "1 hour", slide: str = "10 minutes", threshold: int = 3) -> DataFrame:
    """Sliding windows per customer with at least ``threshold`` rows: count, sum, score."""
    counted = (
        df.withWatermark("transaction_date", watermark)
        .groupBy(F.window("transaction_date", length, slide), "customer_id")
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount")))
    return counted.where(F.col("transaction_count") >= threshold).select(
        "customer_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "transaction_count", "total_amount", F.lit("HIGH_VELOCITY").alias("risk_factor"),
        F.when(F.col("transaction_count") >= 5, 30.0).otherwise(20.0).alias("risk_score"))


def window_members(windows: DataFrame, transactions: DataFrame, length: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Transaction ids of the alert windows, one row each, so no window is collected into a list."""
    placed = transactions.select("customer_id", "transaction_id", F.window("transaction_date", length, slide).alias("w")).select(
        "customer_id", "transaction_id", F.col("w.start").alias("window_start"))
    return placed.join(windows.select("customer_id", "window_start"), ["customer_id", "window_start"])


def alert_level(score: Column) -> Column:
    return tier(score, [(25, "HIGH"), (15, "MEDIUM")], "LOW")


def union_alerts(*alerts: DataFrame) -> DataFrame:
    """Alerts on one schema, classified."""
    out = alerts[0].select(*ALERT)
    for more in alerts[1:]:
        out = out.unionByName(more.select(*ALERT))
    return out.withColumn("risk_level", alert_level(F.col("risk_score")))


def within_watermark(df: DataFrame, watermark: str) -> DataFrame:
    """Rows older than the watermark are dropped by the engine, and no others.

    Only a stateful operator drops late rows, so each row gets a name of its own to be distinct by.
    """
    named = df.withColumn("_row", F.expr("uuid()")).withWatermark("transaction_date", watermark)
    return named.dropDuplicatesWithinWatermark(["_row"]).drop("_row")


def late_rows(query: StreamingQuery) -> int:
    """Rows the engine has dropped behind the watermark, over the progress it still remembers."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


@dataclass(frozen=True)
class EventTimeDetector:
    """Scores the rows of a customer in event-time order, on the engine's keyed state.

    The state of a customer is the summary of the rows scored so far and the rows that the
    watermark (largest event time seen less ``delay_seconds``) has not passed yet. Customers are dealt by hash into
    ``buckets``, each with one state, as one array per field: the engine calls Python once for a bucket and not once for
    a customer. A stream of many customers needs more of them, a checkpoint keeps the number it began with. A row that arrives behind the watermark is late and dropped. An
    event-time timeout is set to the earliest waiting row; when it runs out, or when other
    rows of the bucket arrive, ``step`` scores what the watermark has passed. State, timeouts,
    watermark and recovery are the engine's: a stopped stream goes on from its checkpoint.
    ``rest`` scores the rows that still wait with the batch operators, at the end of a stream.

    Rows of one customer are scored by one task of a batch, one after another in constant
    memory beside the rows themselves; only buckets with new or passed rows are visited.
    """

    delay_seconds: int
    #: Fields of the summary and of a waiting row besides its time and id, as DDL.
    summary: str
    fields: dict[str, str]
    found: str
    step: Callable[[tuple | None, list[tuple]], tuple[tuple, list[tuple]]]
    finish: Callable[[DataFrame], DataFrame]
    score: Callable[[DataFrame, DataFrame | None], DataFrame]
    buckets: int = 512

    def alerts(self, df: DataFrame) -> DataFrame:
        """Alerts of a stream in append mode, as soon as the watermark has passed their rows."""
        kind = df.schema["customer_id"].dataType.simpleString()
        rows = df.withWatermark("transaction_date", f"{self.delay_seconds} seconds").select(
            F.pmod(F.hash("customer_id"), F.lit(self.buckets)).alias("_bucket"), F.col("customer_id").cast("string").alias("_who"),
            "transaction_date", F.unix_micros("transaction_date").alias("_at"), F.col("transaction_id").alias("_id"),
            *[F.col(name).cast(type_).alias(name) for name, type_ in self.fields.items()])
        found = rows.where("_at IS NOT NULL").groupBy("_bucket").applyInPandasWithState(
            self._visit(), f"_who string, _at bigint, _id bigint, {self.found}", self._state(kind), "append", GroupStateTimeout.EventTimeTimeout)
        return self.finish(found.withColumns({
            "customer_id": F.col("_who").cast(kind), "transaction_id": F.col("_id"), "event_time": F.timestamp_micros("_at")}).drop("_who"))

    def _state(self, kind: str) -> str:
        """Customers are strings in the state; ``_kind`` is always empty and tells the type of their ids."""
        summary = {"_known": "string", **dict(f.split() for f in self.summary.split(", "))}
        waiting = {"_who": "string", "_at": "bigint", "_id": "bigint", **self.fields}
        return ", ".join(f"{name} array<{kind}>" for name, kind in {**summary, **waiting, "_kind": kind}.items())

    def _visit(self) -> Callable:
        names, size, step = ["_who", "_at", "_id", *self.fields], self.summary.count(",") + 2, self.step
        columns = ["_who", "_at", "_id", *[f.split()[0] for f in self.found.split(", ")]]

        def visit(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            held = state.get if state.exists else None
            known = {row[0]: row[1:] for row in zip(*held[:size])} if held else {}
            passed = state.getCurrentWatermarkMs() * 1000
            waiting = list(zip(*held[size:-1])) if held else []
            for batch in batches:  # plain lists: most batches of a customer have a row or two
                rows = zip(*[batch[name].tolist() for name in names])
                waiting += [(*row[:3], *[None if v != v else v for v in row[3:]]) for row in rows if row[1] > passed]
            waiting.sort(key=lambda row: (row[0] is not None, row[0] or "", row[1], row[2]))
            left, alerts = [], []
            for who, rows in groupby(waiting, key=lambda row: row[0]):
                rows = list(rows)
                due = [row[1:] for row in rows if row[1] <= passed]
                left += rows[len(due):]
                if due:
                    known[who], more = step(known.get(who), due)
                    alerts += [(who, *alert) for alert in more]
            summaries = zip(*((who, *summary) for who, summary in known.items())) if known else [()] * size
            state.update((*map(list, summaries), *map(list, zip(*left) if left else [()] * len(names)), []))
            if left:
                state.setTimeoutTimestamp(max(min(row[1] for row in left) // 1000, passed // 1000 + 1))
            if alerts:
                yield pd.DataFrame(alerts, columns=columns)
        return visit

    def rest(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """Alerts of the rows that wait in the state of a stopped stream."""
        state = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
        summary, columns = [f.split()[0] for f in self.summary.split(", ")], ["_who", "_at", "_id", *self.fields]
        kind = state.schema["_kind"].dataType.elementType

        def rows(who: str, names: list[str]) -> DataFrame:
            each = state.select(F.explode(F.arrays_zip(*names)).alias("_row")).select("_row.*")
            return each.withColumn("customer_id", F.col(who).cast(kind)).drop(who)

        waiting = rows("_who", columns).withColumnsRenamed({"_id": "transaction_id"}).withColumn("transaction_date", F.timestamp_micros("_at")).drop("_at")
        return self.score(waiting, rows("_known", ["_known", *summary]))


def _step_moments(summary: tuple | None, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
    """Compare each row with the moments of strictly earlier rows, then add it; rows of one instant are added together."""
    n, mean, m2, low, high = summary or (0, 0.0, 0.0, None, None)
    alerts = []
    for at, same in groupby(rows, key=lambda row: row[0]):
        same = [row for row in same if row[2] is not None]
        if n > 1 and low != high and m2 > 0:
            deviation = (m2 / (n - 1)) ** 0.5
            alerts += [(at, name, v, abs(v - mean) / deviation) for _, name, v in same if abs(v - mean) >= 2 * deviation]
        for _, _, v in same:
            n += 1
            gap = v - mean
            mean += gap / n
            m2 += gap * (v - mean)
            low, high = (v, v) if low is None else (min(low, v), max(high, v))
    return (n, mean, m2, low, high), alerts


def _finish_moments(found: DataFrame) -> DataFrame:
    return found.where("z_score >= 2").select(
        "transaction_id", "customer_id", "event_time", "amount", "z_score",
        F.lit("STATISTICAL_ANOMALY").alias("risk_factor"), tier(F.col("z_score"), [(3, 25.0)], 15.0).alias("risk_score"))


def _score_moments(ready: DataFrame, summary: DataFrame | None) -> DataFrame:
    """|amount - mean| / sample deviation of strictly earlier rows, kept from 2 up."""
    rows = prior_moments(ready, "customer_id", "transaction_date", "amount")
    if summary is None:
        n, mean, m2, low, high = (F.col(f"prior_{c}") for c in ("n", "mean", "m2", "min", "max"))
    else:
        rows = rows.join(summary, "customer_id", "left")
        n, mean, m2 = merged_moments(*[F.col(c) for c in ("prior_n", "prior_mean", "prior_m2", "n", "mean", "m2")])
        low, high = F.least("prior_min", "min"), F.greatest("prior_max", "max")
    deviation = deviation_of(n, m2, low, high, sample=True)
    z = F.when(deviation > 0, F.abs(F.col("amount") - mean) / deviation).otherwise(F.lit(0.0))
    return _finish_moments(rows.withColumns({"z_score": z, "event_time": F.col("transaction_date")}))


def statistical_detector(delay_seconds: int = 1800) -> EventTimeDetector:
    return EventTimeDetector(
        delay_seconds, "n bigint, mean double, m2 double, min double, max double", {"amount": "double"}, "amount double, z_score double",
        _step_moments, _finish_moments, _score_moments)


def _step_places(max_hours: float) -> Callable[[tuple | None, list[tuple]], tuple[tuple, list[tuple]]]:
    def step(summary: tuple | None, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
        """Compare the country of each row with that of the row before."""
        alerts = []
        for at, name, country in rows:
            if summary is not None and None not in (country, summary[1]) and country != summary[1]:
                hours = (at // 1_000_000 - summary[0] // 1_000_000) / 3600
                if hours < max_hours:
                    alerts.append((at, name, summary[1], country, hours))
            summary = at, country
        return summary, alerts
    return step


def _finish_places(found: DataFrame) -> DataFrame:
    return found.select(
        "transaction_id", "customer_id", "event_time", "prev_country", "location_country", "time_diff_hours",
        F.lit("GEOGRAPHIC_ANOMALY").alias("risk_factor"), F.lit(20.0).alias("risk_score"))


def _score_places(max_hours: float) -> Callable[[DataFrame, DataFrame | None], DataFrame]:
    def score(ready: DataFrame, summary: DataFrame | None) -> DataFrame:
        rows = previous_event(ready, "customer_id", "transaction_date", "transaction_id", ["location_country", "transaction_date"])
        place, since = F.col("previous.location_country"), F.unix_seconds(F.col("previous.transaction_date"))
        if summary is not None:
            rows = rows.join(summary, "customer_id", "left")
            place = F.when(F.col("previous").isNull(), F.col("last_country")).otherwise(place)
            since = F.when(F.col("previous").isNull(), F.floor(F.col("last_at") / 1_000_000)).otherwise(since)
        hours = (whole_seconds("transaction_date") - since) / 3600
        return _finish_places(rows.where((F.col("location_country") != place) & (hours < max_hours)).withColumns({
            "event_time": F.col("transaction_date"), "prev_country": place, "time_diff_hours": hours}))
    return score


def geographic_detector(delay_seconds: int = 3600, max_hours: float = 6.0) -> EventTimeDetector:
    return EventTimeDetector(
        delay_seconds, "last_at bigint, last_country string", {"location_country": "string"},
        "prev_country string, location_country string, time_diff_hours double", _step_places(max_hours), _finish_places, _score_places(max_hours))


@dataclass(frozen=True)
class CountWindows:
    """Tumbling windows of ``size`` rows in arrival order; within a batch rows are ordered by (ts, id).

    A batch is reduced to one partial aggregate per window it touches and the number of rows
    seen up to its end, which is all that the next batch reads: rows are neither kept nor written
    again. ``measures`` are aggregates of rows, ``merge`` says how their partial values are put together
    (``sum`` where nothing is said). ``closed`` are the windows that are full, ``every`` has the open one too.
    """

    state: str
    output: str
    size: int
    measures: dict[str, Column]
    merge: dict[str, Callable[[str], Column]]
    ts: str = "transaction_date"
    tiebreak: str = "transaction_id"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, f"{self.output}/batch_id={batch_id}"
        offset = spark.read.parquet(f"{self.state}/batch_id={batch_id - 1}").first()["seen"] if batch_id > 0 else 0
        placed = row_index(batch, self.ts, self.tiebreak).withColumn("window_no", F.floor((F.col("row_index") + offset) / self.size))
        partial = placed.groupBy("window_no").agg(F.count(F.lit(1)).alias("_rows"), *[m.alias(n) for n, m in self.measures.items()])
        partial.write.mode("overwrite").parquet(part)
        seen = spark.read.schema(partial.schema).parquet(part).agg((F.coalesce(F.sum("_rows"), F.lit(0)) + offset).alias("seen"))
        seen.write.mode("overwrite").parquet(f"{self.state}/batch_id={batch_id}")

    def every(self, spark: SparkSession) -> DataFrame:
        partial = spark.read.parquet(self.output).drop("batch_id")
        return partial.groupBy("window_no").agg(
            F.sum("_rows").alias("_rows"), *[self.merge.get(n, F.sum)(n).alias(n) for n in self.measures])

    def closed(self, spark: SparkSession) -> DataFrame:
        return self.every(spark).where(F.col("_rows") == self.size)


def count_windows(df: DataFrame, size: int, measures: dict[str, Column], ts: str = "transaction_date", tiebreak: str = "transaction_id") -> DataFrame:
    """Batch form of :class:`CountWindows`, the short last window included."""
    placed = row_index(df, ts, tiebreak).withColumn("window_no", F.floor(F.col("row_index") / size))
    return placed.groupBy("window_no").agg(*[m.alias(n) for n, m in measures.items()])
