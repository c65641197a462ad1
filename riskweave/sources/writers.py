"""Sinks, bulk append and ingest."""

from __future__ import annotations

import time
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.normalize import accepted, normalise
from riskweave.operators.relational import last_per_key
from riskweave.sources import readers


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
    files: int | None = None, max_records_per_file: int | None = None,
) -> None:
    """Snappy parquet; ``files`` bounds the file count, ``max_records_per_file`` the file size."""
    if files:
        df = df.repartition(files)  # coalesce would also narrow what is computed upstream
    writer = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode, properties or {})


def append_new(
    spark: SparkSession, batch: DataFrame, path: str, key: str = "transaction_id", on_duplicate: str = "fail"
) -> None:
    """Append a batch of rows with new keys.

    By default any repeated key stops the whole batch and nothing is written. With
    ``on_duplicate="skip"`` stored keys are left out and of repeated ones the highest row is taken.
    """
    stored = spark.read.parquet(path).select(key)
    if on_duplicate == "fail":
        repeated = batch.groupBy(key).count().where("count > 1").select(key)
        clash = batch.select(key).join(stored, key, "left_semi").unionByName(repeated)
        if not clash.isEmpty():
            raise ValueError(f"duplicate {key} in batch, nothing written")
        fresh = batch
    else:
        fresh = last_per_key(batch, key).join(stored, key, "left_anti")
    fresh.write.mode("append").parquet(path)


@dataclass(frozen=True)
class IngestResult:
    path: str
    format: str | None
    read: int
    normalised: int
    saved: int
    success: bool
    duration: float
    error: str | None = None


_READERS = {"CSV": readers.read_raw_csv, "JSON": readers.read_raw_json, "FIXED_WIDTH": readers.read_fixed_width}


def ingest(spark: SparkSession, path: str, target: str, ingest_ts: str, source_format: str | None = None) -> IngestResult:
    """Read, normalise and store in one pass; the counts are observed while writing.

    What is wrong with the input (unknown format, missing or broken file) is the result;
    any other error is raised.
    """
    start, kind = time.monotonic(), None

    def result(read: int = 0, normalised: int = 0, saved: int = 0, error: str | None = None) -> IngestResult:
        return IngestResult(path, kind, read, normalised, saved, error is None, time.monotonic() - start, error)

    try:
        kind = source_format or readers.detect_format(path)
        if kind not in _READERS:
            raise ValueError(f"Unsupported format: {kind}")
    except ValueError as problem:
        return result(error=str(problem))
    seen, stored = Observation("ingest"), Observation("store")
    try:
        rows = normalise(_READERS[kind](spark, path), kind, ingest_ts).observe(
            seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("reject_reason").isNull()).alias("normalised"))
        accepted(rows).observe(stored, F.count(F.lit(1)).alias("saved")).write.mode("append").parquet(target)
    except (PySparkException, Py4JError, ValueError) as problem:
        lines = [x.strip() for x in str(problem).splitlines() if x.strip()]
        return result(error=next((x for x in lines if "ValueError: " in x), lines[0] if lines else "failed"))
    counts = seen.get
    return result(counts["read"], counts["normalised"], stored.get["saved"])


def ingest_folder(spark: SparkSession, root: str, target: str, ingest_ts: str) -> list[IngestResult]:
    """Ingest every supported file below ``root``, one after the other; a broken file does not stop the next."""
    paths = [r["path"] for r in readers.list_files(spark, root).select("path").orderBy("path").toLocalIterator()]
    return [ingest(spark, p, target, ingest_ts) for p in paths if p.lower().endswith(tuple(readers.EXTENSIONS))]


def import_status(processed: Column, succeeded: Column, finished: Column) -> Column:
    return (
        F.when(~finished, "IN_PROGRESS")
        .when((succeeded == 0) & (processed > 0), "FAILED")
        .when(succeeded < processed, "PARTIAL")
        .otherwise("COMPLETED"))


def import_log(runs: DataFrame) -> DataFrame:
    """Log rows from (source, processed, succeeded, started_at, finished_at)."""
    return runs.select(
        "source", F.col("processed").alias("records_processed"), F.col("succeeded").alias("records_success"),
        (F.col("processed") - F.col("succeeded")).alias("records_failed"), "started_at", "finished_at",
        (F.unix_seconds("finished_at") - F.unix_seconds("started_at")).alias("duration_seconds"),
        import_status(F.col("processed"), F.col("succeeded"), F.col("finished_at").isNotNull()).alias("status"))


def export_by_day(df: DataFrame, path: str, start: str | None = None, end: str | None = None) -> None:
    """Append ``[start, end)`` below year/month/day folders."""
    if start:
        df = df.where(F.col("transaction_date") >= F.lit(start).cast("timestamp"))
    if end:
        df = df.where(F.col("transaction_date") < F.lit(end).cast("timestamp"))
    dated = df.withColumns({
        "year": F.year("transaction_date"), "month": F.month("transaction_date"), "day": F.dayofmonth("transaction_date")})
    # REBALANCE lets adaptive execution split a hot day over several writers and
    # merge quiet days, so neither one task nor many tiny files result.
    dated.hint("rebalance", "year", "month", "day").write.mode("append").option(
        "maxRecordsPerFile", 1_000_000).partitionBy("year", "month", "day").parquet(path)


def process_day(spark: SparkSession, source: str, target: str, year: int, month: int, day: int) -> None:
    """Fraud report of one day partition, replacing only that day of the target."""
    from riskweave.operators.detectors import scored_transactions

    rows = readers.read_partitions(spark, source, {"year": year, "month": month, "day": day})
    report = scored_transactions(rows).withColumns({"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)})
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year", "month", "day").parquet(target)


def save_monitoring(path: str, metrics: DataFrame, predictions: DataFrame, summary: DataFrame) -> None:
    for name, df in (("metrics", metrics), ("predictions", predictions), ("summary", summary)):
        df.write.mode("overwrite").json(f"{path}/{name}")


def save_corpus(path: str, **tables: DataFrame) -> None:
    """Indexed corpus as parquet tables, e.g. chunks, idf and weights or vectors."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_corpus(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
