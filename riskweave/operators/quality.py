"""Data quality and batch functions over partitions."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

log = logging.getLogger(__name__)


def missing_values(df: DataFrame) -> DataFrame:
    """Per column: type, missing count and percentage, from one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return counted.unpivot(["_rows"], df.columns, "column", "missing").select(
        "column", kinds[F.col("column")].alias("data_type"), "missing",
        F.round(F.coalesce(F.try_divide(F.col("missing") * 100, "_rows"), F.lit(0.0)), 2).alias("missing_pct"))


def schema_issues(df: DataFrame, expected: StructType) -> list[str]:
    actual = {f.name: f.dataType for f in df.schema.fields}
    issues = []
    for field in expected.fields:
        if field.name not in actual:
            issues.append(f"Missing column: {field.name}")
        elif actual[field.name] != field.dataType:
            issues.append(
                f"Type mismatch for {field.name}: expected {field.dataType.simpleString()}, got {actual[field.name].simpleString()}")
    return issues


def column_types(df: DataFrame, expected: StructType) -> DataFrame:
    """Expected against actual type, with the rows that fill the column."""
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = list(dict.fromkeys([*actual, *wanted]))
    counted = df.agg(*[(F.count(F.col(c)) if c in actual else F.lit(0)).cast("bigint").alias(c) for c in names])

    def lookup(kinds: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for item in kinds.items() for x in item])[F.col("column")]

    rows = counted.unpivot([], names, "column", "filled")
    verdict = (
        F.when(F.col("expected").isNull(), "EXTRA").when(F.col("actual").isNull(), "MISSING")
        .when(F.col("expected") != F.col("actual"), "TYPE_MISMATCH").otherwise("OK"))
    return rows.select("column", "filled", lookup(wanted).alias("expected"), lookup(actual).alias("actual")).withColumn("verdict", verdict)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every set of equal rows (nulls equal). Copies fold before the shuffle."""
    sizes = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def quality_score(df: DataFrame, expected: StructType | None = None) -> DataFrame:
    """100 less penalties for missing values, duplicates and schema issues, at least 0."""
    issues = schema_issues(df, expected) if expected else []
    # Weighted by copies, the distinct rows give the missing counts as well, so
    # one aggregation over all columns answers both questions.
    sizes = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    facts = sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_n"))), F.lit(0)).alias(f"_m{i}") for i, c in enumerate(df.columns)])

    def share(name: str) -> Column:
        return F.coalesce(F.try_divide(F.col(name) * 100.0, F.col("total_rows")), F.lit(0.0))

    penalty = sum((F.least(share(f"_m{i}") / 2, F.lit(10.0)) for i in range(len(df.columns))), F.lit(0.0))
    score = F.lit(100.0) - penalty - F.least(share("duplicates"), F.lit(20.0)) - 5.0 * len(issues)
    return facts.select(
        "total_rows", "duplicates", F.lit(len(issues)).alias("schema_issues"),
        F.greatest(score, F.lit(0.0)).alias("quality_score"))


def apply_in_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str, skipped: Accumulator | None = None
) -> DataFrame:
    """Run a caller's pandas function on each Arrow batch of each partition.

    A batch that fails, or whose result does not fit ``schema``, is skipped and its rows
    are added to ``skipped``. Batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                result = fn(batch)[wanted.names]
                pa.RecordBatch.from_pandas(result, schema=arrow, preserve_index=False)
            except Exception:  # noqa: BLE001 - the contract is to skip it
                log.exception("batch of %d rows skipped", len(batch))
                if skipped is not None:
                    skipped.add(len(batch))
                continue
            yield result

    return df.mapInPandas(run, wanted)


@dataclass(frozen=True)
class BatchStats:
    total_rows: int
    processed_rows: int
    output_rows: int
    seconds: float
    rows_per_second: float
    output: str


def process_dataset(
    spark: SparkSession, source: str, target: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str, source_format: str = "parquet"
) -> BatchStats:
    """Read csv or parquet, apply ``fn`` batch by batch, write parquet and report. Retried tasks count skipped rows again."""
    start, seen, written = time.monotonic(), Observation("read"), Observation("written")
    reader = spark.read.options(header=True, inferSchema=True) if source_format == "csv" else spark.read
    rows = reader.format(source_format).load(source).observe(seen, F.count(F.lit(1)).alias("n"))
    skipped = spark.sparkContext.accumulator(0)
    apply_in_batches(rows, fn, schema, skipped).observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    seconds, total = time.monotonic() - start, seen.get["n"]
    done = total - skipped.value
    return BatchStats(total, done, written.get["n"], seconds, done / seconds if seconds else 0.0, target)


def parallel_map(df: DataFrame, column: str, fn: Callable[[object], object], result_type: DataType | str, output: str = "result") -> DataFrame:
    """A caller's Python function over a column in its row order; an item that fails gives null.

    One call per item: for user code only, wherever a built-in function cannot say it.
    """
    def safe(item: object) -> object:
        try:
            return fn(item)
        except Exception:  # noqa: BLE001 - the contract is null
            return None

    @F.pandas_udf(result_type)
    def run(items: pd.Series) -> pd.Series:
        return pd.Series([safe(i) for i in items], dtype="object")

    return df.withColumn(output, run(F.col(column)))
