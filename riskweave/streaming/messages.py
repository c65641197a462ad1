"""Message decoding and streaming sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_messages(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Streaming message source with a binary ``value``, e.g. "kafka" with
    ``kafka.bootstrap.servers`` and ``subscribe``; the connector is the cluster's."""
    return spark.readStream.format(source).options(**options).load()


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Payload bytes to columns; a payload that is not JSON gives null columns."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def encode(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def _start(writer: object, every: str | None) -> StreamingQuery:
    """Run at an interval, or over what is there and then stop when ``every`` is None."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def write_messages(df: DataFrame, sink: str, checkpoint: str, every: str | None = "5 seconds", **options: str) -> StreamingQuery:
    writer = encode(df).writeStream.format(sink).outputMode("append").options(**options).option("checkpointLocation", checkpoint)
    return _start(writer, every)


def write_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """``foreachBatch``; ``write`` must give the same result when a batch id comes again."""
    return _start(df.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint), every)


def jdbc_batches(url: str, table: str, **properties: str) -> Callable[[DataFrame, int], None]:
    """Append each batch once: rows carry ``batch_id`` and a batch already stored is skipped."""
    def write(batch: DataFrame, batch_id: int) -> None:
        reader = batch.sparkSession.read.format("jdbc").options(url=url, **properties)
        stored = reader.option("query", f"SELECT batch_id FROM {table} WHERE batch_id = {int(batch_id)}").load()
        if stored.isEmpty():
            batch.withColumn("batch_id", F.lit(batch_id)).write.jdbc(url, table, "append", properties)
    return write


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """One folder per batch id, replaced when the batch comes again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def write_files(
    df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ("risk_level",), every: str | None = "1 minute"
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").options(path=path, checkpointLocation=checkpoint)
    return _start(writer.partitionBy(*partition_by) if partition_by else writer, every)


def write_console(df: DataFrame, every: str | None = "10 seconds", output_mode: str = "append") -> StreamingQuery:
    return _start(df.writeStream.format("console").option("truncate", False).outputMode(output_mode), every)


def write_memory(df: DataFrame, name: str, checkpoint: str, output_mode: str = "complete", every: str | None = None) -> StreamingQuery:
    """Debug sink held by the driver: meant for small aggregates."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(output_mode)
    return _start(writer if output_mode == "append" else writer.option("checkpointLocation", checkpoint), every)
