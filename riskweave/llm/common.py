"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import scratch

#: White space as the contracts define it, and words as maximal runs of anything else.
SPACE = r"[\x20\x09-\x0D]"
NULL_ID = -(2 ** 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row.

    Higher-order functions work a captured expression out again for every element;
    a lambda variable is a plain reference.
    """
    return F.transform(F.array(value), body)[0]


def text_of(name: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def space_words(text: Column) -> Column:
    """Words between white space, in order, nothing else changed."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, label: str, **options: int) -> DataFrame:
    """Write below the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.options(compression="zstd", **options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove stored tables that no later step and no result reads; what was made from them is stored itself."""
    for df in stored:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Return what Arrow and the C library keep for later to the system: a Python worker outlives its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and the n+1 offsets of a list column; a null list counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return column.flatten().to_numpy(zero_copy_only=False), offsets


def slices(batch: pa.RecordBatch, text: int, most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch, bounded by rows and bytes of its text column; one text may be longer."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy().astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, min(low + most_rows, int(np.searchsorted(ends, before + most_bytes, side="right"))))
        yield batch.slice(low, high - low)
        low = high
