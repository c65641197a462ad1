"""Transaction and file sources."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.schemas import TRANSACTION

# Fixed values: (field, start, length), 0-based.
DEFAULT_LAYOUT = (
    ("transaction_id", 0, 20), ("customer_id", 20, 20), ("amount", 40, 20), ("transaction_date", 60, 20),
    ("merchant_name", 80, 30),
)
COMPACT_LAYOUT = (
    ("transaction_id", 0, 8), ("customer_id", 8, 9), ("date", 17, 8), ("time", 25, 4), ("amount_cents", 29, 9),
    ("currency", 38, 3), ("merchant_name", 41, 18), ("merchant_category", 59, 10), ("mcc", 69, 4),
    ("country", 73, 4), ("city", 77, 12),
)
EXTENSIONS = {".csv": "CSV", ".json": "JSON", ".txt": "FIXED_WIDTH"}


def read_transactions(
    spark: SparkSession, path: str, source_format: str = "parquet", schema: StructType | None = None, **options: str
) -> DataFrame:
    """``schema`` is the transaction schema if not given; CSV infers one then, which reads the files twice."""
    kind = source_format.lower()
    reader = spark.read.options(**options)
    if kind == "parquet":
        return reader.schema(schema or TRANSACTION).parquet(path)
    if kind == "csv":
        csv = spark.read.options(**{"header": "true", "dateFormat": "yyyy-MM-dd HH:mm:ss", **options})
        return (csv.schema(schema) if schema else csv.option("inferSchema", "true")).csv(path)
    if kind == "json":
        return reader.schema(schema or TRANSACTION).json(path)
    if kind == "jdbc":
        return read_jdbc(spark, path, **options)
    raise ValueError(f"Unsupported format: {source_format}")


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, lower: object = None, upper: object = None,
    partitions: int = 64, fetch_size: int = 10000, **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column it runs as many ranged reads."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str = "transactions", **kwargs: object) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def read_partitions(spark: SparkSession, path: str, partitions: dict[str, object] | None = None) -> DataFrame:
    """Parquet restricted to partition values; the equalities prune directories."""
    df = spark.read.parquet(path)
    for column, value in (partitions or {}).items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def read_csv(
    spark: SparkSession, path: str, header: bool = False, infer_schema: bool = False,
    date_format: str = "yyyy-MM-dd", timestamp_format: str = "yyyy-MM-dd HH:mm:ss", schema: StructType | str | None = None,
) -> DataFrame:
    reader = spark.read.options(
        header=header, inferSchema=infer_schema, dateFormat=date_format, timestampFormat=timestamp_format)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json(spark: SparkSession, path: str, multiline: bool = False, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema else reader).json(path)


def read_raw_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """All-string rows, cells trimmed, quotes doubled inside quoted cells, blank lines skipped.

    A quoted cell may hold line breaks, so a file is read by one task; pass
    ``multiLine=False`` for large files known to have none, which are then split.
    """
    raw = spark.read.options(**{
        "header": True, "quote": '"', "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True, "nullValue": "\u0000", "emptyValue": "", **options}).csv(path)
    return raw.select(*[F.coalesce(F.trim(f"`{c}`"), F.lit("")).alias(c.strip()) for c in raw.columns])


def _as_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return ""  # an object or array


_STRUCTURE = re.compile(r'\\.|["{}\[\]]', re.S)


def _structure(text: str, depth: int, quoted: bool) -> tuple[int, bool]:
    """Open brackets and whether a string is open after ``text``."""
    for mark in _STRUCTURE.findall(text):
        if mark == '"':
            quoted = not quoted
        elif not quoted and mark in "{[":
            depth += 1
        elif not quoted and mark in "}]":
            depth -= 1
    return depth, quoted


def _cut(pieces: Iterable[str], depth: int = 0, quoted: bool = False, begins: bool = True, final: bool = True) -> Iterator[tuple[str, str, bool]]:
    """Text between closing braces as (kind, text, whether a record ends there), cut where records end.

    ``depth`` and ``quoted`` tell where the text begins, ``begins`` that it begins a file and ``final`` that it ends one. "head"
    belongs to a record that began before the text, "tail" to one that goes on after it, "whole" is complete.
    """
    inside, waiting, held = begins or (depth <= 1 and not quoted), [], None

    def add(text: str) -> Iterator[tuple[str, str, bool]]:
        nonlocal depth, quoted, inside, waiting
        waiting.append(text)
        depth, quoted = _structure(text, depth, quoted)
        if depth <= 1 and not quoted:
            yield "whole" if inside else "head", "".join(waiting), True
            inside, waiting = True, []

    for piece in pieces:
        if held is not None:
            yield from add(held + "}")
        held = piece
    if held is not None:
        yield from add(held if final else held + "}")
    if waiting:
        yield ("whole" if final else "tail") if inside else "head", "".join(waiting), final


def _parsed(texts: Iterable[str], name: str = "file", begins: bool = True, final: bool = True) -> Iterator[dict[str, str | None]]:
    """Records of texts cut where records end; the brackets of the array are expected where the file begins and ends."""
    def refused(word: str) -> str:
        raise ValueError(f"{name}: malformed JSON, {word}")

    decoder = json.JSONDecoder(parse_float=lambda x: repr(float(x)), parse_int=str, parse_constant=refused)
    rest, begun, first = "", not begins, begins

    def take(text: str) -> Iterator[dict[str, str | None]]:
        nonlocal rest, begun, first
        rest = (rest + text).lstrip()
        if not begun and rest:
            if rest[0] != "[":
                raise ValueError(f"{name}: expected a JSON array")
            begun, rest = True, rest[1:].lstrip()
        while rest and rest[0] != "]":
            at = rest
            if not first:
                if at[0] != ",":
                    raise ValueError(f"{name}: malformed JSON, expected a comma")
                at = at[1:].lstrip()
            if not at:
                return
            if at[0] != "{":
                raise ValueError(f"{name}: array item is not an object")
            try:
                record, end = decoder.raw_decode(at)
            except json.JSONDecodeError as problem:
                if problem.pos < len(at.rstrip()) and "Unterminated string" not in problem.msg:
                    raise ValueError(f"{name}: malformed JSON, {problem.msg}") from None
                return  # the record goes on
            first, rest = False, at[end:].lstrip()
            yield {k: _as_text(v) for k, v in record.items()}

    for text in texts:
        yield from take(text)
    if final and not begun:
        raise ValueError(f"{name}: expected a JSON array")
    if rest.strip() != ("]" if final else ""):
        raise ValueError(f"{name}: malformed JSON, cut off or with text after the array")


def json_records(pieces: Iterable[str], name: str = "file") -> Iterator[dict[str, str | None]]:
    """Records of a JSON array given as the text between closing braces.

    Only the current record is held, and it is parsed once, when its last brace is there. Text that is no array of objects, is cut off or
    goes on after the array raises ``ValueError``.
    """
    return _parsed((text for _, text, _ in _cut(pieces)), name)


def _brackets(part: Iterable[tuple[int, str]]) -> tuple[bool, int, int, bool] | None:
    """Whether a split begins a file, by how much it opens brackets if it starts outside or inside a string, and whether it ends in the other state."""
    begins, opened, odd = None, [0, 0], False
    for offset, piece in part:
        begins = offset == 0 if begins is None else begins
        for mark in _STRUCTURE.findall(piece + "}"):
            if mark == '"':
                odd = not odd
            elif mark in "{}[]":
                opened[odd] += 1 if mark in "{[" else -1
    return None if begins is None else (begins, *opened, odd)


def _split_starts(found: list[tuple[int, tuple[bool, int, int, bool]]]) -> dict[int, tuple[int, int, bool, bool, bool]]:
    """Split -> (file, depth, quoted, begins the file, ends the file), from the brackets of the splits before it."""
    starts, depth, quoted, file = {}, 0, False, -1
    for at, (split, (begins, outside, inside, odd)) in enumerate(found):
        if begins:
            file, depth, quoted = file + 1, 0, False
        starts[split] = file, depth, quoted, begins, at + 1 == len(found) or found[at + 1][1][0]
        depth, quoted = depth + (inside if quoted else outside), quoted != odd
    return starts


def _over_splits(fragments: Iterable[tuple[object, bool, bool, bool, str]]) -> Iterator[dict[str, str | None]]:
    """Records of a file that go over the end of a split, from their parts (split, begins the file, ends the file, a record ends here, text)."""
    waiting, begins = [], False
    for _, first, final, ends, text in fragments:
        waiting.append(text)
        begins = begins or first
        if ends:
            yield from _parsed(["".join(waiting)], begins=begins, final=final)
            waiting, begins = [], False


def read_raw_json(spark: SparkSession, path: str | list[str], split_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Records of JSON array files as ``record MAP<STRING, STRING>``; null stays null, nested values become ''.

    Files are read in splits of at most ``split_bytes``, each by a task that streams it up to the next closing brace and keeps one
    record in memory. The brackets and quotes of the splits are counted first, if a file has several, so that each
    knows where it starts; a record over the end of a split is put together from its parts. Broken files fail the read.
    """
    paths = [path] if isinstance(path, str) else path
    for name in paths:  # no task ever sees an empty file
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []:
            if status.isFile() and status.getLen() == 0:
                raise ValueError(f"{name}: expected a JSON array")
    # Splits in the order of their files and offsets, wherever the file system is: the text source cannot promise that.
    pieces = spark.sparkContext.newAPIHadoopFile(
        ",".join(paths), "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text",
        conf={"textinputformat.record.delimiter": "}", "mapreduce.input.fileinputformat.split.maxsize": str(split_bytes),
              "mapreduce.input.fileinputformat.input.dir.recursive": "true"})
    begin = pieces.mapPartitions(lambda part: [offset == 0 for offset, _ in islice(part, 1)]).collect() if pieces.getNumPartitions() > 1 else [True]
    if all(begin):
        records = pieces.mapPartitions(lambda part: ((r,) for r in json_records(text for _, text in part)))
        return spark.createDataFrame(records, "record map<string,string>")
    starts = _split_starts([(i, b) for i, b in pieces.mapPartitionsWithIndex(lambda i, part: [(i, _brackets(part))]).collect() if b])

    def cut(i: int, part: Iterable[tuple[int, str]]) -> Iterator[tuple[str, str, bool]]:
        return _cut((text for _, text in part), *starts[i][1:]) if i in starts else iter(())

    def complete(i: int, part: Iterable[tuple[int, str]]) -> Iterator[tuple[dict]]:
        whole = (text for kind, text, _ in cut(i, part) if kind == "whole")
        for text in whole:  # there may be none, then the split lies within one record
            yield from ((r,) for r in _parsed(chain([text], whole), begins=starts[i][3], final=starts[i][4]))

    def over(i: int, part: Iterable[tuple[int, str]]) -> Iterator[tuple[int, tuple]]:
        alone, parts = True, []
        for kind, text, ends in cut(i, part):
            if kind == "whole":
                alone = False
            else:
                parts.append((ends, text))
        for n, (ends, text) in enumerate(parts):
            yield starts[i][0], ((i, n), alone and starts[i][3], alone and starts[i][4], ends, text)

    parts = pieces.mapPartitionsWithIndex(over).groupByKey().flatMap(
        lambda file: ((r,) for r in _over_splits(sorted(file[1], key=lambda part: part[0]))))
    return spark.createDataFrame(pieces.mapPartitionsWithIndex(complete).union(parts), "record map<string,string>")


def fixed_width_fields(line: Column, layout: tuple[tuple[str, int, int], ...]) -> list[Column]:
    return [
        F.when(F.length(line) >= start + length, F.trim(F.substring(line, start + 1, length))).otherwise(F.lit("")).alias(name)
        for name, start, length in layout]


def read_fixed_width(
    spark: SparkSession, path: str | list[str], layout: tuple[tuple[str, int, int], ...] = DEFAULT_LAYOUT, **options: str
) -> DataFrame:
    """Fields cut by position. A file's first line is skipped when it starts with ``#``."""
    lines = spark.read.options(**options).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("line"))
    # First line of a file = lowest line id of the split that starts at byte 0.
    heads = lines.where("offset = 0").groupBy("file").agg(
        F.min("line").alias("line"), F.min_by("value", "line").alias("head")).where("ltrim(head) LIKE '#%'").select("file", "line")
    body = lines.join(heads, ["file", "line"], "left_anti").where(F.length(F.trim("value")) > 0)
    return body.select(*fixed_width_fields(F.col("value"), layout))


def detect_format(path: str) -> str:
    for extension, name in EXTENSIONS.items():
        if path.lower().endswith(extension):
            return name
    raise ValueError(f"Unsupported file format: {path}")


def file_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """First line -> the files that begin with it. One short line per file reaches the driver."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("line")).where("offset = 0 AND length(trim(value)) > 0")
    found: dict[str, list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "line").alias("head")).collect():
        found.setdefault(row["head"], []).append(row["file"])
    return found


def _as_records(rows: DataFrame, kind: str) -> DataFrame:
    pairs = [x for c in rows.columns for x in (F.lit(c), F.col(f"`{c}`"))]
    return rows.select(F.lit(kind).alias("format"), F.create_map(*pairs).alias("record"))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every supported file below ``root`` as (format, record MAP<STRING, STRING>).

    Extensions are matched whatever their case. CSV files are grouped by their header
    and read by name; all fields stay, so ``normalise`` can resolve their aliases.
    """
    paths: dict[str, list[str]] = {}
    for row in list_files(spark, root).select("path").toLocalIterator():
        if row["path"].lower().endswith(tuple(EXTENSIONS)):
            paths.setdefault(detect_format(row["path"]), []).append(row["path"])
    parts = []
    for same in file_headers(spark, paths["CSV"]).values() if "CSV" in paths else ():
        parts.append(_as_records(read_raw_csv(spark, same), "CSV"))
    if "JSON" in paths:
        parts.append(read_raw_json(spark, paths["JSON"]).select(F.lit("JSON").alias("format"), "record"))
    if "FIXED_WIDTH" in paths:
        parts.append(_as_records(read_fixed_width(spark, paths["FIXED_WIDTH"]), "FIXED_WIDTH"))
    if not paths:
        raise ValueError(f"No supported files below {root}")
    if not parts:
        return spark.createDataFrame([], "format string, record map<string,string>")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean_lines(lines: DataFrame) -> DataFrame:
    """Blank lines dropped, trailing blanks cut."""
    return lines.where(r"value RLIKE '\\S'").withColumn("value", F.regexp_replace("value", r"\s+$", ""))


def csv_file_report(spark: SparkSession, path: str) -> DataFrame:
    """Per file: header columns, records, cleaned lines and whether it is usable. Files of one name in several folders stay apart."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("line"))
    first = F.when(F.col("offset") == 0, F.col("line"))
    return lines.groupBy("path", "file").agg(
        F.min_by("value", first).alias("head"),
        (F.count(F.lit(1)) - 1).alias("records"),
        F.count_if(F.col("value").rlike(r"\S")).alias("clean_lines"),
    ).select(
        "file", F.size(F.split("head", ",")).alias("header_columns"), "records", "clean_lines",
        (F.size(F.split("head", ",")) >= 2).alias("valid"))


def is_json(value: Column) -> Column:
    """Strict syntax check. The parser stops at the end of the first value, so the
    text has to parse inside an array and inside an object alike."""
    inside_array = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    inside_object = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return (F.length(F.trim(value)) > 0) & inside_array.isNotNull() & inside_object.isNotNull()


def json_syntax_report(lines: DataFrame) -> DataFrame:
    """Documents and how many of them are valid JSON."""
    return lines.agg(F.count(F.lit(1)).alias("documents"), F.count_if(is_json(F.col("value"))).alias("valid"))


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, size and modification time of the files below ``path``, contents unread."""
    return spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path).select(
        "path", F.col("length").alias("size_bytes"), "modificationTime")


def _open(path: str) -> pa.NativeFile:
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_stream("/" + path[5:].lstrip("/"))
    system, name = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@%"))
    return system.open_input_stream(name)


def _streamed_md5(batches: Iterator[pa.RecordBatch], portion: int = 4 * 1024 * 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            digest = hashlib.md5()
            with _open(path) as stream:
                while part := stream.read(portion):
                    digest.update(part)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(1)], names=["path", "md5", "length"])


def file_hashes(spark: SparkSession, path: str, pattern: str = "*", in_row: int = 64 * 1024 * 1024) -> DataFrame:
    """MD5 and size in MB per file; each file is hashed by the task that reads it.

    A file of at most ``in_row`` bytes is one row of the scan. A larger one, of any size, is read
    as a stream in portions; its file system must be one that pyarrow knows. Empty files are not
    listed by the scan and have no row.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path)
    small = files.where(F.col("length") <= in_row).select("path", F.md5("content").alias("md5"), "length")
    large = files.where(F.col("length") > in_row).select("path", "length").mapInArrow(_streamed_md5, "path string, md5 string, length long")
    return small.union(large).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "md5", (F.col("length") / (1024 * 1024)).alias("size_mb"))
