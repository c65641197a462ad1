"""A: sources and sinks, exercised on files written from the given tables."""

import pyarrow as pa
from pyspark.sql import functions as F

from riskweave.operators import monitoring, retrieval
from riskweave.plans.normal import INGEST_TS, _AMOUNT
from riskweave.plans.registry import query
from riskweave.plans.tables import Tables, cte
from riskweave.session import scratch
from riskweave.sources import readers, writers

_TX = "transaction_id, customer_id, transaction_date, amount, merchant_name"
_COLS = [c.strip() for c in _TX.split(",")]
_TYPED = "transaction_id bigint, customer_id bigint, transaction_date timestamp, amount double, merchant_name string"
_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _tx(spark, d):
    return Tables(spark, d).tx.select(*_COLS)


@query("A1_read_parquet", cte("tx", f"SELECT {_TX} FROM tx"))
def a1_parquet(spark, d):
    path, rows = scratch(spark, "a1"), _tx(spark, d)
    writers.write_parquet(rows, path)
    return readers.read_transactions(spark, path, "parquet", rows.schema)


@query("A1_read_csv", cte("tx", f"SELECT {_TX} FROM tx"))
def a1_csv(spark, d):
    path = scratch(spark, "a1csv")
    writers.write_csv(_tx(spark, d).withColumn("transaction_date", F.date_format("transaction_date", _STAMP)), path)
    found = readers.read_transactions(spark, path, "csv", timestampFormat=_STAMP)
    return found.select(F.col("transaction_id").cast("bigint").alias("transaction_id"), F.col("customer_id").cast("bigint").alias("customer_id"),
                        "transaction_date", F.col("amount").cast("double").alias("amount"), "merchant_name")


@query("A1_read_json", cte("tx", f"SELECT {_TX} FROM tx"))
def a1_json(spark, d):
    path, rows = scratch(spark, "a1json"), _tx(spark, d)
    rows.write.option("timestampFormat", _STAMP).json(path)
    return readers.read_transactions(spark, path, "json", rows.schema, timestampFormat=_STAMP)


@query("A2_partition_filter", cte("tx", f"SELECT {_TX} FROM tx WHERE location_country = 'CN' AND merchant_category = 'purchase'"))
def a2(spark, d):
    path = scratch(spark, "a2")
    writers.write_parquet(Tables(spark, d).tx, path, ["location_country", "merchant_category"])
    return readers.read_partitions(spark, path, {"location_country": "CN", "merchant_category": "purchase"}).select(*_COLS)


@query("A3_read_csv", cte("tx", f"SELECT {_TX} FROM tx"))
def a3(spark, d):
    path = scratch(spark, "a3")
    writers.write_csv(_tx(spark, d).withColumn("transaction_date", F.date_format("transaction_date", _STAMP)), path, header=False)
    return readers.read_csv(spark, path, timestamp_format=_STAMP, schema=_TYPED)


@query("A4_read_json", cte("tx", f"SELECT {_TX} FROM tx"))
def a4(spark, d):
    path = scratch(spark, "a4")
    _tx(spark, d).withColumn("transaction_date", F.date_format("transaction_date", _STAMP)).write.json(path)
    return readers.read_json(spark, path, schema=_TYPED.replace("timestamp", "string")).withColumn(
        "transaction_date", F.try_to_timestamp("transaction_date", F.lit(_STAMP)))


@query("A5_raw_csv", cte("raw_bank", """
SELECT transaction_id, trim(amount) AS amount, trim(is_fraud) AS is_fraud, concat('"', merchant_name, '", ', location) AS place
FROM (SELECT *, coalesce(nullif(city, ''), 'none') AS location FROM raw_bank)"""))
def a5(spark, d):
    path = scratch(spark, "a5")
    place = F.concat(F.lit('"'), "merchant_name", F.lit('", '), F.coalesce(F.nullif("city", F.lit("")), F.lit("none")))
    Tables(spark, d).raw_bank.select("transaction_id", "amount", "is_fraud", place.alias("place")).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return readers.read_raw_csv(spark, path)


def _closed(batches):
    begun = False
    for batch in batches:
        begun = begun or batch.num_rows > 0
        yield batch
    yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"])], names=["value"])


def _write_array(rows, path):
    """JSON array files, one for each partition, one record a line."""
    item = F.to_json(F.struct(*[c for c in rows.columns if c != "transaction_date"]))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # the number of a row within its partition
    rows.select(F.concat(F.when(first, "[").otherwise(","), item).alias("value")).mapInArrow(_closed, "value string").write.text(path)
    _add_ending(rows.sparkSession, path, ".json")


def _add_ending(spark, folder, ending):
    """The text writer only knows ``.txt``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(root):
        if status.getPath().getName().startswith("part-"):
            files.rename(status.getPath(), status.getPath().suffix(ending))


@query("A6_raw_json", cte("tx", """
SELECT transaction_id::VARCHAR AS id, merchant_name AS merchant, '' AS place, CASE WHEN is_fraud THEN 'true' ELSE 'false' END AS fraud FROM tx"""))
def a6(spark, d):
    path = scratch(spark, "a6")
    rows = Tables(spark, d).tx.select(
        "transaction_date", "transaction_id", F.col("merchant_name").alias("merchant"), F.struct("location_country").alias("place"),
        F.col("is_fraud").alias("fraud"))
    _write_array(rows, path)
    record = readers.read_raw_json(spark, path)
    return record.select(F.col("record")["transaction_id"].alias("id"), F.col("record")["merchant"].alias("merchant"),
                         F.col("record")["place"].alias("place"), F.col("record")["fraud"].alias("fraud"))


def _fixed_line(rows):
    def cell(column, width):
        return F.rpad(F.col(column).cast("string"), width, " ")
    day = F.rpad(F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss"), 20, " ")
    return rows.select(F.concat(cell("transaction_id", 20), cell("customer_id", 20), cell("amount", 20), day, cell("merchant_name", 30)).alias("value"))


@query("A7_fixed_width", cte("tx", """
SELECT transaction_id::VARCHAR AS transaction_id, customer_id::VARCHAR AS customer_id, amount::DECIMAL(12,2)::DOUBLE AS amount,
       strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, merchant_name FROM tx"""))
def a7(spark, d):
    path = scratch(spark, "a7")
    _fixed_line(_tx(spark, d)).write.text(path)
    return readers.read_fixed_width(spark, path).withColumn("amount", F.col("amount").cast("double"))


def _mixed_tree(spark, d, label):
    """CSV with two headers, one JSON array and fixed-width files, by the source of the row."""
    root, rows = scratch(spark, label), Tables(spark, d).tx
    keep = rows.select("source_system", *_COLS)
    csv = keep.where("source_system = 'CSV'").drop("source_system")
    csv.where("transaction_id % 2 = 0").write.option("header", True).csv(f"{root}/csv/a")
    csv.where("transaction_id % 2 = 1").select(
        F.col("amount").alias("Amount"), F.col("customer_id").alias("customer"), F.col("transaction_id").alias("id"),
        F.col("transaction_date").alias("date"), F.col("merchant_name").alias("merchant")).write.option("header", True).csv(f"{root}/csv/b")
    _write_array(keep.where("source_system = 'JSON'").drop("source_system"), f"{root}/arrays")
    _fixed_line(keep.where("source_system = 'FIXED_WIDTH'")).write.text(f"{root}/fixed")
    return root


@query("A8_mixed_tree", cte("tx", """
SELECT source_system AS format, count(*) AS n, round(sum(amount), 2) AS total, CAST(sum(transaction_id) AS BIGINT) AS ids FROM tx GROUP BY source_system"""))
def a8(spark, d):
    record = F.col("record")
    amount, key = F.coalesce(record["amount"], record["Amount"]), F.coalesce(record["transaction_id"], record["id"])
    return readers.read_tree(spark, _mixed_tree(spark, d, "a8")).groupBy("format").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(amount.cast("double")), 2).alias("total"), F.sum(key.cast("bigint")).alias("ids"))


@query("A9_csv_report", cte("tx", "SELECT count(*) AS records, CAST(5 AS INT) AS header_columns, TRUE AS valid FROM tx WHERE source_system = 'CSV'"))
def a9_report(spark, d):
    return readers.csv_file_report(spark, f"{_mixed_tree(spark, d, 'a9')}/csv/*").agg(
        F.sum("records").alias("records"), F.max("header_columns").alias("header_columns"), F.bool_and("valid").alias("valid"))


@query("A9_clean_lines", r"""
WITH l AS (SELECT doc_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS value FROM documents)
SELECT doc_id, count(*) AS lines, CAST(sum(length(regexp_replace(value, '\s+$', ''))) AS BIGINT) AS characters FROM l
WHERE regexp_matches(value, '\S') GROUP BY doc_id""")
def a9(spark, d):
    lines = Tables(spark, d).base("documents").select("doc_id", F.explode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("value"))
    return readers.clean_lines(lines).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters"))


@query("A9_json_syntax", "SELECT count(*) AS documents, count(*) FILTER (json_valid(CASE WHEN event_type = 'error' THEN props || '}' ELSE props END)) AS valid FROM events")
def a9_json(spark, d):
    value = F.when(F.col("event_type") == "error", F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return readers.json_syntax_report(Tables(spark, d).base("events").select(value.alias("value")))


@query("A10_ingest_counts", cte("raw_bank", f"""
WITH n AS (SELECT transaction_id <> '' AND ({_AMOUNT}) IS NOT NULL AS good FROM raw_bank)
SELECT count(*) AS records_read, count(*) FILTER (good) AS normalised, count(*) FILTER (good) AS saved, TRUE AS success,
       count(*) FILTER (good) AS stored FROM n"""))
def a10(spark, d):
    source, target = scratch(spark, "a10in"), scratch(spark, "a10out")
    Tables(spark, d).raw_bank.write.option("header", True).csv(source)
    result = writers.ingest(spark, source, target, INGEST_TS, "CSV")
    return spark.read.parquet(target).agg(F.count(F.lit(1)).alias("stored")).select(
        F.lit(result.read).cast("bigint").alias("records_read"), F.lit(result.normalised).cast("bigint").alias("normalised"),
        F.lit(result.saved).cast("bigint").alias("saved"), F.lit(result.success).alias("success"), "stored")


@query("A10_ingest_folder", cte("tx", """
SELECT source_system AS format, count(*) AS records_read, count(*) AS saved, CAST((source_system = 'JSON')::INT AS BIGINT) AS failed_files FROM tx GROUP BY source_system"""))
def a10_folder(spark, d):
    root, target = _mixed_tree(spark, d, "a10tree"), scratch(spark, "a10all")
    spark.createDataFrame([('[{"transaction_id": "X", "amount": 1},',)], "value string").write.text(f"{root}/broken")
    _add_ending(spark, f"{root}/broken", ".json")
    results = writers.ingest_folder(spark, root, target, INGEST_TS)
    rows = spark.createDataFrame([(r.format, r.read, r.saved, r.success) for r in results], "format string, read bigint, saved bigint, success boolean")
    return rows.groupBy("format").agg(
        F.sum("read").alias("records_read"), F.sum("saved").alias("saved"), F.count_if(~F.col("success")).alias("failed_files"))


@query("A11_import_log", """
WITH r AS (SELECT o_orderpriority AS source, count(*) AS processed, count(*) FILTER (o_orderstatus <> CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'P' END) AS succeeded,
                  min(o_orderdate) AS s, CASE WHEN o_orderpriority <> '5-LOW' THEN max(o_orderdate) END AS f FROM orders GROUP BY 1)
SELECT source, processed AS records_processed, succeeded AS records_success, processed - succeeded AS records_failed,
       CAST(epoch(f) - epoch(s) AS BIGINT) AS duration_seconds,
       CASE WHEN f IS NULL THEN 'IN_PROGRESS' WHEN succeeded = 0 AND processed > 0 THEN 'FAILED' WHEN succeeded < processed THEN 'PARTIAL' ELSE 'COMPLETED' END AS status FROM r""")
def a11(spark, d):
    day = F.col("o_orderdate").cast("timestamp")
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") != "1-URGENT")
    runs = Tables(spark, d).base("orders").groupBy(F.col("o_orderpriority").alias("source")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(~bad).alias("succeeded"), F.min(day).alias("started_at"),
        F.max(F.when(F.col("o_orderpriority") != "5-LOW", day)).alias("finished_at"))
    return writers.import_log(runs).drop("started_at", "finished_at")


@query("A12_bulk_append", cte("tx", f"SELECT {_TX} FROM tx"))
def a12(spark, d):
    path, rows = scratch(spark, "a12"), _tx(spark, d)
    writers.write_parquet(rows.where("amount > 5000"), path)
    writers.append_new(spark, rows.unionByName(rows.where("amount < 1000")), path, on_duplicate="skip")
    return spark.read.parquet(path)


@query("A13_partitioned_write", cte("tx", """
SELECT location_country, count(*) AS n, round(sum(amount), 2) AS total FROM tx GROUP BY location_country"""))
def a13(spark, d):
    path = scratch(spark, "a13")
    writers.write_parquet(Tables(spark, d).tx, path, ["location_country"])
    return spark.read.parquet(path).groupBy("location_country").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("A14_file_control", cte("tx", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS oversized FROM tx"))
def a14(spark, d):
    path = scratch(spark, "a14")
    writers.write_parquet(_tx(spark, d), path, files=256, max_records_per_file=400)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(F.sum("rows").alias("n"), F.count_if(F.col("rows") > 400).alias("oversized"))


@query("A15_write_csv", cte("tx", f"SELECT {_TX} FROM tx"))
def a15(spark, d):
    path = scratch(spark, "a15")
    writers.write_csv(_tx(spark, d).withColumn("transaction_date", F.date_format("transaction_date", _STAMP)), path)
    return readers.read_csv(spark, path, header=True, timestamp_format=_STAMP, schema=_TYPED)


@query("A17_export_range", cte("tx", """
SELECT transaction_id, year(transaction_date)::INT AS year, month(transaction_date)::INT AS month, day(transaction_date)::INT AS day FROM tx
WHERE transaction_date >= TIMESTAMP '2024-01-05' AND transaction_date < TIMESTAMP '2024-01-20'"""))
def a17(spark, d):
    path = scratch(spark, "a17")
    writers.export_by_day(Tables(spark, d).tx, path, "2024-01-05", "2024-01-20")
    return spark.read.parquet(path).select("transaction_id", "year", "month", "day")


@query("A18_daily_batch", cte("tx", """
WITH day AS (SELECT * FROM tx WHERE CAST(transaction_date AS DATE) = DATE '2024-01-15'),
c2 AS (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY floor(epoch_us(transaction_date) / 1000000) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n,
              lag(location_country) OVER w AS p, (floor(epoch_us(transaction_date) / 1000000) - floor(epoch_us(lag(transaction_date) OVER w) / 1000000)) / 3600 AS h,
              avg(amount) OVER (PARTITION BY customer_id) AS mean, stddev_samp(amount) OVER (PARTITION BY customer_id) AS sd
       FROM day WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id)),
s AS (SELECT transaction_id, CASE WHEN amount > 5000 THEN 25.0 ELSE 0 END + CASE WHEN n >= 5 THEN 30 WHEN n >= 3 THEN 20 ELSE 0 END
        + CASE WHEN sd > 0 AND abs(amount - mean) / sd >= 3 THEN 25 WHEN sd > 0 AND abs(amount - mean) / sd >= 2 THEN 15 ELSE 0 END
        + CASE WHEN hour(transaction_date) BETWEEN 2 AND 5 THEN 15 ELSE 0 END + CASE WHEN p <> location_country AND h < 6 THEN 20 ELSE 0 END AS score FROM c2)
SELECT transaction_id, score::DOUBLE AS total_risk_score, 15 AS day FROM s WHERE score > 0"""))
def a18(spark, d):
    source, target = scratch(spark, "a18in"), scratch(spark, "a18out")
    writers.export_by_day(Tables(spark, d).tx, source)
    writers.process_day(spark, source, target, 2024, 1, 15)
    writers.process_day(spark, source, target, 2024, 1, 15)  # a repeat replaces the day
    return spark.read.parquet(target).select("transaction_id", "total_risk_score", "day")


@query("A19_file_listing")
def a19(spark, d):
    return readers.list_files(spark, d, "*.parquet").withColumn("path", F.element_at(F.split("path", "/"), -1))


@query("A20_file_hashes")
def a20(spark, d):
    return readers.file_hashes(spark, d, "*.parquet")


@query("A26_monitoring_logs", cte("predictions", """
SELECT 'predictions' AS part, count(*) AS n FROM predictions UNION ALL SELECT 'metrics', 2 * count(DISTINCT model_version) FROM predictions UNION ALL SELECT 'summary', 1"""))
def a26(spark, d):
    path, rows = scratch(spark, "a26"), Tables(spark, d).predictions
    wide = rows.groupBy(F.col("model_version").alias("model")).agg(F.avg(monitoring.hits()).alias("accuracy"), F.avg("latency").alias("latency"))
    writers.save_monitoring(path, monitoring.metric_rows(wide, "model", ["accuracy", "latency"], INGEST_TS), rows, monitoring.realtime_metrics(rows))
    counted = [spark.read.json(f"{path}/{p}").agg(F.lit(p).alias("part"), F.count(F.lit(1)).alias("n")) for p in ("predictions", "metrics", "summary")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("A27_saved_corpus", """
SELECT (SELECT count(*) FROM documents) AS documents,
       (SELECT count(DISTINCT term) FROM (SELECT unnest(list_filter(string_split_regex(translate(lower(text), '!"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', ''), '\\s+'),
          lambda w: length(w) > 0)) AS term FROM documents)) AS terms""".replace("\\\\", "\\"))
def a27(spark, d):
    path, docs = scratch(spark, "a27"), Tables(spark, d).base("documents")
    retrieval.build_index(docs, "doc_id", "text", path)
    writers.save_corpus(path, documents=docs)
    saved = writers.load_corpus(spark, path, "documents", "idf", "postings")
    return saved["documents"].agg(F.count(F.lit(1)).alias("documents")).select(
        "documents", saved["idf"].agg(F.count(F.lit(1)).alias("n")).scalar().alias("terms"))
