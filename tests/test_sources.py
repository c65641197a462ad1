import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskweave.plans import files
from riskweave.sources import readers, writers


def put(folder, name, text):
    target = folder / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text, encoding="utf-8")
    return str(target)


def test_raw_csv(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'name,description,amount\n"Test, Inc.","Product with ""quotes""",123.45\n\n  padded ,, 7 \n')
    rows = [tuple(r) for r in readers.read_raw_csv(spark, path).collect()]
    assert rows == [("Test, Inc.", 'Product with "quotes"', "123.45"), ("padded", "", "7")]
    empty = put(tmp_path, "b.csv", "transaction_id,amount\n")
    assert readers.read_raw_csv(spark, empty).count() == 0


def test_raw_json_array(spark, tmp_path):
    path = put(tmp_path, "a.json", '[\n {"id": "1", "amount": 125.50, "n": null, "o": {"x": 1}, "l": [1], "b": true, "t": "{not json"},\n {"id": 2}\n]')
    rows = [r["record"] for r in readers.read_raw_json(spark, path).collect()]
    assert rows == [{"id": "1", "amount": "125.5", "n": None, "o": "", "l": "", "b": "true", "t": "{not json"}, {"id": "2"}]


@pytest.mark.parametrize("text,problem", [
    ('{"id": 1}', "expected a JSON array"), ("", "expected a JSON array"), ('[{"id": 1},', "cut off"), ('[{"id": 1}', "cut off"), ('[{"id": 1}] x', "cut off"),
    ('[{"id": 1} {"id": 2}]', "comma"), ('[{"id": oops}, {"a": 1}]', "malformed"), ("[1, 2]", "not an object"), ('[{"a": "cut', "cut off")])
def test_broken_json_is_an_error(spark, tmp_path, text, problem):
    with pytest.raises(ValueError, match=problem):
        list(readers.json_records(text.split("}")))
    result = writers.ingest(spark, put(tmp_path, "in/a.json", text), str(tmp_path / "out"), "2024-02-01 00:00:00")
    assert not result.success and problem in result.error and result.format == "JSON" and result.duration > 0


def test_json_pieces_of_any_cut():
    text = ' [ {"a": "x}y", "b": {"c": [1, {"d": 2}]}, "e": "\\"}"} , {} ,{"f": -1.50e1}\n] '
    assert list(readers.json_records(text.split("}"))) == [{"a": "x}y", "b": "", "e": '"}'}, {}, {"f": "-15.0"}]
    assert list(readers.json_records(["[]"])) == []


def test_a_record_of_many_objects_is_parsed_once(monkeypatch):
    calls = []
    decode = json.JSONDecoder.raw_decode
    monkeypatch.setattr(json.JSONDecoder, "raw_decode", lambda self, text, *more: calls.append(len(text)) or decode(self, text, *more))
    record = {"a": 1, "o": [{"x": i, "t": "[{\\"} for i in range(6000)]}
    text = json.dumps([record, {"a": 2}])
    assert list(readers.json_records(text.split("}"))) == [{"a": "1", "o": ""}, {"a": "2"}]
    assert len(calls) == 2


def test_large_json_array(spark, tmp_path):
    path = tmp_path / "big.json"
    with path.open("w") as out:
        out.write("[" + ",".join('{"id": "%d", "note": "%s"}' % (i, "n" * 400) for i in range(200_000)) + "]")
    assert path.stat().st_size > 80_000_000
    assert readers.read_raw_json(spark, str(path)).where("length(record['note']) = 400").count() == 200_000


@pytest.mark.parametrize("split", [40, 190, 900])
def test_one_json_array_in_many_splits(spark, tmp_path, split):
    rows = [{"id": str(i), "t": 'x}",{"[\\ é' * (i % 5), "o": {"l": [{"a": 1}, {}]}} for i in range(25)]
    path = put(tmp_path, "a/a.json", " " + json.dumps(rows, indent=1, ensure_ascii=False) + "\n")
    put(tmp_path, "a/b.json", '[{"id": "b"}]')
    put(tmp_path, "a/c.json", "[ ]")
    found = readers.read_raw_json(spark, str(tmp_path / "a"), split_bytes=split)
    want = [{"id": r["id"], "t": r["t"], "o": ""} for r in rows] + [{"id": "b"}]
    assert sorted(sorted(r["record"].items()) for r in found.collect()) == sorted(sorted(r.items()) for r in want)
    if split == 190:  # the file is no longer read by one task
        assert readers.read_raw_json(spark, path, split_bytes=split).select(F.spark_partition_id()).distinct().count() > 2


@pytest.mark.parametrize("text", [
    '[{"a": 1}, {"a": 2}', '[{"a": 1} {"a": 2}]', '[{"a": 1}] {"a": 2}', '[{"a": 1}][{"a": 2}]', '[{"a": 1}, {"a": "2]', '[{"a": 1}, 3, {"a": 2}]',
    '{"a": 1}, {"a": 2}]', '[{"a": 1}}, {"a": 2}]'])
@pytest.mark.parametrize("split", [2, 9])
def test_broken_json_in_many_splits_is_an_error(spark, tmp_path, text, split):
    with pytest.raises(Exception, match="ValueError: "):
        readers.read_raw_json(spark, put(tmp_path, "a.json", text), split_bytes=split).collect()


def test_arrays_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("transaction_id"), F.lit("m").alias("merchant"))
    files._write_array(rows.repartition(3), str(tmp_path / "many"))
    files._write_array(rows.where("transaction_id < 0"), str(tmp_path / "none"))
    assert len(list((tmp_path / "many").glob("*.json"))) == 3
    assert sorted(int(r["record"]["transaction_id"]) for r in readers.read_raw_json(spark, str(tmp_path / "many")).collect()) == list(range(10))
    assert readers.read_raw_json(spark, str(tmp_path / "none")).count() == 0


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'id,shop,amount\n1,"Shop\nA",5\n2,B,6\n')
    assert [tuple(r) for r in readers.read_raw_csv(spark, path).collect()] == [("1", "Shop\nA", "5"), ("2", "B", "6")]


def line(*parts):
    return "".join(p.ljust(w) for p, w in zip(parts, (20, 20, 20, 20, 30)))


def test_fixed_width_header_and_short_lines(spark, tmp_path):
    put(tmp_path, "f/a.txt", "  # header\n" + line("T1", "C1", "10.5", "2024-01-01", "Shop") + "\n\n# T2 is data now\n")
    put(tmp_path, "f/b.txt", line("T3", "C3", "1", "2024-01-02", "Other") + "\n")
    rows = {r["transaction_id"]: tuple(r) for r in readers.read_fixed_width(spark, str(tmp_path / "f")).collect()}
    assert rows["T1"] == ("T1", "C1", "10.5", "2024-01-01", "Shop")
    assert rows["T3"][4] == "Other"
    assert rows[""] == ("", "", "", "", "")  # 17 characters: every field ends past the line
    assert len(rows) == 3


def test_compact_layout(spark, tmp_path):
    path = put(tmp_path, "c.txt", "TXN30001CUST50001202411010830000034500USDWALMART           RETAIL    5411US  DALLAS      \n")
    r = readers.read_fixed_width(spark, path, readers.COMPACT_LAYOUT).first()
    assert (r["transaction_id"], r["customer_id"], r["date"], r["time"], r["amount_cents"]) == ("TXN30001", "CUST50001", "20241101", "0830", "000034500")
    assert (r["currency"], r["merchant_name"], r["merchant_category"], r["mcc"], r["country"], r["city"]) == ("USD", "WALMART", "RETAIL", "5411", "US", "DALLAS")


def test_tree_of_formats(spark, tmp_path):
    put(tmp_path, "x/a.csv", "transaction_id,customer_id,amount\nA,1,2\n")
    put(tmp_path, "x/y/b.json", '[{"transaction_id": "B", "amount": 3}]')
    put(tmp_path, "x/y/z/c.txt", line("C", "1", "4", "2024-01-01", "S") + "\n")
    put(tmp_path, "x/ignored.xml", "<a/>")
    put(tmp_path, "x/Q.CSV", "customer_id,Amount,id\nc3,9,D\n")
    put(tmp_path, "x/y/e.JSON", '[{"id": "E", "Amount": 5, "is_fraud": true, "extra": "kept"}]')
    rows = [(r["format"], r["record"]) for r in readers.read_tree(spark, str(tmp_path / "x")).collect()]
    got = {r.get("transaction_id", r.get("id")): (f, r.get("amount", r.get("Amount"))) for f, r in rows}
    assert got == {"A": ("CSV", "2"), "B": ("JSON", "3"), "C": ("FIXED_WIDTH", "4"), "D": ("CSV", "9"), "E": ("JSON", "5")}
    assert {"customer_id": "c3", "Amount": "9", "id": "D"} in [r for _, r in rows]
    assert next(r for _, r in rows if r.get("id") == "E")["is_fraud"] == "true" and any(r.get("extra") == "kept" for _, r in rows)
    with pytest.raises(ValueError):
        readers.detect_format("a.xml")
    assert [readers.detect_format(n) for n in ("A.CSV", "b.json", "c.txt")] == ["CSV", "JSON", "FIXED_WIDTH"]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Unsupported format"):
        readers.read_transactions(spark, "/nowhere", "xml")


def test_csv_report_and_clean_lines(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b,c\n1,2,3  \n\n   \n4,5,6\n")
    put(tmp_path, "b.csv", "only\n1\n")
    got = {r["file"]: (r["header_columns"], r["records"], r["clean_lines"], r["valid"]) for r in readers.csv_file_report(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": (3, 4, 3, True), "b.csv": (1, 1, 2, False)}
    assert [r["value"] for r in readers.clean_lines(spark.read.text(path)).collect()] == ["a,b,c", "1,2,3", "4,5,6"]
    for folder, lines in (("x", 3), ("y", 5)):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder, "same.csv", "a,b\n" + "1,2\n" * lines)
    same = readers.csv_file_report(spark, f"{tmp_path}/[xy]/*").collect()
    assert sorted((r["file"], r["records"]) for r in same) == [("same.csv", 3), ("same.csv", 5)]


def test_json_syntax(spark):
    cases = {'{"a": 1}': True, "[1, 2]": True, "3": True, '"x"': True, '{"a": 1}}': False, "1]": False, "1}": False, "1,2": False, '1,"b":2': False, "": False, "{": False, "1}]": False, "1]}": False}
    df = spark.createDataFrame([(k,) for k in cases], "value string").withColumn("ok", readers.is_json(F.col("value")))
    assert {r["value"]: r["ok"] for r in df.collect()} == cases


def test_file_hash_and_listing(spark, tmp_path):
    put(tmp_path, "a.bin", "hello")
    r = readers.file_hashes(spark, str(tmp_path)).first()
    assert r["md5"] == hashlib.md5(b"hello").hexdigest() and r["size_mb"] == 5 / 1048576
    assert readers.list_files(spark, str(tmp_path)).first()["size_bytes"] == 5


def test_large_files_are_hashed_as_streams(spark, tmp_path):
    texts = {"a b%20#é.bin": "hello", "two.bin": "y" * 5_000_000}
    for name, text in texts.items():
        put(tmp_path, name, text)
    expected = {name: hashlib.md5(text.encode()).hexdigest() for name, text in texts.items()}
    for in_row in (-1, 10, 2 ** 31 - 1):
        assert {r["file"]: r["md5"] for r in readers.file_hashes(spark, str(tmp_path), in_row=in_row).collect()} == expected


def test_jdbc_options_split_the_scan():
    got = readers.jdbc_options("jdbc:x", "t", "id", 0, 100, partitions=4)
    assert got == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    assert "partitionColumn" not in readers.jdbc_options("jdbc:x", "t")


def test_append_guards_the_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 1), ("B", 2)], "transaction_id string, v int").write.parquet(path)
    batch = spark.createDataFrame([("B", 9), ("C", 3)], "transaction_id string, v int")
    with pytest.raises(ValueError):
        writers.append_new(spark, batch, path, on_duplicate="fail")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        writers.append_new(spark, batch.where("v = 3").unionByName(batch.where("v = 3")), path, on_duplicate="fail")
    writers.append_new(spark, batch.unionByName(batch), path, on_duplicate="skip")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("A", 1), ("B", 2), ("C", 3)]


def test_ingest_counts_and_failure(spark, tmp_path):
    path = put(tmp_path, "in.csv", "transaction_id,customer_id,amount,transaction_date\nT1,C1,10.00,2024-01-15\n,C2,20.00,2024-01-15\nT3,C3,,2024-01-15\n")
    target = str(tmp_path / "out")
    result = writers.ingest(spark, path, target, "2024-02-01 00:00:00")
    assert (result.read, result.normalised, result.saved, result.success) == (3, 1, 1, True)
    assert spark.read.parquet(target).count() == 1
    failed = writers.ingest(spark, str(tmp_path / "none.csv"), target, "2024-02-01 00:00:00")
    assert not failed.success and failed.error
    assert "Unsupported" in writers.ingest(spark, str(tmp_path / "a.xml"), target, "2024-02-01 00:00:00").error


def test_import_states(spark):
    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame([("a", 10, 10, t, t), ("b", 10, 4, t, t), ("c", 10, 0, t, t), ("d", 1, 1, t, None), ("e", 0, 0, t, t)],
                                 "source string, processed bigint, succeeded bigint, started_at timestamp, finished_at timestamp")
    assert {r["source"]: r["status"] for r in writers.import_log(runs).collect()} == {
        "a": "COMPLETED", "b": "PARTIAL", "c": "FAILED", "d": "IN_PROGRESS", "e": "COMPLETED"}


def test_partition_pruning_and_pushdown(spark, tmp_path, ts):
    rows = [(str(i), "C", ts(i * 40000), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_date timestamp, amount double")
    path = str(tmp_path / "days")
    writers.export_by_day(df, path, "2024-03-02 00:00:00", "2024-03-05 00:00:00")
    stored = spark.read.parquet(path)
    assert {(r["year"], r["month"]) for r in stored.collect()} == {(2024, 3)} and {r["day"] for r in stored.collect()} == {2, 3, 4}
    one = readers.read_partitions(spark, path, {"year": 2024, "month": 3, "day": 3})
    assert {r["transaction_date"].day for r in one.collect()} == {3}
    plan = one.where("amount > 3").select("transaction_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThan(amount,3.0)" in plan
