"""Many equal rows, every code point of the packing shortcut, and columns with the operators' own names."""

import pyarrow as pa
import pytest

from data import prose
from riskweave.llm import decontamination, ngram_join, packing, suffix_dedup
from riskweave.llm.queries import tokenizer_path


def test_many_equal_rows_lose_all_in_bounded_memory(spark):
    same, other = prose(1, 150), prose(2, 150)
    docs = spark.range(20_000).selectExpr("CAST(null AS long) AS doc_id", f"'{same}' AS text").union(
        spark.range(300).selectExpr("13L", f"'{other}' AS text")).union(spark.range(1).selectExpr("14L", f"'new {other[:450]}' AS text"))
    got = suffix_dedup.remove_repeats(docs).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted((str(r.doc_id), r.n_bytes - r.n_removed, r.n_spans, r["count"]) for r in got) == [("13", 0, 1, 300), ("14", 4, 1, 1), ("None", 0, 1, 20_000)]


def test_rows_of_one_id_are_told_apart(spark):
    texts = [prose(s, 140) for s in range(300)]
    texts += [texts[0] + " tail", texts[1]]
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got)[-4:] == sorted([len(texts[0]), len(texts[0]), len(texts[1]), len(texts[1])])
    assert sum(r.n_removed > 0 for r in got) == 4


def test_packing_ids_of_every_letter_with_marks():
    from tokenizers import Tokenizer
    whole, fast = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path(), "uint16")
    texts = ["Yeni BİLGİ. Bu İŞİ!"]
    for code in [c for c in range(0x20, 0x180)] + [0x130, 0x1E9E, 0x345, 0x3A3, 0x10FFFD]:
        c = chr(code)
        texts.append(" ".join(f"{a}{c}{b}{m}" for a in ("", "a", "Ab") for b in ("", "b", "Z") for m in ("", ".", "...", "!)", "'s,")))
    coded = fast(texts)
    for text, ids in zip(texts, coded):
        assert memoryview(ids).cast("H").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE_WORDS", 40)
    monkeypatch.setattr(packing, "_CACHE_CHUNKS", 60)
    small, texts = packing.WordIds(tokenizer_path(), "uint16"), [prose(s, 60) + "." for s in range(12)]
    coded = [small([t])[0] for t in texts]
    monkeypatch.undo()
    large = packing.WordIds(tokenizer_path(), "uint16")
    assert coded == [large([t])[0] for t in texts]
    assert len(small.chunks) < 60 + 130 < len(large.chunks)


def test_encoder_remembers_runs_and_not_every_form_of_a_word():
    fast = packing.WordIds(tokenizer_path(), "uint16")
    marks = [""] + [a + b for a in ".,;!" for b in ("", "!", "?", ")")]
    forms = [f"{word}{mark}" for word in ("stone", "Stone", "STONE", "sToNe") for mark in marks]
    assert fast([" ".join(forms)]) == [b"".join(fast(forms))]
    assert len(fast.chunks) <= 1 + len(marks) and len(fast.words) == 1


def test_packing_workers_give_memory_back_after_every_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(packing, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array([n, n]), pa.array([prose(n, 30), ""])], names=["doc_id", "text"]) for n in range(3)]
    chunks = list(packing._tokenise(tokenizer_path(), "uint16", 4096, 2)(iter(batches)))
    assert sum(b.num_rows for b in chunks) == 6 and len(calls) == 3


def test_own_column_names_come_back_unchanged(spark):
    rows = [(1, prose(1, 60), "a", 11, "x"), (2, prose(1, 60), "b", 12, "y"), (3, prose(2, 60), "c", 13, "z"), (4, None, "d", 14, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _row long, text_class string")
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(tuple(r) for r in left.collect()) == [rows[0], rows[2], rows[3]]
    bench = spark.createDataFrame([(1, " ".join(prose(2, 60).split()[5:40]))], "item_id long, text string")
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(tuple(r) for r in left.collect()) == [rows[0], rows[1], rows[3]]


def test_decontamination_leaves_its_items_to_spark(spark, monkeypatch):
    """The plan is built without reading a row and has one scan a side, whatever the number of blocks."""
    texts = spark.createDataFrame([(i, f"w{i} a b c d e f g") for i in range(50)], "id long, text string")
    for name in ("collect", "toLocalIterator", "toPandas", "first"):
        monkeypatch.setattr(type(texts), name, lambda *a, **b: pytest.fail("read while planning"))
    hits = decontamination.contaminated(texts.withColumnRenamed("id", "doc_id"), texts.withColumnRenamed("id", "item_id"), block_words=10)
    assert hits._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2
    monkeypatch.undo()
    assert hits.count() == 2500
