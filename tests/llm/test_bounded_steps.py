"""Texts are split once, and the tokenizer and the vectoriser are asked for a bounded number of runs or terms at a time."""

from collections import Counter
from types import SimpleNamespace

import pyarrow as pa

from data import prose
from riskweave.llm import ngram_join, packing, source_divergence
from riskweave.llm.queries import tokenizer_path


def test_tokenizer_is_asked_in_blocks(monkeypatch):
    monkeypatch.setattr(packing, "_ASKED", 50)
    whole, fast, most = packing.WordIds(tokenizer_path(), "uint16"), packing.WordIds(tokenizer_path(), "uint16"), []
    own = fast.tokenizer

    def asked(texts, **options):
        most.append(max(len(t.split()) for t in texts))
        return own.encode_batch_fast(texts, **options)

    fast.tokenizer = SimpleNamespace(encode_batch_fast=asked, encode=own.encode)
    text = " ".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "aeiou" for c in "klmnrst")
    assert len(set(text.split())) == 280
    assert memoryview(fast([text])[0]).cast("H").tolist() == own.encode(text, add_special_tokens=False).ids
    assert max(most) <= 50 and len(most) >= 5
    assert whole([text]) == fast([text])


def _splits(df):
    return df._jdf.queryExecution().executedPlan().toString().count("split(")


def test_near_duplicates_split_a_text_once_in_a_pass(spark, tmp_path):
    spark.createDataFrame([(1, prose(1, 60))], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    assert _splits(ngram_join._signed(docs, 5, 140)) == 1
    asked = spark.createDataFrame([(1, 2, "x")], "first_id long, _raw long, _text string")
    assert _splits(ngram_join._asked_sets(docs, asked, 5)) == 1


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    a, b = prose(1, 80), prose(2, 80)
    near = a + " tail"
    rows = [(None, a), (None, b), (7, near), (7, b), (7, b.upper()), (9, a), (3, None), (4, " .,"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicates(docs).select("doc_id", "class_id", "n_links", "text_class").collect()
    found = sorted((str(r.doc_id), str(r.class_id), r.n_links, r.text_class is None) for r in got)
    assert found == sorted([
        ("None", "7", 2, False), ("9", "7", 2, False), ("7", "7", 2, False),  # a twice and its near copy
        ("None", "7", 2, False), ("7", "7", 2, False), ("7", "7", 2, False),  # b three times
        ("3", "3", 0, True), ("4", "4", 0, True), ("None", "None", 0, True)])


def test_divergence_gives_distinct_terms_to_the_fit_and_whole_counts_to_the_vectors(spark):
    text = "Aa aa bb " * 3 + "cc"
    rows = [("x", "s", text)] * 5 + [("x", "t", "bb dd"), ("y", "s", None), (None, "s", "aa")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    got = source_divergence.terms_of(docs, 1).collect()
    named = [sorted(r.terms) for r in got if r.weight is None]
    assert sorted(named) == sorted([["x\0aa", "x\0bb", "x\0cc"]] * 5 + [["x\0bb", "x\0dd"], [], ["\0aa"]])
    assert all(sorted(r.some) == sorted(r.terms) for r in got if r.weight is None)
    sums = {}
    for r in got:
        for term in r.terms if r.weight else []:
            sums[r.group, term] = sums.get((r.group, term), 0) + r.weight
    assert sorted((t, n) for (_, t), n in sums.items()) == [("\0aa", 1), ("x\0aa", 30), ("x\0bb", 1), ("x\0bb", 15), ("x\0cc", 5), ("x\0dd", 1)]
    # fewer words reach the vectors than the texts have
    assert sum(len(r.terms) for r in got if r.weight) < 30


def test_fit_is_given_a_term_by_as_many_documents_as_decide(spark):
    docs = spark.createDataFrame([("x", "st"[i % 2], f"often w{'abcd'[i % 4]}") for i in range(12)], "lang string, source string, text string").coalesce(1)
    got = [t for r in source_divergence.terms_of(docs, 1, min_docs=4).collect() if r.weight is None for t in r.terms]
    assert sorted(got) == sorted(["x\0often"] * 4 + [f"x\0w{c}" for c in "abcd"] * 3)
    for least, kept in ((3, 5), (4, 1), (12, 1), (13, 0)):
        counts = source_divergence.term_counts(docs, min_docs=least)[1].groupBy("term").agg({"count": "sum"}).collect()
        assert len(counts) == kept and all(r[1] == (12 if r.term == "often" else 3) for r in counts)


def test_terms_of_a_task_are_counted_over_its_slices(monkeypatch):
    monkeypatch.setattr(source_divergence, "_ROWS", 3)
    texts = [f"often w{'abcd'[i % 4]} " + "twice " * (i % 2 + 1) for i in range(40)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i % 2 for i in range(40)]), pa.array([b"x"] * 40), pa.array([t.encode() for t in texts])], names=["group", "lang", "text"])
    want = Counter((i % 2, f"x\0{word}") for i, t in enumerate(texts) for word in t.split())
    for held, once in ((1 << 21, True), (6, False)):
        monkeypatch.setattr(source_divergence, "HELD_SUMS", held)
        fit, sums, entries = Counter(), Counter(), 0
        for out in source_divergence._split_terms(1, 4)(iter([batch.slice(0, 17), batch.slice(17)])):
            for group, weight, terms, some in zip(*[c.to_pylist() for c in out.columns]):
                if weight is None:
                    fit.update(terms)
                    assert sorted(some) == sorted(terms)
                else:
                    entries += len(terms)
                    sums.update({(group, t): weight for t in terms})
        assert sums == want
        # a slice alone decides nothing about what the slices before have given
        assert not once or set(fit.values()) == {4}
        assert not once or entries == sum(sum(d != "0" for d in f"{n:x}") for n in want.values())
        assert set(fit) == {t for _, t in want} and min(fit.values()) >= 4


def test_sampled_terms_do_not_depend_on_the_others():
    terms = pa.array([f"t{i}é" * (1 + i % 5) for i in range(4000)] + [""])
    picked = source_divergence._one_of(terms, 8)
    assert 350 < picked.sum() < 650
    assert (source_divergence._one_of(terms.slice(1000, 500), 8) == picked[1000:1500]).all()
    assert source_divergence._one_of(terms, 1).all() and not len(source_divergence._one_of(terms.slice(0, 0), 8))
