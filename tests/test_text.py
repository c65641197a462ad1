import math
import random
import re
import string
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskweave.functions import text
from riskweave.operators import documents, retrieval


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(fn(F.col("t"))).first()[0]


def test_whitespace_and_cleaning(spark):
    assert one(spark, "Hello    world  \n  test", text.normalise_whitespace) == "Hello world test"
    assert one(spark, "  Hello   World!  ", text.preprocess) == "Hello World!"
    assert one(spark, "  A  b @#é!  ", lambda c: text.preprocess(c, ("lowercase", "clean_special", "normalize"))) == "a b !"
    assert one(spark, "a-b_c (d) é", lambda c: text.remove_special(c, keep_punctuation=False)) == "abc d "
    assert one(spark, "One. Two!? \n ...Three", text.sentences) == ["One", "Two", "Three"]


def test_truncate_and_tokens(spark):
    assert one(spark, "x" * 101, text.truncate) == "x" * 97 + "..."
    assert one(spark, "x" * 100, text.truncate) == "x" * 100
    assert one(spark, "x" * 11, text.token_estimate) == 2
    assert one(spark, "It's  a TEST-case, ok!", text.tokens) == ["its", "a", "testcase", "ok"]
    assert one(spark, "...", text.tokens) == []


def test_text_features_of_empty_text(spark):
    r = text.text_features(spark.createDataFrame([("",), ("Ab 1",)], "t string"), "t").drop("t").collect()
    assert tuple(r[0]) == (0, 0, 0.0, 0.0, 0.0) and tuple(r[1]) == (4, 2, 1.5, 0.25, 0.25)


def reference_chunks(s, size, overlap):
    spans, start = [], 0
    while True:
        if start >= len(s):
            return spans
        spans.append((start, s[start:start + size]))
        if start + size >= len(s):
            return spans
        start += size - overlap


@pytest.mark.parametrize("size,overlap", [(500, 100), (10, 0), (7, 3), (7, 6)])
def test_char_chunks(spark, size, overlap):
    texts = ["a" * 1500, "", "x", "abcdefghij" * 3, "abcdefg", "abcdefgh", "é" * 21]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {}
    for r in documents.chunk_by_chars(df, "k", "t", size, overlap).orderBy("k", "chunk_id").collect():
        assert r["length"] == len(r["text"])
        got.setdefault(r["k"], []).append((r["start_pos"], r["text"]))
    assert got == {i: reference_chunks(s, size, overlap) for i, s in enumerate(texts) if s}


def test_chunk_arguments():
    for fn, column in ((text.char_chunks, F.lit("a")), (text.word_chunks, "words")):
        with pytest.raises(ValueError):
            fn(column, 5, 5)


def test_word_chunks_keep_the_tail(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(11))), (2, "  "), (3, "a b")], "k int, t string")
    got = [(r["k"], r["chunk_id"], r["text"]) for r in documents.chunk_by_words(df, "k", "t", 5, 2).orderBy("k", "chunk_id").collect()]
    assert got == [(1, 0, "w0 w1 w2 w3 w4"), (1, 1, "w3 w4 w5 w6 w7"), (1, 2, "w6 w7 w8 w9 w10"), (1, 3, "w9 w10"), (3, 0, "a b")]


def test_metadata_of_the_document_wins(spark):
    df = spark.createDataFrame([(1, "abc", {"chunk_id": "mine", "lang": "en"}), (2, "abc", None)], "k int, t string, m map<string,string>")
    got = {r["id"]: r["metadata"] for r in documents.chunk_index(df, "k", "t", "m").collect()}
    assert got["doc_1_chunk_0"] == {"doc_id": "1", "chunk_id": "mine", "start_pos": "0", "lang": "en"}
    assert got["doc_2_chunk_0"] == {"doc_id": "2", "chunk_id": "0", "start_pos": "0"}


def test_context_assembly(spark):
    df = spark.createDataFrame([("q", 1, "a" * 300), ("q", 2, "b" * 300), ("q", 3, "c" * 10), ("p", 1, "d" * 950), ("p", 2, "e" * 60), ("n", 1, "f" * 50)], "q string, rank int, t string")
    got = {r["q"]: r["context"] for r in documents.assemble_context(df, "q", "rank", "t", 450).collect()}
    assert got["q"] == "[Document 1]\n" + "a" * 300 + "\n\n[Document 2]\n" + "b" * 150 + "..."
    assert got["p"] == "[Document 1]\n" + "d" * 450 + "..." and got["n"] == "[Document 1]\n" + "f" * 50
    assert {r["q"]: r["context"] for r in documents.assemble_context(df, "q", "rank", "t", 350).collect()}["q"] == "[Document 1]\n" + "a" * 300
    assert documents.assemble_context(df, "q", "rank", "t").count() == 3


def test_rerank(spark):
    results = spark.createDataFrame([("q", i, f"d{i}") for i in range(1, 6)] + [("s", i, f"s{i}") for i in (1, 2)], "q string, rank int, doc string")
    rankings = spark.createDataFrame([("q", "4, x,9,2,1"), ("s", "2,1")], "q string, ranking string")
    got = [(r["q"], r["doc"]) for r in documents.rerank(results, rankings, "q", "rank").orderBy("q", "new_rank").collect()]
    assert got == [("q", "d4"), ("q", "d2"), ("s", "s1"), ("s", "s2")]


def test_parse_fields(spark):
    df = spark.createDataFrame([("Name: A\nTotal: 5 Total: 6\nName:  B \nother",)], "t string")
    r = df.select(*[c.alias(n) for n, c in documents.parse_fields(F.col("t"), ["Name", "Total", "Date"]).items()]).first()
    assert tuple(r) == ("B", "5  6", None)


def test_conversations(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "yo"), (1, 0, "user", "hi"), (1, 2, "tool", "x"), (2, 0, None, "n")], "conv_id int, turn int, role string, text string")
    got = {r["conv_id"]: r["prompt"] for r in documents.flatten_conversations(df).collect()}
    assert got == {1: "User: hi\nAssistant: yo", 2: "User: n"}


def test_corpus_upkeep(spark):
    corpus = spark.createDataFrame([("doc_0", "a"), ("doc_1", "b")], "id string, text string")
    new = spark.createDataFrame([(7, "x"), (3, "y")], "n int, text string")
    grown = documents.append_documents(corpus, new, F.floor(F.col("n") / 5), ["n"])
    assert {r["id"]: r["text"] for r in grown.collect()} == {"doc_0": "a", "doc_1": "b", "doc_2": "y", "doc_3": "x"}
    assert documents.clear(grown).count() == 0


def brute_tfidf(docs, queries, k):
    def toks(s):
        return "".join(c for c in s.lower() if c not in string.punctuation).split()
    tokenised = [toks(d) for d in docs]
    df = {}
    for t in tokenised:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    def vec(t):
        v = {w: t.count(w) / len(t) * math.log(len(docs) / df[w]) for w in set(t) if w in df}
        n = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / n for w, x in v.items()} if n else v
    vecs = [vec(t) for t in tokenised]
    out = {}
    for i, q in enumerate(queries):
        qv = vec(toks(q))
        scored = sorted(((round(sum(x * v.get(w, 0) for w, x in qv.items()), 10), j) for j, v in enumerate(vecs)), key=lambda p: (-p[0], p[1]))[:k]
        out[i] = [(j, s) for s, j in scored if s > 0]
    return out


def test_tfidf_search_matches_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = ["the " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 30))) for _ in range(60)]
    docs += docs[:20]  # copies tie
    queries = ["w1 w2, unseen", "the", "w5 w5 w6 w7!", "unseen"]
    df = spark.createDataFrame(list(enumerate(docs)), "d int, t string")
    index = retrieval.build_index(df, "d", "t", str(tmp_path / "ix"))
    got = {}
    for r in retrieval.tfidf_search(index, "d", spark.createDataFrame(list(enumerate(queries)), "q int, t string"), "q", "t", 7).orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append((r["d"], pytest.approx(r["score"], abs=1e-9)))
    assert {q: v for q, v in brute_tfidf(docs, queries, 7).items() if v} == got


@pytest.mark.parametrize("head", [0, 2, 100])
def test_index_of_common_and_rare_terms_and_repeated_keys(spark, tmp_path, head):
    docs = [(1, "a b b c"), (2, "a c d"), (2, "a b"), (3, "b e a"), (None, "a f c"), (None, "c b"), (4, ""), (5, None), (6, "a")]
    df = spark.createDataFrame(docs, "d long, t string")
    index = retrieval.build_index(df, "d", "t", str(tmp_path / "ix"), head=head)
    tf = retrieval.term_frequencies(df, "d", "t")
    plain = retrieval.unit_weights(tf, retrieval.inverse_document_frequencies(tf, df), "d")

    def rows(weights):
        return sorted(((r["d"] is None, r["d"] or 0, r["term"], round(r["weight"], 9)) for r in weights.collect()))
    assert rows(index["postings"]) == rows(plain) and index["tf"].count() == tf.count()
    queries = spark.createDataFrame([(0, "b c"), (0, "f"), (1, "e d d"), (2, "unseen")], "q long, t string")
    asked = retrieval.unit_weights(retrieval.term_frequencies(queries, "q", "t"), index["idf"], "q").select("q", "term", F.col("weight").alias("w"))
    scored = plain.join(asked, "term").groupBy("q", "d").agg(F.sum(F.col("weight") * F.col("w")).alias("score"))
    found = retrieval.tfidf_search(index, "d", queries, "q", "t", 9)
    assert sorted((r["q"], str(r["d"]), round(r["score"], 9)) for r in found.collect()) == sorted((r["q"], str(r["d"]), round(r["score"], 9)) for r in scored.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^,()]*q#\d+L?, d#", plan)  # sums need no shuffle


def test_search_shuffles_no_postings_whatever_the_planner_may_broadcast(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b b c"), (2, "a c d"), (2, "a b"), (None, "c b"), (4, ""), (5, None)], "d long, t string")
    queries = spark.createDataFrame([(0, "b c"), (0, "d"), (1, "c d d"), (2, "unseen"), (None, "b")], "q long, t string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = retrieval.build_index(df, "d", "t", str(tmp_path / "ix"), head=2)
        found = retrieval.tfidf_search(index, "d", queries, "q", "t", 9)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [term" in plan and "hashpartitioning(term" not in plan
        several = retrieval.tfidf_search(index, "d", queries, "q", "t", 9, block=1)
        assert several._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin [term") > 2

        def rows(hits):
            return sorted((str(r["q"]), str(r["d"]), round(r["score"], 9), r["rank"]) for r in hits.collect())
        assert rows(found) == rows(several) and len(rows(found)) > 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("block", [100, 2])
def test_dense_search(spark, metric, block):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(90, 8)).round(2)
    vectors[60:] = vectors[:30]  # exact copies: the lower id comes first
    corpus = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "i int, v array<double>").repartition(5)
    queries = spark.createDataFrame([(j, [float(x) for x in vectors[j] + 0.01]) for j in range(7)], "q int, qv array<double>")
    got = {}
    for r in retrieval.dense_search(corpus, "i", "v", queries, "q", "qv", 4, metric, block=block).orderBy("q", "rank").collect():
        got.setdefault(r["q"], []).append(r["i"])
    for j in range(7):
        q = vectors[j] + 0.01
        if metric == "cosine":
            s = -(vectors @ q) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(q) + 1e-8)
        else:
            s = ((vectors - q) ** 2).sum(1)
        want = sorted(range(90), key=lambda i: (round(float(s[i]), 10), i))[:4]
        assert got[j] == want


def test_dense_search_holds_no_copy_of_a_batch():
    names, block = pa.array([[1, 2]] * 300), np.ones((2, 20_000)).tobytes()
    batch = pa.RecordBatch.from_arrays([names, pa.array([block] * 300), names, pa.array([block] * 300)], names=["_names", "_q", "_keys", "_v"])
    run = retrieval._block_scores("q", "i", 1, "cosine")
    tracemalloc.start()
    found = pa.Table.from_batches(list(run(iter([batch])))).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["q"] == [1, 2] and found["i"] == [1, 1]
    assert peak < batch.nbytes / 10


def _pairs(names, asked, keys, vectors, rows, columns, asked_first):
    """Rows as the cross join hands them on, one a batch."""
    def blocks(ids, matrix, n):
        return [(pa.array([ids[x:x + n]]), pa.array([matrix[x:x + n].tobytes()], pa.binary())) for x in range(0, len(ids), n)]
    left, right = blocks(names, asked, rows), blocks(keys, vectors, columns)
    both = [(x, y) for x in left for y in right] if asked_first else [(x, y) for y in right for x in left]
    return [pa.RecordBatch.from_arrays([*x, *y], names=["_names", "_q", "_keys", "_v"]) for x, y in both]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scale", [1.0, 1e-5])
@pytest.mark.parametrize("asked_first, held", [(True, 0), (False, 0), (False, 1000)])
def test_dense_blocks_equal_brute_force(metric, scale, asked_first, held):
    rng, k = np.random.default_rng(4), 4
    vectors = rng.normal(size=(260, 6)).round(2) * scale
    vectors[100:160] = vectors[7]  # more copies than are worked out one by one
    vectors[200:220] = vectors[:20]
    vectors[230] = 0
    vectors[231, 2] = np.nan
    keys = [f"k{i * 37 % 260:03}" for i in range(260)]
    keys[110] = keys[215] = None
    asked = np.concatenate([vectors[:40], vectors[228:233]])
    run = retrieval._block_scores("q", "i", k, metric, held, 16)
    batches = _pairs(list(range(45)), asked, keys, vectors, 20, 70, asked_first)
    got = {}
    for r in pa.Table.from_batches(list(run(iter(batches)))).to_pylist():
        got.setdefault(r["q"], []).append((r["score"] if metric == "l2" else -r["score"], r["i"] or "", r["i"]))
    for q in range(45):
        if metric == "cosine":
            s = -(vectors @ asked[q]) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(asked[q]) + 1e-8)
        else:
            s = ((vectors - asked[q]) ** 2).sum(1)
        want = sorted((round(float(x), 10), i or "", i) for x, i in zip(s, keys) if x == x)[:k]
        found = sorted(got.get(q, []))[:k]
        assert [x[2] for x in found] == [x[2] for x in want], q
        assert np.allclose([x[0] for x in found], [x[0] for x in want], rtol=0, atol=2e-10)


def test_dense_search_works_out_near_pairs_only(monkeypatch):
    """Double precision and ordering are for what can be among the k best, over all blocks a query meets in a task."""
    rng, own, scored = np.random.default_rng(5), retrieval._scores, []
    monkeypatch.setattr(retrieval, "_scores", lambda q, v, metric: scored.append(len(q) * len(v)) or own(q, v, metric))
    vectors, ids = rng.normal(size=(3000, 32)), list(range(3000))
    run = retrieval._block_scores("q", "i", 3, "cosine")
    found = pa.Table.from_batches(list(run(iter(_pairs(ids, vectors, ids, vectors, 3000, 1000, True))))).to_pydict()
    assert sum(scored) < 0.01 * 3000 ** 2
    assert found["q"] == [i for i in ids for _ in range(3)]  # not k a block
    assert found["i"][::3] == ids


def test_threshold_applies_after_top_k(spark):
    corpus = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1])], "i int, v array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "q int, qv array<double>")
    assert [r["i"] for r in retrieval.dense_search(corpus, "i", "v", queries, "q", "qv", 3, threshold=0.5).orderBy("rank").collect()] == [0, 2]


@pytest.mark.parametrize("name", ["K5_tfidf_weights", "K7_tfidf_search"])
def test_tfidf_queries_see_a_changed_corpus(spark, tmp_path, name):
    spark.createDataFrame([(0, "red stone")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in ([(1, "red stone"), (2, "blue")], [(7, "red leaf"), (8, "blue"), (9, "stone")]):
        spark.createDataFrame(docs, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = {r["doc_id"] for r in entry.queries()[name](spark, str(tmp_path)).collect()}
        assert got == {i for i, text in docs if name.startswith("K5") or text != "blue"}
