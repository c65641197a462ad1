"""Byte-level BPE against tiktoken, source divergence and ranked search against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from data import EDGE_SCHEMA, edge_rows, prose
from riskweave.llm import byte_bpe, ranked_search, source_divergence
from riskweave.llm.queries import RANKS, tokenizer_path

ROWS = edge_rows()


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, EDGE_SCHEMA)


# 11 byte-level BPE

@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBpe.from_file(tokenizer_path(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def oracle(coder):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_every_token_encodes_to_itself(coder):
    undone = [coder.parts(rank) for rank in range(256, len(coder.bytes))]
    assert all(undone) and all(coder.bytes[a] + coder.bytes[b] == coder.bytes[256 + i] for i, (a, b) in enumerate(undone))
    assert all(coder.parts(rank) is None for rank in range(256))


@pytest.mark.parametrize("letters", [b"ab", b"abc ", b"the anoiser", bytes(range(256)), "あえäß€".encode(), b" \n\t", b"-=_*"])
def test_pieces_equal_the_library(coder, oracle, letters):
    rng = random.Random(len(letters))
    for _ in range(1500):
        piece = bytes(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        assert coder.encode_piece(piece) == oracle._encode_single_piece(piece), piece


def test_small_vocabularies_merge_by_rank():
    """Made-up ranks in which greedy longest matches are often wrong; merged here by plain search for the lowest rank."""
    rng = random.Random(4)
    for _ in range(40):
        tokens = [bytes([c]) for c in b"abc"]
        while len(tokens) < 25:
            joined = rng.choice(tokens) + rng.choice(tokens)
            if joined not in tokens and merge(joined, {t: i for i, t in enumerate(tokens)} | {joined: len(tokens)}) == [joined]:
                tokens.append(joined)
        ranks = {t: i for i, t in enumerate(tokens)}
        coder = byte_bpe.ByteBpe(ranks)
        for _ in range(60):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
            assert [coder.bytes[i] for i in coder.encode_piece(piece)] == merge(piece, ranks)


def merge(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return parts
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_long_pieces_take_linear_time(coder, oracle):
    for unit in ("a", "ab", "é", "-", " ", "abcdefghij"):
        text = unit * (200_000 // len(unit))
        assert coder.decode(coder.encode(text)) == text.encode()
    short = "ab-é  x" * 40
    assert np.frombuffer(coder.encode(short * 6000), "<u4").tolist() == oracle.encode_ordinary(short * 6000)  # beyond the streamed size


def test_bpe_on_edges(spark, edge, oracle):
    ids = byte_bpe.encode(edge, tokenizer_path(RANKS), public_tokenizers.PATTERN)
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in byte_bpe.decode(ids, tokenizer_path(RANKS)).collect())
    want = []
    for doc, text, *_ in ROWS:
        tokens = oracle.encode_ordinary(text or "")
        want.append((str(doc), len(tokens), np.array(tokens, "<u4").tobytes(), (text or "").encode()))
    assert got == sorted(want)
    assert byte_bpe.decode(ids.limit(0), tokenizer_path(RANKS)).count() == 0


# 12 source divergence

def expected_divergence(rows, min_docs, top=10):
    rows = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(source_divergence.UPPER, source_divergence.LOWER))), l or "", s or "")
            for t, l, s in rows]
    out = set()
    for lang in {l for _, l, _ in rows}:
        mine = [(terms, s) for terms, l, s in rows if l == lang]
        df = Counter(t for terms, _ in mine for t in set(terms))
        kept = sorted(t for t in df if df[t] >= min_docs)
        count = {s: Counter() for _, s in mine}
        for terms, s in mine:
            count[s].update(t for t in terms if df[t] >= min_docs)
        count[None] = sum(count.values(), Counter())
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept} for s, c in count.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            if s is None:
                continue
            parts = {"pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in count if o is not None and o != s],
                     "term": [(f(p[s][t], p[None][t]), t) for t in kept if count[s][t] and p[s][t] > p[None][t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found) if part == "pair" or i < top}
    return out


def test_divergence_equals_brute_force_whatever_the_blocks(spark):
    rng, rows = random.Random(2), []
    for i in range(260):
        words = [rng.choice("Alpha beta ganz éte süß naïve ЖУК жук x1y a-b mot rare%d" .split()) + rng.choice(["", "s", "Z"]) for _ in range(rng.randint(0, 12))]
        rows.append((" ".join(words) % tuple([i] * " ".join(words).count("%d")) if words else None, rng.choice(["en", "de", None, "", "x"]),
                     rng.choice(["a", "b", "c", "d", "e", None, "Ü"])))
    rows += [(None, "fr", "only"), ("new words here", "it", "one"), (None, "it", "two")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = expected_divergence(rows, 5)
    for options in ({}, {"fitted_terms": 40, "block": 2, "bucket": 3}):
        got = [tuple(r) for r in source_divergence.divergence(docs, min_docs=5, **options).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_divergence_on_edges(spark, edge):
    rows = [(r[1], r[2], r[3]) for r in ROWS]
    for min_docs in (1, 10):
        got = {tuple(r) for r in source_divergence.divergence(edge, min_docs=min_docs).collect()}
        assert got == expected_divergence(rows, min_docs)
    assert source_divergence.divergence(edge.limit(0)).count() == 0
    none = spark.createDataFrame([(None, "en", s) for s in "ab"], "text string, lang string, source string")
    assert sorted(tuple(r) for r in source_divergence.divergence(none).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_sums_of_a_task_are_given_out_in_parts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(source_divergence, "HELD_SUMS", 4)
    vector = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows = [(i % 3, {"type": 0, "size": 9, "indices": [i % 9, 8], "values": [1.0, 2.0]} if i % 9 != 8 else None) for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], vector)], names=["group", "vector"]) for part in (rows[:7], rows[7:20], rows[20:21], rows[21:])]
    got, want = Counter(), Counter()
    for out in source_divergence._sparse_sums(iter(batches)):
        for group, slot, count in zip(*[c.to_pylist() for c in out.columns]):
            got[group, slot] += count
    for group, v in rows:
        for slot, n in zip(v["indices"], v["values"]) if v else ():
            want[group, slot] += int(n)
    assert got == want


# 13 ranked search

def expected_hits(docs, items, k=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(source_divergence.UPPER, source_divergence.LOWER)))
    rows = [(d, Counter(find(t))) for d, t in docs]
    rows = [(d, c, c.total()) for d, c in rows if c]
    n_docs, n_terms = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(find(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c, n in rows:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, -2 ** 63 if doc is None else doc))
        out += [(item, i + 1, None if d == -2 ** 63 else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment, block_terms", [(1024, 50_000), (7, 40)])
def test_search_equals_brute_force(spark, segment, block_terms):
    texts = [prose(i % 90, 20 + i % 50) for i in range(300)]  # copies: ties decided by id
    docs = [(1000 - 3 * i, t) for i, t in enumerate(texts)] + [(5, None), (6, "...")]
    items = [(i, " ".join(texts[i * 7].split()[:15]).upper()) for i in range(20)] + [(20, "absent2"), (21, None), (3, "one more OF the")]
    index = ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string"), segment=segment)
    got = ranked_search.search(index, spark.createDataFrame(items, "item_id long, text string"), block_terms=block_terms)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected_hits(docs, items)


def test_search_on_edges(spark, edge):
    items = [(1, ROWS[4][1]), (None, "word a x é"), (2, ""), (3, "ß ſ 12 5 don t")]
    asked = spark.createDataFrame([(i, t, 7, "x") for i, t in items], "item_id long, text string, score long, doc_id string")
    got = ranked_search.search(ranked_search.build_index(edge), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected_hits([r[:2] for r in ROWS], items)
    assert ranked_search.search(ranked_search.build_index(edge.limit(0)), asked).count() == 0
    assert ranked_search.search(ranked_search.build_index(edge), asked.limit(0)).count() == 0


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(ranked_search, "_PIECE", 5)
    text = "One two;THREE one é1é  two" * 9
    assert ranked_search.terms_of(text.encode()) == Counter(w.encode() for w in re.sub(r"[^0-9a-zé]+", " ", text.lower()).split())


def test_accumulators_are_limited():
    """A rare term decides: the postings of a term in every document are read for the survivors only."""
    rng = np.random.default_rng(3)
    size = 5000
    everywhere = (np.arange(size), np.full(size, 1000), 1000)
    rare = (np.sort(rng.choice(size, 30, replace=False)), np.full(30, 500_000), 500_000)
    item, touched = ranked_search.Item([0, 1], [8000, 3]), []
    found, scores = ranked_search.accumulate(item, [rare, everywhere], size, 10, touched)
    assert touched == [30, 30] and found.tolist() == rare[0].tolist() and set(scores.tolist()) == {8000 * 500_000 + 3000}
    tie = (np.arange(size), np.full(size, 500_000), 500_000)  # a bound equal to the k-th score still creates
    found, _ = ranked_search.accumulate(ranked_search.Item([0, 1], [3, 3]), [rare, tie], size, 10)
    assert len(found) == size
    late = ranked_search.Item([0, 1], [3, 3])
    late.best = [(-10 ** 9, d) for d in range(10)]  # scores of earlier segments limit as well
    assert not len(ranked_search.accumulate(late, [rare, tie], size, 10)[0])


def test_stored_segments_lie_in_small_row_groups(spark):
    """Spark reads up to 4,096 rows of a row group at once, which would be all wide segments of a file."""
    docs = spark.range(30, numPartitions=1).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("stone w"), F.col("id")).alias("text"))
    stored = ranked_search.store_index(ranked_search.build_index(docs, segment=2))
    assert stored.count() == 15
    files = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in stored.inputFiles()]
    assert max(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) == ranked_search.READ_TOGETHER
    items = [(1, "w7 stone"), (2, "w29")]
    got = ranked_search.search(stored, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted([tuple(r) for r in got], key=repr) == expected_hits([(2 * i, f"stone w{i}") for i in range(30)], items)


def test_search_gets_the_items_with_the_first_segment_of_a_task(spark, monkeypatch):
    """They are not sent again with every segment."""
    def counting(k):
        def run(batches):
            sent = [(b.num_rows - b.column("wanted").null_count, b.num_rows) for b in batches]
            found = [[sum(n)] for n in zip(*sent)] if sent else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()) for n in (*found, found[0])], names=["item", "doc_id", "score"])
        return run

    docs = spark.createDataFrame([(i, f"a b{i}") for i in range(40)], "doc_id long, text string").coalesce(2)
    index = ranked_search.store_index(ranked_search.build_index(docs, segment=3))
    monkeypatch.setattr(ranked_search, "_search", counting)
    got = ranked_search.search(index, spark.createDataFrame([(1, "a b7")], "item_id long, text string"), k=100).collect()
    assert sum(r.doc_id for r in got) == index.count() == 14
    assert {r.item_id for r in got} == {1} and max(r.doc_id for r in got) > 1
