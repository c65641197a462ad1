"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import DATA
from data import edge_rows, near_corpus, plain_words, prose, shingle_set
from riskweave.llm import (decontamination, html_main_text, licences, line_dedup, ngram_join, packing, quality_classifier, queries,
                           suffix_dedup, toxicity)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# 1 decontamination

def test_decontamination_tolerates_substitutions(spark):
    rng, items = random.Random(3), [prose(500 + i, 45) for i in range(30)]
    rows, want = [], set()
    for d in range(120):
        text = prose(2000 + d, 200).split()
        if d % 2:
            item = d % 30
            words = items[item].rstrip(".").split()
            for at in rng.sample(range(len(words)), 4):
                words[at] = f"other{rng.randrange(999)}"
            place = rng.randrange(150)
            text[place:place] = words
            want.add((d, item))
        rows.append((d, " ".join(text)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(spark, rows), bench).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents(spark, rows), bench, block_words=100).collect()}
    assert blocks == want


def test_seeds_hit_any_two_substitutions_in_a_passage():
    """A 20-word passage with two words changed is hit by some seed wherever they are."""
    for a in range(20):
        for b in range(a):
            assert any(all(mask[i - s] == "0" for i in (a, b) if s <= i < s + len(mask))
                       for mask in decontamination.MASKS for s in range(20 - len(mask) + 1)), (a, b)


def test_best_stretch():
    assert decontamination.best_stretch(np.array([0, 1, 1, 0, 1, 1, 1, 1, 0], dtype=bool), 3) == (4, 8, 4)


def test_decontamination_finds_every_shared_passage(spark):
    docs, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = {r.item_id: plain_words(r.text) for r in bench.collect()}
    grams = defaultdict(set)
    for i, w in items.items():
        for k in range(len(w) - 12):
            grams[w[k:k + 13]].add(i)
    want = set()
    for r in docs.collect():
        w = plain_words(r.text)
        want |= {(r.doc_id, i) for k in range(len(w) - 12) for i in grams.get(w[k:k + 13], ())}
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert want <= got and len(got) <= len(want) + 3


def test_whole_copies_of_short_items_are_found_wherever_words_differ(spark):
    """Items of 5 to 20 words with one to three words changed at every choice of places."""
    items = {n: [f"item{n}word{k}" for k in range(n)] for n in (*range(5, 21), 40)}
    rows, want = [], set()
    for n, words in items.items():
        spread = [range(0, n, 5)] if n == 40 else [p for k in (1, 2, 3) for p in itertools.combinations(range(n), k)]
        for places in spread:
            copy = [w if k not in places else "other" for k, w in enumerate(words)]
            if 5 * (n - len(places)) >= 4 * n:
                want.add((len(rows), n))
            rows.append((len(rows), " ".join(["before", "it", *copy, "after", "it"])))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = decontamination.contaminated(documents(spark, rows).repartition(8), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert want <= got
    assert all(r.item_id > 16 for r in found if (r.doc_id, r.item_id) not in want)  # thirteen equal words of a longer item
    assert all(r.n_matched <= r.length <= r.n_item_words and r.doc_start == r.item_start + 2 for r in found)


# 2 and 10: held-out figures

LABELLED = DATA.replace("0.001", "0.1")


def held_out(spark, rows, label):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    pairs = rows.where("held_out").join(labels, "doc_id").select("score", "predicted", label).collect()
    pos, neg = [r[0] for r in pairs if r[2]], [r[0] for r in pairs if not r[2]]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]), np.mean([r[1] == r[2] for r in pairs]), len(pairs)


def test_toxicity_on_held_out_rows(spark):
    auc, right, n = held_out(spark, queries.op2_toxicity(spark, LABELLED), "toxic")
    assert n > 900 and auc > 0.95 and right > 0.97, (auc, right, n)


def test_quality_on_held_out_rows(spark):
    auc, right, n = held_out(spark, queries.op10_quality_classifier(spark, LABELLED), "quality")
    assert n > 800 and auc > 0.99 and right > 0.98, (auc, right, n)


def test_folding():
    assert toxicity.fold("1D10T ѕtuріd Clówn c1​own 1984 a1") == " idiot stupid ciown ciown 1984 ai "


def test_exceptions_and_stems():
    lexicon = toxicity.Lexicon({" fool ": 2.0, " vexo": 3.0}, (" april fool ",))
    found = lexicon.automaton()
    assert toxicity.hits(toxicity.fold("A fool, an April fool; vexomat foolish convexo"), found) == [(2, 2.0), (21, 3.0)]
    chosen = toxicity.choose_terms([(" vexoab ", 9, 0), (" vexocd ", 9, 0), (" vexo", 18, 0), (" bad ", 20, 0), (" the ", 50, 500)], 50, 500, 2.0)
    assert set(chosen) == {" vexo", " bad "}


# 3 packing

def test_packing_is_an_exact_cover(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    extra = documents(spark, [(-1 - n, r[1]) for n, r in enumerate(edge_rows())])
    docs = docs.unionByName(extra)
    rows = packing.pack(docs, queries.tokenizer_path()).collect()
    want = {r.doc_id: np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], dtype="<u4") for r in docs.collect()}
    pieces, laid = defaultdict(list), defaultdict(list)
    for r in rows:
        assert bytes(r.ids) == want[r.doc_id][r.start:r.start + r.length].tobytes() and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        laid[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for d, parts in pieces.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(want[d])
    for parts in laid.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 4096 or at & (at - 1) == 0  # nothing is padded


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = packing.hilbert_key(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# 4 n-gram join

def brute_links(rows, threshold=0.8):
    sets = {d: shingle_set(t) for d, t in rows}
    links = {d: {e for e in sets if e != d and sets[d] and len(sets[d] & sets[e]) >= threshold * len(sets[d] | sets[e])} for d in sets}
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for d, others in links.items():
            low = min([label[d], *[label[e] for e in others]])
            if low < label[d]:
                label[d], changed = low, True
    return {d: (label[d], len(links[d])) for d in sets}


@pytest.mark.parametrize("unit", [256, 3])
def test_join_finds_every_link(spark, unit):
    rows = near_corpus()
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(documents(spark, rows), unit=unit).collect()}
    assert got == brute_links(rows)


def test_prefixes_are_shortened_until_the_target(spark):
    rows = near_corpus()
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(documents(spark, rows), trees=6, depth=8).collect()}
    assert got == brute_links(rows)


def test_overlaps_by_blocks():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in (5, 30, 40, 60)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = ngram_join.overlaps(sets, chunk=7)
    assert all(got[i, j] == want[i][j] for i in range(4) for j in range(4) if i != j)


# 6 licences

def test_licence_rules(spark):
    mit = "\n".join(licences.SENTENCES[k] for k in ("mit-title", "mit-grant", "mit-condition", "as-is"))
    rows = [
        (1, "Intro text. " + mit + "\nLicensed under CC BY-NC 4.0."), (2, "Released under the MIT License. Released under the MIT License."),
        (3, "This work is licensed under the GNU General Public License, version 3."), (4, licences.SENTENCES["as-is"]),
        (5, "  LICENSED under the Apache license, version 2.0!"), (6, "Licensed under CC BY 9.0."),
        (7, licences.SENTENCES["mpl-2.0"] + " " + licences.SENTENCES["unlicense"]),
    ]
    got = {r.doc_id: (r.matches, r.licences) for r in licences.scan(documents(spark, rows)).collect()}
    assert got == {
        1: (["MIT", "CC-BY-NC-4.0"], ["CC-BY-NC-4.0", "MIT"]), 2: (["MIT", "MIT"], ["MIT"]), 3: (["GPL-3.0-only"],) * 2, 4: ([], []),
        5: (["Apache-2.0"],) * 2, 6: ([], []), 7: (["MPL-2.0", "Unlicense"],) * 2}


def test_wrapped_and_commented_licences(spark):
    S = licences.SENTENCES
    mit = ["The MIT License (MIT)", "", "Copyright (c) 2020 Somebody", "", *[x for k in ("mit-grant", "mit-condition", "as-is") for x in (*textwrap.wrap(S[k], 60), "")]]
    bsd = [*textwrap.wrap(S["bsd-grant"], 50), "", *textwrap.wrap("1. " + S["bsd-source"], 50), *textwrap.wrap("2. " + S["bsd-binary"], 50)]
    gnu = [*textwrap.wrap(S["gnu-free"], 40), "", *textwrap.wrap(S["gnu-hope"], 40)]
    mpl = textwrap.wrap(S["mpl-2.0"] + " If a copy of it was not distributed, get one.", 30)
    plain = {"MIT": mit, "BSD-2-Clause": bsd, "GPL-3.0-or-later": gnu, "MPL-2.0": mpl, "ISC": textwrap.wrap(S["isc-grant"], 70)}
    rows = [(name, "\n".join(["int x", *[(before + x).rstrip() + after for x in lines], "", "code"]))
            for name, lines in plain.items() for before, after in (("", ""), ("# ", ""), (" * ", ""), ("// ", "\r"), (";; ", ""), ("dnl ", ""), ("REM ", "\r"))]
    rows += [("MIT", "A heading\nReleased under the MIT License.\nmore"), ("MIT", "no stop\nThe MIT License (MIT)\nno stop")]
    rows += [("", "Released under\n\nthe MIT License."), ("", "It is not Released under\nthe MIT License."), ("", "Released under\nthe MIT License of old"), ("", "Released. under the MIT License.")]
    got = licences.scan(documents(spark, [(i, text) for i, (_, text) in enumerate(rows)])).collect()
    assert [(r.doc_id, r.matches) for r in sorted(got)] == [(i, [name] if name else []) for i, (name, _) in enumerate(rows)]


# 7 line dedup

def test_line_dedup_by_brute_force(spark):
    rng, pool = random.Random(9), [prose(i, 12) for i in range(30)] + ["short", ""]
    rows = [(d, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) for _ in range(rng.randint(0, 12)))) for d in range(80)]
    holders = defaultdict(set)

    def key(x):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for d, t in rows:
        for x in t.split("\n"):
            holders[key(x)].add(d)
    got = {r.doc_id: r for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    for d, t in rows:
        kept = [x for x in t.split("\n") if not (len(key(x)) >= 40 and len(holders[key(x)]) >= 5 and max(holders[key(x)]) != d)]
        assert got[d].kept_text == "\n".join(kept) and got[d].n_dropped == t.count("\n") + 1 - len(kept)
        assert sum(r["last"] - r["first"] + 1 for r in got[d].dropped or []) == got[d].n_dropped


# 8 repeated strings

def brute_repeats(rows, length):
    seen = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = {}
    for d, t in rows:
        mask = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mask[i] += 1
                mask[i + length if i + length <= len(t) else len(t)] -= 1
        covered = np.cumsum(mask)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        out[d] = (len(t), int(covered.sum()), spans, hashlib.sha256(bytes(b for b, c in zip(t, covered) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("length,window", [(400, 192), (60, 24)])
def test_repeats_by_brute_force(spark, length, window):
    rng = random.Random(length)
    passages = [prose(i, 120).encode() for i in range(6)] + ["añb" .encode() * 300, b"z" * 900]
    rows = []
    for d in range(60):
        t = prose(3000 + d, rng.randint(0, 150)).encode()
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            cut = p[a:a + rng.choice([length - 1, length, length + 1, length + 37, 2 * length])]
            at = rng.randint(0, len(t))
            t = t[:at] + cut + t[at:]
        rows.append((d, t.decode("utf-8", "ignore")))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None)]
    want = brute_repeats([(d, (t or "").encode()) for d, t in rows], length)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in suffix_dedup.remove_repeats(documents(spark, rows), length, window).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 10 * length


def test_phrases_cover_every_start_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 700)
    data = prose(1, 900).encode() + b"q" * 3000
    found = suffix_dedup.phrases(data, 400)
    assert [a for a, _, _ in found][1:] == [b + 1 for _, b, _ in found][:-1] and found[-1][1] == len(data) - 400
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 1 << 20)
    assert found == suffix_dedup.phrases(data, 400)


# 9 main text

PAGE = (
    "<!DOCTYPE html><html><head><title>No title</title><script>var t='<p>no</p>';</script></head><body><nav><ul><li><a href='/x'>no menu</a>"
    "</li></ul></nav><div class=\"ad\">no advert words here at all today</div><article><h1>The &amp; head</h1><p><b>First.<br><p>Some  <i>more</i>\n words"
    " of &lt;text&gt; here</p><aside>no side</aside><p>Last&nbsp;one.</p></article><div id='comments'><p>no comment from a reader, long as it is</p></div>"
    "<footer>&copy; no footer</footer>")


def test_main_text():
    assert html_main_text.main_text(PAGE, html_main_text.START) == "The & head\nFirst.\nSome more words of <text> here\nLast one."


def test_training_keeps_signs_and_finds_marked_regions(spark):
    pages = [r[0] for r in spark.read.parquet(f"{DATA}/pages.parquet").select("html").collect()]
    weights = html_main_text.train(pages)
    assert all(w > 0 if k in (html_main_text.WORD, html_main_text.LINKED) else w < 0 for k, w in weights.items())
    for page in pages:
        tokens, (low, high) = html_main_text.parse(page)
        a, b = html_main_text.best_region(tokens, weights)
        words = [i for i, t in enumerate(tokens) if t[2].strip()]
        assert [i for i in words if low <= i < high] == [i for i in words if a <= i < b]


# the pipeline

def test_pipeline_by_brute_force(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    kept = {d: t for d, t in docs.items() if d in {r.doc_id for r in queries.op5_quality_rules(spark, DATA).where("kept").collect()}}
    holders = defaultdict(set)
    for d, t in kept.items():
        for x in t.split("\n"):
            holders[x.strip(" \t\n\x0b\x0c\r").lower()].add(d)
    kept = {d: "\n".join(x for x in t.split("\n") if not (
        len(k := x.strip(" \t\n\x0b\x0c\r").lower()) >= 40 and len(holders[k]) >= 5 and max(holders[k]) != d)) for d, t in kept.items()}
    classes = brute_links(list(kept.items()))
    kept = {d: t for d, t in kept.items() if classes[d][0] == d}
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    hit = {r.doc_id for r in decontamination.contaminated(documents(spark, list(kept.items())), bench).collect()}
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], dtype="<u4") for d, t in kept.items() if d not in hit}
    assert {r.doc_id for r in rows} == ids.keys()
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_native_plans_have_no_python(spark):
    for name in ("op5_quality_rules", "op7_line_dedup"):
        plan = queries.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
    assert queries.op5_quality_rules(spark, DATA).where(F.col("n_words") < 0).count() == 0
