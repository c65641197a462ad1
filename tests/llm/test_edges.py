"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest

import corpus_pipeline
from data import EDGE_SCHEMA, edge_rows
from riskweave.llm import (decontamination, html_main_text, licences, line_dedup, ngram_join, packing, quality_classifier,
                           quality_rules, suffix_dedup, toxicity)
from riskweave.llm.queries import tokenizer_path

ROWS = edge_rows()


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, EDGE_SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (8, 0, 1), (None, 1, 1), (9, None, None), (7, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")


def by_document(spark, labels):
    return {
        "toxicity": lambda d: toxicity.toxicity(d, toxicity.learn(d, labels, support=1)),
        "classifier": lambda d: quality_classifier.score(d, quality_classifier.fit(d, labels, bits=10)),
        "rules": quality_rules.quality_rules,
        "licences": licences.scan,
        "lines": line_dedup.line_dedup,
        "near": lambda d: ngram_join.near_duplicates(d, unit=2),
        "repeats": suffix_dedup.remove_repeats,
    }


@pytest.mark.parametrize("name", ["toxicity", "classifier", "rules", "licences", "lines", "near", "repeats"])
def test_one_row_per_document(spark, edge, none, labels, name):
    run = by_document(spark, labels)[name]
    got = run(edge)
    assert len(set(got.columns)) == len(got.columns)
    rows = got.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    empty = run(none)
    assert empty.count() == 0 and empty.columns == got.columns


def test_defined_values(spark, edge):
    rules = {(r.doc_id, r.source): r for r in quality_rules.quality_rules(edge).where("doc_id < 5").collect()}
    assert [rules[i, "s"].n_words for i in (1, 2, 3, 4)] == [0, 0, 0, 1] and not any(r.kept for r in rules.values())
    assert rules[1, "s"].failed_rules == ["few_words"]
    lines = {r.doc_id: r for r in line_dedup.line_dedup(edge).where("doc_id < 5").collect()}
    assert [lines[i].n_lines for i in (1, 2, 3, 4)] == [1, 1, 2, 1] and lines[1].kept_text == ""
    near = ngram_join.near_duplicates(edge).collect()
    copies = [r for r in near if r.class_id == 5]
    assert len(copies) == 5 and all(r.n_links == 4 for r in copies)  # a null id, three copies, one near copy
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in near if r.text_class is None)
    gone = {r.doc_id: r for r in suffix_dedup.remove_repeats(edge).collect()}
    assert gone[1].n_bytes == gone[1].n_removed == 0
    assert gone[9].n_removed == 5000 and gone[9].n_spans == 1 and bytes(gone[9].kept) == b""
    assert gone[8].n_removed == 6000
    assert gone[5].n_removed == gone[5].n_bytes


def test_searches_on_edges(spark, edge, none):
    items = spark.createDataFrame([(1, ROWS[4][1]), (2, None), (3, ""), (4, "word"), (5, ROWS[4][1])], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontamination.contaminated(edge, items).collect()}
    assert hits == {(d, i) for d in (5, 6, None, 12) for i in (1, 5)}
    assert decontamination.contaminated(edge, items.limit(0)).count() == 0
    assert decontamination.contaminated(none, items).count() == 0
    pages = spark.createDataFrame([(1, None, "u"), (2, "", None), (None, "<p>a b", "u"), (2, "<nav>x y", "u"), (3, "<" * 50, "u")], "page_id long, html string, url string")
    assert [r.text for r in html_main_text.extract(pages).collect()] == ["", "", "a b", "", ""] or \
        [r.text for r in html_main_text.extract(pages).collect()][:4] == ["", "", "a b", ""]
    assert html_main_text.extract(pages.limit(0)).count() == 0


def test_packing_edges(spark, edge, none):
    pieces = packing.pack(edge, tokenizer_path()).collect()
    assert sum(p.length for p in pieces if p.doc_id in (1, 2, 3)) == 3
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_pipeline_stages_on_edges(spark, edge, none, tmp_path):
    spark.createDataFrame([(1, "nothing of that kind is in any document here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (edge, none):
        docs = start
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{tmp_path}/{start is none}-{number}"
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            docs = spark.read.parquet(out)
            if number < 4:
                assert docs.columns == corpus_pipeline.COLUMNS, name
        assert (docs.count() == 0) == (start is none)


def test_pipeline_drops_only_rows_that_hold_a_passage(spark, tmp_path):
    item = "seven plain words and four more make this item"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = f"before it {item} after it"
    rows = [(None, leak), (None, "clean one"), (None, None), (4, leak), (4, "clean two"), (4, leak), (5, "clean one"), (-2 ** 63, "clean three")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert left.columns == corpus_pipeline.COLUMNS
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted((str(i), str(t)) for i, t in rows if t != leak)
