"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import store, table
from riskweave.llm import byte_bpe, html_main_text, licences, quality_classifier, ranked_search, source_divergence, toxicity
from riskweave.llm.decontamination import contaminated
from riskweave.llm.line_dedup import line_dedup
from riskweave.llm.ngram_join import near_duplicates
from riskweave.llm.packing import pack
from riskweave.llm.quality_rules import quality_rules
from riskweave.llm.suffix_dedup import remove_repeats

TOKENIZER, RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _remainder(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), _remainder(4) != 2)
    return toxicity.toxicity(docs, lexicon).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def piece_digests(docs: DataFrame) -> DataFrame:
    return pack(docs, tokenizer_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join("sentences", "").alias("sentences"), F.size("matches").cast("long").alias("n_matches"),
        F.array_join("licences", ",").alias("licences"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).cast("int").alias("repeated"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), usable=_remainder(5) != 0)
    return quality_classifier.score(docs, weights).select(
        "doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = tokenizer_path(RANKS)
    ids = store(byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), "ids")
    return byte_bpe.decode(ids, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.store_index(ranked_search.build_index(table(spark, sf_dir, "documents")))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
    return {**found, "pipeline": pipeline}


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, s.top IS NOT NULL AND s.top <> k.doc_id AS gone FROM k LEFT JOIN s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM r),
t AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_marks,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(ws, lambda w: list_contains(STOPS, w))) AS n_stops
  FROM d LEFT JOIN t USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 1.5 * n_words AND 20 * n_words AND n_symbols <= 0.2 * n_words
  AND n_marks <= 0.3 * n_words AND n_stops >= 0.02 * n_words AND n_dup_lines <= 0.6 * n_lines AS kept
FROM b
"""


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 10 * k >= 8 * (cx.n + cy.n - k)),
r AS (SELECT doc_id AS d, doc_id AS o FROM documents UNION SELECT r.d, l.y FROM r JOIN l ON l.x = r.o),
m AS (SELECT d, min(o) AS class_id FROM r GROUP BY d),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT d AS doc_id, class_id, coalesce(n_links, 0) AS n_links FROM m LEFT JOIN n ON n.x = d
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lc FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
f AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, lc FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
  1 + 1000000000::HUGEINT * (lc + 2) // (sum(lc) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS q FROM f),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
t AS (SELECT id, doc_id, len(ts) AS n, unnest(ts) AS term FROM d),
f AS (SELECT id, doc_id, n, term, count(*) AS tf FROM t SEMI JOIN i USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM f, c GROUP BY term, n_docs),
s AS (SELECT item_id, id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM f JOIN i USING (term) JOIN w USING (term), c GROUP BY item_id, id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

OP6_SQL = r"""
WITH s AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.;:!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS pieces FROM documents),
u AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos FROM s),
n AS (SELECT doc_id, pos, trim(regexp_replace(lower(piece), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM u),
k(norm, ident) AS (VALUES SENTENCES),
q AS (SELECT doc_id, string_agg('<' || ident || '>', '' ORDER BY pos) AS sentences FROM n JOIN k USING (norm) GROUP BY doc_id),
h AS (SELECT doc_id, unnest(regexp_extract_all(sentences, 'PATTERN')) AS hit FROM q),
r(hit, licence) AS (VALUES RULES),
a AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM h JOIN r USING (hit) GROUP BY doc_id)
SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences
FROM documents LEFT JOIN q USING (doc_id) LEFT JOIN a USING (doc_id)
"""


def _pairs(table: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in table.items())


def oracle_sql() -> dict[str, str]:
    from riskweave.llm.quality_rules import STOP_WORDS
    stops = sorted({*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]})
    pattern, names = licences.rule_pattern()
    return {
        "op4_ngram_join": OP4_SQL,
        "op5_quality_rules": OP5_SQL.replace("STOPS", "[" + ", ".join(f"'{w}'" for w in stops) + "]"),
        "op6_licences": OP6_SQL.replace("SENTENCES", _pairs(licences.cut_table())).replace("PATTERN", pattern).replace("RULES", _pairs(names)),
        "op7_line_dedup": OP7_SQL,
        "op12_source_divergence": OP12_SQL,
        "op13_ranked_search": OP13_SQL,
    }
