"""Line dedup: drop lines that many documents share, built-in functions only.

Every line gets a key (stripped, A-Z lower-cased) and a 128-bit hash of it. Hashes are
range-partitioned together with a block of document ids and sorted by document and
position, so a line that a third of the corpus shares is spread over many tasks. A
window streams each (hash, block) run in that order; runs are merged per hash in a
partial aggregate. What comes back is no text but, per document, the dropped lines as
runs: a run-length compressed bitmap. ``apply_bitmaps`` puts it on the texts.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` is the smallest
id; rows with one ``doc_id`` count as one document; equal rows are treated alike; keys
below ``min_chars`` code points are never dropped; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import NULL_ID, let, store, text_of

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 4096


def line_key(line: Column) -> Column:
    bare = F.trim(line, F.lit(WHITE))
    # lower() is only right for ASCII lines: others keep letters outside A-Z
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _row_key(id_col: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(id_col), F.lit(NULL_ID)).alias("_id"), F.xxhash64(text_of(text)).alias("_row")]


def line_table(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a long key: document, position, hash."""
    keys = F.filter(
        F.transform(_lines(text_of(text)), lambda x, i: F.struct(line_key(x).alias("key"), i.alias("pos"))),
        lambda s: F.length(s["key"]) >= min_chars)
    rows = docs.select(*_row_key(id_col, text), F.explode(keys).alias("_l"))
    return rows.select(
        "_id", "_row", F.col("_l.pos").alias("_pos"), F.xxhash64("_l.key").alias("_h1"),
        F.xxhash64(F.lit(1), "_l.key").alias("_h2"), F.floor(F.col("_id") / BLOCK).alias("_block"))


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per document that loses lines: (_id, _row, dropped) with runs (first, last) of positions."""
    order = ["_h1", "_h2", "_block"]
    lines = store(
        line_table(docs, min_chars, id_col, text)
        .repartitionByRange(*order).sortWithinPartitions(*order, F.desc("_id"), "_pos"), "lines")
    run = Window.partitionBy(*order).orderBy(F.desc("_id"), "_pos")
    streamed = lines.repartitionByRange(*order).select(
        "_h1", "_h2", "_id", F.lag("_id").over(run).alias("_before"))
    # Stored, so that both sides of the join are shuffled for it and a hot line can be split.
    shared = store(
        streamed.groupBy("_h1", "_h2")
        .agg(F.sum(F.when(F.col("_before").isNull() | (F.col("_before") != F.col("_id")), 1).otherwise(0)).alias("_docs"),
             F.max("_id").alias("_top"))
        .where(F.col("_docs") >= min_docs).select("_h1", "_h2", "_top"), "shared")
    dropped = lines.join(shared, ["_h1", "_h2"]).where(F.col("_id") != F.col("_top"))
    return dropped.groupBy("_id", "_row").agg(F.collect_set("_pos").alias("_p")).select(
        "_id", "_row", let(F.sort_array("_p"), _runs).alias("dropped"))


def _runs(p: Column) -> Column:
    first = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
    last = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines outside the runs, joined again; linear in the number of lines."""
    def cut(lines: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda r: r["last"] + 1))
        ends = F.concat(F.transform(dropped, lambda r: r["first"]), F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))), "\n")
    return let(_lines(text), cut)


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Documents with ``n_lines``, ``n_dropped``, ``dropped`` (runs) and ``kept_text``."""
    results = {"n_lines", "n_dropped", "dropped", "kept_text", "_id", "_row"}
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in results]
    keyed = docs.select(*columns, *_row_key(id_col, text))
    maps = drop_bitmaps(docs, min_chars, min_docs, id_col, text)
    joined = keyed.join(maps, ["_id", "_row"], "left")
    count = F.aggregate("dropped", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return joined.select(
        *columns, F.size(_lines(text_of(text))).cast("long").alias("n_lines"),
        F.coalesce(count, F.lit(0)).cast("long").alias("n_dropped"), "dropped",
        F.when(F.col("dropped").isNull(), text_of(text)).otherwise(kept_text(text_of(text), F.col("dropped"))).alias("kept_text"))
