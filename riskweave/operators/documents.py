"""Chunk tables, context assembly, re-ordering, corpus upkeep and line parsing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.ordered import numbered
from riskweave.functions.text import char_chunks, elements, strip, word_chunks, words
from riskweave.operators.relational import last_per_key


def chunk_by_chars(docs: DataFrame, key: str, text: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    return docs.select(key, elements(char_chunks(F.col(text), size, overlap)).alias("c")).where("c IS NOT NULL").select(key, "c.*")


def chunk_by_words(docs: DataFrame, key: str, text: str, size: int = 500, overlap: int = 50) -> DataFrame:
    split = docs.select(key, words(F.col(text)).alias("_words"))
    return split.select(key, F.posexplode_outer(word_chunks("_words", size, overlap)).alias("chunk_id", "text")).where("text IS NOT NULL")


def merged_metadata(chunk: dict[str, Column], document: Column) -> Column:
    """Chunk keys plus document keys; the document's value wins where both exist."""
    own = F.create_map(*[x for name, value in chunk.items() for x in (F.lit(name), value.cast("string"))])
    document = F.coalesce(document, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(own, lambda k, v: ~F.map_contains_key(document, k)), document)


def chunk_index(docs: DataFrame, key: str, text: str, metadata: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Chunks with id ``doc_<key>_chunk_<n>`` and merged metadata."""
    chunks = docs.select(key, metadata, elements(char_chunks(F.col(text), size, overlap)).alias("c")).where("c IS NOT NULL")
    own = {"doc_id": F.col(key), "chunk_id": F.col("c.chunk_id"), "start_pos": F.col("c.start_pos")}
    return chunks.select(
        F.concat(F.lit("doc_"), F.col(key).cast("string"), F.lit("_chunk_"), F.col("c.chunk_id").cast("string")).alias("id"),
        F.col("c.text").alias("text"), merged_metadata(own, F.col(metadata)).alias("metadata"))


def assemble_context(results: DataFrame, query: str, rank: str, text: str, max_length: int | None = None, least_tail: int = 100) -> DataFrame:
    """Ranked texts of each query as ``[Document i]`` blocks within ``max_length`` characters.

    The first text that does not fit is cut, if more than ``least_tail`` characters
    are left, and ends the context. Each query has at most top-k rows here.
    """
    ordered = Window.partitionBy(query).orderBy(rank)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    body = F.col(text)
    head = F.concat(F.lit("[Document "), F.col(rank).cast("string"), F.lit("]\n"))
    if max_length is None:
        kept = results.withColumn("_block", F.concat(head, body))
    else:
        sized = results.withColumn("_used", F.coalesce(F.sum(F.length(body)).over(before), F.lit(0)))
        over = sized.withColumn("_over", (F.col("_used") + F.length(body) > max_length).cast("int"))
        left = F.lit(max_length) - F.col("_used")
        block = F.when(F.col("_over") == 0, F.concat(head, body)).when(
            left > least_tail, F.concat(head, F.substring(body, F.lit(1), left.cast("int")), F.lit("...")))
        kept = over.withColumn("_passed", F.coalesce(F.sum("_over").over(before), F.lit(0))).where("_passed = 0").withColumn("_block", block)
    blocks = F.array_sort(F.collect_list(F.when(F.col("_block").isNotNull(), F.struct(F.col(rank), F.col("_block")))))
    return kept.groupBy(query).agg(F.array_join(F.transform(blocks, lambda b: b["_block"]), "\n\n").alias("context"))


def rerank(results: DataFrame, rankings: DataFrame, query: str, rank: str, k: int = 3) -> DataFrame:
    """Re-order each query's results by a ``"3,1,5"`` ranking.

    Positions are 1-based; non-numbers are dropped, the first ``k`` kept, and those
    outside the result list ignored. Queries with at most ``k`` results stay as they are.
    """
    numbers = F.filter(F.transform(F.split("ranking", ","), lambda x: F.trim(x)), lambda x: x.rlike("^[0-9]+$"))
    wanted = rankings.select(query, F.posexplode(F.slice(numbers, 1, k)).alias("_place", "_pick")).select(
        query, F.col("_pick").try_cast("int").alias(rank), (F.col("_place") + 1).alias("_place"))
    sizes = results.groupBy(query).agg(F.count(F.lit(1)).alias("_size"))
    sized = results.join(sizes, query)
    moved = sized.where(F.col("_size") > k).join(wanted, [query, rank])
    new_rank = F.row_number().over(Window.partitionBy(query).orderBy("_place"))
    reordered = moved.withColumn("new_rank", new_rank).drop("_place", "_size")
    unchanged = sized.where(F.col("_size") <= k).withColumn("new_rank", F.col(rank)).drop("_size")
    return reordered.unionByName(unchanged)


def snippet(text: Column, limit: int = 200) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def evidence_rows(results: DataFrame, source: str, text: str, score: str) -> DataFrame:
    """(source, excerpt, score); the excerpt always ends in dots and a missing source is ``Unknown``."""
    return results.withColumns({
        "source": F.coalesce(source, F.lit("Unknown")),
        "excerpt": F.concat(F.substring(text, 1, 200), F.lit("...")),
        "relevance_score": F.coalesce(score, F.lit(0.0))})


def append_documents(corpus: DataFrame, new: DataFrame, cell: Column, order: Sequence[str]) -> DataFrame:
    """Add documents under ids ``doc_<n + i>``, n being the corpus size before."""
    size = corpus.agg(F.count(F.lit(1)).alias("n"))
    placed = numbered(new, cell, order, "_i")
    ids = F.concat(F.lit("doc_"), (size.scalar() + F.col("_i")).cast("string"))
    return corpus.unionByName(placed.withColumn("id", ids).select(*corpus.columns))


def delete_documents(corpus: DataFrame, keys: DataFrame) -> DataFrame:
    return corpus.join(keys.select("id"), "id", "left_anti")


def update_documents(corpus: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace the text of the ids in ``updates`` (id, text); unknown ids change nothing, of repeated ids the highest text counts."""
    new = last_per_key(updates.select("id", "text"), "id").select("id", F.col("text").alias("_new"))
    return corpus.join(new, "id", "left").withColumn("text", F.coalesce("_new", "text")).select(*corpus.columns)


def clear(corpus: DataFrame) -> DataFrame:
    return corpus.where(F.lit(False))


def corpus_size(corpus: DataFrame, vector: str, bytes_per_number: int = 8) -> DataFrame:
    return corpus.agg(
        F.count(F.lit(1)).alias("num_documents"), F.max(F.size(vector)).alias("embedding_dim"),
        (F.sum(F.size(vector)) * bytes_per_number / (1024 * 1024)).alias("total_size_mb"))


def parse_fields(text: Column, fields: Sequence[str]) -> dict[str, Column]:
    """``Field: value`` lines as columns. A line belongs to the first field it starts with; the last line wins."""
    lines = F.split(text, "\n")

    def owner(label: str, earlier: list[str]) -> Callable[[Column], Column]:
        def owned(line: Column) -> Column:
            mine = line.startswith(label)
            for other in earlier:
                mine = mine & ~line.startswith(other)
            return mine
        return owned

    columns = {}
    for i, field in enumerate(fields):
        label = f"{field}:"
        last = F.try_element_at(F.filter(lines, owner(label, [f"{f}:" for f in fields[:i]])), F.lit(-1))
        columns[field] = strip(F.replace(last, F.lit(label), F.lit("")))
    return columns


def extraction_check(text: Column, fields: Column, needed: float = 0.7) -> dict[str, Column]:
    """Share of the fields named anywhere in the text (any case), verdict and the missing ones."""
    lowered = F.lower(text)
    missing = F.filter(fields, lambda f: ~F.contains(lowered, F.lower(f)))
    score = F.coalesce(F.try_divide(F.size(fields) - F.size(missing), F.size(fields)), F.lit(0.0))
    return {"completeness_score": score, "complete": score >= needed, "missing_fields": missing}


# Fixed values.
ROLE_LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}


def flatten_conversations(turns: DataFrame) -> DataFrame:
    """Turns of a conversation as labelled lines in order; other roles are dropped."""
    label = F.create_map(*[F.lit(x) for item in ROLE_LABELS.items() for x in item])[F.coalesce("role", F.lit("user"))]
    lines = turns.select("conv_id", "turn", F.concat(label, F.lit(": "), F.coalesce("text", F.lit(""))).alias("line")).where("line IS NOT NULL")
    return lines.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda t: t["line"]), "\n").alias("prompt"))
