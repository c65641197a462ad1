"""Exact TF-IDF index and search, dense vector search."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.text import elements, tokens
from riskweave.session import scratch

# Scores are compared at this many places: sums differ in the last bits with the
# order of addition, and copies of a text must tie so that the key decides.
PLACES = 10
# Dense search: vectors of a block, its bytes, rows multiplied at once, parts of the corpus, and rows held for a task.
ROWS, BLOCK_BYTES, TILE, PARTS, HELD = 4096, 4 << 20, 256, 16, 50_000


def _counted(sorted_terms: Column) -> Column:
    """(term, n) of a sorted token array by run lengths."""
    last = F.filter(F.sequence(F.lit(0), F.size(sorted_terms) - 1), lambda i: (i == F.size(sorted_terms) - 1) | (
        F.get(sorted_terms, i) != F.get(sorted_terms, i + 1)))
    return F.transform(F.array(last), lambda ends: F.transform(ends, lambda end, i: F.struct(
        F.get(sorted_terms, end).alias("term"), (end - F.coalesce(F.get(ends, i - 1), F.lit(-1))).cast("long").alias("n"))))[0]


def document_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _all, _terms): the number of tokens and (term, n) of a text, in its row.

    Terms are counted inside the row, so texts are not shuffled.
    """
    counted = F.transform(F.array(F.sort_array(tokens(F.col(text)))), lambda t: F.struct(
        F.size(t).alias("all"), F.when(F.size(t) > 0, _counted(t)).alias("terms")))[0]
    return docs.select(key, elements(F.array(counted)).alias("_d")).select(key, F.col("_d.all").alias("_all"), F.col("_d.terms").alias("_terms"))


def _term_rows(counts: DataFrame, *columns: str) -> DataFrame:
    rows = counts.select(*columns, "_all", elements("_terms").alias("_c")).where("_c IS NOT NULL")
    return rows.select(*columns, "_c.term", "_c.n", (F.col("_c.n") / F.col("_all")).alias("tf"))


def term_frequencies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, n, tf) with tf = occurrences / all tokens of the document; one text per key."""
    return _term_rows(document_terms(docs, key, text), key)


def inverse_document_frequencies(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln(N / df), unsmoothed."""
    size = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", F.log(size / F.col("df")))


def _weighted(tf: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    return tf.join(idf.select("term", "idf"), "term").select(key, "term", "idf", (F.col("tf") * F.col("idf")).alias("_w")).where("_w <> 0")


def unit_weights(tf: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """(key, term, weight), L2-normalised per document; zero weights are left out.

    Only the terms of one document meet in a window, so its size is that of a text.
    """
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return _weighted(tf, idf, key).select(key, "term", "idf", (F.col("_w") / norm).alias("weight"))


def _with_norms(rows: DataFrame, norms: DataFrame, key: str) -> DataFrame:
    """Rows with the ``_norm`` of their key. A null key is no join key, its norm comes as a value.

    The norms of a partition are hashed, so the rows, which are wide, are not sorted to meet them.
    """
    unkeyed = norms.where(F.col(key).isNull()).agg(F.max("_norm")).scalar()
    return rows.join(norms.hint("shuffle_hash"), key, "left").withColumn("_norm", F.when(F.col(key).isNull(), unkeyed).otherwise(F.col("_norm")))


def build_index(docs: DataFrame, key: str, text: str, path: str, head: int = 100_000) -> dict[str, DataFrame]:
    """Write the index tables below ``path`` and return them as stored.

    ``tf`` holds the counts, ``idf`` the vocabulary and ``postings`` the unit weights of
    every document. Each is computed once, from the stored ones before it, and the
    planner sees the true table sizes when it chooses joins.

    A posting is wide for a shuffle, so few of them travel. Texts are dealt by key, and counts are stored as
    one row per text, in buckets by key (``counts``; ``tf`` is the same as rows). The ``head`` most frequent terms
    found in more than one text, a table of bounded size that holds most postings, are sent to the counts, whatever
    the planner's limit for that. Only postings of rarer terms are shuffled to their idf. The length of a
    document (``norms``) is summed from both.
    """
    spark = docs.sparkSession

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", "zstd").mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    buckets, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"tf_{uuid.uuid4().hex}"
    dealt = docs.select(key, text).repartition(buckets, key)
    document_terms(dealt, key, text).write.bucketBy(buckets, key).mode("overwrite").saveAsTable(
        table, format="parquet", path=f"{path}/tf", compression="zstd")
    counts = spark.table(table)
    tf = _term_rows(counts, key)
    idf = stored("idf", inverse_document_frequencies(tf, docs))
    common = F.broadcast(stored("head", idf.where("df > 1").orderBy(F.desc("df"), "term").limit(head)))
    rare = stored("tail", _weighted(tf.join(common, "term", "left_anti"), idf, key).drop("idf"))
    squares = [w.groupBy(key).agg(F.sum(F.col("_w") * F.col("_w")).alias("_s")) for w in (_weighted(tf, common, key), rare)]
    norms = stored("norms", squares[0].union(squares[1]).groupBy(key).agg(F.sqrt(F.sum("_s")).alias("_norm")))
    lying = _with_norms(counts, norms, key)
    frequent = _term_rows(lying, key, "_norm").join(common.select("term", "idf"), "term").withColumn("_w", F.col("tf") * F.col("idf")).where("_w <> 0")
    unit = (F.col("_w") / F.col("_norm")).alias("weight")
    postings = stored("postings", frequent.select(key, "term", unit).union(_with_norms(rare, norms, key).select(key, "term", unit)))
    return {"tf": tf, "idf": idf, "postings": postings, "counts": counts, "norms": norms}


def corpus_stats(docs: DataFrame, text: str) -> DataFrame:
    terms = docs.select(elements(tokens(F.col(text))).alias("term"))
    return docs.agg(F.count(F.lit(1)).alias("num_documents")).select(
        "num_documents", terms.agg(F.countDistinct("term").alias("v")).scalar().alias("vocab_size"))


def top_k(scored: DataFrame, query: str, order: list[Column], k: int) -> DataFrame:
    """``rank`` 1..k per query. Spark keeps k rows per query in each task before it shuffles."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order))).where(F.col("rank") <= k)


def tfidf_search(
    index: dict[str, DataFrame], key: str, queries: DataFrame, query: str, text: str, k: int = 5, block: int = 200_000,
) -> DataFrame:
    """(query, key, score, rank) with score > 0; unknown query terms still count in the query's length.

    The counts lie in buckets by key, so they are read once, meet only the query terms and
    are summed per (query, document) without a shuffle; the k best of a task leave it. The
    query terms are stored first and sent to the counts in blocks of whole queries of about
    ``block`` terms; every block reads the counts once.
    """
    asked = unit_weights(term_frequencies(queries, query, text), index["idf"], query).select(
        query, "term", "idf", F.col("weight").alias("_q"))
    path = scratch(queries.sparkSession, "asked")
    asked.write.parquet(path)
    asked = queries.sparkSession.read.schema(asked.schema).parquet(path)
    blocks = 1 + asked.count() // block
    lying = _term_rows(_with_norms(index["counts"], index["norms"], key), key, "_norm")

    def scores(some: DataFrame) -> DataFrame:
        return lying.join(F.broadcast(some), "term").groupBy(query, key).agg(
            F.sum(F.col("tf") * F.col("idf") / F.col("_norm") * F.col("_q")).alias("score")).where("score > 0")

    own = F.pmod(F.xxhash64(query), F.lit(blocks))
    scored = reduce(DataFrame.union, [scores(asked.where(own == b) if blocks > 1 else asked) for b in range(blocks)])
    # Rounded for the order only: copies of a text tie and the key decides.
    return top_k(scored, query, [F.desc(F.round("score", PLACES)), F.asc(key)], k)


def where_metadata(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    for column, value in filters.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    dots = queries @ vectors.T
    if metric == "cosine":
        return dots / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :] + 1e-8)
    squares = (queries * queries).sum(1)[:, None] + (vectors * vectors).sum(1)[None, :]
    return np.maximum(squares - 2 * dots, 0.0)


def dense_search(
    corpus: DataFrame, key: str, vector: str, queries: DataFrame, query: str, query_vector: str,
    k: int = 5, metric: str = "cosine", threshold: float | None = None, block: int = 1024,
) -> DataFrame:
    """Exact nearest vectors as (query, key, score, rank).

    ``metric``: "cosine" (best is highest) or "l2", the squared distance (best is
    lowest). Both sides are packed where they lie, and every block of queries meets every block
    of the corpus in some task, which multiplies at most ``block`` queries at once and keeps the
    k best per query over all blocks of its part. Nothing passes through the driver and the plan is the
    same for any number of queries. The threshold applies after the top k, as a limit on
    what is shown. Null vectors are left out on both sides.
    """
    sides = [(queries, query, query_vector, "_names", "_q", max(1, min(ROWS, HELD // k))), (corpus, key, vector, "_keys", "_v", ROWS)]
    (asked, name_kind), (side, key_kind) = (_packed(*x) for x in sides)
    schema = f"`{query}` {name_kind}, `{key}` {key_kind}, score double"
    pairs = asked.crossJoin(side.coalesce(PARTS)).select("_names", "_q", "_keys", "_v")
    scored = pairs.mapInArrow(_block_scores(query, key, k, metric, tile=min(block, TILE)), schema)
    best = top_k(scored, query, [F.asc("score") if metric == "l2" else F.desc("score"), F.asc(key)], k)
    return best if threshold is None else best.where(F.col("score") >= threshold)


def _packed(df: DataFrame, key: str, vector: str, names: str, matrix: str, rows: int) -> tuple[DataFrame, str]:
    """(keys, bytes of the vectors) for at most ``rows`` rows of a partition and BLOCK_BYTES, and the type of the keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = set(whole.column(1).value_lengths().to_pylist())
            if len(lengths) > 1:
                raise ValueError("vectors of different lengths")
            most = max(1, min(rows, BLOCK_BYTES // max(8, *(8 * n for n in lengths)))) if lengths else rows
            for part in (whole.slice(low, most) for low in range(0, whole.num_rows, most)):
                values = part.column(1).flatten().to_numpy(zero_copy_only=False)
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([keys, pa.array([values.tobytes()], pa.binary())], names=[names, matrix])

    side = df.select(F.col(key), F.col(vector).cast("array<double>").alias("_x")).where("_x IS NOT NULL")
    kind = side.schema[0].dataType.simpleString()
    return side.mapInArrow(run, f"{names} array<{kind}>, {matrix} binary"), kind


class _Block:
    """Vectors of one side where they lie, with unit vectors of single precision to find what can be near."""

    def __init__(self, names: pa.Array, matrix: pa.Buffer, unit: bool):
        self.names, self.vectors = names, np.frombuffer(matrix, dtype="float64").reshape(len(names), -1)
        self.units = None
        if unit:
            self.norms = np.linalg.norm(self.vectors, axis=1)
            if np.isfinite(self.norms).all():
                self.least = float(self.norms[self.norms > 0].min(initial=np.inf))
                # Parted by rows: a part is small, so no second copy of the block is made.
                self.units = np.empty(self.vectors.shape, dtype="float32")
                for low in range(0, len(names), TILE):
                    own = slice(low, low + TILE)
                    self.units[own] = self.vectors[own] / np.where(self.norms[own] > 0, self.norms[own], 1.0)[:, None]


class _Asked(_Block):
    """A block of queries and the best found for each: rows of the block, scores (lowest best) and keys, in order of the rows."""

    def __init__(self, names: pa.Array, matrix: pa.Buffer, unit: bool):
        super().__init__(names, matrix, unit)
        self.vectors = self.vectors.copy()  # its batch goes before it
        self.rows, self.scores, self.keys = np.empty(0, dtype=np.int64), np.empty(0), None
        self.bound = np.full(len(names), np.inf)  # of the k-th best

    def holds(self, names: pa.Array, matrix: pa.Buffer) -> bool:
        return np.array_equal(self.vectors.view("int64").ravel(), np.frombuffer(matrix, dtype="int64")) and self.names.equals(names)

    def take(self, rows: np.ndarray, scores: np.ndarray, keys: pa.Array, k: int) -> None:
        if self.keys is not None:
            rows, scores, keys = np.concatenate([self.rows, rows]), np.concatenate([self.scores, scores]), pa.concat_arrays([self.keys, keys])
        table = pa.table({"row": rows, "score": scores, "key": keys})
        order = pc.sort_indices(table, sort_keys=[(name, "ascending") for name in table.column_names], null_placement="at_start").to_numpy()
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        order, rows, place = order[place < k], rows[place < k], place[place < k]
        self.rows, self.scores, self.keys = rows, scores[order], keys.take(pa.array(order))
        self.bound[rows[place == k - 1]] = self.scores[place == k - 1]

    def found(self, names: list[str], sign: float) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.names.take(pa.array(self.rows)), self.keys, pa.array(self.scores * sign)], names=names)


def _dense(asked: np.ndarray, vectors: np.ndarray, metric: str, bound: np.ndarray, k: int, sign: float):
    """(row, column, score) of the k best of every row as good as its bound; of equal scores the first columns."""
    ordered = np.round(_scores(asked, vectors, metric), PLACES) * sign
    if ordered.shape[1] > k:
        known = ~np.isnan(ordered)
        ordered[~known] = np.inf
        last = np.partition(ordered, k - 1, axis=1)[:, k - 1]
        better, equal = ordered < last[:, None], (ordered == last[:, None]) & known
        near = better | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= (k - better.sum(1))[:, None]))
        near &= ordered <= bound[:, None]
    else:
        near = ordered <= bound[:, None]
    i, j = np.nonzero(near)
    return i, j, ordered[i, j]


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """A score that k or more of every row reach: the k-th highest of the highest of groups of columns."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    groups = min(scores.shape[1], max(64, 4 * k))
    highest = np.maximum.reduceat(scores, np.arange(groups) * scores.shape[1] // groups, axis=1)
    return np.partition(highest, groups - k, axis=1)[:, groups - k]


def _tile(asked: _Asked, side: _Block, own: slice, metric: str, k: int, sign: float):
    """(row, column, score) of what can be among the k best of some rows of the block.

    A cosine of single precision differs from the exact one by less than ``slack``; pairs that are
    farther from the k-th best are left out, the others are worked out exactly. Rows with
    many such pairs, as of copies of one vector, are worked out whole.
    """
    bound, vectors = asked.bound[own], asked.vectors[own]
    slack = np.inf
    if asked.units is not None and side.units is not None:
        slack = (vectors.shape[1] + 16) * 2.0 ** -23 + 1e-8 / (asked.least * side.least)
    if not slack < 1e-3:
        return _dense(vectors, side.vectors, metric, bound, k, sign)
    close = asked.units[own] @ side.units.T
    limit = -bound - slack
    if np.isinf(bound).any():
        limit = np.maximum(limit, _kth(close, k).astype("float64") - 2 * slack)
    hits = np.flatnonzero(close >= limit.astype("float32")[:, None])
    i, j = np.divmod(hits, close.shape[1])
    many = np.bincount(i, minlength=len(bound)) > 4 * k + 32
    parts = []
    if many.any():
        few, whole = ~many[i], np.flatnonzero(many)
        i, j = i[few], j[few]
        row, column, score = _dense(vectors[whole], side.vectors, metric, bound[whole], k, sign)
        parts.append((whole[row], column, score))
    dots = np.einsum("ij,ij->i", vectors[i], side.vectors[j])
    parts.append((i, j, np.round(dots / (asked.norms[own][i] * side.norms[j] + 1e-8), PLACES) * sign))
    i, j, scores = (np.concatenate(x) for x in zip(*parts))
    good = scores <= bound[i]
    return i[good], j[good], scores[good]


def _block_scores(query: str, key: str, k: int, metric: str, held: int = HELD, tile: int = TILE):
    sign, unit, names = (1.0 if metric == "l2" else -1.0), metric == "cosine", [query, key, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[_Asked] = []
        # A batch holds many megabytes of vectors: they are read where they lie, one pair of blocks at a time.
        for batch in batches:
            for row in range(batch.num_rows):
                asked_names, matrix, keys, vectors = (batch.column(c)[row] for c in range(4))
                matrix, asked_names, keys = matrix.as_buffer(), asked_names.values, keys.values
                # Queries met before, as a rule the last ones, go on with what they have found.
                asked = next((b for b in reversed(blocks) if b.holds(asked_names, matrix)), None)
                if asked is None:
                    while blocks and sum(len(b.rows) for b in blocks) > held // 2:
                        yield blocks.pop(0).found(names, sign)
                    blocks.append(asked := _Asked(pa.concat_arrays([asked_names]), matrix, unit))
                order = pc.sort_indices(keys, null_placement="at_start").to_numpy()
                if (np.diff(order) != 1).any():  # columns in order of their keys
                    keys, sorted_vectors = keys.take(pa.array(order)), np.frombuffer(vectors.as_buffer(), dtype="float64").reshape(len(order), -1)[order]
                    side = _Block(keys, memoryview(sorted_vectors).cast("B"), unit)
                else:
                    side = _Block(keys, vectors.as_buffer(), unit)
                found = [(low, *_tile(asked, side, slice(low, low + tile), metric, k, sign)) for low in range(0, len(asked.names), tile)]
                rows, columns, scores = (np.concatenate(x) for x in zip(*((i + low, j, score) for low, i, j, score in found)))
                if len(rows):
                    asked.take(rows, scores, keys.take(pa.array(columns)), k)
        for block in blocks:
            if block.keys is not None:
                yield block.found(names, sign)
    return run


def similarity_above(found: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Similarity = 1 - distance, kept from ``threshold`` up."""
    return found.withColumn("similarity", 1 - F.col("distance")).where(F.col("similarity") >= threshold)
