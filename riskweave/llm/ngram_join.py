"""N-gram Jaccard join with a MinHash LSH forest, verified exactly.

Texts with the same words are one class; everything below works on one row per class.
A signature holds ``trees`` groups of ``depth`` minima. Per tree the groups are the
keys of a prefix trie; classes with an equal prefix meet in a bucket. Matching starts
at the full depth. The links found, weighted by the inverse of the chance that a pair
of their similarity is found at this depth, estimate how many there are in all; while
the estimated recall is below ``target`` the prefix is shortened by one and matched again.

Buckets become work units: equal member sets of several trees are one unit, and a bucket
of more than ``unit`` members is cut into blocks that are met pair by pair. Inside a unit
shingle sets are compared exactly as blocks of an incidence matrix. A pair is counted only in
the first tree where it meets, so no pair is counted twice and no list of pairs is ever
written: a unit returns the number of links of each member and a star of edges per
connected part. Components of these edges are the classes of near duplicates.

Defined cases: a null or wordless text is a class of its own without links; a text
with fewer than ``n`` words has one shingle, all its words; equal rows are copies of one
text; a null id never is a class id unless the class has no other; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import discard, give_back, hashed, lists, plain_words, store, text_of

TREES, DEPTH = 28, 5
SIGNED = "_id long, _raw long, _text string, _sig binary"
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows and their offsets per document; short documents have one."""
    counts = np.diff(offsets)
    windows = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    cuts = np.concatenate(([0], np.cumsum(windows)))
    start = np.arange(cuts[-1]) - np.repeat(cuts[:-1] - offsets[:-1], windows)
    end = np.repeat(offsets[1:], windows)
    total = np.zeros(len(start), dtype=np.uint64)
    for i in range(n):
        total *= np.uint64(0x9E3779B97F4A7C15)
        at = start + i
        total += np.where(at < end, words[np.minimum(at, max(len(words) - 1, 0))] if len(words) else 0, np.uint64(1))
    return _mixed(total), cuts


def signatures(names: np.ndarray, cuts: np.ndarray, size: int) -> np.ndarray:
    """(documents, size) minima of 32-bit values; every document must have a shingle."""
    rng = np.random.default_rng(11)
    a = (rng.integers(1, 2 ** 32, size, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    b = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
    out = np.empty((len(cuts) - 1, size), dtype=np.uint32)
    buffer = np.empty(len(names), dtype=np.uint64)
    for k in range(size):
        np.multiply(names, a[k], out=buffer)
        buffer += b[k]
        buffer >>= np.uint64(32)
        out[:, k] = np.minimum.reduceat(buffer, cuts[:-1])
    return out


def _sign(n: int, size: int):
    names_out = [x.split()[0] for x in SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows without words are left out here: a filter of Spark would split every text a second time for it.
            bare, worded = (batch.filter(x) for x in (batch.column(2).is_null(), batch.column(2).is_valid()))
            yield pa.RecordBatch.from_arrays([*bare.columns[:3], pa.nulls(bare.num_rows, pa.binary())], names=names_out)
            for low in range(0, worded.num_rows, 512):
                part = worded.slice(low, 512)
                words, offsets = lists(part.column(3))
                names, cuts = shingles(words.view(np.uint64), offsets, n)
                rows = signatures(names, cuts, size)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([r.tobytes() for r in rows], type=pa.binary())], names=names_out)
            give_back()
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = lists(batch.column(2))
            names, cuts = shingles(words.view(np.uint64), offsets, n)
            sets = [np.unique(names[cuts[i]:cuts[i + 1]]).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sets, type=pa.binary())], names=["_text", "_found", "_set"])
            give_back()
    return run


def overlaps(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by blocks of the incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = int(rank[-1]) + 1
    for low in range(0, width, chunk):
        a, b = np.searchsorted(column, (low, low + chunk))
        block = np.zeros((len(sets), min(chunk, width - low)), dtype=np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        total += block @ block.T
    return total


LINKED = "_text string, links long, root string, pairs double, expected double"


def _verify(threshold: float, trees: int, depth: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_text").reset_index(drop=True)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["_set"]]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        common = overlaps(sets)
        similar = common / (sizes[:, None] + sizes[None, :] - common)
        linked = similar >= threshold
        np.fill_diagonal(linked, False)
        tree, keys = int(rows["tree"].iloc[0]), np.stack(rows["keys"].to_numpy())
        for t in range(tree):  # met in an earlier tree
            linked &= keys[:, t][:, None] != keys[:, t][None, :]
        side = rows["side"].to_numpy()
        linked &= (side[:, None] != side[None, :]) | (side == 0)[:, None]
        root = np.arange(len(rows))
        while True:  # smallest member reached
            best = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(axis=1))
            best = best[best]
            if (best == root).all():
                break
            root = best
        chance = 1 - (1 - np.where(linked, similar, 1) ** depth) ** trees
        weight = rows["copies"].to_numpy()
        return pd.DataFrame({
            "_text": rows["_text"], "links": (linked * weight[None, :]).sum(axis=1).astype(np.int64),
            "root": rows["_text"].to_numpy()[root], "pairs": linked.sum(axis=1) / 2, "expected": (linked / chance).sum(axis=1) / 2})
    return run


def _keys(trees: int, full: int, depth: int):
    """One trie key per tree: the first ``depth`` of its ``full`` minima."""
    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(
        t, F.substring(F.col("_sig"), t * (4 * full) + 1, F.lit(4 * depth))))


def _units(keyed: DataFrame, unit: int) -> DataFrame:
    """(unit, tree, side, _text): buckets as member sets, or pairs of blocks of large buckets.

    side 0: any two members are a pair; 1 and 2: only pairs across.
    """
    met = keyed.select("_text", F.posexplode("keys").alias("tree", "key"))
    # Stored, so that both sides of the join are shuffled for it and a hot bucket can be split.
    sizes = store(met.groupBy("tree", "key").count().where("count > 1"), "sizes")
    met = met.join(sizes, ["tree", "key"])
    small = (
        met.where(F.col("count") <= unit).groupBy("tree", "key").agg(F.sort_array(F.collect_list("_text")).alias("members"))
        .groupBy("members").agg(F.min("tree").alias("tree"))
        .select(F.md5(F.array_join("members", "")).alias("unit"), "tree", F.lit(0).alias("side"), F.explode("members").alias("_text")))
    blocks = F.ceil(F.col("count") / unit)
    large = met.where(F.col("count") > unit).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("_text"), "blocks"))
    large = large.select("tree", "key", "_text", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    large = large.select(
        F.concat_ws(":", "tree", "key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "tree",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "_text")
    return small.unionByName(large)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of the component. Minimum spreading with pointer jumping."""
    both = store(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = store(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = store(spread.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")), "labels")
        old, labels = labels, new.select("node", "label")
        labels.stored_at = new.stored_at
        discard(old)
        if not new.where("label != was").limit(1).count():
            discard(both)
            return labels


def _signed(docs: DataFrame, n: int, size: int) -> DataFrame:
    """(_id, _raw, _text, _sig) of every row: hash of the text as it is, digest of its words and signature, both null without words."""
    side = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text_of()).alias("_raw"), plain_words(text_of()).alias("_words"))
    return side.select(
        "_id", "_raw", F.when(F.size("_words") > 0, F.md5(F.array_join("_words", " "))).alias("_text"),
        hashed(F.col("_words")).alias("_hashes")).mapInArrow(_sign(n, size), SIGNED)


def _asked_sets(docs: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    """(_text, _set) of the asked classes. Their rows are met by id and hash of the text as it is, which need no words;
    the words are worked out of the rows met, and their digest settles whether it is the text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text_of().alias("_whole")).withColumn("_hash", F.xxhash64("_whole"))
    met = rows.join(asked.select("first_id", "_raw", "_text"), F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("_hash") == F.col("_raw")))
    split = met.select("_text", plain_words(F.col("_whole")).alias("_words")).select(
        "_text", F.md5(F.array_join("_words", " ")).alias("_found"), hashed(F.col("_words")).alias("_hashes"))
    return split.mapInArrow(_sets(n), "_text string, _found string, _set binary").where("_text = _found").groupBy("_text").agg(
        F.first("_set").alias("_set"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, target: float = 0.9999, trees: int = TREES,
                    depth: int = DEPTH, unit: int = 256) -> DataFrame:
    """Every document with ``class_id`` (smallest id of its group), ``n_links``, ``text_class`` and ``group_class``."""
    signed = store(_signed(docs, n, trees * depth), "signed")
    # The smallest id of a class, null only if there is no other, and the hash of a row that has it.
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_raw")).alias("first")
    classes = store(signed.where("_text IS NOT NULL").groupBy("_text").agg(
        first, F.count(F.lit(1)).alias("copies"), F.first("_sig").alias("_sig")).select(
        "_text", F.col("first._id").alias("first_id"), F.col("first._raw").alias("_raw"), "copies", "_sig"), "classes")
    named = store(signed.select("_id", "_text"), "texts")
    discard(signed)
    level, sets, known = depth, None, None
    while True:
        keyed = classes.select("_text", "copies", "first_id", "_raw", _keys(trees, depth, level).alias("keys"))
        units = store(_units(keyed, unit), "units")
        asked = keyed.join(units.select("_text").distinct(), "_text", "left_semi")
        sets = store(_asked_sets(docs, asked, n).join(asked, "_text"), "sets")
        linked = store(
            units.join(sets.drop("first_id", "_raw"), "_text").groupBy("unit")
            .applyInPandas(_verify(threshold, trees, level), LINKED).where("links > 0"), "linked")
        known = linked.agg(F.sum("pairs"), F.sum("expected")).first()
        discard(units, sets)
        if level == 1 or known[0] and known[0] >= target * known[1]:
            break
        discard(linked)
        level -= 1
    labels = components(linked.where("root != _text").select(F.col("_text").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("_text").agg(F.sum("links").alias("links"))
    grouped = classes.select("_text", "first_id", "copies").join(links, "_text", "left").join(
        labels.select(F.col("node").alias("_text"), "label"), "_text", "left").select(
        "_text", "first_id", "copies", "links", F.coalesce("label", "_text").alias("group_class"))
    grouped = store(grouped, "grouped")
    discard(classes, linked, labels)
    heads = store(grouped.groupBy("group_class").agg(F.min("first_id").alias("class_id")), "heads")
    by_text = grouped.join(heads, "group_class").select(
        "_text", "class_id", "group_class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    worded = named.where("_text IS NOT NULL").join(by_text, "_text").select(
        F.col("_id").alias("doc_id"), "class_id", "n_links", F.col("_text").alias("text_class"), "group_class")
    empty = named.where("_text IS NULL").select(
        F.col("_id").alias("doc_id"), F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("string").alias("text_class"), F.lit(None).cast("string").alias("group_class"))
    return worded.unionByName(empty)


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Documents with one of each group: the row with the smallest id (and, of equal ids, the smallest text class)."""
    found = store(near_duplicates(docs, **options), "near")
    stays = found.where("text_class IS NOT NULL").groupBy("group_class").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("_id"), "text_class")).alias("_stay")).select("_stay.*")
    keyed = docs.select(F.struct("*").alias("_kept"), "doc_id", "text")
    keyed = keyed.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(2 ** 63 - 1))).withColumn(
        "_words", plain_words(text_of())).withColumn("text_class", F.md5(F.array_join("_words", " ")))
    worded = keyed.where(F.size("_words") > 0).join(stays, ["_id", "text_class"]).dropDuplicates(["_id", "text_class"])
    return worded.select("_kept.*").unionByName(keyed.where(F.size("_words") == 0).select("_kept.*"))
