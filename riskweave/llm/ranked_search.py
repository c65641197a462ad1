"""Ranked lexical search, term at a time with limited accumulators.

The index is a table of segments: a task turns each ``SEGMENT`` documents into one row with
their ids and lengths, the sorted terms and the postings of every term (places of documents
and occurrences), packed. Every document and every term is in it, and building it shuffles nothing.
Segments are wide rows and Spark reads up to 4,096 rows of a row group at once, so the stored
index has ``READ_TOGETHER`` segments in a row group: a task holds that many, whatever the size of a file.

Collection figures come from the segments: the numbers of documents and of terms, and for
the terms of the items their document frequencies, counted per segment and summed. The items
are laid out in blocks of about ``BLOCK_TERMS`` terms with the weights of their terms; each block
is one row, small enough to be sent to every task, and is met with all segments; Python gets it
with the first segment of a task.

Inside a segment an item is evaluated term at a time, rarest term first. A document met
for the first time gets an accumulator with its partial score. A term adds at most its
weight times the largest saturation among its postings; once the bounds of the terms that
remain add up to less than the k-th largest partial score, of this segment or of those
the task has finished, no further document can be among the best: no accumulators are created
from then on, those that cannot reach that score either are given up, and the
postings of the remaining terms are read only to update the survivors exactly. A bound
equal to the k-th score still creates, because the smaller id wins a tie.

The score of a term is weight * ((10^9 * tf) div (1000 * tf + 8 * m)) in 64-bit integers, with
m = 10 + ((90 * n * N) div L) and weight = floor(1000 * ln((2N + 2) / (2df + 1))).

Defined cases: a null text has no terms; documents without terms are not counted and not
found; rows with one item id are one item with the terms of all of them, a null item id is
an item as well; items without a known term give no rows; equal rows of documents are
results of their own; a null document id comes before all others among equal scores; texts
of any length are indexed whole; an empty table gives no rows; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import NULL_ID, give_back, lists, store, text_of

SEGMENT, SEGMENT_BYTES, READ_TOGETHER, BLOCK_TERMS, TOP = 1024, 4 << 20, 4, 50_000, 10
_PIECE = 1 << 20
SEGMENTS = "docs array<long>, lengths array<long>, terms array<binary>, ends array<int>, postings binary"
HITS = "item long, doc_id long, score long"
#: Bytes of ASCII that are no digit or letter become spaces, A-Z become a-z; all others are part of terms.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(256))
NOT_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: bytes) -> Counter:
    """Occurrences of each term; a long text is split piece by piece."""
    data, found, at = text.translate(_TERM_BYTES), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


class _Segment:
    """A segment as it grows: two numbers for a posting and every term once."""

    def __init__(self):
        self.docs, self.lengths, self.sizes, self.held = [], [], [], 0
        self.numbers: dict[bytes, int] = {}
        self.terms, self.counts = array("i"), array("i")

    def add(self, doc: int, text: bytes) -> None:
        if terms := terms_of(text):
            self.docs.append(doc)
            self.lengths.append(terms.total())
            self.sizes.append(len(terms))
            self.held += len(text)
            self.terms.extend([self.numbers.setdefault(term, len(self.numbers)) for term in terms])
            self.counts.extend(terms.values())

    def batch(self) -> pa.RecordBatch:
        order, rank = sorted(self.numbers), np.empty(len(self.numbers), dtype=np.int32)
        rank[[self.numbers[term] for term in order]] = np.arange(len(order))
        ranks = rank[np.frombuffer(self.terms, dtype=np.int32)]
        by_term = np.argsort(ranks, kind="stable")  # in a term by place
        places = np.repeat(np.arange(len(self.docs), dtype=np.int32), self.sizes)[by_term]
        ends = np.cumsum(np.bincount(ranks, minlength=len(order)))
        values = [self.docs, self.lengths, order, ends, _packed(places, np.frombuffer(self.counts, dtype=np.int32)[by_term])]
        kinds = [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary()]
        names = [field.split()[0] for field in SEGMENTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(values, kinds)], names=names)


def _packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    return pa.compress(np.concatenate([places, counts]).tobytes(), codec="zstd", asbytes=True)


def _unpacked(postings: pa.Buffer, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(postings, decompressed_size=8 * n, codec="zstd"), dtype=np.int32)
    return both[:n], both[n:]


def _build(size: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Segment()
        for batch in batches:
            for doc, text in zip(*batch.columns):
                made.add(doc.as_py(), text.as_py())
                if len(made.docs) >= size or made.held >= most:
                    yield made.batch()
                    made = _Segment()
            give_back()
        if made.docs:
            yield made.batch()
    return run


def build_index(docs: DataFrame, segment: int = SEGMENT, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per segment of at most ``segment`` documents; a segment ends once it holds ``segment_bytes`` of text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_of().cast("binary").alias("text")).mapInArrow(
        _build(segment, segment_bytes), SEGMENTS)


def store_index(index: DataFrame) -> DataFrame:
    """The index as written, few segments in a row group."""
    return store(index, "index", **{"parquet.block.row.count.limit": READ_TOGETHER})


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term) of every item, each term once; terms are bytes, as in the index."""
    lowered = F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, NOT_TERMS), lambda w: w != "")
    return items.select(F.col("item_id").cast("long").alias("item"), F.explode(words).alias("term")).distinct().select(
        F.coalesce("item", F.lit(NULL_ID)).alias("item"), F.col("term").cast("binary").alias("term")).distinct()


def weighted_items(index: DataFrame, items: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per block of items: number of documents and terms of the collection, and (item, term, df, weight) of the block."""
    asked = store(item_terms(items), "item_terms")
    size = index.agg(
        F.coalesce(F.sum(F.size("docs")), F.lit(0)).cast("long").alias("n_docs"),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)), F.lit(0)).alias("n_terms"))
    held = index.select(F.explode(F.arrays_zip("terms", "ends", F.concat(F.array(F.lit(0)), F.col("ends")).alias("begins"))).alias("_t"))
    held = held.select(F.col("_t.terms").alias("term"), (F.col("_t.ends") - F.col("_t.begins")).cast("long").alias("df")).where("term IS NOT NULL")
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.col("n_docs") + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    blocks = asked.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_terms), F.lit(1)).alias("blocks"))
    return (
        asked.join(df, "term").crossJoin(F.broadcast(size)).crossJoin(F.broadcast(blocks))
        .groupBy(F.pmod(F.xxhash64("item"), "blocks").alias("block"), "n_docs", "n_terms")
        .agg(F.collect_list(F.struct("item", "term", "df", weight.alias("weight"))).alias("wanted")))


class Item:
    """The terms of one item as numbers of the block's terms, rarest first, and the best scores of a task."""
    __slots__ = ("terms", "weights", "best")

    def __init__(self, terms: list[int], weights: list[int]):
        self.terms, self.weights = terms, weights
        self.best: list[tuple[int, int]] = []  # (-score, doc), best first


def accumulate(item: Item, postings: list[tuple[np.ndarray, np.ndarray, int] | None], size: int, k: int, touched: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of the documents of a segment that can be among the k best.

    ``postings`` holds per term of the block the places, saturations and the largest saturation.
    ``touched`` collects how many postings were looked at, for tests.
    """
    steps = [(postings[t], w) for t, w in zip(item.terms, item.weights) if postings[t] is not None]
    remaining = sum(p[2] * w for p, w in steps)
    floor = -item.best[k - 1][0] if len(item.best) >= k else 0
    scores = np.zeros(size, dtype=np.int64)
    survivors: np.ndarray | None = None
    for (places, saturation, largest), weight in steps:
        if survivors is None:
            if remaining < floor:
                survivors = np.flatnonzero(scores + remaining >= floor)
                survivors = survivors[scores[survivors] > 0]
        if survivors is None:
            scores[places] += saturation * weight
            if touched is not None:
                touched.append(len(places))
        elif len(survivors):
            at = np.minimum(np.searchsorted(places, survivors), len(places) - 1)
            hit = places[at] == survivors
            scores[survivors[hit]] += saturation[at[hit]] * weight
            if touched is not None:
                touched.append(int(hit.sum()))
        remaining -= largest * weight
        if survivors is None and size > k:
            kth = int(np.partition(scores, size - k)[size - k])
            floor = max(floor, kth)
    if survivors is None:
        survivors = np.flatnonzero(scores)
    return survivors, scores[survivors]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, items = {}, {}
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                if part.column(2).null_count == 0:
                    numbers, items = _block(part.column(2)[0].as_py())
                n_docs, n_terms = (part.column(i)[0].as_py() for i in range(2))
                docs, lengths, ends = (lists(part.column(i))[0] for i in (3, 4, 6))
                places, counts = _unpacked(part.column(7)[0].as_buffer(), int(ends[-1]))
                m8 = 8 * (10 + 90 * lengths * n_docs // n_terms)
                postings: list = [None] * len(numbers)
                for at, term in enumerate(part.column(5)[0].as_py()):
                    number = numbers.get(term)
                    if number is not None:
                        low, high = int(ends[at - 1]) if at else 0, int(ends[at])
                        here, tf = places[low:high], counts[low:high].astype(np.int64)
                        saturation = 1_000_000_000 * tf // (1000 * tf + m8[here])
                        postings[number] = (here, saturation, int(saturation.max()))
                for item in items.values():
                    found, scores = accumulate(item, postings, len(docs), k)
                    if len(found):
                        keep = np.lexsort((docs[found], -scores))[:k]
                        item.best = sorted(item.best + list(zip((-scores[keep]).tolist(), docs[found[keep]].tolist())))[:k]
            batch = part = docs = lengths = ends = None  # else they are held while the next batch is read
            give_back()
        hits = [(name, doc, -score) for name, item in items.items() for score, doc in item.best if score < 0]
        columns = list(zip(*hits)) if hits else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])
    return run


def _block(wanted: list[dict]) -> tuple[dict[bytes, int], dict[int, Item]]:
    numbers: dict[bytes, int] = {}
    by_item: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for w in sorted(wanted, key=lambda w: (w["df"], w["term"])):
        by_item[w["item"]].append((w["df"], numbers.setdefault(w["term"], len(numbers)), w["weight"]))
    return numbers, {name: Item([t for _, t, _ in terms], [w for _, _, w in terms]) for name, terms in by_item.items()}


def search(index: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, best first, equal scores by ascending id."""
    blocks = store(weighted_items(index, items, block_terms), "items")
    first = F.monotonically_increasing_id().bitwiseAND(2 ** 33 - 1) == 0  # of a task
    columns = ["n_docs", "n_terms", F.when(first, F.col("wanted")).alias("wanted"), *[field.split()[0] for field in SEGMENTS.split(", ")]]
    best = None
    for row in blocks.select("block").orderBy("block").collect():  # the numbers of the blocks only
        one = blocks.where(F.col("block") == row.block)
        found = index.crossJoin(F.broadcast(one)).select(*columns).mapInArrow(_search(k), HITS)
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = blocks.select(*[F.col("block").alias(name) for name in ("item", "doc_id", "score")]).limit(0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    known = lambda name: F.when(F.col(name) != NULL_ID, F.col(name))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        known("item").alias("item_id"), "rank", known("doc_id").alias("doc_id"), "score")
