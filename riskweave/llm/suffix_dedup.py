"""Repeated byte strings by prefix-free parsing.

A text is parsed at triggers: the places whose 8-byte rolling hash is the smallest in
some window of ``WINDOW`` places. Every string of ``length`` bytes holds a trigger that
depends on its own bytes only (the smallest hash of its first window), so equal strings
are anchored at equal places. The starts that share an anchor form a phrase: the bytes
from the first start to the end of the last string. Phrases with equal bytes are one
dictionary entry.

Of the corpus order only the classes of suffixes that agree on ``length`` bytes are needed,
so suffixes carry names instead of ranks:
* ``head`` names the bytes after an anchor that all strings anchored there share. A head
  that occurs once ends the search; that is most of a corpus.
* A phrase whose dictionary entry occurs twice is repeated as a whole, without a look at its strings.
* Only heads with several dictionary entries have their strings named, each entry once
  however often it occurs: first the bytes that a class of neighbouring starts shares,
  then, where these occur twice, string by string. A name in two entries is a repeated string.
Hot phrases are counted in partial aggregates and never gathered.

Defined cases: a null text is empty; texts shorter than ``length`` bytes lose nothing;
equal rows are copies of each other and lose all that a copy loses, whatever their
number; a row is known by its id and a 64-bit hash of its text, null ids are one id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import NULL_ID, discard, store, text_of

LENGTH, GRAM, WINDOW, STEP = 400, 8, 192, 32
_SEGMENT = 1 << 20
PHRASES = "head long, entry long, _id long, _row long, first int, last int, anchor int"
CUT = "head long, _id long, _row long, first int, last int, anchor int, once boolean, bytes binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<first:int,end:int>>"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def phrases(data: bytes, length: int, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(first start, last start, anchor) for all starts of strings of ``length`` bytes, in order."""
    starts = len(data) - length + 1
    if starts <= 0:
        return []
    out: list[tuple[int, int, int]] = []
    raw = np.frombuffer(data, dtype=np.uint8)
    for low in range(0, starts, _SEGMENT):
        high = min(starts, low + _SEGMENT)
        part = raw[low:high + window - 1 + GRAM - 1]
        grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(part, GRAM)).view(np.uint64).ravel()
        mixed = ((grams ^ (grams >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)) & np.uint64(0xFFFFFFFF00000000)
        mixed |= np.arange(len(mixed), dtype=np.uint64)  # the leftmost of equals
        anchor = (sliding_min(mixed, window) & np.uint64(0xFFFFFFFF)).astype(np.int64) + low
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        last = np.concatenate((first[1:] - 1, [len(anchor) - 1]))
        for a, b, t in zip((first + low).tolist(), (last + low).tolist(), anchor[first].tolist()):
            if out and out[-1][2] == t:
                out[-1] = (out[-1][0], b, t)
            else:
                out.append((a, b, t))
    return out


def _signed(names: list[int]) -> pa.Array:
    return pa.array(np.array(names, dtype=np.uint64).view(np.int64))


def _parse(length: int, window: int):
    shared = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows: list[tuple] = []
                for doc, row, data in zip(*[c.to_pylist() for c in part.columns]):
                    view = memoryview(data)
                    rows += [(name(view[t:t + shared]), name(view[a:b + length], (t - a) << 16 | (b - a)), doc, row, a, b, t)
                             for a, b, t in phrases(data, length, window)]
                columns = list(zip(*rows)) if rows else [[]] * 7
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [_signed(columns[0]), _signed(columns[1]), *[pa.array(c, type=t) for c, t in zip(columns[2:], kinds)]],
                    names=[x.split()[0] for x in PHRASES.split(", ")])
    return run


def _cut_phrases(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[tuple] = []
                for doc, row, data, wanted in zip(*[c.to_pylist() for c in part.columns]):
                    rows += [(w["head"], doc, row, w["first"], w["last"], w["anchor"], w["once"], data[w["first"]:w["last"] + length]) for w in wanted]
                columns = list(zip(*rows)) if rows else [[]] * 8
                kinds = [pa.int64()] * 3 + [*[pa.int32()] * 3, pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in CUT.split(", ")])
    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            rows = []
            for doc, data, spans in zip(*[c.to_pylist() for c in batch.slice(low, 256).columns]):
                gone, kept, at = merged([(s["first"], s["end"]) for s in spans or []]), [], 0
                for a, b in gone:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                rows.append((doc, len(data), sum(b - a for a, b in gone), len(gone), b"".join(kept), [{"first": a, "end": b} for a, b in gone]))
            span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.binary(), span])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """(_id, _row, spans): per document the ranges covered by repeated strings, not yet merged."""
    side = _side(docs)
    parsed = side.select("_id", "_row", F.col("_text").cast("binary").alias("_text")).mapInArrow(_parse(length, window), PHRASES)
    entries = parsed.groupBy("head", "entry").count()
    # Counts are stored before they meet the rows again: both sides of such a join are then
    # shuffled for it, and a hot phrase can be split.
    heads = store(entries.groupBy("head").agg(
        F.sum("count").alias("phrases"), F.count(F.lit(1)).alias("entries")).where("phrases > 1").select("head", "entries"), "heads")
    # Equal rows have the same phrases: they become one row with a count, in a step of its own, so that the join can be split.
    several = store(parsed.join(heads, "head"), "phrases")
    found = store(several.groupBy("head", "entry", "entries", "_id", "_row", "first", "last", "anchor").agg(
        F.count(F.lit(1)).alias("copies")), "phrases")
    discard(heads, several)
    mixed = found.where("entries > 1")
    by_entry = store(mixed.groupBy("head", "entry").agg(
        F.sum("copies").alias("n"), F.min(F.struct("_id", "_row", "first")).alias("chosen")), "entries")
    mixed = store(mixed.join(by_entry, ["head", "entry"]).select(
        "head", "_id", "_row", "first", "last", "anchor", (F.col("n") == 1).alias("once"),
        (F.col("chosen") == F.struct("_id", "_row", "first")).alias("named")), "mixed")
    discard(by_entry)
    wanted = mixed.where("named").groupBy("_id", "_row").agg(
        F.collect_list(F.struct("head", "first", "last", "anchor", "once")).alias("wanted"))
    cut = store(
        side.join(wanted, ["_id", "_row"]).groupBy("_id", "_row").agg(
            F.first("_text").alias("_text"), F.first("wanted").alias("wanted"))
        .select("_id", "_row", F.col("_text").cast("binary").alias("_text"), "wanted")
        .mapInArrow(_cut_phrases(length), CUT), "cut")
    strings = store(_named_strings(cut, length, min(STEP, length - window)), "strings")
    discard(cut)
    same = ["head", "back", "name"]
    twice = store(strings.groupBy(*same).count().where("count > 1").select(*same), "twice")
    whole = found.where("entries = 1").select("_id", "_row", "first", (F.col("last") + length).alias("end"))
    whole = whole.unionByName(mixed.where("NOT once").select("_id", "_row", "first", (F.col("last") + length).alias("end")))
    single = strings.where("once").join(twice, same).select("_id", "_row", F.col("at").alias("first"), (F.col("at") + length).alias("end"))
    return whole.unionByName(single).groupBy("_id", "_row").agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def _named_strings(cut: DataFrame, length: int, step: int) -> DataFrame:
    """(head, back, name, _id, _row, at, once): strings of the cut phrases that can occur twice, by name.

    ``back`` is the distance from the string's start to its anchor. Strings whose
    ``back`` falls into one class of ``step`` share all but ``step - 1`` of their bytes; the
    shared bytes are named first, and only classes named twice name their strings.
    """
    phrase = ["_id", "_row", "first"]

    def part(start: Column, size: int) -> Column:
        return F.xxhash64(F.substring(F.col("bytes"), start - F.col("first") + 1, F.lit(size)))

    classes = F.sequence(F.floor((F.col("anchor") - F.col("last")) / step).cast("int"), F.floor((F.col("anchor") - F.col("first")) / step).cast("int"))
    rough = cut.select(*phrase, "head", "anchor", "bytes", F.explode(classes).alias("class")).select(
        *phrase, "head", "class", part(F.col("anchor") - F.col("class") * step, length - step + 1).alias("shared"))
    key = ["head", "class", "shared"]
    twice = store(rough.groupBy(*key).count().where("count > 1").select(*key), "classes")
    alive = rough.join(twice, key).groupBy(*phrase).agg(F.collect_list("class").alias("classes"))
    starts = F.filter(F.sequence("first", "last"), lambda i: F.array_contains(
        F.col("classes"), F.floor((F.col("anchor") - i) / step).cast("int")))
    return cut.join(alive, phrase).select("head", "anchor", "bytes", *phrase, "once", F.explode(starts).alias("at")).select(
        "head", (F.col("anchor") - F.col("at")).alias("back"), part(F.col("at"), length).alias("name"), "_id", "_row", "at", "once")


def _side(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text_of()).alias("_row"), text_of().alias("_text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """Per document the byte counts, the removed spans and the bytes that stay."""
    spans = repeated_spans(docs, length, window)
    return _side(docs).join(spans, ["_id", "_row"], "left").select(
        "doc_id", F.col("_text").cast("binary").alias("_text"), "spans").mapInArrow(_remove, RESULT)
