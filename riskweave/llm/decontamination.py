"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask of token positions; the ignored positions may differ, so a passage
with substituted words is still hit. Test items are hashed under every mask, training
documents are hashed the same way in one vectorised pass, and the two sides meet on
equal hashes. Around each hit the item is laid along the document on that diagonal,
and the best-scoring stretch (+1 for an equal token, ``-penalty`` for another) decides.

A copy of a whole item counts from ``share`` equal tokens on, wherever the others are. With
at most s others, one of s + 1 equal blocks of the item is untouched, so the blocks are
seeds too (two to four words long at 0.8) and no such copy is missed.

The benchmark is packed where it lies into blocks of about ``block_words`` tokens at most,
the documents into slices, and every block meets every slice in some task. Nothing passes
through this module's driver code and the plan is the same for any benchmark size.

Defined cases: null texts have no words; items with fewer than ``min_item_words`` words (one word) are no evidence and are not searched; items
shorter than the masks are searched by their blocks alone, so that one of two to four words must occur whole; words cut off by an end of the document count as substituted; an empty table on either side gives no rows; rows
with a null id give rows with a null id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import NULL_ID, give_back, hashed, lists, plain_words, store, text_of

MASKS = ("11111111", "11011011011", "1110010111001", "10101100101101")
SCHEMA = "doc_id long, item_id long, doc_start long, item_start long, length long, n_matched long, n_item_words long"
KEYED = SCHEMA + ", _row long"
PACKED = {"item": ["item_ids", "item_offsets", "item_words"], "doc": ["doc_ids", "doc_offsets", "doc_rows", "doc_words"]}
_FILTER_BITS = 22


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """One hash per window start; positions with 0 in the mask do not count."""
    count = len(tokens) - len(mask) + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for at, bit in enumerate(mask):
        if bit == "1":
            total *= factor
            total += tokens[at:at + count]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    return total


def best_stretch(equal: np.ndarray, penalty: int) -> tuple[int, int, int]:
    """(start, end, matches) of the stretch with the highest score, the first of equals."""
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -penalty))))
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    start = int(np.argmin(sums[:end + 1]))
    return start, end, int(equal[start:end].sum())


def least_equal(n_words: int, share: float) -> int:
    """Equal tokens a copy of a whole item needs."""
    return int(np.ceil(share * n_words - 1e-9))


def blocks(n_words: int, share: float) -> tuple[int, range]:
    """(length, starts) of blocks of which a copy of a whole item leaves one untouched."""
    spare = n_words - least_equal(n_words, share)
    length = n_words // (spare + 1)
    return length, range(0, (spare + 1) * length, length)


def _index(items: list[np.ndarray], masks: tuple[str, ...], share: float) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per mask: sorted hashes with item and position, and a fixed-size table of hash prefixes."""
    seeds: dict[str, list] = {}
    for i, item in enumerate(items):
        for mask in masks:
            codes = seed_hashes(item, mask)
            seeds.setdefault(mask, []).append((codes, np.full(len(codes), i), np.arange(len(codes))))
        length, starts = blocks(len(item), share)
        seeds.setdefault("1" * length, []).append((seed_hashes(item, "1" * length)[starts], np.full(len(starts), i), np.array(starts)))
    out = []
    for mask, parts in seeds.items():
        names, owner, place = (np.concatenate(x) for x in zip(*parts))
        if not len(names):
            continue
        order = np.argsort(names, kind="stable")
        seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
        seen[names >> np.uint64(64 - _FILTER_BITS)] = True
        out.append((mask, names[order], owner[order], place[order], seen))
    return out


def _equal(tokens: np.ndarray, offsets: np.ndarray, flat: np.ndarray, bounds: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Equal tokens over the whole overlap of every hit."""
    doc, item, diagonal = hits.T
    low = np.maximum(0, -diagonal)
    size = np.minimum(bounds[item + 1] - bounds[item], offsets[doc + 1] - offsets[doc] - diagonal) - low
    ends = np.cumsum(size)
    step = np.arange(ends[-1]) - np.repeat(ends - size, size)
    same = tokens[np.repeat(offsets[doc] + diagonal + low, size) + step] == flat[np.repeat(bounds[item] + low, size) + step]
    return np.add.reduceat(same, ends - size, dtype=np.int64)


def _hits(tokens: np.ndarray, offsets: np.ndarray, index: list, flat: np.ndarray, bounds: np.ndarray, least: np.ndarray,
          cells: int = 4_000_000) -> np.ndarray:
    """Distinct (document row, item, diagonal, equal tokens) with equal seed hashes and enough equal tokens to be judged.

    Hits are laid out in portions of about ``cells`` tokens, so frequent seeds take time, not memory.
    """
    found, portion = [], max(1, cells // int(np.max(np.diff(bounds))))
    for mask, names, owner, place, seen in index:
        codes = seed_hashes(tokens, mask)
        at = np.flatnonzero(seen[codes >> np.uint64(64 - _FILTER_BITS)])
        doc = np.searchsorted(offsets, at, side="right") - 1
        inside = at + len(mask) <= offsets[doc + 1]
        at, doc = at[inside], doc[inside]
        start, stop = np.searchsorted(names, codes[at], "left"), np.searchsorted(names, codes[at], "right")
        ends = np.cumsum(stop - start)
        for low in range(0, int(ends[-1]) if len(ends) else 0, portion):
            number = np.arange(low, min(low + portion, int(ends[-1])))
            seed = np.searchsorted(ends, number, side="right")
            entry = stop[seed] - (ends[seed] - number)
            hits = np.unique(np.stack([doc[seed], owner[entry], at[seed] - offsets[doc[seed]] - place[entry]], axis=1), axis=0)
            equal = _equal(tokens, offsets, flat, bounds, hits)
            enough = equal >= least[hits[:, 1]]
            found.append(np.column_stack([hits[enough], equal[enough]]))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 4), dtype=np.int64)


def _packed(df: DataFrame, side: str, most_rows: int, most_words: int) -> DataFrame:
    """Rows (id, words, more) to rows (ids, offsets, more, bytes of the words), bounded by rows and words; one row may be longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = lists(batch.column(1))
            low = 0
            while low < batch.num_rows:
                high = int(np.searchsorted(offsets, offsets[low] + most_words, side="right")) - 1
                high = min(max(high, low + 1), low + most_rows, batch.num_rows)
                part = words[offsets[low]:offsets[high]]
                columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (
                    batch.column(0).slice(low, high - low), pa.array(offsets[low:high + 1] - offsets[low]),
                    *[more.slice(low, high - low) for more in batch.columns[2:]])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([part.tobytes()], pa.binary())], names=PACKED[side])
                low = high

    return df.mapInArrow(run, ", ".join(f"{x} {'binary' if x == PACKED[side][-1] else 'array<long>'}" for x in PACKED[side]))


class _Block:
    """A block of test items and its index."""

    def __init__(self, ids: list, bounds: np.ndarray, words: bytes, masks: tuple[str, ...], need: int, share: float):
        self.ids, self.bounds, self.flat = ids, bounds, np.frombuffer(words, dtype=np.uint64)
        self.items = [self.flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.index = _index(self.items, masks, share)
        self.least = np.array([min(need, least_equal(len(x), share)) for x in self.items])


def _search(masks: tuple[str, ...], penalty: int, need: int, share: float, block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what the groups of an earlier step left in this worker
        known: dict[tuple, _Block] = {}  # as many blocks as hold ``block_words`` words, one at least
        for row in (one for whole in batches for i in range(whole.num_rows) for one in whole.slice(i, 1).to_pylist()):
            name = tuple(row["item_ids"]), tuple(row["item_offsets"]), row["item_words"]
            if name not in known:
                while known and sum(len(x.flat) for x in known.values()) + len(name[2]) // 8 > block_words:
                    known.pop(next(iter(known)))
                known[name] = _Block(row["item_ids"], np.array(row["item_offsets"]), name[2], masks, need, share)
            block, docs, keys = known[name], row["doc_ids"], row["doc_rows"]
            ids, items, least = block.ids, block.items, block.least
            tokens, offsets = np.frombuffer(row["doc_words"], dtype=np.uint64), np.array(row["doc_offsets"])
            best: dict[tuple[int, int], tuple] = {}
            for doc, item, diagonal, equal in _hits(tokens, offsets, block.index, block.flat, block.bounds, least).tolist():
                text, want = tokens[offsets[doc]:offsets[doc + 1]], items[item]
                start, end = max(0, diagonal), min(len(text), diagonal + len(want))
                same = text[start:end] == want[start - diagonal:end - diagonal]
                a, b, matched = best_stretch(same, penalty)
                if matched < least[item]:
                    if equal < least_equal(len(want), share):
                        continue
                    places = np.flatnonzero(same)  # a copy of the whole item, from its first equal token to its last
                    a, b, matched = int(places[0]), int(places[-1]) + 1, equal
                row = (matched, -(start + a), start + a - diagonal, b - a)
                best[doc, item] = max(best.get((doc, item), row), row)
            rows = [(docs[d], ids[i], -r[1], r[2], r[3], r[0], len(items[i]), keys[d]) for (d, i), r in sorted(best.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in (zip(*rows) if rows else [[]] * 8)],
                names=[x.split()[0] for x in KEYED.split(", ")])
    return run


def _found(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, need: int = 13, share: float = 0.8,
           penalty: int = 3, min_item_words: int = 2, block_words: int = 1_000_000) -> DataFrame:
    words = hashed(plain_words(text_of())).alias("words")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words).where(F.size("words") >= max(1, min_item_words))
    side = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words, F.xxhash64(text_of()).alias("_row"))
    return _packed(items, "item", block_words, block_words).crossJoin(_packed(side, "doc", 512, 500_000)).mapInArrow(
        _search(masks, penalty, need, share, block_words), KEYED)


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per (document, item) with ``need`` equal tokens in the best stretch, or ``share`` of the item's tokens equal."""
    return _found(docs, benchmark, **settings).drop("_row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Documents without a hit. A row is known by its id and a hash of its text, as in line dedup: of rows
    with one id, or with a null id, those that hold a passage go and the others stay; equal rows share their fate.
    """
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), "_row"]
    hits = store(_found(docs, benchmark, **settings).select(*key).distinct(), "hits")
    keyed = docs.select(F.struct("*").alias("_kept"), key[0], F.xxhash64(text_of()).alias("_row"))
    return keyed.join(hits, ["_id", "_row"], "left_anti").select("_kept.*")
