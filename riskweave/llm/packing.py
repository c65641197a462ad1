"""Packing along a space-filling curve.

One pass turns each text into token ids and a document vector: every token id is hashed
to a fixed random direction and the mean of the directions, squashed into a cube of few
dimensions, gets a Hilbert key. Ids are stored in chunks of at most one sequence, so a
row stays small however long its document. Chunks are range-sorted by (key, document,
start); each partition is one stretch of the curve and lays its ids end to end into
sequences. Cuts are free, so only the end of a partition is short: it is split into
sequences whose lengths are powers of two, which need no padding.

Defined cases: a null text is empty and still has its end token; a null id sorts first;
equal rows are packed each by itself; an empty table gives no rows. The partition bounds
are sampled once per execution: store the result before using it in two actions.
"""

from __future__ import annotations

import sys
import types
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import give_back, slices, store, text_of

END = 2
LENGTH = 4096
DIMENSIONS, BITS = 4, 10
#: Entries of the two memories of an encoder: runs that make up chunks, and words with other signs.
_CACHE_CHUNKS, _CACHE_WORDS = 180_000, 30_000
#: Runs given to the tokenizer at once, whose answer takes some hundred bytes for each, and chunks laid at once.
_ASKED, _LAID = 10_000, 1024
_MARKS = ".,;:!?*%&$#)"
#: Letters up to "ž" as ranges; without "İ", whose lower case ends in a combining mark that belongs to the marks then.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ž"
_ALL_LETTERS = "".join(c for c in map(chr, range(0x17F)) if c.isalpha() and c != "İ")

CHUNKS = "doc_id long, curve_key long, start long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, curve_key long, ids binary"


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (n, dims), each below 2**bits.

    The coordinates are first turned into the transposed index (reflect and rotate from
    the highest bit down, then Gray-code), whose bits are then interleaved.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Memory:
    """Ids by text, at most about ``most`` of them: half are those in use since the other half was full."""
    def __init__(self, most: int):
        self.half = most // 2
        self.used: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.used)

    def get(self, asked: list[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of distinct texts in their order; ``learn`` gives those not remembered."""
        if len(self.used) > self.half:
            self.used, self.older = {"": b""}, self.used
        found = list(map(self.used.get, asked))
        missing = [n for n, ids in enumerate(found) if ids is None]
        new = []
        for n in missing:
            found[n] = self.older.get(asked[n])
            if found[n] is None:
                new.append(n)
        if new:
            for n, ids in zip(new, learn([asked[n] for n in new])):
                found[n] = ids
        self.used.update((asked[n], found[n]) for n in missing)
        return found


class WordIds:
    """Token ids of texts, each distinct run of a slice looked up once.

    The vocabulary splits at white space, and runs of letters and runs of marks are
    separate pieces to it. A chunk of plain Latin letters with trailing marks is put
    together from the ids of both parts; any other chunk goes through the tokenizer whole.
    Chunks are cut and put together a slice at a time, so only runs are remembered.
    """
    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.chunks, self.words = Memory(_CACHE_CHUNKS), Memory(_CACHE_WORDS)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of letter runs and mark runs; each ends with exactly one end-of-word token."""
        if len(words) > _ASKED:
            return [ids for low in range(0, len(words), _ASKED) for ids in self._encode(words[low:low + _ASKED])]
        joined = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(joined, dtype=self.dtype)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            return [self._whole(word) for word in words]
        flat, ends = ids.tobytes(), (cuts * ids.itemsize).tolist()
        return [flat[low:high] for low, high in zip([0] + ends, ends)]

    def _whole(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _coded(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks as bytes, in their order."""
        word = pc.utf8_rtrim(chunks, characters=_MARKS)
        plain = pc.match_substring_regex(word, f"^[{_LETTERS}]+$")
        put_together = chunks.filter(plain)
        lowered, marks = pc.utf8_lower(word.filter(plain)), pc.utf8_ltrim(put_together, characters=_ALL_LETTERS)
        runs = pa.concat_arrays([lowered, marks]).dictionary_encode()
        coded = self.chunks.get(runs.dictionary.to_pylist(), self._encode)
        whole = self.words.get(chunks.filter(pc.invert(plain)).to_pylist(), lambda new: [self._whole(chunk) for chunk in new])
        parts, number = pa.array(coded, type=pa.large_binary()).take(runs.indices), len(put_together)
        joined = pc.binary_join_element_wise(parts[:number], parts[number:], pa.scalar(b"", pa.large_binary()))
        # The chunks put together come first, then the others; each is taken from its place.
        places, own = np.empty(len(chunks), dtype=np.int64), plain.to_numpy(zero_copy_only=False)
        places[own], places[~own] = np.arange(number), np.arange(number, len(chunks))
        return pa.concat_arrays([joined, pa.array(whole, type=pa.large_binary())]).take(pa.array(places))

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text: its chunks are numbered, each distinct one is looked up, and the ids are gathered by number."""
        plain = texts.to_pylist() if isinstance(texts, pa.Array) else texts
        if not all(t.isascii() or unicodedata.is_normalized("NFC", t) for t in plain) or not isinstance(texts, pa.Array):
            texts = pa.array([unicodedata.normalize("NFC", t) for t in plain], type=pa.large_string())
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()
        taken = self._coded(numbered.dictionary).take(numbered.indices)
        _, ends, flat = taken.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[taken.offset:]
        cuts = ends[np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy())))].tolist() if len(taken) else [0] * (len(plain) + 1)
        flat = memoryview(flat) if flat else b""
        return [bytes(flat[low:high]) for low, high in zip(cuts, cuts[1:])]


def word_ids(path: str, dtype: str) -> WordIds:
    """The encoder of this Python worker: one at a time, kept from task to task, its memories bounded."""
    home = sys.modules.setdefault("_riskweave_worker", types.ModuleType("_riskweave_worker"))
    if getattr(home, "encoder", (None,))[0] != (path, dtype):
        home.encoder = (path, dtype), WordIds(path, dtype)
    return home.encoder[1]


def _tokenise(path: str, dtype: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path, dtype)
        directions = np.random.default_rng(7).standard_normal((1 << 16, DIMENSIONS)).astype(np.float32)
        width, last = np.dtype(dtype).itemsize, np.array([end], dtype=dtype).tobytes()
        step = length * width
        for batch in batches:
            for part in slices(batch, 1, 1024, 4_000_000):
                coded = [x + last for x in encode(part.column(1))]
                means = np.stack([directions.take(np.frombuffer(x, dtype=dtype) & 0xFFFF, axis=0).sum(axis=0) / (len(x) // width) for x in coded])
                cube = np.clip(((np.tanh(means * 6) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
                keys = hilbert_key(cube, BITS).tolist()
                rows = [(doc, key, at // width, len(x) // width, x[at:at + step])
                        for doc, key, x in zip(part.column(0).to_pylist(), keys, coded) for at in range(0, len(x), step)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.binary()])],
                    names=["doc_id", "curve_key", "start", "doc_tokens", "ids"])
            give_back()
    return run


def token_chunks(docs: DataFrame, path: str, dtype: str = "uint16", length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, curve_key, start, doc_tokens, ids): ids of each document in chunks of at most one sequence."""
    side = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return side.mapInArrow(_tokenise(path, dtype, length, end), CHUNKS)


def _lay(dtype: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, room, open_rows = TaskContext.get().partitionId() << 32, length, []
        width = np.dtype(dtype).itemsize

        def wide(x: memoryview) -> bytes:
            return np.frombuffer(x, dtype=dtype).astype("<u4").tobytes()

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 7 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)],
                                              names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in (whole.slice(low, _LAID) for whole in batches for low in range(0, whole.num_rows, _LAID)):
            done = []
            for doc, key, start, total, ids in zip(*[c.to_pylist() for c in batch.columns]):
                view, count, at = memoryview(ids), len(ids) // width, 0
                while at < count:
                    n = min(room, count - at)
                    open_rows.append((doc, start + at, n, total, sequence, length - room, key, view[at * width:(at + n) * width]))
                    at, room = at + n, room - n
                    if not room:
                        done += [(*r[:7], wide(r[7])) for r in open_rows]
                        sequence, room, open_rows = sequence + 1, length, []
            yield batch_of(done)
        # the rest of this stretch: powers of two, largest first
        rest, done = length - room, []
        size = 1 << rest.bit_length() >> 1
        queue = open_rows[::-1]
        while rest:
            if size > rest:
                size >>= 1
                continue
            offset = 0
            while offset < size:
                doc, start, n, total, _, _, key, view = queue.pop()
                take = min(n, size - offset)
                done.append((doc, start, take, total, sequence, offset, key, wide(view[:take * width])))
                if take < n:
                    queue.append((doc, start + take, n - take, total, 0, 0, key, view[take * width:]))
                offset += take
            sequence, rest = sequence + 1, rest - size
        yield batch_of(done)
        give_back()
    return run


def pack(docs: DataFrame, path: str, dtype: str = "uint16", length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids; ``ids`` are little-endian unsigned 32-bit."""
    # The stored row number follows the starts of a document and tells equal rows apart, so that any place can be a border.
    chunks = store(token_chunks(docs, path, dtype, length, end).withColumn("row", F.monotonically_increasing_id()), "tokens")
    order = ["curve_key", "doc_id", "row"]
    laid = chunks.repartitionByRange(*order).sortWithinPartitions(*order)
    return laid.select("doc_id", "curve_key", "start", "doc_tokens", "ids").mapInArrow(_lay(dtype, length), PIECES)
