"""Byte-level BPE encoding and decoding in linear time.

The vocabulary is a file of ranks (base64 bytes and rank a line); lower ranks merge first.
Token bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton over the
vocabulary finds the longest token at every place of a piece in one pass. Encoding then
walks the piece from left to right: it takes the longest token, and accepts it if merging
by rank would leave the previous token and this one side by side. That answer depends on
the two tokens only and is remembered. If it is no, the next shorter token that is a prefix
is tried; if none is left, the previous token is given up and its place is marked as one
that no encoding passes through, so that no place is given up twice.

Whether two tokens stay side by side is found by undoing their merges, the latest first: if
at some moment the two parts that touch would have merged earlier than the merge undone
last, merging by rank would have chosen them.

Each match of the split pattern is encoded by itself, and a distinct short piece once as
long as it stays in the piece memory. All memories have bounds and go when the task ends.

Defined cases: a null text is empty and has no ids; special tokens are ordinary text; a
null id is kept; equal rows are encoded each by itself; texts of any length are encoded
whole, long ones piece by piece; an empty table gives no rows; other columns, whatever
their names, are not read. The decoded bytes are those of the text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import text_of

ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded binary"
_PAIRS, _PIECES, _SHORT, _STREAMED, _ROWS = 250_000, 300_000, 64, 1 << 20, 256


class ByteBpe:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        self.ranks = ranks
        self.bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self._sizes = [len(token) for token in self.bytes]
        self.pattern, self._automaton = pattern, None
        self._pairs: dict[int, bool] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._prefix: dict[int, int | None] = {}
        self._pieces: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str | None = None) -> ByteBpe:
        with open(path, "rb") as lines:
            rows = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in rows}, pattern)

    def _matcher(self):
        if self._automaton is None:
            import ahocorasick
            self._automaton = ahocorasick.Automaton()
            for token, rank in self.ranks.items():
                self._automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
            self._automaton.make_automaton()
        return self._automaton

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self._prefix:
            data = self.bytes[token]
            self._prefix[token] = next((r for n in range(len(data) - 1, 0, -1) if (r := self.ranks.get(data[:n])) is not None), None)
        return self._prefix[token]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._parts:
            data, left, found = self.bytes[token], self.shorter(token), None
            while left is not None and found is None:
                right = self.ranks.get(data[len(self.bytes[left]):])
                if right is not None and left < token and right < token and self._stay_apart(left, right, token):
                    found = (left, right)
                left = self.shorter(left)
            self._parts[token] = found
        return self._parts[token]

    def _stay_apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge before rank ``limit`` joins the touching ends of two tokens."""
        while True:
            joined = self.ranks.get(self.bytes[left] + self.bytes[right])
            if joined is not None and joined < limit:
                return False
            # Undo the later of the two merges; of equal merges the left one comes first.
            of_left, of_right = self.parts(left), self.parts(right)
            if of_left is not None and (of_right is None or left > right):
                limit, left = left, of_left[1]
            elif of_right is not None:
                limit, right = right + 1, of_right[0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= _PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._stay_apart(left, right, len(self.bytes))
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, as merging by rank gives them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [0] * size
        for end, (token, back) in self._matcher().iter(piece.decode("latin-1")):
            longest[end - back] = token  # ends come in ascending order, so the longest is last
        ids: list[int] = []
        at, passable, lengths, pairs = 0, bytearray(b"\x01") * (size + 1), self._sizes, self._pairs
        token: int | None = longest[0] if size else None
        while at < size:
            end = at + lengths[token]
            if passable[end] and (not ids or (pairs[key] if (key := ids[-1] << 32 | token) in pairs else self.compatible(ids[-1], token))):
                ids.append(token)
                at = end
                token = longest[at] if at < size else None
                continue
            token = self.shorter(token)
            while token is None:  # nothing fits here: give the previous token up
                passable[at] = 0
                given = ids.pop()
                at -= lengths[given]
                token = self.shorter(given)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        import regex
        if len(text) < _STREAMED:
            return self._encoded(regex.findall(self.pattern, text))
        pieces, out = (m.group() for m in regex.finditer(self.pattern, text)), []
        while some := list(islice(pieces, _STREAMED >> 4)):
            out.append(self._encoded(some))
        return b"".join(out)

    def _encoded(self, pieces: list[str]) -> bytes:
        known = self._pieces
        coded = list(map(known.get, pieces))
        if None in coded:
            if len(known) >= _PIECES:
                known.clear()
            for i, ids in enumerate(coded):
                if ids is None:
                    piece = pieces[i]
                    ids = coded[i] = known.get(piece) or np.array(self.encode_piece(piece.encode("utf-8")), dtype="<u4").tobytes()
                    if len(piece) <= _SHORT:
                        known[piece] = ids
        return b"".join(coded)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe.from_file(path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                ids = [coder.encode(text.as_py()) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])
    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe.from_file(path)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([coder.decode(ids.as_py()) for ids in part.column(2)], pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every text; ``ids`` are little-endian unsigned 32-bit."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(_encode(path, pattern), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of :func:`encode` with the bytes that their ids stand for; null ids decode to no bytes."""
    return encoded.select("doc_id", "n_tokens", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(_decode(path), DECODED)
