"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are n-grams of words, n-grams of word shapes (letters, capitals and digits
collapsed, signs kept) and a mark on words whose five-word window already occurred in
the text; each is hashed into a table of ``2**bits`` weights. The words are hashed by
built-in functions, so tasks only see arrays of numbers; a score is a sparse dot product.

Training uses at most ``sample`` labelled rows (a documented bound). They are dealt into
``shards``; each shard runs the updates row by row from the common state, and the states
are averaged after every round.

Defined cases: a null or empty text has no features and scores the bias; null labels are
not used; without labels every score is 0.5; equal rows score alike; rows with a null id
are scored like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import hashed, lists, space_words, text_of
from riskweave.llm.toxicity import training_rows

BITS = 18
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-3
SCALE = 8.0
_GRAM = np.uint64(0x9E3779B97F4A7C15)


def word_arrays(text: Column) -> list[Column]:
    """Hashed words and hashed shapes of a text."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[\p{Ll}\p{Lo}\p{Lm}]+", "a"), r"\p{Lu}+", "A"), r"\p{Nd}+", "0")
    return [hashed(space_words(text)).alias("_words"), hashed(space_words(shape)).alias("_shapes")]


def _slot(x: np.ndarray, kind: int, bits: int) -> np.ndarray:
    x = (x ^ np.uint64(kind * 0x632BE59BD9B4E019 & (2 ** 64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits)).astype(np.int64)


def _grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens from each place on; places near the end of the array wrap into nothing."""
    count = max(0, len(tokens) - n + 1)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        total = total * _GRAM + tokens[i:i + count]
    return total


def features(words: np.ndarray, w_cuts: np.ndarray, shapes: np.ndarray, s_cuts: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, slot, value) arrays, one triple per kind of feature."""
    kinds = [(words, w_cuts, 1), (words, w_cuts, 2), (shapes, s_cuts, 1), (shapes, s_cuts, 2), (shapes, s_cuts, 3)]
    for kind, (tokens, cuts, n) in enumerate(kinds):
        sizes = np.maximum(np.diff(cuts) - n + 1, 0)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(cuts[:-1], sizes)
        yield doc, _slot(_grams(tokens, n)[at], kind, bits), (SCALE / np.maximum(sizes, 1))[doc]
    sizes = np.maximum(np.diff(w_cuts) - 4, 0)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(w_cuts[:-1], sizes)
    names = _grams(words, 5)[at] + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    again = np.ones(len(names), dtype=bool)
    again[np.unique(names, return_index=True)[1]] = False
    doc = doc[again]
    yield doc, np.zeros(len(doc), dtype=np.int64), (SCALE / np.maximum(sizes, 1))[doc]


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    out = []
    for name in ("_words", "_shapes"):
        cuts = np.concatenate(([0], np.cumsum([len(x) for x in rows[name]])))
        flat = np.concatenate(rows[name].to_numpy()) if cuts[-1] else np.empty(0, dtype=np.int64)
        out += [flat.astype(np.int64).view(np.uint64), cuts]
    return tuple(out)


def _train(z0: np.ndarray, n0: np.ndarray, bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = z0.copy(), n0.copy()
        rows = rows.sort_values("_order").reset_index(drop=True)
        for low in range(0, len(rows), 256):
            part = rows.iloc[low:low + 256]
            triples = list(features(*_arrays(part), bits))
            doc = np.concatenate([t[0] for t in triples])
            slot, value = np.concatenate([t[1] for t in triples]), np.concatenate([t[2] for t in triples])
            key, inverse = np.unique(doc * (1 << bits) + slot, return_inverse=True)
            value = np.bincount(inverse, weights=value, minlength=len(key))
            doc, slot = key >> bits, key & ((1 << bits) - 1)
            edges = np.searchsorted(doc, np.arange(len(part) + 1))
            for i, y in enumerate(part["_y"].tolist()):
                at, x = np.append(slot[edges[i]:edges[i + 1]], len(z) - 1), np.append(value[edges[i]:edges[i + 1]], 1.0)
                w = weights_of(z[at], n[at])
                g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
                n[at] += g * g
        return pd.DataFrame({"z": [z.tobytes()], "n": [n.tobytes()]})
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, sample: int = 16_000,
        shards: int = 6, rounds: int = 2, bits: int = BITS) -> np.ndarray:
    """Weights (the last one is the bias) from at most ``sample`` labelled rows."""
    rows = training_rows(docs, labels, label, F.lit(True) if usable is None else usable, sample)
    rows = rows.select(F.pmod(F.xxhash64("_id"), F.lit(shards)).alias("_shard"), F.xxhash64(F.lit(3), "_id").alias("_order"), "_y", *word_arrays(F.col("_text")))
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for _ in range(rounds):
        states = rows.groupBy("_shard").applyInPandas(_train(z, n, bits), "z binary, n binary").collect()
        if states:
            z = np.mean([np.frombuffer(s[0]) for s in states], axis=0)
            n = np.mean([np.frombuffer(s[1]) for s in states], axis=0)
    return weights_of(z, n).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """Documents with ``score`` (0 to 1)."""
    kept = [c for c in docs.columns if c not in ("score", text, "_words", "_shapes")]
    side = docs.select(*[F.col(f"`{c}`") for c in kept], *word_arrays(text_of(text)))
    schema = side.drop("_words", "_shapes").schema.add("score", "double")
    bits = int(np.log2(len(weights) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):  # the arrays below are several times a slice
                part = batch.slice(low, 512)
                words, w_cuts = lists(part.column(len(kept)))
                shapes, s_cuts = lists(part.column(len(kept) + 1))
                total = np.full(part.num_rows, float(weights[-1]))
                for doc, slot, value in features(words.view(np.uint64), w_cuts, shapes.view(np.uint64), s_cuts, bits):
                    total += np.bincount(doc, weights=weights[slot] * value, minlength=part.num_rows)
                out = pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], out], names=schema.names)
    return side.mapInArrow(run, schema)
