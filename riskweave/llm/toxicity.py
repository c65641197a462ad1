"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lower-cases, removes accents and invisible characters, maps look-alike letters to
Latin ones and undoes digit substitutions inside words; l and i, both of which 1 may stand
for, become one letter. The lexicon (words, and stems that
several words share) and its weights come from labelled documents: the log-odds of a term
between toxic and other documents. Exception phrases are two-word phrases around a hit that
only occur in clean documents; a hit inside one does not count. The weight of a document, by
itself and per word, goes through a logistic curve fitted on the same sample.

Training uses at most ``sample`` labelled rows (a documented bound), chosen by a hash of the id.

Defined cases: a null or empty text scores as a text without hits; null labels are not
used; without both labels in the sample the lexicon is empty and every score is the share
of toxic rows; equal rows score alike; rows with a null id are scored like others.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import text_of

# Letters that look like Latin ones (Cyrillic, Greek, other), and digits or signs used for letters.
LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнԛԝαορτυικνεβγѵɡıɩł", "aeopcyxijsdhkmtbhqwaoptuikvebyvgiil"))
SUBSTITUTES = dict(zip("0134578@$", "oieastbas"))
_INVISIBLE = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
_LETTERS = str.maketrans(LOOKALIKES) | _INVISIBLE
_DIGITS = str.maketrans(SUBSTITUTES)
_MARKS = re.compile(r"[̀-ͯ]+")
_MIXED = re.compile(r"[^\W_]*[0-9@$](?:[^\W_]|[@$])*")
_HAS_DIGIT = re.compile(r"[0-9@$]")
_WORDS = re.compile(r"[^\W_]+")
STEMS = (4, 5, 6, 7)


def fold(text: str) -> str:
    """Folded words, each with one space before and the text with one after."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).translate(_LETTERS)
    if _HAS_DIGIT.search(text):
        text = _MIXED.sub(lambda m: m[0] if m[0].isdigit() else m[0].translate(_DIGITS), text)
    return " " + " ".join(_WORDS.findall(text.replace("l", "i"))) + " "


@dataclass
class Lexicon:
    """``terms``: " word " or " stem" -> weight; ``exceptions``: " two words "; ``curve``: logistic coefficients.

    Terms and phrases are lower-case; l and i count as one letter in them too.
    """
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase.replace("l", "i"), (len(phrase), None))
        for term, weight in self.terms.items():
            found.add_word(term.replace("l", "i"), (len(term), weight))
        if len(found):
            found.make_automaton()
        return found


def hits(folded: str, automaton: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """(start, weight) of each word that is hit outside exception phrases; the heaviest term of a word counts."""
    if not len(automaton):
        return []
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        else:
            found[start] = max(found.get(start, weight), weight)
    if spared:
        found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in spared)}
    return sorted(found.items())


def measure(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Weight of a text: the sum, and the sum per hundred words."""
    total = sum(w for _, w in hits(folded, automaton))
    return math.log1p(total), math.log1p(100 * total / (folded.count(" ") - 1 + 20))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, sample: int) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows; the chosen labels are small by that bound and are broadcast."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
        .select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(sample))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), text_of().alias("_text")).join(F.broadcast(chosen), "_id")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(fold(text).split())
            counts[y].update(f" {w} " for w in words)
            counts[y].update({f" {w[:n]}" for w in words for n in STEMS if len(w) > n})
        terms = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
            names=["term", "toxic", "clean"])


def choose_terms(rows: list[tuple[str, int, int]], toxic: int, clean: int, least: float) -> dict[str, float]:
    """Stems before words: a stem is taken if its words together say clearly more than any one of them."""
    odds = {t: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) for t, a, b in rows}
    support = {t: a for t, a, _ in rows}
    best_word: Counter = Counter()
    for t in support:
        if t.endswith(" "):
            for n in STEMS:
                best_word[t[:n + 1]] = max(best_word[t[:n + 1]], support[t])
    chosen: dict[str, float] = {}
    for t in sorted(odds, key=lambda t: (len(t.strip()), t)):
        covered = any(t[:n + 1] in chosen for n in STEMS if n < len(t.strip()))
        if odds[t] < least or covered:
            continue
        if t.endswith(" ") or support[t] > 1.5 * best_word[t]:
            chosen[t] = min(odds[t], 8.0)
    return chosen


def _count_phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded, phrases = fold(text), set()
                for start, _ in hits(folded, automaton):
                    end = folded.index(" ", start + 1)
                    if start:
                        phrases.add(folded[folded.rindex(" ", 0, start):end + 1])
                    if end + 1 < len(folded):
                        phrases.add(folded[start:folded.index(" ", end + 1) + 1])
                counts[y].update(phrases)
            terms = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
                names=["term", "toxic", "clean"])
    return run


def _measures(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            pairs = [measure(fold(t), automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64())],
                names=["y", "total", "dense"])
    return run


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    w, shrink = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - shrink @ w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, grad)
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = 20_000,
          least: float = 2.5, support: int = 4) -> Lexicon:
    """Lexicon, exceptions and curve from a bounded sample of labelled rows. Terms and phrases are chosen by support and odds alone;
    ``sample`` bounds how many there can be. Their order, by frequency and then by name, settles ties."""
    rows = training_rows(docs, labels, "toxic", F.lit(True) if usable is None else usable, sample).select("_text", "_y")
    totals = {r[0]: r[1] for r in rows.groupBy("_y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    share = toxic / (toxic + clean) if toxic + clean else 0.0
    if not toxic or not clean:
        return Lexicon(curve=(math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0))
    counted = "term string, toxic long, clean long"
    counts = rows.mapInArrow(_count_terms, counted).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rate = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / (clean + 1))
    candidates = counts.where((F.col("toxic") >= support) & (rate >= math.exp(least) * 0.9)).orderBy(F.desc("toxic"), "term")
    lexicon = Lexicon(choose_terms([tuple(r) for r in candidates.collect()], toxic, clean, least))
    phrases = rows.mapInArrow(_count_phrases(lexicon), counted).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    clear = phrases.where((F.col("clean") >= 3) & (F.col("toxic") * 20 <= F.col("clean"))).orderBy(F.desc("clean"), "term")
    lexicon.exceptions = tuple(sorted(r[0] for r in clear.collect()))
    scored = rows.mapInArrow(_measures(lexicon), "y int, total double, dense double").collect()
    x = np.array([(r[1], r[2]) for r in scored])
    lexicon.curve = fit_curve(x, np.array([r[0] for r in scored], dtype=np.float64))
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Documents with ``score`` (0 to 1), ``weight_total`` and ``weight_density``."""
    kept = [c for c in docs.columns if c not in ("score", "weight_total", "weight_density", "_text")]
    side = docs.select(*[F.col(f"`{c}`") for c in kept], text_of(text).alias("_text"))
    schema = side.drop("_text").schema.add("score", "double").add("weight_total", "double").add("weight_density", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        c, a, b = lexicon.curve
        for batch in batches:
            pairs = [measure(fold(t), automaton) for t in batch.column(len(kept)).to_pylist()]
            x = np.array(pairs).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(c + a * x[:, 0] + b * x[:, 1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array(x[:, 0]), pa.array(x[:, 1])], names=schema.names)
    return side.mapInArrow(run, schema)
