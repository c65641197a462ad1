"""Divergence of the sources of a language, counted exactly.

``CountVectorizer`` with ``minDF`` and the largest integer as ``vocabSize`` learns the kept
terms and turns every document into its exact sparse vector. A term carries its lang, so one
fit learns the vocabularies of all langs side by side, each by the documents of its own lang,
without a job per lang. The vocabulary passes through the driver while it is fitted;
therefore the kept (lang, term) pairs of one part of the hashes are counted first and,
where all of them may be beyond ``fitted_terms``, dealt by hash into several fits of bounded size. Vocabularies of different fits have
no term in common and all sums add up, so their number changes no result.

A document is given to the fit as its distinct terms; a term that ``min_docs`` documents of a task have is
kept whatever the others hold, so the fit is given it by no more of them. The vocabulary is the same. For the vectors a task
counts the terms of each group, as far as ``HELD_SUMS`` counts go, and cuts counts into digits to the base 16: a row holds the terms
with one digit at one place, so a term is looked up once or twice for all documents of a task and the vectors, times their weights, are exact.
The vectors are summed per (lang, source) as sparse sums: inside a task over its batches, so that a hot source
is summed before the shuffle, then by a hash aggregate.

Pairs of sources are evaluated in blocks: the terms of a lang are dealt into buckets and its
sources into blocks of at most about ``block``; a task holds one bucket of two blocks as two
small matrices. Terms that neither block holds are not visited: all of them give a pair one
and the same value, which is added at the end.

With p = 1 + floor(10^9 * (count + 2) / (N + 2V)), N the counts of a group and V the kept
terms of its lang, a pair or a term has the value floor((p - q)^2 / (p + q)). Counts and p
are computed in integers and decimals; p is at most 10^9 + 1, so squares fit in 64 bits.

Defined cases: a null text, lang or source is the empty string; repeated rows count as often
as they occur; a group without a kept term still has its pairs; a lang without a kept term
gives its pairs the value 0; a lang with one source gives no pairs; equal values rank by
item in byte order; texts of any length are counted whole; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import give_back, slices, store
from riskweave.session import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of ASCII that are no letter become spaces, A-Z become a-z; all others are part of terms. 0xFF is in no UTF-8 text.
_TERM_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
_CUT, _ROWS, _BYTES, _LONGEST = b"\xff", 4096, 8_000_000, 1 << 16
MIN_DOCS, LARGEST, SCALE, TOP = 10, 2 ** 31 - 1, 1_000_000_000, 10
LONG_COUNTS = 9_000_000_000  # times SCALE, these stay in 64 bits
#: Bounds of the terms of one fit, of the sums a task holds, of the sources of a block and of the terms of a bucket;
#: one of SHARE terms is counted to foresee how many are kept.
FITTED_TERMS, SHARE, HELD_SUMS, BLOCK, BUCKET = 1_000_000, 64, 1 << 21, 128, 1024
TERMS = "group long, weight long, terms array<string>, some array<string>"
SUMS = "group long, slot int, count long"
PARTIAL = "lang string, source string, item string, partial long, covered long"


def _name(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _group() -> Column:
    return F.xxhash64(_name("lang"), _name("source")).alias("group")


def _summed(key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in the order of their first place, and the sum of their weights."""
    found = pa.array(key).dictionary_encode()
    return found.dictionary.to_numpy(), np.bincount(found.indices.to_numpy(), weight, len(found.dictionary)).astype(np.int64)


def _one_of(terms: pa.StringArray, share: int) -> np.ndarray:
    """Whether a term falls into one of ``share`` hashes of its bytes, whatever the other terms are."""
    if not len(terms):
        return np.zeros(0, dtype=bool)
    ends = np.frombuffer(terms.buffers()[1], dtype=np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    sizes, raw = np.diff(ends), np.frombuffer(terms.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
    power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    place = np.arange(len(raw)) - np.repeat(ends[:-1] - ends[0], sizes)
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[place])))
    code = np.diff(total[ends - ends[0]])
    code = (code ^ (code >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return (code >> np.uint64(32)) % np.uint64(share) == 0


def _split_terms(share: int, least: int):
    def words_of(part: pa.RecordBatch) -> tuple[np.ndarray, pa.DictionaryArray]:
        texts, sizes = [], np.zeros(part.num_rows, dtype=np.int64)
        for row, (lang, text) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
            words = text.translate(_TERM_BYTES).split()
            sizes[row] = len(words)
            if words:
                key = lang + b"\0"
                texts.append(key + (_CUT + key).join(words) + _CUT)
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        cut = raw == _CUT[0]
        cuts = np.flatnonzero(cut)
        ends = np.concatenate(([0], cuts - np.arange(len(cuts)))).astype(np.int32)
        words = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(ends), pa.py_buffer(raw[~cut]))
        return sizes, words.dictionary_encode()

    def numbered(code: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Which of the documents that hold the term this one is, those of earlier slices included."""
        order = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(seen)))
        number = np.empty(len(code), dtype=np.int64)
        number[order] = np.arange(len(code)) - np.concatenate(([0], ends))[code[order]]
        return number + seen[code]

    def listed(owner: np.ndarray, code: np.ndarray, rows: int, terms: pa.Array) -> pa.ListArray:
        ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=rows)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), terms.take(pa.array(code)))

    def batch_of(group, weight, terms, some) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([group, weight, terms, some], names=[x.split()[0] for x in TERMS.split(", ")])

    def whole(key: np.ndarray, count: np.ndarray, groups: np.ndarray, terms: pa.Array) -> Iterator[pa.RecordBatch]:
        """Rows that hold the terms of a group with one and the same digit, to the base 16, at one place of their counts."""
        owner, code = key >> 32, key & 0xFFFFFFFF
        for shift in range(0, int(count.max(initial=0)).bit_length(), 4):
            digit = count >> shift & 15
            there = np.flatnonzero(digit)
            kind = owner[there] << 4 | digit[there]
            order = np.argsort(kind, kind="stable")
            there, kind = there[order], kind[order]
            first = np.union1d(np.flatnonzero(np.diff(kind, prepend=-1)), np.arange(0, len(kind), _LONGEST))
            ends = pa.array(np.append(first, len(kind)).astype(np.int32))
            yield batch_of(pa.array(groups[kind[first] >> 4]), pa.array((kind[first] & 15) << shift),
                           pa.ListArray.from_arrays(ends, terms.take(pa.array(code[there]))), pa.nulls(len(first), pa.list_(pa.string())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate(x) for x in zip(*parts)))

        terms = None
        for part in (part for batch in batches for part in slices(batch, 2, _ROWS, _BYTES)):
            if terms is None:  # terms have one number in all slices until their counts are given out
                terms, picked, seen, groups, parts, held = pa.array([], pa.string()), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64), {}, [], 0
            part = part.take(pa.array(np.argsort(part.column(0).to_numpy(), kind="stable")))  # keys that meet often lie together
            sizes, words = words_of(part)
            found = pa.concat_arrays([terms, words.dictionary]).dictionary_encode()
            code = found.indices.to_numpy()[len(terms):][words.indices.to_numpy()].astype(np.int64)
            terms, new = found.dictionary, found.dictionary[len(terms):]
            picked, seen = np.concatenate((picked, _one_of(new, share))), np.concatenate((seen, np.zeros(len(new), dtype=np.int64)))
            row = np.repeat(np.arange(part.num_rows), sizes)

            names, own = np.unique(part.column(0).to_numpy(), return_inverse=True)
            own = np.array([groups.setdefault(x, len(groups)) for x in names.tolist()], dtype=np.int64)[own]
            parts.append(_summed(own[row] << 32 | code))
            held += len(parts[-1][0])

            undecided = seen[code] < least
            pairs = _summed(row[undecided] << 32 | code[undecided])[0]
            owner, code = pairs >> 32, pairs & 0xFFFFFFFF
            given = numbered(code, seen) < least
            seen += np.bincount(code, minlength=len(seen))
            owner, code = owner[given], code[given]
            shown = picked[code]
            yield batch_of(part.column(0), pa.nulls(part.num_rows, pa.int64()), listed(owner, code, part.num_rows, terms),
                           listed(owner[shown], code[shown], part.num_rows, terms))
            if held > HELD_SUMS:
                parts = [merged()]
                held = len(parts[0][0])
                if held > HELD_SUMS // 2:
                    yield from whole(*parts[0], np.array([*groups], dtype=np.int64), terms)
                    terms = None
        if terms is not None:
            yield from whole(*merged(), np.array([*groups], dtype=np.int64), terms)
        give_back()
    return run


def terms_of(docs: DataFrame, share: int = SHARE, min_docs: int = MIN_DOCS) -> DataFrame:
    """(group, weight, terms, some), a term behind its lang and a zero character.

    Weight null: a document, its distinct terms but those that ``min_docs`` documents of its task have given already,
    which makes them kept whatever follows, and those of them in one of ``share`` hashes. Other rows: terms
    of all documents of a group in a task; the weights of the rows that hold a term add up to its occurrences.
    """
    return docs.select(_group(), _name("lang").cast("binary").alias("lang"),
                       _name("text").cast("binary").alias("text")).mapInArrow(_split_terms(share, max(min_docs, 1)), TERMS)


def _sparse_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the sparse vectors, times the weights of a third column, per group, in parts of at most about HELD_SUMS entries."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, slot, value = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((slot, group))
        group, slot, value = group[order], slot[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], (slot[1:] != slot[:-1]) | (group[1:] != group[:-1]))))
        return group[first], slot[first], np.add.reduceat(value, first)

    def batch_of(sums: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in sums], names=["group", "slot", "count"])

    for batch in batches:
        vectors = batch.column(1)
        indices, values = vectors.field("indices"), vectors.field("values")
        sizes = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        slots = indices.flatten().to_numpy(zero_copy_only=False)
        if len(slots):
            groups = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            counts = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if batch.num_columns > 2:
                counts *= np.repeat(batch.column(2).to_numpy(zero_copy_only=False), sizes)
            parts.append((groups, slots, counts))
            held += len(slots)
        if held > 2 * HELD_SUMS:
            parts = [merged()]
            held = len(parts[0][0])
            if held > HELD_SUMS:
                yield batch_of(parts[0])
                parts, held = [], 0
    if parts:
        yield batch_of(merged())


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, fitted_terms: int = FITTED_TERMS) -> tuple[DataFrame, DataFrame]:
    """(lang, source) of all occurring groups, and (lang, source, term, count) of their kept terms with a count.

    The counts also have a number of the (lang, term), its count in the lang and, true in one of its rows, ``first``.
    """
    spark = docs.sparkSession
    # What the fit and the vectors read lies in columns of its own, so that neither unpacks the other's terms.
    single = F.col("weight").isNull()
    rows = store(terms_of(docs, SHARE, min_docs).select(
        "group", "weight", F.when(single, F.col("terms")).alias("fitted"), F.when(~single, F.col("terms")).alias("counted"), "some"), "terms")
    groups = store(docs.select(_group(), _name("lang").alias("lang"), _name("source").alias("source")).distinct(), "groups")
    if groups.groupBy("group").count().where("count > 1").limit(1).count():
        raise RuntimeError("two (lang, source) groups have one 64-bit key")
    some = rows.select(F.explode("some").alias("term"))
    kept = SHARE * some.groupBy("term").count().where(F.col("count") >= min_docs).count()
    fits = 1 + kept * 11 // (10 * fitted_terms)
    # A vectoriser fails without a kept term; this one is no term of a text and gets no count.
    spare = spark.range(max(min_docs, 1)).select(F.array(F.lit("\0")).alias("terms"))
    counts = None
    for number in range(fits):
        def mine(name: str) -> Column:
            terms = F.col(name) if fits == 1 else F.filter(name, lambda t: F.pmod(F.xxhash64(t, F.lit(1)), F.lit(fits)) == number)
            return terms.alias("terms")

        model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=LARGEST).fit(
            rows.where("weight IS NULL").select(mine("fitted")).unionByName(spare))
        path = scratch(spark, "vocabulary")
        model.save(path)
        vocabulary = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("slot", "key"))
        sums = model.transform(rows.where("weight IS NOT NULL").select("group", "weight", mine("counted"))).select("group", "vector", "weight").mapInArrow(_sparse_sums, SUMS)
        # A task has summed already and gives a group and slot about once; dealt by slot, they meet the rest and their terms in one exchange.
        found = sums.repartition("slot").groupBy("group", "slot").agg(F.sum("count").alias("count")).join(vocabulary, "slot").select(
            "group", F.substring_index("key", "\0", -1).alias("term"), "count", (F.lit(number << 32) + F.col("slot")).alias("number"),
            F.sum("count").over(Window.partitionBy("slot")).alias("lang_count"), (F.col("group") == F.min("group").over(Window.partitionBy("slot"))).alias("first"))
        counts = found if counts is None else counts.unionByName(found)
    counts = store(counts.join(groups, "group").drop("group"), "counts")
    return groups.select("lang", "source"), counts


def _share(count: str, kept: str = "kept") -> Column:
    """1 + floor(10^9 * (count + 2) / (N + 2V)); read only where the lang keeps a term. Decimals only where 64 bits may be too few."""
    below = f"greatest(all_counts + 2 * {kept}, 1)"
    return F.expr(f"CASE WHEN {count} < {LONG_COUNTS}L THEN 1 + {SCALE}L * ({count} + 2) div {below} ELSE "
                  f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0)) div CAST({below} AS DECIMAL(20,0)) END").cast("long")


def _value(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _block_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of one bucket of terms for the pairs of one or two blocks of sources, over the terms that these hold."""
    lang, number = rows["lang"].iloc[0], rows["number"].to_numpy()
    term = np.full(len(number), -1)  # where a row only names its source
    term[number >= 0] = pd.factorize(number[number >= 0])[0]
    width = int(term.max()) + 1

    def matrix(side: int) -> tuple[np.ndarray, np.ndarray]:
        mine = (rows["side"] == side).to_numpy()
        part, column = rows[mine], term[mine]
        code, names = pd.factorize(part["source"])
        base = np.zeros(len(names), dtype=np.int64)
        base[code] = part["p0"].to_numpy(dtype=np.int64)
        cells = np.repeat(base[:, None], width, axis=1)
        cells[code[column >= 0], column[column >= 0]] = part["p"].to_numpy(dtype=np.int64)[column >= 0]
        return np.asarray(names, dtype=object), cells

    left, p = matrix(0)
    right, q = matrix(1)
    alone = rows["low"].iloc[0] == rows["high"].iloc[0]
    if alone:
        right, q = left, p
    out = []
    for i, source in enumerate(left):
        gap = q - p[i]
        values = (gap * gap // (q + p[i])).sum(axis=1).tolist()
        for item, value in zip(right, values):
            if not alone:
                out.append((lang, item, source, value, width))
            if item != source:
                out.append((lang, source, item, value, width))
    return pd.DataFrame(out, columns=["lang", "source", "item", "partial", "covered"])


def _blocks(cells: DataFrame, blocks: Column) -> DataFrame:
    """Each row once for every pair of blocks that its source takes part in; side 1 is the later block of two."""
    own = F.pmod(F.xxhash64("source"), blocks)
    spread = cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return spread.withColumns({
        "low": F.least("own", "other"), "high": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, fitted_terms: int = FITTED_TERMS, block: int = BLOCK,
               bucket: int = BUCKET) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the ``top`` terms that stand out."""
    groups, counts = term_counts(docs, min_docs, fitted_terms)
    kept = counts.groupBy("lang").agg(F.count_if("first").alias("kept"), F.sum("count").alias("lang_counts"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("all_counts"))
    known = store(
        groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").join(sizes, "lang")
        .fillna(0, ["all_counts", "kept", "lang_counts"]).select("lang", "source", "all_counts", "kept", "lang_counts", "sources", _share("0").alias("p0")), "known")
    shares = counts.join(known, ["lang", "source"]).withColumn("p", _share("count"))

    tasks = known.withColumns({"buckets": F.ceil(F.greatest("kept", F.lit(1)) / bucket), "blocks": F.ceil(F.col("sources") / block)})
    named = tasks.where("kept > 0 AND sources > 1").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    named = named.select("lang", "source", "bucket", "blocks", "p0", F.lit(-1).cast("long").alias("number"), F.lit(0).cast("long").alias("p"))
    cells = shares.where("sources > 1").select(
        "lang", "source", F.pmod(F.xxhash64("number"), F.ceil(F.col("kept") / bucket)).alias("bucket"),
        F.ceil(F.col("sources") / block).alias("blocks"), "p0", "number", "p")
    placed = _blocks(cells.unionByName(named), F.col("blocks")).select("lang", "bucket", "low", "high", "side", "source", "number", "p0", "p")
    sums = placed.groupBy("lang", "bucket", "low", "high").applyInPandas(_block_sums, PARTIAL)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("partial").alias("partial"), F.sum("covered").alias("covered"))
    other = known.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = known.join(other, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
    unseen = F.col("kept") - F.coalesce("covered", F.lit(0))
    pairs = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        F.when(F.col("kept") > 0, F.coalesce("partial", F.lit(0)) + unseen * _value("p0", "q0")).otherwise(0).cast("long").alias("value"))

    whole = shares.where("count > 0").withColumn("all_counts", F.col("lang_counts")).withColumn("q", _share("lang_count"))
    terms = whole.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _value("p", "q").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
