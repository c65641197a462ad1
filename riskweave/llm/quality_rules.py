"""Quality rules: a table of thresholds compiled into one projection, built-in functions only.

Every measure is a column expression over the whole text; the rule table is turned into
one ``array`` of the names of the rules that a row breaks. No shuffle, no user function.

Defined cases: a null text reads as empty and has no words; ratios of an empty text are
0 and only the word-count rule can fail; repeated rows are judged each by itself; any
further column passes through unless it has the name of a result column, which wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import hashed, let, space_words, text_of

WINDOW = 8
WHITE = " \t\n\x0b\x0c\r"

# Frequent function words of the supported languages.
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this",
    "to", "was", "with",
    "au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas", "pour",
    "que", "qui", "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu",
    "al", "con", "del", "el", "es", "las", "lo", "los", "no", "para", "por", "se", "su", "y",
)


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule if ``measure`` is below ``low`` or above ``high``; None: no bound."""
    name: str
    measure: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("few_words", "n_words", low=20),
    Rule("repeated_windows", "repeat_pct", high=30),
)
RULES = (
    Rule("word_length", "mean_word_chars", low=1.5, high=20),
    Rule("symbols", "symbol_ratio", high=0.2),
    Rule("exclamations", "exclamation_ratio", high=0.3),
    Rule("few_stop_words", "stop_word_ratio", low=0.02),
    Rule("duplicate_lines", "dup_line_ratio", high=0.6),
)


def _repeated(words: Column) -> Column:
    """Words inside 8-word windows that the text holds twice or more.

    Windows are named by a 64-bit hash of the names of their halves, and only where a half
    occurs twice. Only a text with a repeated name sorts its (name, start) pairs; neighbours with one name give the starts, and the starts in
    order give the words they cover.
    """
    def covered(starts: Column) -> Column:
        step = F.aggregate(
            F.sort_array(F.array_distinct(starts)),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")))
        return step["n"].cast("long")

    def starts(names: Column) -> Column:
        pairs = F.sort_array(F.transform(names, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.flatten(F.zip_with(
            F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))

    half = WINDOW // 2

    def halves(one: Column) -> Column:
        """Names of runs of four words; a repeated window repeats some of them."""
        return F.transform(F.slice(one, F.lit(1), F.size(one) - (half - 1)), lambda x, i: F.xxhash64(x, *[F.get(one, i + k) for k in range(1, half)]))

    def whole(four: Column) -> Column:
        count = F.size(four) - half
        return F.zip_with(F.slice(four, F.lit(1), count), F.slice(four, F.lit(1 + half), count), lambda a, b: F.xxhash64(a, b))

    none = F.lit(0).cast("long")

    def repeats(four: Column) -> Column:
        return F.when(F.size(F.array_distinct(four)) == F.size(four), none).otherwise(let(
            whole(four), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(starts(h)))))

    return F.when(F.size(words) < WINDOW, none).otherwise(let(hashed(words), lambda one: let(halves(one), repeats)))


def measures(text: Column) -> Column:
    """One struct of all counts of a text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(WHITE)) != "")

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS, *[s.capitalize() for s in STOP_WORDS]))).cast("long").alias("n_stop_words"),
            _repeated(words).alias("n_repeat_words"))

    def line_counts(line: Column) -> Column:
        return F.struct(
            F.size(line).cast("long").alias("n_lines"),
            (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"))

    def mark_counts(marks: Column) -> Column:
        return F.struct(
            F.length(F.replace(marks, F.lit("!"), F.lit(""))).cast("long").alias("n_symbols"),
            (F.length(marks) - F.length(F.replace(marks, F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"))

    marks = F.regexp_replace(text, r"[^#*$%&|<>!]+", "")
    return F.struct(let(space_words(text), counts).alias("w"), let(lines, line_counts).alias("l"), let(marks, mark_counts).alias("s"))


def _derived() -> dict[str, Column]:
    w, l, s = "_m.w.", "_m.l.", "_m.s."

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    return {
        "n_words": F.col(w + "n_words"),
        "word_chars": F.col(w + "word_chars"),
        "n_symbols": F.col(s + "n_symbols"),
        "n_dup_lines": F.col(l + "n_dup_lines"),
        "n_repeat_words": F.col(w + "n_repeat_words"),
        "mean_word_chars": ratio(w + "word_chars", w + "n_words"),
        "symbol_ratio": ratio(s + "n_symbols", w + "n_words"),
        "exclamation_ratio": ratio(s + "n_exclamations", w + "n_words"),
        "stop_word_ratio": ratio(w + "n_stop_words", w + "n_words"),
        "dup_line_ratio": ratio(l + "n_dup_lines", l + "n_lines"),
        # compared as 100 * repeated > 30 * words: whole numbers, no rounding
        "repeat_pct": F.coalesce(F.try_divide(100 * F.col(w + "n_repeat_words"), F.col(w + "n_words")), F.lit(0.0)),
    }


def broken(rules: tuple[Rule, ...], value: dict[str, Column]) -> Column:
    """The names of the rules a row breaks, in table order."""
    def fails(r: Rule) -> Column:
        # an empty text has no ratio to judge
        judged = F.lit(True) if r.measure == "n_words" else value["n_words"] > 0
        low = value[r.measure] < r.low if r.low is not None else F.lit(False)
        high = value[r.measure] > r.high if r.high is not None else F.lit(False)
        return judged & (low | high)
    return F.filter(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES,
                  text: str = "text") -> DataFrame:
    """Documents with their counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    value = _derived()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    results = {*counts, "base_failed", "failed_rules", "kept"}
    passing = [F.col(f"`{c}`") for c in docs.columns if c not in results and c != "_m"]
    # explode keeps the optimizer from copying the measures into a later filter
    measured = docs.select(*passing, F.explode(F.array(measures(text_of(text)))).alias("_m"))
    return measured.select(
        *[F.col(f"`{c}`") for c in measured.columns if c != "_m"],
        *[value[c].alias(c) for c in counts],
        broken(base, value).alias("_base"), broken(rules, value).alias("_rules"),
    ).select(
        "*", (F.size("_base") > 0).alias("base_failed"), F.concat("_base", "_rules").alias("failed_rules"),
        ((F.size("_base") == 0) & (F.size("_rules") == 0)).alias("kept"),
    ).drop("_base", "_rules")
