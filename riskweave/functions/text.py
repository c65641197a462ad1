"""Column expressions on text and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. (?U) makes \s cover every Unicode blank.
BLANKS = r"(?U)\s+"
PUNCTUATION = r"[!-/:-@\[-`{-~]+"
NOT_BASIC = r"""(?U)[^a-zA-Z0-9\s.,!?;:\-()\[\]"']+"""
NOT_ALPHANUMERIC = r"(?U)[^a-zA-Z0-9\s]+"


def elements(array: str | Column) -> Column:
    """Rows of an array, one null row for an empty one; drop it with IS NOT NULL.

    A plain ``explode`` makes the optimizer filter on ``size(array) > 0`` at the
    scan, which works the array out a second time for every text.
    """
    return F.explode_outer(array)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: F.length(w) > 0)


def calendar_features(ts: Column) -> dict[str, Column]:
    day = F.weekday(ts)
    return {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "dayofweek": day,
        "hour": F.hour(ts), "is_weekend": F.when(day >= 5, 1).otherwise(0)}


def text_features(df: DataFrame, text: str) -> DataFrame:
    """Add length, word count, mean word length and shares of capitals and digits.

    Word figures come from one pass: in single-spaced text there is a blank less
    than words. Costly parts are columns of their own, so each is worked out once.
    """
    body = F.col(text)
    parts = df.withColumns({
        "text_length": F.length(body), "_spaced": normalise_whitespace(body),
        "_upper": F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")), "_digits": F.length(F.regexp_replace(body, r"[^\p{Nd}]+", ""))})
    parts = parts.withColumns({"_all": F.length("_spaced"), "_letters": F.length(F.replace("_spaced", F.lit(" "), F.lit("")))})
    parts = parts.withColumn("word_count", F.when(F.col("_letters") > 0, F.col("_all") - F.col("_letters") + 1).otherwise(0))

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return parts.select(
        *df.columns, "text_length", "word_count", ratio("_letters", "word_count").alias("avg_word_length"),
        ratio("_upper", "text_length").alias("uppercase_ratio"), ratio("_digits", "text_length").alias("digit_ratio"))


def normalise_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def remove_special(text: Column, keep_punctuation: bool = True) -> Column:
    return F.regexp_replace(text, NOT_BASIC if keep_punctuation else NOT_ALPHANUMERIC, "")


def preprocess(text: Column, operations: tuple[str, ...] = ("normalize",)) -> Column:
    """Whatever order is asked for, the steps run normalise, clean, lower."""
    if "normalize" in operations:
        text = normalise_whitespace(text)
    if "clean_special" in operations:
        text = remove_special(text)
    return F.lower(text) if "lowercase" in operations else text


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "[.!?]+"), strip), lambda s: F.length(s) > 0)


def truncate(text: Column, limit: int = 100, suffix: str = "...") -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - len(suffix)), F.lit(suffix))).otherwise(text)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def tokens(text: Column) -> Column:
    """Lower case, ASCII punctuation deleted, split on blanks."""
    return words(F.regexp_replace(F.lower(text), PUNCTUATION, ""))


def _starts(length: Column, step: int, last: Column) -> Column:
    return F.when(length > 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)))


def char_chunks(text: Column, size: int = 1000, overlap: int = 200) -> Column:
    """Array of (chunk_id, text, length, start_pos); the last chunk is the first one reaching the end."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step, length = size - overlap, F.length(text)
    starts = _starts(length, step, length - overlap - 1)

    def chunk(start: Column, i: Column) -> Column:
        piece = F.substring(text, start + 1, F.lit(size))
        return F.struct(i.alias("chunk_id"), piece.alias("text"), F.length(piece).alias("length"), start.alias("start_pos"))

    return F.transform(starts, chunk)


def word_chunks(tokens_: str, size: int = 500, overlap: int = 50) -> Column:
    """Array of texts starting every ``size - overlap`` words, tail included even when it repeats.

    Takes the name of a column of words: an expression would be split again for every chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    starts = _starts(F.size(tokens_), size - overlap, F.size(tokens_) - 1)
    return F.transform(starts, lambda s: F.array_join(F.slice(tokens_, s + 1, F.lit(size)), " "))
