"""Order-dependent computations that never put one whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to a single task, so
a key holding a third of the data stops the job. The helpers here cut each key
into slices (of time, or of value), work inside ``(key, slice)`` and carry a
small summary from slice to slice. The summary has one row per slice, so the only
window that spans a whole key runs over at most *number of slices* rows.

Slices are pure functions of the row. They need no sampling, give the same answer
when a lost task is recomputed, and do not depend on the number of partitions. Their rows are
counted first: a slice with more than ``SLICE_ROWS`` rows (a hot customer's hour, one midnight,
values close together) is cut along its order into ranges that are measured and then stored, so that a
recomputed task finds the same cuts. Without such slices nothing but the count is added.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import scratch

SLICE, PART = "_slice", "_slice_part"
#: Rows of a slice that are ordered together; slices with more are cut.
SLICE_ROWS = 20_000
#: Cuts of all crowded slices of a table together. Beyond it they grow like the partitions of any shuffle.
MOST_CUTS = 20_000
MICROS = "_micros"
UNBOUNDED = Window.unboundedPreceding


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)


def whole_seconds(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def time_slice(ts: str, seconds: int) -> Column:
    return F.floor(whole_seconds(ts) / F.lit(seconds)).cast("bigint")


def value_slice(value: str | Column, cells: int = 1024) -> Column:
    """Monotone integer cell of a number: ``cells`` cells per power of two.

    ``log2`` rounded down plus the linear position inside the octave is continuous
    and increasing, hence neighbouring values never swap cells.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.abs(v)
    octave = F.floor(F.log2(F.when(size > 0, size)))
    place = octave + size / F.pow(F.lit(2.0), octave) - 1 + 64
    return F.coalesce(F.floor(F.signum(v) * F.greatest(place, F.lit(0.0)) * cells), F.lit(0)).cast("bigint")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal or equally null keys; the columns of the left side come first."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def _crowded(placed: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """(keys, slice) of the slices above ``limit`` rows, stored; None where there are none."""
    counts = placed.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    if counts.isEmpty():
        return None
    return _stored(counts.select(*keys, SLICE), "crowded")


def _cut(rows: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """Number the rows' ranges along (keys, order) as ``PART``; stored, since the bounds are measured."""
    ranges = min(MOST_CUTS, rows.count() // limit + 1)
    return _stored(rows.repartitionByRange(ranges, *keys, *order).withColumn(PART, F.spark_partition_id()), "cut")


def with_slices(df: DataFrame, keys: Sequence[str], cell: Column, order: Sequence[str], limit: int | None = None) -> tuple[DataFrame, list[str]]:
    """The rows with their slice, and the columns that name a slice within ``keys`` in order.

    Rows are cut anywhere along ``order``, ties of its first columns included; only rows equal in
    all of ``keys`` and ``order`` stay together. Null keys are one key.
    """
    limit = limit or SLICE_ROWS
    placed = df.withColumn(SLICE, cell)
    full = _crowded(placed, keys, limit)
    if full is None:
        return placed, [SLICE]
    at = [*keys, SLICE]
    cut = _cut(_stored(_matched(placed, full, at, "left_semi"), "rows"), keys, order, limit)
    return _matched(placed, full, at, "left_anti").withColumn(PART, F.lit(0)).unionByName(cut), [SLICE, PART]


def _sweep(points: DataFrame, key: str, at: str, width: int, parts: int, leaves: int, upto: int) -> DataFrame:
    """Sum of ``n`` over a trailing window of ``width`` positions, as running totals.

    A point counts from its position on and is taken off again ``width + leaves``
    later, so every row costs the same whatever the window holds; a sliding frame
    would add up the whole window again for each row. A slice is ``width / parts``
    long and starts from the total of the ``parts`` slices before it.
    """
    step = -(-width // parts)
    parts, reach = -(-width // step), -(-width // step) * step
    if reach != width:
        raise ValueError("the window must be a whole number of slices")
    cell = F.floor(F.col(at) / step).cast("bigint")
    totals = points.groupBy(F.col(key), cell.alias(SLICE)).agg(F.sum("n").alias("n"))
    before = Window.partitionBy(key).orderBy(SLICE).rangeBetween(-parts, -1)
    opening = totals.select(
        F.col(key), F.col(SLICE), (F.col(SLICE) * step - 1).alias("_at"), F.sum("n").over(before).alias("_delta"),
        F.lit(False).alias("_own")).where("_delta IS NOT NULL")
    own = F.struct(cell.alias(SLICE), F.col(at).alias("_at"), F.col("n").alias("_delta"), F.lit(True).alias("_own"))
    gone = F.struct(
        (cell + parts).alias(SLICE), (F.col(at) + width + leaves).alias("_at"), (-F.col("n")).alias("_delta"), F.lit(False).alias("_own"))
    moves = points.select(F.col(key), F.explode(F.array(own, gone)).alias("_m")).select(key, "_m.*")
    w = Window.partitionBy(key, SLICE).orderBy("_at").rangeBetween(UNBOUNDED, upto)
    return (
        moves.unionByName(opening)
        .withColumn("_sum", F.coalesce(F.sum("_delta").over(w), F.lit(0)))
        .where("_own")
        .select(key, F.col("_at").alias(at), "_sum"))


def trailing_count(df: DataFrame, key: str, ts: str, seconds: int, parts: int = 120) -> DataFrame:
    """Rows of the same key in ``[t - seconds, t]``, whole seconds, both ends included.

    One output row per (key, second). Rows are counted per second before anything
    is ordered, so a slice holds a bounded number of rows however hot the key is.
    """
    per_second = df.groupBy(F.col(key), whole_seconds(ts).alias("second")).agg(F.count(F.lit(1)).alias("n"))
    return _sweep(per_second, key, "second", seconds, parts, 1, 0).withColumnRenamed("_sum", "trailing")


def strict_trailing_count(df: DataFrame, key: str, ts: str, seconds: int, parts: int = 120) -> DataFrame:
    """Rows of the same key in the open interval ``(t - seconds, t)``, to the microsecond.

    One output row per (key, instant).
    """
    instants = df.groupBy(F.col(key), micros(ts).alias(MICROS)).agg(F.count(F.lit(1)).alias("n"))
    return _sweep(instants, key, MICROS, seconds * 1_000_000, parts, -1, -1).withColumnRenamed("_sum", "recent")


def merged_moments(n: Column, mean: Column, m2: Column, n2: Column, mean2: Column, m22: Column) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared distances from the mean of two parts taken together; a part without rows is null or 0."""
    n, n2 = F.coalesce(n, F.lit(0)), F.coalesce(n2, F.lit(0))
    gap = F.coalesce(mean2 - mean, F.lit(0.0))
    both = F.nullif(n + n2, F.lit(0))
    middle = F.when(n == 0, mean2).when(n2 == 0, mean).otherwise(mean + gap * n2 / both)
    return n + n2, middle, F.coalesce(m2, F.lit(0.0)) + F.coalesce(m22, F.lit(0.0)) + F.coalesce(gap * gap * n * n2 / both, F.lit(0.0))


_PARTS = {"n": F.count, "mean": F.avg, "var": F.var_pop, "min": F.min, "max": F.max}


def _before(parts: DataFrame, group: Sequence[str], order: Sequence[str], prefix: str) -> DataFrame:
    """Moments of the parts before each part of its group: n, mean, m2, min and max with ``prefix``.

    Parts are merged around the first mean of the group, so large values with small
    differences keep them.
    """
    along = Window.partitionBy(*group).orderBy(*order)
    earlier = along.rowsBetween(UNBOUNDED, -1)
    centre = F.first("c_mean", ignorenulls=True).over(along.rowsBetween(UNBOUNDED, Window.unboundedFollowing))
    shifted = parts.withColumn("_c", centre).withColumn("_d", F.col("c_mean") - F.col("_c"))

    def total(x: Column) -> Column:
        return F.sum(x).over(earlier)

    n, d = F.col("c_n"), F.col("_d")
    run_n, run_d = total(n), total(n * d)
    spread = total(n * F.col("c_var")) + F.greatest(total(n * d * d) - run_d * run_d / F.nullif(run_n, F.lit(0)), F.lit(0.0))
    columns = {
        "n": run_n, "mean": F.col("_c") + run_d / F.nullif(run_n, F.lit(0)), "m2": spread,
        "min": F.min("c_min").over(earlier), "max": F.max("c_max").over(earlier)}
    return shifted.select(*group, *order, *[c.alias(prefix + name) for name, c in columns.items()])


def _crowded_moments(rows: DataFrame, key: str, v: Column, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows of crowded slices with the moments before them in their cut, and the totals of the cuts.

    The rows of one instant become one part first, so an instant of any size is cut.
    """
    at = [key, SLICE, PART]
    instants = rows.groupBy(key, SLICE, MICROS).agg(*[f(v).alias(f"c_{name}") for name, f in _PARTS.items()])
    cut = _cut(_stored(instants, "instants"), [key], [MICROS], limit)
    n, mean = F.col("c_n"), F.col("c_mean")
    whole = cut.groupBy(*at).agg(
        F.sum(n).alias("n"), (F.sum(n * mean) / F.nullif(F.sum(n), F.lit(0))).alias("mean"), F.min("c_min").alias("min"), F.max("c_max").alias("max"))
    gap = mean - F.col("mean")
    totals = _matched(cut, whole, at, "inner").groupBy(*at, "n", "mean", "min", "max").agg(
        (F.sum(n * (F.col("c_var") + gap * gap)) / F.nullif(F.first("n"), F.lit(0))).alias("var"))
    return (_matched(rows, _before(cut, at, [MICROS], "i_"), [key, SLICE, MICROS], "inner"),
            totals.select(*at, *[F.col(name).alias(f"c_{name}") for name in _PARTS]))


def prior_moments(df: DataFrame, key: str, ts: str, value: str, slice_seconds: int = 3600, limit: int | None = None) -> DataFrame:
    """Add count, mean, squared distances, min and max of strictly earlier rows of the key.

    Columns ``prior_n``, ``prior_mean``, ``prior_m2``, ``prior_min``, ``prior_max``. Inside a
    slice the engine's running variance is used; the slices before it come as merged moments.
    """
    v, limit = F.col(value).cast("double"), limit or SLICE_ROWS
    placed = df.withColumn(SLICE, time_slice(ts, slice_seconds)).withColumn(MICROS, micros(ts))
    full, at = _crowded(placed, [key], limit), [key, SLICE]
    plain = placed if full is None else _matched(placed, full, at, "left_anti")
    inside = Window.partitionBy(*at).orderBy(MICROS).rangeBetween(UNBOUNDED, -1)
    parts = {name: f(v) for name, f in _PARTS.items()}
    totals = plain.groupBy(*at).agg(*[c.alias(f"c_{name}") for name, c in parts.items()])
    rows = plain.select("*", *[c.over(inside).alias(f"i_{name}") for name, c in parts.items()])
    rows = rows.withColumn("i_m2", F.col("i_n") * F.col("i_var")).drop("i_var")
    if full is not None:
        crowded, more = _crowded_moments(_stored(_matched(placed, full, at, "left_semi"), "rows"), key, v, limit)
        rows = rows.withColumn(PART, F.lit(0)).unionByName(crowded)
        totals = totals.withColumn(PART, F.lit(0)).unionByName(more)
        at = [*at, PART]
    joined = rows.join(_before(totals, [key], at[1:], "c_"), at, "left")
    count, mean, m2 = merged_moments(*[F.col(c) for c in ("i_n", "i_mean", "i_m2", "c_n", "c_mean", "c_m2")])
    return joined.select(
        *[F.col(c) for c in df.columns], count.alias("prior_n"), mean.alias("prior_mean"), m2.alias("prior_m2"),
        F.least("i_min", "c_min").alias("prior_min"), F.greatest("i_max", "c_max").alias("prior_max"))


def deviation_of(n: Column, m2: Column, low: Column, high: Column, sample: bool) -> Column:
    """Standard deviation from squared distances; exactly 0 where all values were equal."""
    freedom = F.nullif(n - 1, F.lit(0)) if sample else F.nullif(n, F.lit(0))
    return F.when(low == high, F.when(freedom.isNotNull(), F.lit(0.0))).otherwise(F.sqrt(F.greatest(m2, F.lit(0.0)) / freedom))


def previous_event(
    df: DataFrame, key: str, ts: str, tiebreak: str, columns: Sequence[str], slice_seconds: int = 3600
) -> DataFrame:
    """Add ``previous``: struct of ``columns`` of the row before, per key in (ts, tiebreak) order."""
    payload = F.struct(*[F.col(c) for c in columns])
    ordered = F.struct(F.col(ts).alias("_t"), F.col(tiebreak).alias("_b"), payload.alias("_p"))
    placed, by = with_slices(df, [key], time_slice(ts, slice_seconds), [ts, tiebreak])
    last = placed.groupBy(key, *by).agg(F.max(ordered).alias("_last"))
    carry = last.select(key, *by, F.lag("_last._p").over(Window.partitionBy(key).orderBy(*by)).alias("_carry"))
    inside = Window.partitionBy(key, *by).orderBy(ts, tiebreak)
    rows = placed.withColumn("_before", F.lag(payload).over(inside))
    return rows.join(carry, [key, *by], "left").select(
        *[F.col(c) for c in df.columns], F.coalesce("_before", "_carry").alias("previous"))


def numbered(df: DataFrame, cell: Column, order: Sequence[str], output: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in global ``order``.

    ``cell`` must not decrease along that order; rows are numbered cell by cell and
    shifted by the row count of the cells before.
    """
    placed, by = with_slices(df, [], cell, order)
    counts = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(*by, (F.sum("n").over(Window.orderBy(*by)) - F.col("n")).alias("_start"))
    inside = Window.partitionBy(*by).orderBy(*order)
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(starts, by)
        .select(*[F.col(c) for c in df.columns], (F.col("_start") + F.col("_place") - 1).alias(output))
    )


def row_index(df: DataFrame, ts: str, tiebreak: str, slice_seconds: int = 60) -> DataFrame:
    """Position in global (ts, tiebreak) order."""
    return numbered(df, time_slice(ts, slice_seconds), [ts, tiebreak])


def _sliced_counts(df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column], cells: int) -> tuple[DataFrame, list[str]]:
    """One row per distinct value with its measures and slice, and the columns that name a slice."""
    present = df.where(F.col(value).isNotNull())
    points = present.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(*[m.alias(name) for name, m in measures.items()])
    cell = value_slice("value", cells)
    # Rows are an upper bound of the distinct values and need no shuffle of values to be counted.
    if _crowded(present.withColumn(SLICE, value_slice(value, cells)), keys, SLICE_ROWS) is None:
        return points.withColumn(SLICE, cell), [SLICE]
    return with_slices(_stored(points, "points"), keys, cell, ["value"])


def running_totals(
    df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column], cells: int = 1024
) -> DataFrame:
    """Per distinct value: each measure summed over all values up to and including it."""
    points, by = _sliced_counts(df, keys, value, measures, cells)
    totals = points.groupBy(*keys, *by).agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy(*keys).orderBy(*by).rowsBetween(UNBOUNDED, -1)
    whole = Window.partitionBy(*keys)
    carry = totals.select(
        *keys, *by,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"before_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"all_{m}") for m in measures])
    inside = Window.partitionBy(*keys, *by).orderBy("value").rowsBetween(UNBOUNDED, 0)
    return (
        points.select(*keys, *by, "value", *[F.sum(m).over(inside).alias(f"in_{m}") for m in measures])
        .join(carry, [*keys, *by])
        .select(
            *keys, "value",
            *[(F.col(f"in_{m}") + F.col(f"before_{m}")).alias(m) for m in measures],
            *[F.col(f"all_{m}") for m in measures])
    )


def values_at_ranks(
    df: DataFrame, keys: Sequence[str], value: str, ranks: Callable[[Column], Sequence[Column]], cells: int = 1024
) -> DataFrame:
    """Exact order statistics: ``values`` = array with the value at each 0-based rank.

    ``ranks`` maps the group's row count to rank columns. Only the slices that hold
    a wanted rank are ordered; everything else stays a hash aggregate.
    """
    points, by = _sliced_counts(df, keys, value, {"n": F.count(F.lit(1))}, cells)
    totals = points.groupBy(*keys, *by).agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*keys).orderBy(*by).rowsBetween(UNBOUNDED, -1)
    placed = totals.select(
        *keys, *by, "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("size"))
    wanted = placed.select(
        *keys, *by, "n", "start", "size", F.posexplode(F.array(*ranks(F.col("size")))).alias("which", "rank"),
    ).where("rank >= start AND rank < start + n").select(*keys, *by, "which", (F.col("rank") - F.col("start")).alias("rank"), "size")
    inside = Window.partitionBy(*keys, *by).orderBy("value").rowsBetween(UNBOUNDED, 0)
    held = points.join(wanted.select(*keys, *by).distinct(), [*keys, *by], "left_semi").withColumn(
        "upto", F.sum("n").over(inside))
    found = held.join(wanted, [*keys, *by]).where("rank >= upto - n AND rank < upto")
    return found.groupBy(*keys).agg(
        F.max("size").alias("size"),
        F.transform(F.sort_array(F.collect_list(F.struct("which", "value"))), lambda s: s["value"]).alias("values"))


def linear_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: dict[str, float], cells: int = 1024
) -> DataFrame:
    """Exact percentiles with linear interpolation between the two neighbouring ranks."""
    def ranks(n: Column) -> list[Column]:
        out = []
        for p in points.values():
            at = (n - 1) * F.lit(p)
            out += [F.floor(at), F.ceil(at)]
        return out

    picked = values_at_ranks(df, keys, value, ranks, cells)
    columns = []
    for i, (name, p) in enumerate(points.items()):
        at = (F.col("size") - 1) * F.lit(p)
        low, high = F.get("values", F.lit(2 * i)), F.get("values", F.lit(2 * i + 1))
        columns.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picked.select(*keys, *columns)
