"""Sliced orderings against brute force, on data where one key holds a third of the rows."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.functions import ordered

BASE = datetime(2024, 3, 1, 22, 30)


def micros_of(t):
    return int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    out = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(12)}"
        at = BASE + timedelta(microseconds=rnd.randrange(0, 30_000) * 1_000_003)
        if i % 10 == 0:  # equal instants and whole seconds
            at = BASE + timedelta(seconds=rnd.randrange(0, 20) * 600)
        out.append((i, key, at, float(rnd.choice([10, 10, 20, 35.5, 7000]))))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, key string, ts timestamp, v double").repartition(5)


def test_trailing_count(frame, rows):
    got = {(r["key"], r["second"]): r["trailing"] for r in ordered.trailing_count(frame, "key", "ts", 3600).collect()}
    for _, key, at, _ in rows:
        s = micros_of(at) // 1_000_000
        want = sum(1 for _, k, t, _ in rows if k == key and s - 3600 <= micros_of(t) // 1_000_000 <= s)
        assert got[key, s] == want


@pytest.mark.parametrize("seconds", [600, 7200])
def test_strict_trailing_count(frame, rows, seconds):
    got = {(r["key"], r["_micros"]): r["recent"] for r in ordered.strict_trailing_count(frame, "key", "ts", seconds).collect()}
    for _, key, at, _ in rows:
        m = micros_of(at)
        want = sum(1 for _, k, t, _ in rows if k == key and m - seconds * 1_000_000 < micros_of(t) < m)
        assert got[key, m] == want


@pytest.mark.parametrize("width", [60, 3600, 10**7])
def test_prior_moments(frame, rows, width):
    for r in ordered.prior_moments(frame, "key", "ts", "v", width).collect():
        before = [v for _, k, t, v in rows if k == r["key"] and t < r["ts"]]
        assert r["prior_n"] == len(before)
        mean = sum(before) / len(before) if before else None
        assert r["prior_mean"] == (pytest.approx(mean) if before else None)
        assert r["prior_m2"] == pytest.approx(sum((v - mean) ** 2 for v in before))
        assert r["prior_min"] == (min(before) if before else None)
        assert r["prior_max"] == (max(before) if before else None)


@pytest.mark.parametrize("width", [60, 3600])
def test_previous_event(frame, rows, width):
    for r in ordered.previous_event(frame, "key", "ts", "id", ["id", "v"], width).collect():
        before = [(t, i, v) for i, k, t, v in rows if k == r["key"] and (t, i) < (r["ts"], r["id"])]
        assert (tuple(r["previous"]) if r["previous"] else None) == (max(before)[1:] if before else None)


def test_row_index(frame, rows):
    order = [i for i, _, _, _ in sorted(rows, key=lambda r: (r[2], r[0]))]
    got = {r["id"]: r["row_index"] for r in ordered.row_index(frame, "ts", "id").collect()}
    assert [got[i] for i in order] == list(range(len(rows)))


def test_values_at_ranks_and_percentiles(spark):
    rnd = random.Random(1)
    data = [("a", rnd.gauss(0, 1000)) for _ in range(900)] + [("b", 5.0)] * 50 + [("c", -1.5), ("c", 0.0), ("c", 2.0 ** 20)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r["g"]: r["values"] for r in ordered.values_at_ranks(df, ["g"], "v", lambda n: [F.lit(0), F.floor(n / 2), n - 1]).collect()}
    for g in "abc":
        s = sorted(v for k, v in data if k == g)
        assert got[g] == [s[0], s[len(s) // 2], s[-1]]
    line = ordered.linear_percentiles(df, ["g"], "v", {"p": 0.95}).collect()
    for r in line:
        s = sorted(v for k, v in data if k == r["g"])
        at = 0.95 * (len(s) - 1)
        low = math.floor(at)
        high = min(low + 1, len(s) - 1)
        assert r["p"] == pytest.approx(s[low] + (s[high] - s[low]) * (at - low))


def test_running_totals(spark):
    rnd = random.Random(2)
    values = [rnd.choice([-3.0, -0.001, 0.0, 1.0, 1.0000001, 2.0, 1023.9, 1024.0, 5e9]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    for r in ordered.running_totals(df, [], "v", {"n": F.count(F.lit(1))}).collect():
        assert r["n"] == sum(1 for v in values if v <= r["value"])
        assert r["all_n"] == len(values)


def test_value_slices_never_fall(spark):
    rnd = random.Random(3)
    values = sorted([rnd.uniform(-1, 1) * 10 ** rnd.randrange(-12, 15) for _ in range(3000)] + [s * 2.0 ** e * (1 + d) for s in (-1, 1) for e in range(-40, 50) for d in (-1e-15, 0, 1e-15)] + [0.0])
    cells = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(ordered.value_slice("v")).collect()]
    assert all(a <= b for a, b in zip(cells, cells[1:]))


def test_deviation_of_equal_values_is_zero(spark):
    df = spark.createDataFrame([(3, 1e-17, 0.1, 0.1), (1, 0.0, 5.0, 5.0), (2, 0.5, 1.0, 2.0)], "n int, q double, lo double, hi double")
    cols = [F.col(c) for c in ("n", "q", "lo", "hi")]
    got = df.select(ordered.deviation_of(*cols, sample=False).alias("p"), ordered.deviation_of(*cols, sample=True).alias("s")).collect()
    assert [r["p"] for r in got] == [0.0, 0.0, 0.5]
    assert got[0]["s"] == 0.0 and got[1]["s"] is None and got[2]["s"] == pytest.approx(math.sqrt(0.5))


@pytest.mark.parametrize("offset", [1e6, 1e9, 1e12])
def test_deviations_do_not_depend_on_the_level(spark, offset):
    """z-scores of shifted amounts equal those of the amounts, in one slice and over many."""
    from datetime import datetime, timedelta
    rnd = random.Random(4)
    values = [float(rnd.randrange(100)) for _ in range(40)]
    at = [datetime(2024, 1, 1) + timedelta(minutes=7 * i) for i in range(40)]
    df = spark.createDataFrame([(i, 1, at[i], v, v + offset) for i, v in enumerate(values)], "id int, key int, ts timestamp, v double, w double")
    for width in (600, 10 ** 7):
        got = {r["id"]: r for r in ordered.prior_moments(df, "key", "ts", "w", width).collect()}
        for i in range(2, 40):
            mean = sum(values[:i]) / i
            assert got[i]["prior_mean"] - offset == pytest.approx(mean, abs=1e-3)
            assert got[i]["prior_m2"] == pytest.approx(sum((v - mean) ** 2 for v in values[:i]), rel=1e-6, abs=2e-2 if offset > 1e10 else 1e-6)


@pytest.fixture()
def tight(monkeypatch):
    """Every slice of more than 20 rows counts as crowded."""
    monkeypatch.setattr(ordered, "SLICE_ROWS", 20)


@pytest.fixture(scope="module")
def midnight():
    """A third of the rows under one key, most of them on two dates without a time; null keys and values."""
    rnd = random.Random(11)
    days = [datetime(2024, 3, 1), datetime(2024, 3, 2)]
    out = []
    for i in range(500):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b"])
        at = days[i % 2] if i % 5 else days[0] + timedelta(seconds=rnd.randrange(0, 5000))
        out.append((i, key, at, None if i % 50 == 7 else 1e6 + rnd.random()))
    return out


@pytest.fixture(scope="module")
def dated(spark, midnight):
    return spark.createDataFrame(midnight, "id bigint, key string, ts timestamp, v double").repartition(4)


@pytest.mark.parametrize("keys,limit", [(["key"], 20), ([], 50)])
def test_crowded_slices_are_cut(dated, keys, limit):
    """Rows of one instant are spread over ranges of bounded size that do not overlap."""
    placed, by = ordered.with_slices(dated, keys, ordered.time_slice("ts", 3600), ["ts", "id"], limit)
    assert by == [ordered.SLICE, ordered.PART] and placed.count() == dated.count()
    ranges = placed.groupBy(*keys, *by).agg(
        F.count("*").alias("n"), F.min(F.struct("ts", "id")).alias("low"), F.max(F.struct("ts", "id")).alias("high")).collect()
    assert max(r["n"] for r in ranges) <= 3 * limit  # ranges are sampled, so they are not all alike
    ranges.sort(key=lambda r: tuple(r[k] for k in [*keys, *by]))
    for before, after in zip(ranges, ranges[1:]):
        if all(before[k] == after[k] for k in keys):
            assert before["high"] < after["low"]


def test_few_rows_are_not_cut(dated):
    placed, by = ordered.with_slices(dated, ["key"], ordered.time_slice("ts", 3600), ["ts", "id"])
    assert by == [ordered.SLICE] and ordered.PART not in placed.columns


def test_previous_event_in_crowded_slices(dated, midnight, tight):
    rank = sorted((k, t, i, v) for i, k, t, v in midnight)
    want = {b[2]: (a[2], a[3]) if a[0] == b[0] else None for a, b in zip([("", None, None, None), *rank], rank)}
    got = {r["id"]: tuple(r["previous"]) if r["previous"] else None for r in ordered.previous_event(dated, "key", "ts", "id", ["id", "v"]).collect()}
    assert got == want


def test_row_index_in_crowded_slices(dated, midnight, tight):
    order = [i for i, _, _, _ in sorted(midnight, key=lambda r: (r[2], r[0]))]
    got = {r["id"]: r["row_index"] for r in ordered.row_index(dated, "ts", "id").collect()}
    assert [got[i] for i in order] == list(range(len(order)))


@pytest.mark.parametrize("limit", [3, 20, None])
def test_prior_moments_in_crowded_slices(dated, midnight, limit):
    """Rows of one instant never count for each other, wherever the slice was cut."""
    got = ordered.prior_moments(dated, "key", "ts", "v", limit=limit).collect()
    assert len(got) == len(midnight)
    for r in got:
        before = [v for _, k, t, v in midnight if k == r["key"] and t < r["ts"] and v is not None]
        assert r["prior_n"] == len(before)
        mean = math.fsum(before) / len(before) if before else None
        assert r["prior_mean"] == (pytest.approx(mean, rel=1e-12) if before else None)
        assert r["prior_m2"] == pytest.approx(math.fsum((v - mean) ** 2 for v in before), rel=1e-6, abs=1e-6)
        assert (r["prior_min"], r["prior_max"]) == ((min(before), max(before)) if before else (None, None))


def test_null_keys_of_crowded_slices_stay(spark, tight):
    df = spark.range(200).select(F.col("id"), F.lit(None).cast("string").alias("key"), F.lit(BASE).alias("ts"), F.col("id").cast("double").alias("v"))
    assert ordered.previous_event(df, "key", "ts", "id", ["id"]).count() == 200
    assert {r["prior_n"] for r in ordered.prior_moments(df, "key", "ts", "v").collect()} == {0}


def test_close_values_fill_many_slices(spark):
    """Epoch seconds of a month lie in one fixed cell; the cuts spread them and the ranks stay exact."""
    seconds = spark.range(0, 2_600_000).select((F.lit(1_700_000_000) + F.col("id")).alias("at"))
    points, by = ordered._sliced_counts(seconds, [], "at", {"n": F.count(F.lit(1))}, 1024)
    sizes = [r["count"] for r in points.groupBy(*by).count().collect()]
    assert len(sizes) >= 100 and max(sizes) <= 4 * ordered.SLICE_ROWS
    got = ordered.values_at_ranks(seconds, [], "at", lambda n: [F.lit(0), F.floor(n / 2), n - 1]).first()["values"]
    assert got == [1_700_000_000.0, 1_701_300_000.0, 1_702_599_999.0]


def test_totals_and_ranks_in_crowded_cells(spark, tight):
    rnd = random.Random(2)
    values = [(g, 100 + rnd.randrange(900) / 1e5) for g in ("a", None) for _ in range(400)]
    df = spark.createDataFrame(values, "g string, v double")
    alone = [v for g, v in values if g == "a"]
    got = {r["value"]: (r["n"], r["all_n"]) for r in ordered.running_totals(df.where("g = 'a'"), ["g"], "v", {"n": F.count(F.lit(1))}).collect()}
    assert got == {v: (sum(x <= v for x in alone), len(alone)) for v in alone}
    middle = ordered.values_at_ranks(df.where("g = 'a'"), ["g"], "v", lambda n: [F.lit(0), F.floor(n / 2)]).first()["values"]
    assert middle == [min(alone), sorted(alone)[200]]
