"""Signals on hand-made blips and with hot keys forced."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldkit.functions.scalars import bucket
from fieldkit.operators import signals as S
from fieldkit.operators.skew import number_copies, salted_join

SCHEMA = "ascension double, declination double, time double, frequency double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def skewed(spark):
    """One signal with a third of all rows, one (signal, time) with many copies."""
    rng = random.Random(5)
    rows = [(1.0, 1.0, float(rng.randrange(400)), 7.0) for _ in range(300)]
    rows += [(1.0, 1.0, 55.0, 7.0)] * 250
    rows += [(2.0, 2.0, 9.0, 8.0)] * 120
    rows += [(float(rng.randrange(5)), float(rng.randrange(5)), float(rng.randrange(90)),
              float(rng.randrange(5))) for _ in range(600)]
    rng.shuffle(rows)
    return rows, frame(spark, rows).repartition(4).persist()


def by_key(rows):
    times = defaultdict(list)
    for a, d, t, f in rows:
        times[(f, a, d)].append(t)
    return {k: sorted(v) for k, v in times.items()}


def test_bucket_is_half_even(spark):
    rows = [(v,) for v in (0.5, 1.5, 2.5, -0.5, -1.5, 2.4)]
    got = spark.createDataFrame(rows, "v double").select(bucket(F.col("v"), 0)).collect()
    assert [r[0] for r in got] == [0.0, 2.0, 2.0, 0.0, -2.0, 2.0]


@pytest.mark.parametrize("decimals", [0, 1, 2, 5, 7])
def test_bucket_rounds_as_python_does(spark, decimals):
    rng = random.Random(decimals)
    values = [2.675, 9.995, 0.000005, 0.000015, 1e300, -1e300, 1e15, 4503599627370497.5, -0.4, 0.0]
    values += [k / 2 / 10 ** decimals for k in range(-4001, 4001)]
    values += [rng.uniform(-1e4, 1e4) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r[0] for r in df.select(bucket(F.col("v"), decimals)).collect()]
    assert got == [float(round(v, decimals)) for v in values]
    edge = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double")
    got = [r[0] for r in edge.coalesce(1).select(bucket(F.col("v"), decimals)).collect()]
    assert got[0] is None and got[1] != got[1] and got[2] == float("inf")


def test_counts_sum_to_input_rows(spark, skewed):
    rows, blips = skewed
    counts = S.blip_counts(blips)
    assert counts.agg(F.sum("blip_count")).first()[0] == len(rows)
    assert {(r[0], r[1], r[2]): r[3] for r in counts.collect()} == {
        k: len(v) for k, v in by_key(rows).items()}


def test_empty_input(spark):
    empty = frame(spark, [])
    assert S.blip_counts(empty).count() == 0
    assert S.top_signal_period(empty).count() == 0
    assert S.signal_gaps(empty).count() == 0
    assert S.top_signal_gaps(empty).count() == 0
    assert S.ranked_counts(S.blip_counts(empty)).count() == 0


def test_one_blip_has_no_period_and_no_gap(spark):
    one = frame(spark, [(1.0, 2.0, 3.0, 4.0)])
    row = S.top_signal_period(one).first()
    assert (row["blip_count"], row["period"]) == (1, None)
    assert S.signal_gaps(one).count() == 0


def test_ties_go_to_the_lowest_key(spark):
    blips = frame(spark, [(1.0, 1.0, 1.0, 9.0), (1.0, 1.0, 2.0, 9.0),
                          (2.0, 1.0, 1.0, 3.0), (2.0, 1.0, 5.0, 3.0)])
    row = S.top_signal_period(blips).first()
    assert (row["frequency"], row["period"]) == (3.0, 4.0)


def test_null_coordinates_group_and_null_times_have_no_gap(spark):
    blips = frame(spark, [(None, 1.0, 1.0, 9.0), (None, 1.0, 4.0, 9.0), (1.0, 1.0, None, 2.0),
                          (1.0, 1.0, 2.0, 2.0)])
    for hot_rows in (1, 1000):
        gaps = S.signal_gaps(blips, hot_rows=hot_rows).collect()
        assert [(r["frequency"], r["ascension"], r["gap"]) for r in gaps] == [(9.0, None, 3.0)]


@pytest.mark.parametrize("hot_rows", [1, 40, 10_000])
def test_gaps_are_the_same_however_keys_are_split(skewed, hot_rows):
    rows, blips = skewed
    got = defaultdict(list)
    for r in S.signal_gaps(blips, hot_rows=hot_rows).collect():
        got[(r["frequency"], r["ascension"], r["declination"])].append((r["time"], r["gap"]))
    want = {k: [(b, b - a) for a, b in zip(v, v[1:])] for k, v in by_key(rows).items()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}


@pytest.mark.parametrize("hot_rows", [40, 10_000])
def test_top_gaps(skewed, hot_rows):
    rows, blips = skewed
    key, times = max(by_key(rows).items(), key=lambda kv: len(kv[1]))
    got = S.top_signal_gaps(blips, hot_rows=hot_rows).collect()
    assert {(r["frequency"], r["ascension"], r["declination"]) for r in got} == {key}
    assert sorted(r["gap"] for r in got) == sorted(b - a for a, b in zip(times, times[1:]))


def test_mean_gap_is_the_period(skewed):
    _, blips = skewed
    means = S.signal_gaps(blips).groupBy(*S.KEYS).agg(F.avg("gap").alias("mean"))
    joined = S.signal_periods(blips).join(means, S.KEYS)
    assert joined.filter(F.abs(F.col("mean") - F.col("period")) > 1e-9).count() == 0


@pytest.mark.parametrize("hot_rows,list_rows", [(10_000, 10), (40, 7), (1, 100_000)])
def test_time_lists_are_whole_and_bounded(skewed, hot_rows, list_rows):
    rows, blips = skewed
    found = S.signal_times(S.bucket_blips(blips), S.KEYS, "time", hot_rows, list_rows).collect()
    parts = defaultdict(list)
    for r in found:
        key = (r["frequency"], r["ascension"], r["declination"])
        parts[key].append((r["part"], r["times"], r["blip_count"]))
    want = by_key(rows)
    assert set(parts) == set(want)
    for key, pieces in parts.items():
        pieces.sort(key=lambda p: p[0])
        assert [t for _, times, _ in pieces for t in times] == want[key]
        assert {n for _, _, n in pieces} == {len(want[key])}
        if len(want[key]) > hot_rows:
            assert max(len(times) for _, times, _ in pieces) <= list_rows


def test_copies_are_numbered_in_chunks(spark):
    df = spark.createDataFrame([("a",)] * 23 + [("b",)] * 2 + [(None,)], "k string")
    for chunk in (1, 5, 23, 100):
        got = sorted((r["k"] or "", r["copy"]) for r in number_copies(df, ["k"], chunk).collect())
        assert got == [("", 0)] + [("a", i) for i in range(23)] + [("b", 0), ("b", 1)]


def test_salted_join_equals_plain_join(spark):
    left = spark.createDataFrame([(i % 7 if i > 200 else 0, i) for i in range(500)], "k int, v int")
    right = spark.createDataFrame([(k, w) for k in range(5) for w in range(3)], "k int, w int")
    want = sorted(tuple(r) for r in left.join(right, "k").collect())
    assert sorted(tuple(r) for r in salted_join(left, right, ["k"], 50).collect()) == want


def test_ranks_and_lines(spark):
    blips = frame(spark, [(1.0, 1.0, 1.0, 9.0)] * 3 + [(2.0, 1.0, 1.0, 3.0)] * 2
                  + [(2.0, 1.0, 1.0, 4.0)] * 2 + [(5.0, 1.0, 1.0, 12345678.0)])
    counts = S.blip_counts(blips)
    assert [(r["blip_count"], r["rank"]) for r in S.ranked_counts(counts).collect()] == [
        (3, 1), (2, 2), (2, 2), (1, 4)]
    assert [r["line"] for r in S.formatted_counts(counts).collect()] == [
        "(9.0, 1.0, 1.0): 3", "(3.0, 2.0, 1.0): 2", "(4.0, 2.0, 1.0): 2",
        "(12345678.0, 5.0, 1.0): 1"]
