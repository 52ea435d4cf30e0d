"""Space-filling keys, runs of keys and the range join on them."""

import random

import numpy as np
import pytest

from fieldkit.operators import boxes as B
from fieldkit.operators import curve as C

KEYS = ["frequency", "ascension", "declination"]
BOUNDS = [("f_lo", "f_hi"), ("a_lo", "a_hi"), ("d_lo", "d_hi")]
POINT = "frequency double, ascension double, declination double, time double, copies bigint"


def key_by_bits(cell):
    return sum(((c >> i) & 1) << (3 * i + 2 - axis)
               for axis, c in enumerate(cell) for i in range(C.BITS))


def test_keys_interleave_bits(spark):
    rng = random.Random(1)
    cells = [[rng.randrange(1 << C.BITS) for _ in range(3)] for _ in range(200)]
    cells += [[0, 0, 0], [(1 << C.BITS) - 1] * 3]
    want = [key_by_bits(c) for c in cells]
    assert C.keys_of(np.array(cells)).tolist() == want
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, a int, b int, c int")
    got = df.select("i", C.key_of([df.a, df.b, df.c]).alias("z"))
    assert [r.z for r in got.orderBy("i").collect()] == want


@pytest.mark.parametrize("most", [1, 2, 7, 40])
def test_runs_hold_all_cells_of_a_box_and_do_not_meet(most):
    rng = random.Random(most)
    low = np.array([[rng.randrange(60) for _ in range(3)] for _ in range(50)])
    high = low + np.array([[rng.choice([0, 1, 3, 20]) for _ in range(3)] for _ in range(50)])
    number, first, last = C.key_runs(low, high, most)
    for i in range(50):
        runs = sorted(zip(first[number == i].tolist(), last[number == i].tolist(), strict=True))
        assert 1 <= len(runs) <= most
        assert all(a[1] < b[0] for a, b in zip(runs, runs[1:], strict=False))
        for _ in range(30):
            cell = [rng.randint(a, b) for a, b in zip(low[i].tolist(), high[i].tolist(),
                                                      strict=True)]
            assert any(a <= key_by_bits(cell) <= b for a, b in runs)


def test_more_runs_waste_fewer_keys():
    low, high = np.array([[5, 9, 3]]), np.array([[70, 20, 90]])
    spans = []
    for most in (1, 4, 16, 64):
        _, first, last = C.key_runs(low, high, most)
        spans.append(int((last - first + 1).sum()))
    assert spans == sorted(spans, reverse=True) and spans[-1] < spans[0] / 4
    assert spans[-1] >= 66 * 12 * 88


@pytest.fixture(scope="module")
def sky(spark):
    rng = random.Random(3)
    points = [(*[rng.uniform(0, 200) for _ in range(3)], float(i % 50), 1 + i % 3)
              for i in range(6000)]
    points += [(50.0, 60.0, 70.0, float(i), 1) for i in range(3000)]  # a third at one place
    boxes = []
    for i in range(400):
        low = [rng.uniform(-5, 190) for _ in range(3)]
        high = [v + 2.0 ** rng.uniform(-10, 6) for v in low]
        boxes.append(B.Box(f"b{i}", low[0], high[0], low[1], high[1], low[2], high[2]))
    boxes.append(B.Box("place", 50.0, 50.0, 60.0, 60.0, 70.0, 70.0))
    boxes.append(B.Box("all", -np.inf, np.inf, -np.inf, np.inf, -np.inf, np.inf))
    return points, spark.createDataFrame(points, POINT).repartition(5).cache(), boxes


@pytest.mark.parametrize("sizes", [{}, {"slice_rows": 500}, {"slice_rows": 100, "slice_runs": 20},
                                   {"runs_per_box": 1, "slice_rows": 3}])
def test_matches_equal_all_pairs(spark, sky, sizes):
    points, frame, boxes = sky
    got = C.match_by_curve(frame, B.boxes_frame(spark, boxes), KEYS, BOUNDS, **sizes)
    counted = {r.box_id: r["count"] for r in got.groupBy("box_id").count().collect()}
    p = np.array([row[:3] for row in points])
    want = {}
    for box in boxes:
        sides = [box.range_of(k) for k in KEYS]
        n = int(np.all([(p[:, i] >= a) & (p[:, i] <= b) for i, (a, b) in enumerate(sides)],
                       axis=0).sum())
        if n:
            want[box.box_id] = n
    assert counted == want and want["all"] == 9000 and want["place"] == 3000
    assert sorted(map(tuple, got.filter("box_id = 'all'").drop("box_id").collect())) == sorted(points)


def test_each_point_is_sent_once_whatever_the_widths(spark, sky, monkeypatch):
    """Rows sent to the join are the points, once, and the runs of the boxes."""
    _, frame, boxes = sky
    sent = {}

    def counting(runs, placed, *rest):
        sent["points"], sent["runs"] = placed.count(), runs.count()
        sent["slices"] = [r["count"] for r in placed.groupBy("slice", "part").count().collect()]
        return met(runs, placed, *rest)

    met = C._met
    monkeypatch.setattr(C, "_met", counting)
    C.match_by_curve(frame, B.boxes_frame(spark, boxes[:-1]), KEYS, BOUNDS, slice_rows=1000)
    assert sent["points"] == 9000 and sent["points"] + sent["runs"] <= 2 * 9000
    assert max(sent["slices"]) <= 2000  # the crowded place too is cut
    C.match_by_curve(frame, B.boxes_frame(spark, boxes), KEYS, BOUNDS, slice_runs=40)
    assert sent["points"] > 9000  # only where too many runs reach into a slice


def test_nothing_to_match(spark, sky):
    _, frame, boxes = sky
    none = C.match_by_curve(frame.filter("time < 0"), B.boxes_frame(spark, boxes), KEYS, BOUNDS)
    assert none.collect() == [] and none.columns == ["box_id", *frame.columns]
    far = B.boxes_frame(spark, [B.Box("far", 900.0, 901.0, 0.0, 1.0, 0.0, 1.0),
                                B.Box("turned", 9.0, 1.0, 0.0, 99.0, 0.0, 99.0)])
    assert C.match_by_curve(frame, far, KEYS, BOUNDS).collect() == []
    same = frame.filter("frequency = 50.0 AND ascension = 60.0")
    assert C.match_by_curve(same, B.boxes_frame(spark, boxes), KEYS, BOUNDS).filter(
        "box_id = 'place'").count() == 3000


@pytest.mark.parametrize("values", [(3, 5, 2000), (700, 700, 700), (1, 1, 1), (400, 2, 1)])
def test_totals_without_pairs_equal_those_of_all_pairs(values):
    rng = np.random.default_rng(sum(values))
    points = [rng.integers(0, n, 900) / 8.0 for n in values]
    weights = rng.integers(1, 9, 900)
    lows = [rng.integers(-2, n + 1, 300) / 8.0 for n in values]
    highs = [low + rng.integers(-1, n + 2, 300) / 8.0 for low, n in zip(lows, values, strict=True)]
    lows[0][:3], highs[0][:3], highs[1][5] = -np.inf, np.inf, np.nan
    inside = np.ones((300, 900), dtype=bool)
    for p, low, high in zip(points, lows, highs, strict=True):
        inside &= (p >= low[:, None]) & (p <= high[:, None])
    assert C.totals_inside(points, weights, lows, highs).tolist() == (inside @ weights).tolist()
    assert C.totals_inside([p[:0] for p in points], weights[:0], lows, highs).tolist() == [0] * 300


@pytest.mark.parametrize("sizes", [{}, {"slice_rows": 500}, {"slice_rows": 100, "slice_runs": 20},
                                   {"runs_per_box": 1, "slice_rows": 3}])
def test_counts_by_curve_equal_all_pairs(spark, sky, sizes):
    points, frame, boxes = sky
    table = B.boxes_frame(spark, [*boxes, boxes[0], boxes[-1]])  # a row twice counts twice
    got = C.count_by_curve(frame, table, KEYS, BOUNDS, **sizes).groupBy("box_id").sum("copies").collect()
    p = np.array([row[:3] for row in points])
    copies = np.array([row[4] for row in points])
    want = {}
    for box in [*boxes, boxes[0], boxes[-1]]:
        sides = [box.range_of(k) for k in KEYS]
        n = int(copies[np.all([(p[:, i] >= a) & (p[:, i] <= b) for i, (a, b) in enumerate(sides)],
                              axis=0)].sum())
        if n:
            want[box.box_id] = want.get(box.box_id, 0) + n
    assert {r[0]: r[1] for r in got} == want
    assert C.count_by_curve(frame.filter("time < 0"), table, KEYS, BOUNDS).collect() == []
