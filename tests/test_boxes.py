"""Boxes against brute force, by all three ways of matching."""

import random
import statistics

import pytest

from fieldkit.operators import boxes as B
from fieldkit.operators.quantiles import exact_medians, exact_medians_by
from fieldkit.operators.skew import salted_join

INF = float("inf")
BLIP = "ascension double, declination double, time double, frequency double"


@pytest.fixture(scope="module")
def sky(spark):
    rng = random.Random(11)
    rows = [(round(rng.uniform(0, 9), 3), round(rng.uniform(-5, 5), 3), float(i % 50),
             round(rng.uniform(-20, 20), 3)) for i in range(800)]
    rows += [(4.0, 1.0, 3.0, 2.0)] * 300
    return rows, spark.createDataFrame(rows, BLIP).repartition(4).persist()


def random_boxes(n):
    rng = random.Random(n)
    boxes = []
    for i in range(n):
        f, a, d = rng.uniform(-20, 18), rng.uniform(0, 8), rng.uniform(-5, 4)
        width = rng.choice([0.0, 0.01, 0.3, 2.0, 17.0])
        boxes.append(B.Box(f"b{i}", round(f, 3), round(f + width, 3), a, a + rng.uniform(0, 6),
                           d, d + 3.0))
    return [*boxes, B.Box("copies", 2.0, 2.0, 4.0, 4.0, 1.0, 1.0),
            B.Box("none", 900.0, 901.0, 0.0, 1.0, 0.0, 1.0),
            B.Box("open", -INF, 3.0, 2.0, INF, -INF, INF),
            B.Box("turned", 19.0, -19.0, 0.0, 9.0, -5.0, 5.0)]


def inside(row, box):
    a, d, _, f = (round(v, 5) for v in row)
    return (box.f_lo <= f <= box.f_hi and box.a_lo <= a <= box.a_hi and box.d_lo <= d <= box.d_hi)


@pytest.mark.parametrize("matching", [
    {"few_boxes": 1000}, {"few_boxes": 1, "some_boxes": 1000},
    {"few_boxes": 1, "some_boxes": 1, "by_curve": False},
    {"few_boxes": 1, "some_boxes": 1, "by_curve": False, "hot_rows": 20},
    {"few_boxes": 1, "some_boxes": 1},
    {"few_boxes": 1, "some_boxes": 1, "slice_rows": 30, "slice_runs": 7, "runs_per_box": 5}])
def test_totals_are_the_same_by_every_way(spark, sky, matching):
    rows, blips = sky
    boxes = random_boxes(60)
    got = B.box_totals(blips, B.boxes_frame(spark, boxes), **matching).collect()
    want = {b.box_id: sum(inside(r, b) for r in rows) for b in boxes}
    assert {r["box_id"]: r["total_blips"] for r in got} == want
    assert want["copies"] == 300 and want["none"] == want["turned"] == 0 < want["open"]


@pytest.mark.parametrize("matching", [
    {"few_boxes": 1000}, {"few_boxes": 1, "some_boxes": 1, "hot_rows": 20}])
def test_signals_of_all_boxes(spark, sky, matching):
    rows, blips = sky
    boxes = random_boxes(12)
    want = {}
    for box in boxes:
        for row in rows:
            if inside(row, box):
                a, d, t, f = row
                want.setdefault((box.box_id, f, a, d), []).append(t)
    got = {}
    for r in sorted(B.signals_by_box(blips, B.boxes_frame(spark, boxes), **matching).collect(),
                    key=lambda r: r["part"]):
        got.setdefault((r["box_id"], *[r[k] for k in B.KEYS]), []).extend(r["times"])
    assert got == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("few_boxes", [1, 64])
def test_boxes_that_hold_nothing(spark, sky, few_boxes):
    _, blips = sky
    assert B.box_totals(blips, B.boxes_frame(spark, [])).count() == 0
    turned = [(str(i), 9.0, 1.0, 0.0, 9.0, 0.0, 9.0) for i in range(3)]
    unknown = [("unknown", None, 9.0, 0.0, 9.0, 0.0, 9.0)]
    for rows in (turned, unknown, turned + unknown):
        boxes = spark.createDataFrame(rows, B.BOX_SCHEMA)
        totals = B.box_totals(blips, boxes, few_boxes=few_boxes).collect()
        assert [r["total_blips"] for r in totals] == [0] * len(rows)


def test_bounds_belong_to_the_box(spark):
    blips = spark.createDataFrame([(1.0, 2.0, 7.0, 3.0), (1.000004, 2.0, 8.0, 3.0),
                                   (1.00002, 2.0, 9.0, 3.0)], BLIP)
    box = B.Box("b", 3.0, 3.5, 0.5, 1.0, 2.0, 2.0)
    assert [r["time"] for r in B.box_blips(blips, box).collect()] == [7.0, 8.0]


def test_lines_and_parts(spark):
    blips = spark.createDataFrame([(1.0, 2.0, 5.5, 3.0), (1.0, 2.0, 4.0, 3.0)], BLIP)
    signals = B.box_signals(blips, B.Box("b", 3.0, 3.0, 1.0, 1.0, 2.0, 2.0))
    assert [r["line"] for r in B.formatted_boxes(signals).collect()] == [
        "(3.0, 1.0, 2.0): Count = 2, Times = [4.0, 5.5]"]


def test_median_box(spark):
    rows = [(86.49724, 68.12535, 0.0, 4448.04258), (86.4, 68.0, 0.0, 4448.0),
            (86.6, 68.2, 0.0, 4448.1)]
    box = B.median_box(spark.createDataFrame(rows, BLIP), 0.3).first()
    assert [round(v, 5) for v in box[1:]] == [4447.74258, 4448.34258, 86.19724, 86.79724,
                                              67.82535, 68.42535]


@pytest.mark.parametrize("small_rows", [3, 50, 10_000])
def test_medians_are_exact(spark, small_rows):
    rng = random.Random(3)
    half = [0.0] * 500 + [1.0] * 500
    heavy = [2.5] * 400 + [rng.expovariate(1e-3) for _ in range(600)]
    wild = [rng.choice([-1, 1]) * 10 ** rng.uniform(-30, 30) for _ in range(999)] + [None]
    rows = list(zip(half, heavy, wild, [None] * 1000))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "half double, heavy double, wild double, gone double")

    def median(values):
        values = sorted(v for v in values if v is not None)
        return (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2

    got = exact_medians(df.repartition(5), df.columns, small_rows, accuracy=50)
    assert got == [median(half), median(heavy), median(wild), None]


WAYS = [{"few_boxes": 1000}, {"few_boxes": 1, "some_boxes": 1000},
        {"few_boxes": 1, "some_boxes": 1, "by_curve": False, "hot_rows": 20},
        {"few_boxes": 1, "some_boxes": 1},
        {"few_boxes": 1, "some_boxes": 1, "slice_rows": 10, "slice_runs": 3}]


def sorted_rows(df):
    return sorted((tuple(map(repr, r)) for r in df.collect()))


def test_matches_do_not_depend_on_the_way(spark, sky):
    _, blips = sky
    boxes = B.boxes_frame(spark, random_boxes(20)).union(spark.createDataFrame(
        [(None, -20.0, 20.0, 1.0, 6.0, -5.0, 5.0), ("unknown", None, 9.0, 0.0, 9.0, 0.0, 9.0),
         (None, 2.0, 2.0, 4.0, 4.0, 1.0, 1.0)], B.BOX_SCHEMA))
    for make in (B.match_boxes, B.box_totals,
                 lambda *a, **k: B.signals_by_box(*a, list_rows=7, **k)):
        want = sorted_rows(make(blips, boxes, **WAYS[0]))
        assert len(want) > 20
        for way in WAYS[1:]:
            assert sorted_rows(make(blips, boxes, **way)) == want
    nameless = B.match_boxes(blips, boxes).filter("box_id IS NULL AND copies = 600")
    assert nameless.count() == 1


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
def test_lists_do_not_depend_on_hot_keys(spark, sky, hot_rows):
    _, blips = sky
    box = B.Box("all", -20.0, 20.0, 0.0, 9.0, -5.0, 5.0)
    want = sorted_rows(B.box_signals(blips, box, list_rows=40))
    got = B.box_signals(blips, box, hot_rows=hot_rows, list_rows=40)
    assert sorted_rows(got) == want
    crowded = got.filter("frequency = 2.0 AND ascension = 4.0 AND blip_count >= 300")
    assert sorted((r["part"], len(r["times"])) for r in crowded.collect()) == [
        (i + 1, 40) for i in range(7)] + [(8, 20)]
    assert sum("Part = " in r["line"] for r in B.formatted_boxes(got).collect()) == 7


def candidates(spark, widths, monkeypatch):
    """Pairs of a blip and a box that meet in a cell."""
    rng = random.Random(5)
    blips = spark.createDataFrame([(rng.uniform(0, 1000), rng.uniform(0, 1000), 1.0,
                                    rng.uniform(0, 1000)) for _ in range(2000)], BLIP)
    boxes = []
    for i in range(1000):
        low = [rng.uniform(0, 900) for _ in range(3)]
        high = [v + 2.0 ** rng.choice(widths) for v in low]
        boxes.append(B.Box(str(i), low[0], high[0], low[1], high[1], low[2], high[2]))
    grid = B._grid(B.boxes_frame(spark, boxes))
    with monkeypatch.context() as patch:
        patch.setattr(B, "reduce", lambda *a: B.F.lit(True))  # no exact test, no envelope
        rows = B.bucket_blips(blips, 5).withColumn("copies", B.F.lit(1))
        return B._match_by_cell(rows, grid, None).count()


def test_mixed_widths_meet_few_candidates(spark, monkeypatch):
    same = candidates(spark, [2.9], monkeypatch)
    mixed = candidates(spark, [i / 2 for i in range(-20, 13)], monkeypatch)
    assert mixed <= 16 * max(same, 5)


def test_crowded_cells_are_dealt_on_both_sides(spark):
    left = spark.range(300).selectExpr("id % 3 AS k", "id AS a")
    right = spark.range(200).selectExpr("id % 3 AS k", "id AS b")
    want = sorted_rows(left.join(right, "k").select("k", "a", "b"))
    for hot_rows, hot_right in ((1000, 1000), (7, 1000), (1000, 9), (7, 9)):
        got = salted_join(left, right, ["k"], hot_rows, hot_right).select("k", "a", "b")
        assert sorted_rows(got) == want


def test_median_box_of_nothing_holds_nothing(spark, sky):
    _, blips = sky
    box = B.median_box(blips.filter("time < 0"), 0.3)
    assert box.first()[1:] == (None,) * 6
    assert B.box_totals(blips, box).first()["total_blips"] == 0


@pytest.mark.parametrize("cells", [2, 1024])
@pytest.mark.parametrize("few_ranges", [0, 1000])
def test_medians_of_many_keys_are_exact(spark, cells, few_ranges):
    rng = random.Random(cells)
    rows = [("hot", rng.choice([rng.uniform(-1e9, 1e9), 3.5, 1e-300, -2.0]), 1.0)
            for _ in range(700)]  # over half the rows
    rows += [(rng.choice("abcde"), float(rng.randint(0, 4)), rng.gauss(0, 1)) for _ in range(400)]
    rows += [(None, 5.0, None), (None, 6.0, None), ("one", 7.0, 8.0), ("none", None, None),
             ("far", -1.7e308, 0.0), ("far", 1.7e308, 5e-324)]
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(5)
    got = {r.k: (r.v, r.w) for r in exact_medians_by(df, ["k"], ["v", "w"], cells, few_ranges)
           .collect()}
    def middle(values):
        values = sorted(v for v in values if v is not None)
        return statistics.median(values) if values else None
    for key in {r[0] for r in rows} - {"far"}:
        assert got[key] == tuple(middle(r[i] for r in rows if r[0] == key) for i in (1, 2))
    assert got["far"] == (0.0, statistics.median([0.0, 5e-324]))
    empty = exact_medians_by(df.limit(0), ["k"], ["v"])
    assert empty.collect() == [] and empty.columns == ["k", "v"]


def test_boxes_around_signals(spark, sky):
    rows, blips = sky
    found = {r.box_id: r for r in B.median_boxes(blips, 0.25).collect()}
    groups = {}
    for a, d, _, f in rows:
        groups.setdefault((float(round(f)), float(round(a)), float(round(d))), []).append((f, a, d))
    assert len(found) == len(groups)
    for key, members in groups.items():
        box = found["({}, {}, {})".format(*[v + 0.0 for v in key])]
        for i, (low, high) in enumerate(((1, 2), (3, 4), (5, 6))):
            middle = statistics.median(m[i] for m in members)
            assert (box[low], box[high]) == (middle - 0.25, middle + 0.25)


@pytest.mark.parametrize("matching", [{}, {"by_curve": False}, {"by_curve": False, "hot_rows": 100},
                                      {"slice_rows": 200, "slice_runs": 100}])
def test_totals_of_many_boxes_make_no_pairs(spark, matching):
    """400 blips in each of 900 boxes: a row a box and place, not one a match."""
    blips = spark.createDataFrame([(1.0 + i / 1000, 2.0, float(i), 3.0) for i in range(400)], BLIP)
    boxes = B.boxes_frame(spark, [B.Box(str(i), 2.0 + i / 1000, 4.0, 1.0, 2.0 - i / 9e5, 2.0, 2.0)
                                  for i in range(900)])
    rows = B._matched(blips, boxes, few_boxes=1, some_boxes=1, totals=True, **matching)
    assert 900 <= rows.count() <= 900 * 10
    totals = B.box_totals(blips, boxes, few_boxes=1, some_boxes=1, **matching).collect()
    assert len(totals) == 900 and all(r["total_blips"] == 400 for r in totals)
