"""Lines of least absolute error, row numbers from the scan, and stencils on tiles."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldkit.operators import grids as G
from fieldkit.operators import ordering as O
from fieldkit.operators import robust as L
from fieldkit.session import new_path
from tests.test_plans import plan


def test_the_line_most_rows_lie_on_is_found_beside_wild_ones(spark):
    """Two rows of three lie on the line exactly, the others on both sides: the least error is there."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(900):
        a, b, c = (float(v) for v in rng.normal(size=3) * [1, 50, 0.01])
        wild = float(rng.gamma(1) * 1000) * (1 if k % 2 else -1) if k % 3 == 0 else 0.0
        rows.append((a, b, c, 3 + 2 * a - 0.5 * b + 70 * c + wild, -1 + b - a + wild / 7))
    df = spark.createDataFrame(rows, "a double, b double, c double, u double, v double")
    lines = L.fit_l1(df.repartition(5), ["u", "v"], ["a", "b", "c"])
    assert np.allclose([lines["u"].intercept, *lines["u"].coefficients], [3, 2, -0.5, 70], rtol=1e-3)
    assert np.allclose([lines["v"].intercept, *lines["v"].coefficients], [-1, -1, 1, 0], atol=1e-1)
    scored = L.predict_l1(lines, df, ["a", "b", "c"]).agg(
        F.avg(F.abs(F.col("u") - F.col("predicted_u")))).first()[0]
    assert math.isclose(scored, lines["u"].mae, rel_tol=1e-9)


def test_medians_of_groups_with_ties_and_one_hot_group(spark):
    rng = random.Random(2)
    rows = [(float(k % 3 == 0), float(rng.randint(0, 9))) for k in range(700)]
    rows += [(1.0, 4.0)] * 900
    df = spark.createDataFrame(rows, "x double, y double")
    line = L.fit_l1(df, ["y"], ["x"])["y"]
    least = sum(min(sum(abs(y - m) for x, y in rows if x == g) for m in range(10)) for g in (0, 1))
    assert math.isclose(line.mae, least / len(rows), rel_tol=1e-5)
    assert line.rows == len(rows)


def test_rows_that_teach_nothing(spark):
    rows = [(float(k), 2.0, 5.0 + k, None) for k in range(20)] + [
        (None, 2.0, 1e9, None), (float("nan"), 2.0, 1e9, None), (1.0, 2.0, None, None),
        (1.0, 2.0, float("inf"), None)]
    df = spark.createDataFrame(rows, "x double, same double, y double, z double")
    lines = L.fit_l1(df, ["y", "z"], ["x", "same"])
    assert lines["y"].rows == 20 and lines["y"].mae < 1e-6
    assert abs(lines["y"].coefficients[0] - 1) < 1e-6
    assert lines["z"].rows == 0 and math.isnan(lines["z"].mae)
    empty = L.fit_l1(df.limit(0), ["y"], ["x"])["y"]
    assert empty.rows == 0 and math.isnan(empty.intercept)


@pytest.fixture(scope="module")
def stored(spark):
    path = new_path(spark, "by-file")
    ids = spark.range(0, 3000, 1, 6).withColumn("note", F.lit("n"))
    ids.filter("id < 1000 OR id >= 1500").write.parquet(path)  # one file is empty or short
    return spark.read.parquet(path)


def test_parquet_rows_are_numbered_by_the_scan(spark, stored):
    for few in (100, 0):
        indexed = O.parquet_row_index(stored, few_pieces=few)
        got = sorted((r["row_idx"], r["id"]) for r in indexed.rows.collect())
        ids = [i for i in range(3000) if i < 1000 or i >= 1500]
        assert indexed.size == len(ids) and got == list(enumerate(ids))


def test_numbering_moves_no_row(stored):
    text = plan(O.parquet_row_index(stored).rows.select("id", "row_idx"))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    assert "note" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_no_files_no_rows(spark):
    path = new_path(spark, "none")
    spark.range(0).write.parquet(path)
    indexed = O.parquet_row_index(spark.read.parquet(path))
    assert indexed.size == 0 and indexed.rows.count() == 0


@pytest.mark.parametrize("side", [1, 3, 4, 64])
def test_means_on_tiles_are_those_of_cells(spark, side):
    rng = random.Random(3)
    cells = [(i, j, rng.random()) for i in range(-7, 11) for j in range(-5, 9)
             if rng.random() < 0.9]
    grid = spark.createDataFrame([*cells, (None, 1, 5.0), (2, None, 5.0), (40, 40, None)],
                                 "i bigint, j bigint, v double")
    want = {(r["i"], r["j"]): r["v"] for r in G.grid_neighbor_mean(
        grid.filter("i IS NOT NULL AND j IS NOT NULL AND v IS NOT NULL")).collect()}
    got = {(r["i"], r["j"]): r["v"] for r in G.tile_neighbor_mean(G.to_tiles(grid, side), side).collect()}
    assert got.keys() == want.keys() and len(want) > 40
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    assert G.tile_neighbor_mean(G.to_tiles(grid.limit(0), side), side).collect() == []


def test_only_edges_travel_between_tiles(spark):
    grid = spark.range(64 * 64).select((F.col("id") / 64).cast("bigint").alias("i"),
                                       (F.col("id") % 64).alias("j"), F.lit(1.0).alias("v"))
    tiles = G.to_tiles(grid, 16)
    assert G.tile_edges(tiles, 16).count() == 4 * tiles.count() == 64
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(G.tile_neighbor_mean(tiles, 16))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Cells to their tiles, once for the tiles and once where edges are read off; then the edges.
    assert text.count("Exchange hashpartitioning") == 3
