"""Readers, writers, sites, row position, grids, scores and experiments."""

import math

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from fieldkit.functions.scalars import great_circle_km, sine_profile
from fieldkit.functions.text import float_text, number
from fieldkit.operators import experiments as E
from fieldkit.operators import grids as G
from fieldkit.operators import ordering as O
from fieldkit.operators import sites
from fieldkit.operators import supervised as U
from fieldkit.session import new_path, shared_dir
from fieldkit.sources import readers as R
from fieldkit.sources import writers as W


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# readers and writers

def test_points_parse_or_are_rejected(spark):
    good = ["1, 2, 3", "1,\t2.5  -3e2 ", " 4 5 ,6"]
    bad = ["", "1 2", "1 2 3 4", "1,2 3", "1 x 3", None]
    rows, rejects = R.parse_points(lines(spark, good + bad), 3)
    assert [r["features"] for r in rows.collect()] == [[1, 2, 3], [1, 2.5, -300], [4, 5, 6]]
    assert [r["value"] for r in rejects.collect()] == bad


def test_blips_with_double_and_trailing_spaces(spark):
    rows, rejects = R.parse_blips(lines(spark, ["2.5  3.5 4 5.25 ", "1 2 3", "1 2 3, 4", "a b c d"]))
    assert [tuple(r) for r in rows.collect()] == [(2.5, 3.5, 4.0, 5.25)]
    assert rows.columns == R.BLIP_COLUMNS
    assert rejects.count() == 3


def test_point_file_and_blip_file(spark):
    path = new_path(spark, "t")
    W.write_lines(lines(spark, ["1 2 3 4", "5 6 7 8"]).withColumnRenamed("value", "line"), path)
    assert R.read_blips(spark, path).rows.count() == 2
    assert R.read_points(spark, path, 4).rows.count() == 2
    assert R.read_points(spark, path, 6).rejects.count() == 2


def test_csv_needs_its_declared_columns(spark):
    path = new_path(spark, "csv")
    W.write_results(spark.createDataFrame([(1.5, "a")], "x double, y string"), path)
    assert R.read_table_csv(spark, path, "x double, y string").first() == (1.5, "a")
    with pytest.raises(Exception):
        R.read_table_csv(spark, path, "z double, y string").collect()


def test_file_rows_are_numbered_in_file_order(spark):
    path = new_path(spark, "order")
    ordered = spark.range(5000).repartitionByRange(5, "id").sortWithinPartitions("id")
    W.write_results(ordered, path)
    for split_bytes in ("2k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        indexed = O.file_row_index(R.read_table_csv(spark, path, "id bigint"))
        assert indexed.size == 5000 == indexed.rows.count()
        assert indexed.rows.filter("id <> row_idx").count() == 0
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_projection_has_a_folder_per_cluster(spark):
    path = new_path(spark, "proj")
    W.write_projection(spark.createDataFrame([(0, 1.0), (1, 2.0)], "cluster int, x double"), path)
    assert spark.read.parquet(path + "/cluster=1").first()["x"] == 2.0


def test_images_and_profile(spark):
    path = new_path(spark, "img")
    spark.createDataFrame([(1, 3, [0.0, 255.0], "x")], "id int, label int, pixels array<double>, "
                          "note string").write.parquet(path)
    assert R.read_images(spark, path).columns == ["id", "label", "pixels"]
    out = new_path(spark, "profile")
    W.write_profile(R.read_images(spark, path), out)
    assert spark.read.json(out).first()["pixels"] == [0.0, 255.0]


def test_float_text(spark):
    values = [52.0, 0.0, -3.25, 1e7, 123456789.125, 0.001, 0.00025, -12345678.5, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(float_text(F.col("v"))).collect()] == [
        "52.0", "0.0", "-3.25", "10000000.0", "123456789.125", "0.001", "0.00025", "-12345678.5",
        "1000000000000000.0"]


# sites

def relations(spark):
    orders = spark.createDataFrame(
        [(1, 10), (2, 10), (None, 10), (3, 11), (4, 12), (5, 13), (6, 99), (7, 14), (8, 15)],
        "OrderId bigint, CustomerId bigint")
    customers = spark.createDataFrame(
        [(10, "02139"), (11, "02140"), (12, "02140"), (13, "90001"), (14, "00000"), (15, None),
         (16, "02139")], "CustomerId bigint, PostalCode string")
    zips = spark.createDataFrame(
        [("02139", 42.3736, -71.1097), ("02140", 42.39, -71.13), ("02140", 42.40, -71.13),
         ("90001", 33.97, -118.25), ("2139", 42.0, -71.0)], "Zip string, Lat double, Lng double")
    return orders, customers, zips


def test_sites(spark):
    found = sites.orders_near(*relations(spark)).collect()
    assert sorted((r["zip_code"], r["latitude"], r["order_count"]) for r in found) == [
        ("02139", 42.3736, 2), ("02140", 42.39, 2), ("02140", 42.40, 2)]
    top = sites.drone_sites(*relations(spark), top=2).collect()
    assert [(r["zip_code"], r["latitude"]) for r in top] == [("02139", 42.3736), ("02140", 42.39)]
    assert top[0]["distance_km"] == 0.0


def test_sites_equal_the_plain_join(spark):
    orders, customers, zips = relations(spark)
    zips = zips.union(zips.filter("Zip = '02139'"))
    plain = (orders.join(customers, "CustomerId")
             .join(zips, F.col("PostalCode") == F.col("Zip"))
             .filter(great_circle_km(F.col("Lat"), F.col("Lng")) <= 100)
             .groupBy("PostalCode", "Lat", "Lng").agg(F.count("OrderId").alias("n")))
    for few_customers in (0, 100):
        got = sites.orders_near(orders, customers, zips, few_customers=few_customers)
        assert sorted(tuple(r) for r in got.select("zip_code", "latitude", "longitude",
                                                   "order_count").collect()) == sorted(
            tuple(r) for r in plain.collect())


def test_distance_formulas_agree_and_reach_zero(spark):
    df = spark.range(400).select((F.col("id") * 0.4 - 80).alias("a"), (F.col("id") - 200.0).alias("b"))
    gap = great_circle_km(F.col("a"), F.col("b")) - great_circle_km(
        F.col("a"), F.col("b"), method="haversine")
    assert df.filter(F.abs(gap) > 1e-3).count() == 0
    self_distances = [df.select(great_circle_km(F.lit(v), F.lit(v), v, v)).first()[0]
                      for v in (0.1, 42.3736, 33.3, 77.7)]
    assert max(self_distances) < 1e-3
    assert df.select(great_circle_km(F.lit(None), F.col("b"))).first()[0] is None


# row position

@pytest.mark.parametrize("size,blocks", [(0, 3), (1, 3), (3, 3), (10, 3), (11, 4), (100, 7)])
def test_blocks_are_balanced_and_haloed(spark, size, blocks):
    indexed = O.with_row_index(spark.range(size).withColumnRenamed("id", "k"), ["k"])
    got = {r["k"]: r["block"] for r in O.balanced_blocks(indexed, blocks).collect()}
    short, extra = divmod(size, blocks)
    sizes = [short + 1] * extra + [short] * (blocks - extra)
    want = [b + 1 for b, n in enumerate(sizes) for _ in range(n)]
    assert [got[k] for k in range(size)] == want
    ghosts = {(r["k"], r["block"]) for r in O.block_halo(indexed, blocks).filter("is_ghost")
              .collect()}
    edges = {k for k in range(size - 1) if want[k] != want[k + 1]}
    assert ghosts == {(k, want[k + 1]) for k in edges} | {(k + 1, want[k]) for k in edges}


def test_tail_and_pairs(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(0.5,), (0.25,), (0.75,)], "y double")
    pairs = O.paired_rows(O.with_row_index(left, ["k"]), O.with_row_index(right, ["y"]))
    assert sorted((r["v"], r["y"]) for r in pairs.rows.collect()) == [
        ("a", 0.25), ("b", 0.5), ("c", 0.75)]
    parts = O.tail_split(pairs, 1 / 3).collect()
    assert {r["v"]: r["part"] for r in parts} == {"a": "train", "b": "train", "c": "val"}
    with pytest.raises(ValueError):
        O.paired_rows(pairs, O.with_row_index(right.limit(2), ["y"]))


def test_tail_split_size_is_not_off_by_float_error(spark):
    for size in (100, 1000, 3000):
        parts = O.tail_split(O.Indexed(spark.range(size).withColumnRenamed("id", "row_idx"), size))
        assert parts.filter("part = 'val'").count() == size // 100


# grids

def test_neighbour_mean_skips_edges_and_holes(spark):
    cells = {(i, j): float(i * i + 3 * j) for i in range(5) for j in range(5)}
    del cells[(2, 2)]
    grid = spark.createDataFrame([(*k, v) for k, v in cells.items()], "i long, j long, v double")
    want = {}
    for (i, j) in cells:
        around = [(i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)]
        if all(c in cells for c in around):
            want[(i, j)] = sum(cells[c] for c in around) / 4
    got = G.grid_neighbor_mean(grid)
    assert {(r["i"], r["j"]): r["v"] for r in got.collect()} == want
    assert G.max_abs_change(grid, got).first()[0] == max(abs(cells[k] - v) for k, v in want.items())


def test_edge_profile(spark):
    got = [r["v"] for r in G.edge_profile(spark.range(0, 12), "id", 10).collect()]
    assert got == pytest.approx([100 * math.sin(3.14159 / 2 / 10 * i) for i in range(12)])
    assert spark.range(1).select(sine_profile(F.lit(10), 10)).first()[0] == pytest.approx(100)


# scores

def test_errors_and_log_loss(spark):
    df = spark.createDataFrame([(1.0, 1.5, "a"), (2.0, 1.0, "b")], "y double, p double, g string")
    assert tuple(U.regression_mae(df, "y", "p").first()) == (0.75, 0.25)
    assert {r["g"]: r["mae"] for r in U.regression_mae(df, "y", "p", ["g"]).collect()} == {
        "a": 0.5, "b": 1.0}
    df = spark.createDataFrame([(0, 0, [0.5, 0.5]), (1, 0, [1.0, 0.0])],
                               "y int, p int, q array<double>")
    assert tuple(U.class_accuracy(df, "y", "p").first()) == (2, 0.5)
    assert U.class_log_loss(df, "y", "q").first()[0] == pytest.approx(
        (-math.log(0.5) - math.log(1e-15)) / 2)


def test_several_targets(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"),
                                 (F.col("id") * 2.0 + 1).alias("a"),
                                 (5 - F.col("id") * 0.5).alias("b"),
                                 F.when(F.col("id") < 190, "train").otherwise("val").alias("part"))
    df = U.with_features(df, ["x"])
    models = U.fit_targets(df.filter("part = 'train'"), ["a", "b"])
    errors = U.target_errors(U.predict_targets(models, df), ["a", "b"]).collect()
    assert len(errors) == 4 and max(r["mae"] for r in errors) < 1e-6
    found = {(r["target"], r["term"]): round(r["value"], 6)
             for r in U.coefficients(models, df, ["x"]).collect()}
    assert found == {("a", "intercept"): 1.0, ("a", "x"): 2.0, ("b", "intercept"): 5.0,
                     ("b", "x"): -0.5}


def test_boosting_history_falls(spark):
    df = U.with_features(spark.range(300).select(
        F.col("id").cast("double").alias("x"), F.sin(F.col("id") / 30).alias("y")), ["x"])
    model = U.boosted_l1("y", "features", "p", rounds=5).fit(df)
    history = U.boosting_history(model, {"train": df, "val": df})
    train = [r["value"] for r in history.filter("metric = 'train_mae'").orderBy("epoch").collect()]
    assert len(train) == 5 and train[-1] < train[0]
    last = {r["metric"]: r for r in U.final_values(history).collect()}
    assert last["val_mae"]["value"] == pytest.approx(train[-1])
    assert last["val_mae"]["accuracy"] == pytest.approx(1 - train[-1])


# experiments

def test_grid_is_every_combination(spark):
    grid = E.param_grid(**E.SEARCHED)
    assert len(grid) == 24 and len({tuple(g.values()) for g in grid}) == 24
    assert [g["Epochs"] for g in grid[:4]] == [10, 13, 15, 10]
    frame = E.grid_frame(spark, grid)
    assert frame.columns == E.PARAMETERS and frame.count() == 24


def test_search_logs_one_row_per_run_and_objective(spark):
    df = U.with_features(spark.range(120).select(
        F.col("id").cast("double").alias("x"), F.when(F.col("id") < 60, 0.0).otherwise(1.0)
        .alias("label")), ["x"])
    grid = E.param_grid(**{**E.SEARCHED, "Epochs": [1, 30]})

    def make(row):
        return LogisticRegression(maxIter=5, threshold=0.5 if row["Epochs"] == 30 else 1.0)

    found = E.grid_search(df, df, df, grid[:6], make)
    assert found.count() == 6
    best = E.best_runs(found, score="Validation Accuracy").first()
    assert best["Epochs"] == 30 and best[E.SCORE] > 0.95
    model = LogisticRegression(maxIter=5).fit(df)
    history = U.objective_history(model, df).orderBy("epoch").collect()
    assert len(history) > 1 and history[-1]["value"] < history[0]["value"]


def test_leaderboard_and_delta(spark):
    grid = E.param_grid(**E.SEARCHED)
    names = ", ".join(f"`{c}` {t}" for c, t in zip(
        [*E.PARAMETERS, E.SCORE], ["double"] * 3 + ["int"] * 2 + ["double"]))
    runs = [[(*g.values(), 0.9 + (i * step % 24) / 1000) for i, g in enumerate(grid)]
            for step in (1, 5)]
    one, two = (spark.createDataFrame(r, names) for r in runs)
    board = {(r["parameter"], r["value"]): r for r in E.leaderboard(one).collect()}
    assert len(board) == 10
    assert board[("Batch Size", 16.0)]["runs"] == 24
    low = [r[-1] for r in runs[0] if r[0] == 0.25]
    row = board[("Dropout1", 0.25)]
    assert (row["best"], row["worst"]) == (max(low), min(low))
    assert row["mean"] == pytest.approx(sum(low) / len(low))
    delta = {tuple(r)[:5]: r["change"] for r in E.experiment_delta(one, two).collect()}
    assert delta == {a[:5]: b[-1] - a[-1] for a, b in zip(*runs)}


def test_delta_keeps_rows_of_one_run(spark):
    names = ", ".join(f"`{c}` {t}" for c, t in zip(
        [*E.PARAMETERS, E.SCORE], ["double"] * 3 + ["int"] * 2 + ["double"]))
    one, two = (spark.createDataFrame([(0.1, 0.2, 0.3, 16, n, 0.9)], names) for n in (1, 2))
    got = sorted(tuple(r)[4:] for r in E.experiment_delta(one, two).collect())
    assert got == [(1, 0.9, None, None), (2, None, 0.9, None)]


def test_accuracy_of_each_round(spark):
    df = U.with_features(spark.range(200).select(
        (F.col("id") % 2).cast("double").alias("x"),
        (F.col("id") % 10 < F.col("id") % 2 * 9).cast("double").alias("y")), ["x"])
    model = U.boosted_classes("y", "features", "p", rounds=4, depth=1).fit(df)
    history = U.accuracy_history(model, {"train": df}, "y").orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [1, 2, 3, 4]
    right = model.transform(df).filter("p = y").count() / 200
    assert history[-1]["value"] == pytest.approx(right) and right >= 0.8


@pytest.mark.parametrize("text,value", [
    ("1", 1.0), ("-2.5", -2.5), ("+.5e1", 5.0), ("3.", 3.0), ("1E-3", 0.001), ("5d", None),
    ("3f", None), ("0x1p3", None), ("NaN", None), ("Infinity", None), ("inf", None), ("1e400", None),
    (".", None), ("", None), ("1,5", None)])
def test_plain_numbers_only(spark, text, value):
    got = lines(spark, [text]).select(number(F.col("value"))).first()[0]
    assert got == value


def test_running_total(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS n").repartition(5)
    got, total = O.running_total(rows, ["id"], "n", "before")
    assert total == sum(i % 7 for i in range(1000))
    want = {i: sum(j % 7 for j in range(i)) for i in (0, 1, 500, 999)}
    found = {r["id"]: r["before"] for r in got.filter(F.col("id").isin(list(want))).collect()}
    assert found == want


def test_shared_folder_of_the_context(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark))


def test_thinned_networks_learn_separable_classes(spark):
    df = U.with_features(spark.range(200).select(
        ((F.col("id") % 2) * 4 - 2 + F.sin("id")).alias("x"), F.cos("id").alias("y"),
        (F.col("id") % 2).cast("double").alias("label")), ["x", "y"])
    grid = E.param_grid(**{**E.SEARCHED, "Dropout1": [0.25], "Dropout2": [0.5, 0.9],
                           "Learning Rate": [1.0], "Epochs": [200]})
    make = E.thinned_perceptron(2, 2, hidden=(8, 4))
    assert [make(row).getLayers() for row in grid] == [[2, 6, 2, 2], [2, 6, 1, 2]]
    found = E.grid_search(df, df, df, grid, make).collect()
    assert len(found) == 2 and max(r[E.SCORE] for r in found) > 0.9


def test_grid_search_counts_equal_rows_once(spark):
    """Trees are fitted on one row per different row, and score as on all of them."""
    rows = [(float(i % 2), float((i % 2) != (i % 7 > 4))) for i in range(700)]
    df = U.with_features(spark.createDataFrame(rows, "x double, label double"), ["x"])
    seen = []

    class Tree(DecisionTreeClassifier):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    for least, size in ((1, 4), (2, 700)):
        def make(row, least=least):
            return Tree(maxDepth=int(row["Dropout1"] < 0.3), minInstancesPerNode=least)
        found = E.grid_search(df, df, df, E.param_grid(**E.SEARCHED)[::12], make).collect()
        assert seen == [size] * 2
        seen.clear()
        assert [r[E.SCORE] for r in found] == [pytest.approx(500 / 700), pytest.approx(0.5)]
