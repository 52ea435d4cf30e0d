"""Row position, grids, supervised runs and experiment results."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.operators import clusters as C
from fieldkit.operators import experiments as E
from fieldkit.operators import grids as G
from fieldkit.operators import networks as N
from fieldkit.operators import ordering as O
from fieldkit.operators import robust as L
from fieldkit.operators import supervised as U
from fieldkit.plans.stand_ins import (BLOB_COLUMNS, Query, blobs, experiments, experiments_sql,
                                      grid, grid_sql, table)
from fieldkit.session import new_path, settle
from fieldkit.sources.readers import read_table_csv
from fieldkit.sources.writers import save_model, write_results

BLOCKS = 4
ROUNDS = 20
TARGETS = ["price", "days"]


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def _csv(df: DataFrame, schema: str, name: str) -> O.Indexed:
    """Write as headed CSV, read back, and number the rows as they lie in the files."""
    path = new_path(df.sparkSession, name)
    write_results(df, path)
    return O.file_row_index(read_table_csv(df.sparkSession, path, schema))


def _paired(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV files paired line by line: orders by key, and prices by date."""
    orders = _orders(spark, folder)
    left = _csv(orders.select("o_orderkey").orderBy("o_orderkey"), "o_orderkey bigint", "x")
    right = _csv(orders.orderBy("o_orderdate", "o_orderkey").select("o_totalprice"),
                 "o_totalprice double", "y")
    return O.paired_rows(left, right).rows.select("row_idx", "o_orderkey", "o_totalprice")


def _paired_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two Parquet tables paired row by row as they lie in their files, no row of either moved first."""
    orders = _orders(spark, folder)
    sides = []
    for name, rows in (("x", orders.select("o_orderkey").orderBy("o_orderkey")),
                       ("y", orders.orderBy("o_orderdate", "o_orderkey").select("o_totalprice"))):
        path = new_path(spark, name)
        rows.write.parquet(path)
        sides.append(O.parquet_row_index(spark.read.parquet(path)))
    return O.paired_rows(*sides).rows.select("row_idx", "o_orderkey", "o_totalprice")


def _indexed(spark: SparkSession, folder: str) -> O.Indexed:
    return O.with_row_index(_orders(spark, folder).select("o_orderkey"), ["o_orderkey"])


def _regression(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with one input and two targets; the last 1 % by key are held out."""
    rows = _orders(spark, folder).select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("customer"),
        F.col("o_totalprice").alias("price"),
        F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("double").alias("days"))
    parts = O.tail_split(O.with_row_index(rows, ["o_orderkey"]))
    return U.with_features(parts, ["customer"])


def _errors(spark: SparkSession, folder: str) -> DataFrame:
    data = _regression(spark, folder)
    models = U.fit_targets(data.filter(F.col("part") == "train"), TARGETS)
    errors = U.target_errors(U.predict_targets(models, data), TARGETS)
    return errors.withColumns({c: F.round(c, 4) for c in ("mae", "accuracy")})


def _l1_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Least absolute error of two targets over three inputs that tell four groups apart.

    The least error is then that of each group's median, which SQL can state.
    """
    late = (F.month("o_orderdate") > 6).cast("double")
    urgent = (F.col("o_orderpriority") < "3").cast("double")
    data = _orders(spark, folder).select(
        late.alias("late"), urgent.alias("urgent"), (late * urgent).alias("both"),
        (F.col("o_totalprice") / 500000).alias("price"),
        (F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) / 1000).alias("days"))
    inputs = ["late", "urgent", "both"]
    scored = L.predict_l1(L.fit_l1(data, TARGETS, inputs), data, inputs).withColumn(
        "part", F.lit("train"))
    return _rounded(U.target_errors(scored, TARGETS), 4, "mae", "accuracy")


def _item_features(spark: SparkSession, folder: str) -> DataFrame:
    return U.with_features(
        table(spark, folder, "lineitem").select(
            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
            (F.col("l_discount") * 10000).alias("discount")), ["quantity"])


def _coefficients(spark: SparkSession, folder: str) -> DataFrame:
    data = _item_features(spark, folder)
    models = U.fit_targets(data, ["price", "discount"])
    return (U.coefficients(models, data, ["quantity"])
            .withColumn("value", F.round("value", 4)))


def _roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a model that was saved and loaded."""
    data = _regression(spark, folder)
    path = new_path(spark, "model")
    save_model(U.linear("price", "features", "predicted").fit(data), path)
    scored = LinearRegressionModel.load(path).transform(data)
    return scored.select("o_orderkey", F.round("predicted", 2).alias("predicted"))


def _half_years(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders with one two-valued input, so a tree of depth 1 is a mean per half of the year."""
    rows = _orders(spark, folder).select(
        "o_orderkey", (F.month("o_orderdate") > 6).cast("double").alias("late"),
        (F.col("o_totalprice") / 500000).alias("price"),
        (F.col("o_totalprice") + F.month("o_orderdate") * 15000 > 250000).cast("double")
        .alias("dear"))
    data = settle(U.with_features(O.tail_split(O.with_row_index(rows, ["o_orderkey"])), ["late"]),
                  "half-years")
    return {p: data.filter(F.col("part") == p) for p in ("train", "val")}


def _boosted(spark: SparkSession, folder: str) -> tuple[GBTRegressionModel, dict[str, DataFrame]]:
    parts = _half_years(spark, folder)
    maker = U.boosted_l1("price", "features", "predicted_price", ROUNDS, depth=1)
    return maker.fit(parts["train"]), parts


def _boosted_errors(spark: SparkSession, folder: str) -> DataFrame:
    model, parts = _boosted(spark, folder)
    both = parts["train"].unionByName(parts["val"])
    errors = U.target_errors(U.predict_targets({"price": model}, both), ["price"])
    return errors.withColumns({c: F.round(c, 8) for c in ("mae", "accuracy")})


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return U.boosting_history(*_boosted(spark, folder)).withColumn("value", F.round("value", 8))


def _accuracies(spark: SparkSession, folder: str) -> DataFrame:
    """Training and validation accuracy of a classifier after each of its rounds."""
    parts = _half_years(spark, folder)
    model = U.boosted_classes("dear", "features", "predicted", ROUNDS, depth=1).fit(parts["train"])
    return U.accuracy_history(model, parts, "dear").withColumn("value", F.round("value", 8))


def _rounds_sql(first: str, step: str) -> str:
    """``WITH`` members that unroll boosting on one two-valued input, a mean per group and round.

    ``first`` is the mean the first tree fits and ``step`` that of a later one, given the sum ``p`` so
    far; later trees count a tenth.
    """
    members = [f"""parts AS (SELECT CAST(month(o_orderdate) > 6 AS INTEGER) AS late,
      o_totalprice/500000 AS price,
      CAST(o_totalprice + month(o_orderdate)*15000 > 250000 AS DOUBLE) AS dear,
      CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1
      >= floor((SELECT COUNT(*) FROM orders) * 0.99::DOUBLE) THEN 'val' ELSE 'train' END AS part
      FROM orders)""", "t AS (SELECT * FROM parts WHERE part = 'train')",
               f"r1 AS (SELECT late, {first} AS p FROM t GROUP BY late)"]
    for i in range(2, ROUNDS + 1):
        members.append(f"""r{i} AS (SELECT late, p + 0.1::DOUBLE*avg({step}) AS p
          FROM t JOIN r{i - 1} USING (late) GROUP BY late, p)""")
    every = " UNION ALL ".join(f"SELECT {i} AS epoch, * FROM r{i}" for i in range(1, ROUNDS + 1))
    return ", ".join([*members, f"rounds AS ({every})"])


_L1_SQL = _rounds_sql("avg(price)", "CASE WHEN price < p THEN -1.0::DOUBLE ELSE 1 END")
_LOG_SQL = _rounds_sql("avg(2*dear - 1)",
                       "4*(2*dear - 1) / (1 + exp(2*(2*dear - 1)*p))")


def _mae(spark: SparkSession, folder: str) -> DataFrame:
    """Error of predicting an order's price by the mean price of its priority.

    The means are one row per priority, of which there are five.
    """
    orders = _orders(spark, folder)
    means = orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("predicted"))
    scored = U.regression_mae(orders.join(F.broadcast(means), "o_orderpriority"), "o_totalprice", "predicted")
    return scored.select(*[F.round(c, 4).alias(c) for c in scored.columns])


def _class_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality predicted as "not toxic", with 0.8 put on the prediction."""
    return table(spark, folder, "labels").select(
        "quality", (1 - F.col("toxic")).alias("predicted"),
        F.when(F.col("toxic") == 1, F.array(F.lit(0.8), F.lit(0.2)))
        .otherwise(F.array(F.lit(0.2), F.lit(0.8))).alias("probability"))


def _rounded(df: DataFrame, decimals: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, decimals) for n in names})


def _stump(row: dict) -> DecisionTreeClassifier:
    """A tree that may split once where the first rate is low, and else says the commoner class."""
    return DecisionTreeClassifier(maxDepth=int(row["Dropout1"] < 0.3), minInfoGain=0.0)


def _grid_search(spark: SparkSession, folder: str) -> DataFrame:
    """All 24 runs on line items, told apart by their return flag; saved as CSV and read back."""
    share = F.pmod("l_orderkey", F.lit(10))
    data = U.with_features(table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("returned"),
        ((F.col("l_returnflag") == "R") != (F.col("l_linenumber") > 5)).cast("double")
        .alias("label"),
        F.when(share < 7, "train").when(share < 8, "val").otherwise("test").alias("part")),
        ["returned"])
    sets = [data.filter(F.col("part") == p) for p in ("train", "val", "test")]
    found = E.grid_search(*sets, E.param_grid(**E.SEARCHED), _stump)
    path = new_path(spark, "results")
    write_results(_rounded(found, 8, "Validation Accuracy", E.SCORE), path)
    return read_table_csv(spark, path, found.schema)


def _grid_search_sql() -> str:
    """The commoner class of the training part, by flag or of all, scored on the other parts."""
    lists = ", ".join(
        f'(SELECT unnest({values}) AS "{name}")' if name in ("Batch Size", "Epochs")
        else f'(SELECT unnest({values}::DOUBLE[]) AS "{name}")' for name, values in E.SEARCHED.items())
    score = """(SELECT round(avg(CASE WHEN label = said THEN 1.0::DOUBLE ELSE 0 END), 8)
      FROM items JOIN {said} USING ({on}) WHERE part = '{part}')"""

    def scores(part: str) -> str:
        return (f"""CASE WHEN "Dropout1" < 0.3 THEN {score.format(said="by_flag", on="returned", part=part)}
          ELSE {score.format(said="of_all", on="one", part=part)} END""")

    return f"""WITH items AS (SELECT 1 AS one, l_returnflag = 'R' AS returned,
      CAST((l_returnflag = 'R') <> (l_linenumber > 5) AS INTEGER) AS label,
      CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 < 8 THEN 'val' ELSE 'test'
      END AS part FROM lineitem),
      by_flag AS (SELECT returned, CAST(avg(label) > 0.5 AS INTEGER) AS said FROM items
      WHERE part = 'train' GROUP BY returned),
      of_all AS (SELECT one, CAST(avg(label) > 0.5 AS INTEGER) AS said FROM items
      WHERE part = 'train' GROUP BY one)
      SELECT *, {scores("val")} AS "Validation Accuracy", {scores("test")} AS "{E.SCORE}"
      FROM {lists}"""


# Every parameter of the search takes several values; batches and epochs go together.
_NETWORK_GRID = [
    {**row, "Batch Size": batch, "Epochs": epochs} for row in E.param_grid(
        Dropout1=[0.25, 0.3], Dropout2=[0.5, 0.6], **{"Learning Rate": [0.1, 0.05]})
    for batch, epochs in ((64, 2), (128, 3), (256, 4))]


def _separable(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Points that lie apart by return flag, in parts by a hash of the point."""
    names = [f"s{i}" for i in range(len(BLOB_COLUMNS))]
    scaled = C.scale_columns(blobs(spark, folder), BLOB_COLUMNS, names)
    share = F.pmod(F.xxhash64(*BLOB_COLUMNS), F.lit(10))
    data = settle(scaled.select(
        F.array(*names).alias("features"), (F.instr(F.lit("ANR"), F.col("label")) - 1).alias("label"),
        F.when(share < 7, "train").when(share < 8, "val").otherwise("test").alias("part")), "separable")
    return [data.filter(F.col("part") == part) for part in ("train", "val", "test")]


def _network_search(spark: SparkSession, folder: str) -> DataFrame:
    """24 networks, each with its own rates, batches and epochs; they tell all points apart."""
    found = N.network_search(*_separable(spark, folder), _NETWORK_GRID, 3)
    return _rounded(found, 2, "Validation Accuracy", E.SCORE)


def _network_sql() -> str:
    rows = ", ".join(f"({row['Dropout1']}::DOUBLE, {row['Dropout2']}::DOUBLE, "
                     f"{row['Learning Rate']}::DOUBLE, {row['Batch Size']}, {row['Epochs']})"
                     for row in _NETWORK_GRID)
    return f"""SELECT *, 1.0::DOUBLE AS "Validation Accuracy", 1.0::DOUBLE AS "{E.SCORE}"
      FROM (VALUES {rows}) AS grid({_KEYS_SQL})"""


def _network_history(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and accuracy of each epoch while the last network of the grid trains."""
    train, _, _ = _separable(spark, folder)
    _, history = N.fit_runs(N.pack_shards(train, "features", "label"), 3,
                            [N.run_of(_NETWORK_GRID[-1])])
    return _rounded(history, 3, "loss", "accuracy").select("epoch", "loss", "accuracy")


def _param_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every combination of the few values that four line item columns take."""
    items = table(spark, folder, "lineitem")
    columns = {"Dropout1": F.col("l_discount"), "Dropout2": F.col("l_tax"),
               "Learning Rate": F.col("l_quantity") / 1000, "Epochs": F.year("l_shipdate")}
    seen = [items.select(c.alias(n)).distinct() for n, c in columns.items()]
    grid = E.cross_grid(*seen).withColumn("Batch Size", F.lit(16))
    return grid.select(*[F.col(f"`{p}`") for p in E.PARAMETERS])


def _halo_sql() -> str:
    return f"""WITH b AS (SELECT o_orderkey, CAST(ntile({BLOCKS}) OVER (ORDER BY o_orderkey)
      AS INTEGER) AS block FROM orders),
      edges AS (SELECT block, min(o_orderkey) AS first, max(o_orderkey) AS last FROM b
      GROUP BY block)
      SELECT o_orderkey, block, false AS is_ghost FROM b UNION ALL
      SELECT first, block - 1, true FROM edges WHERE block > 1 UNION ALL
      SELECT last, block + 1, true FROM edges WHERE block < {BLOCKS}"""


_PARTS_SQL = """parts AS (SELECT CAST(o_custkey AS DOUBLE) AS customer, o_totalprice AS price,
  CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS DOUBLE) AS days,
  CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1
    >= floor((SELECT COUNT(*) FROM orders) * 0.99::DOUBLE) THEN 'val' ELSE 'train' END AS part
  FROM orders)"""


def _errors_sql(target: str) -> str:
    return f"""SELECT '{target}' AS target, part,
      round(avg(abs({target} - (a + b*customer))), 4) AS mae,
      round(1 - avg(abs({target} - (a + b*customer))), 4) AS accuracy
      FROM parts, (SELECT regr_intercept({target}, customer) AS a,
      regr_slope({target}, customer) AS b FROM parts WHERE part = 'train') GROUP BY part"""


def _coefficient_sql(target: str, column: str) -> str:
    return f"""SELECT '{target}' AS target, 'intercept' AS term,
      round(regr_intercept({column}, l_quantity), 4) + 0.0::DOUBLE AS value FROM lineitem UNION ALL
      SELECT '{target}', 'quantity', round(regr_slope({column}, l_quantity), 4) + 0.0::DOUBLE FROM lineitem"""


_L1_GROUPS_SQL = """parts AS (SELECT month(o_orderdate) > 6 AS late, o_orderpriority < '3' AS urgent,
  o_totalprice/500000 AS price,
  CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS DOUBLE)/1000 AS days FROM orders)"""


def _l1_sql(target: str) -> str:
    return f"""SELECT '{target}' AS target, 'train' AS part, round(avg(abs({target} - m)), 4) AS mae,
      round(1 - avg(abs({target} - m)), 4) AS accuracy FROM parts JOIN
      (SELECT late, urgent, median({target}) AS m FROM parts GROUP BY ALL) USING (late, urgent)"""


_BOARD_SQL = " UNION ALL ".join(
    f"""SELECT run, '{p}' AS parameter, CAST("{p}" AS DOUBLE) AS value, COUNT(*) AS runs,
    round(max("{E.SCORE}"), 8) AS best, round(min("{E.SCORE}"), 8) AS worst,
    round(avg("{E.SCORE}"), 8) AS mean FROM runs GROUP BY ALL""" for p in E.PARAMETERS)
_KEYS_SQL = ", ".join(f'"{p}"' for p in E.PARAMETERS)

QUERIES = {
    "paired_rows": Query(
        _paired, """SELECT idx AS row_idx, o_orderkey, o_totalprice FROM
        (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)
        JOIN (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx
        FROM orders) USING (idx)"""),
    "paired_files": Query(
        _paired_files, """SELECT idx AS row_idx, o_orderkey, o_totalprice FROM
        (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)
        JOIN (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx
        FROM orders) USING (idx)"""),
    "tail_split": Query(
        lambda s, d: O.tail_split(_indexed(s, d)),
        """SELECT o_orderkey, idx AS row_idx, CASE WHEN idx >= floor(n*0.99::DOUBLE) THEN 'val'
        ELSE 'train' END AS part FROM (SELECT o_orderkey, COUNT(*) OVER () AS n,
        row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)"""),
    "balanced_blocks": Query(
        lambda s, d: O.balanced_blocks(_indexed(s, d), BLOCKS).drop("row_idx"),
        f"""SELECT o_orderkey, CAST(ntile({BLOCKS}) OVER (ORDER BY o_orderkey) AS INTEGER)
        AS block FROM orders"""),
    "block_halo": Query(
        lambda s, d: O.block_halo(_indexed(s, d), BLOCKS).drop("row_idx"), _halo_sql()),
    "grid_neighbor_mean": Query(
        lambda s, d: _rounded(G.grid_neighbor_mean(grid(s, d)), 4, "v"),
        f"""WITH {grid_sql()} SELECT c.i, c.j, round((u.v + d.v + l.v + r.v)/4, 4) AS v
        FROM grid c JOIN grid u ON u.i = c.i - 1 AND u.j = c.j
        JOIN grid d ON d.i = c.i + 1 AND d.j = c.j JOIN grid l ON l.i = c.i AND l.j = c.j - 1
        JOIN grid r ON r.i = c.i AND r.j = c.j + 1"""),
    "tile_neighbor_mean": Query(
        lambda s, d: _rounded(G.tile_neighbor_mean(G.to_tiles(grid(s, d), 4), 4), 4, "v"),
        f"""WITH {grid_sql()} SELECT c.i, c.j, round((u.v + d.v + l.v + r.v)/4, 4) AS v
        FROM grid c JOIN grid u ON u.i = c.i - 1 AND u.j = c.j
        JOIN grid d ON d.i = c.i + 1 AND d.j = c.j JOIN grid l ON l.i = c.i AND l.j = c.j - 1
        JOIN grid r ON r.i = c.i AND r.j = c.j + 1"""),
    "max_abs_change": Query(
        lambda s, d: _rounded(G.max_abs_change(grid(s, d), G.grid_neighbor_mean(grid(s, d))),
                              4, "max_change"),
        f"""WITH {grid_sql()}, next AS (SELECT c.i, c.j, (u.v + d.v + l.v + r.v)/4 AS v
        FROM grid c JOIN grid u ON u.i = c.i - 1 AND u.j = c.j
        JOIN grid d ON d.i = c.i + 1 AND d.j = c.j JOIN grid l ON l.i = c.i AND l.j = c.j - 1
        JOIN grid r ON r.i = c.i AND r.j = c.j + 1)
        SELECT round(max(abs(next.v - grid.v)), 4) AS max_change
        FROM grid JOIN next USING (i, j)"""),
    "sine_profile": Query(
        lambda s, d: _rounded(G.edge_profile(table(s, d, "customer"), "c_custkey",
                                             table(s, d, "customer").count()), 6, "v"),
        """SELECT c_custkey, round(100*sin(((3.14159::DOUBLE/2)/(SELECT COUNT(*) FROM customer))
        * c_custkey), 6) AS v FROM customer"""),
    "regression_mae": Query(
        _mae, """SELECT round(avg(abs(o_totalprice - p)), 4) AS mae,
        round(1 - avg(abs(o_totalprice - p)), 4) AS accuracy FROM orders JOIN
        (SELECT o_orderpriority, avg(o_totalprice) AS p FROM orders GROUP BY o_orderpriority)
        USING (o_orderpriority)"""),
    "linear_coefficients": Query(
        _coefficients, _coefficient_sql("price", "l_extendedprice") + " UNION ALL "
        + _coefficient_sql("discount", "l_discount*10000")),
    "multi_target_regression": Query(
        _errors, f"WITH {_PARTS_SQL} " + " UNION ALL ".join(_errors_sql(t) for t in TARGETS)),
    "l1_regression": Query(
        _l1_errors, f"WITH {_L1_GROUPS_SQL} " + " UNION ALL ".join(_l1_sql(t) for t in TARGETS)),
    "boosted_regression": Query(
        _boosted_errors, f"""WITH {_L1_SQL} SELECT 'price' AS target, part,
        round(avg(abs(price - p)), 8) AS mae, round(1 - avg(abs(price - p)), 8) AS accuracy
        FROM parts JOIN r{ROUNDS} USING (late) GROUP BY part"""),
    "training_history": Query(
        _history, f"""WITH {_L1_SQL} SELECT 'run' AS run_id, CAST(epoch AS INTEGER) AS epoch,
        part || '_mae' AS metric, round(avg(abs(price - p)), 8) AS value
        FROM parts JOIN rounds USING (late) GROUP BY part, epoch"""),
    "final_values": Query(
        lambda s, d: U.final_values(_history(s, d)).withColumn("accuracy", F.round("accuracy", 8)),
        f"""WITH {_L1_SQL} SELECT 'run' AS run_id, part || '_mae' AS metric,
        round(avg(abs(price - p)), 8) AS value, round(1 - round(avg(abs(price - p)), 8), 8)
        AS accuracy FROM parts JOIN r{ROUNDS} USING (late) GROUP BY part"""),
    "accuracy_history": Query(
        _accuracies, f"""WITH {_LOG_SQL} SELECT 'run' AS run_id, CAST(epoch AS INTEGER) AS epoch,
        part || '_accuracy' AS metric,
        round(avg(CASE WHEN (p > 0) = (dear = 1) THEN 1.0::DOUBLE ELSE 0 END), 8) AS value
        FROM parts JOIN rounds USING (late) GROUP BY part, epoch"""),
    "model_roundtrip": Query(
        _roundtrip, """SELECT o_orderkey, round(a + b*o_custkey, 2) AS predicted FROM orders,
        (SELECT regr_intercept(o_totalprice, o_custkey) AS a,
        regr_slope(o_totalprice, o_custkey) AS b FROM orders)"""),
    "class_accuracy": Query(
        lambda s, d: _rounded(U.class_accuracy(_class_scores(s, d), "quality", "predicted"),
                              6, "accuracy"),
        """SELECT COUNT(*) AS n, round(avg(CASE WHEN quality = 1 - toxic THEN 1.0::DOUBLE
        ELSE 0 END), 6) AS accuracy FROM labels"""),
    "class_log_loss": Query(
        lambda s, d: _rounded(U.class_log_loss(_class_scores(s, d), "quality", "probability"),
                              6, "log_loss"),
        """SELECT round(avg(-ln(CASE WHEN quality = 1 - toxic THEN 0.8::DOUBLE ELSE 0.2 END)), 6)
        AS log_loss FROM labels"""),
    "param_grid": Query(
        _param_grid, """SELECT * FROM (SELECT DISTINCT l_discount AS "Dropout1" FROM lineitem),
        (SELECT DISTINCT l_tax AS "Dropout2" FROM lineitem),
        (SELECT DISTINCT l_quantity/1000 AS "Learning Rate" FROM lineitem),
        (SELECT CAST(16 AS INTEGER) AS "Batch Size"),
        (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS "Epochs" FROM lineitem)"""),
    "grid_search": Query(_grid_search, _grid_search_sql()),
    "network_search": Query(_network_search, _network_sql()),
    "network_history": Query(_network_history),
    "experiment_leaderboard": Query(
        lambda s, d: _rounded(E.leaderboard(experiments(s, d), by=["run"]), 8, "best", "worst",
                              "mean"),
        f"WITH {experiments_sql('runs')} {_BOARD_SQL}"),
    "best_runs": Query(
        lambda s, d: E.best_runs(experiments(s, d), 10, by=["run"]).withColumn(
            E.SCORE, F.round(f"`{E.SCORE}`", 8)),
        f"""WITH {experiments_sql('runs')} SELECT * REPLACE
        (round("{E.SCORE}", 8) AS "{E.SCORE}") FROM
        (SELECT * FROM runs ORDER BY "{E.SCORE}" DESC, {_KEYS_SQL}, run LIMIT 10)"""),
    "experiment_delta": Query(
        lambda s, d: _rounded(E.experiment_delta(experiments(s, d, "F"), experiments(s, d, "O")),
                              8, "before", "after", "change"),
        f"""WITH {experiments_sql('one', 'F')}, {experiments_sql('two', 'O')}
        SELECT {_KEYS_SQL}, round(one."{E.SCORE}", 8) AS before, round(two."{E.SCORE}", 8) AS after,
        round(two."{E.SCORE}" - one."{E.SCORE}", 8) AS change
        FROM one FULL JOIN two USING ({_KEYS_SQL})"""),
}
