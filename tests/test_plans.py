"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from fieldkit.operators import boxes as B
from fieldkit.operators import clusters as C
from fieldkit.operators import signals as S
from fieldkit.operators.sites import orders_near
from fieldkit.plans.catalog import CATALOG
from fieldkit.plans.stand_ins import zips
from fieldkit.session import new_path


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = new_path(spark, "stored-blips")
    (spark.range(1000).select((F.col("id") % 10).cast("double").alias("ascension"),
                              (F.col("id") % 7).cast("double").alias("declination"),
                              F.col("id").cast("double").alias("time"),
                              (F.col("id") / 10).alias("frequency"), F.lit("x").alias("note"))
     .write.parquet(path))
    return spark.read.parquet(path)


def test_box_filter_and_columns_reach_the_scan(stored):
    box = B.Box("b", 3.0, 4.0, 1.0, 2.0, 1.0, 2.0)
    text = plan(B.box_blips(stored, box))
    pushed = text.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(frequency" in pushed and "LessThanOrEqual(ascension" in pushed
    assert "note" not in text.split("ReadSchema: ")[1]


def test_few_boxes_need_no_join(spark, stored):
    boxes = B.boxes_frame(spark, [B.Box("b", 3.0, 4.0, 1.0, 2.0, 1.0, 2.0)])
    text = plan(B.match_boxes(stored, boxes))
    assert "Join" not in text
    assert text.count("Exchange") == text.count("Exchange hashpartitioning(box_id") == 1  # copies
    assert "PushedFilters: [Or(" in text or "GreaterThanOrEqual(frequency" in text


def test_many_boxes_join_on_cells(spark, stored):
    boxes = B.boxes_frame(spark, [B.Box(str(i), i, i + 1.0, 1.0, 2.0, 1.0, 2.0) for i in range(9)])
    text = plan(B.match_boxes(stored, boxes, few_boxes=3))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text
    assert "GreaterThanOrEqual(frequency" in text.split("PushedFilters: ")[1].split("]")[0]


def test_counts_combine_before_one_shuffle(stored):
    text = plan(S.top_signal_period(stored))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text and "TakeOrderedAndProject" in text
    assert "note" not in text.split("ReadSchema: ")[1]


# What the last job of a query may hold, and why: eigenvalues of one small matrix per cluster have no
# Spark function, and a grid of combinations is a product.
EXCEPTIONS = {
    **dict.fromkeys(["cluster_variance", "primary_dimensions", "cluster_summary", "cluster_report",
                     "cluster_hunt"], "Pandas"),
    "param_grid": "NestedLoop",
}


@pytest.mark.parametrize("name", list(CATALOG))
def test_no_python_no_cross_join_no_single_partition_window(spark, folder, name):
    text = plan(CATALOG[name].run(spark, folder))
    found = [word for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop") if word in text]
    assert found == [EXCEPTIONS[name]] if name in EXCEPTIONS else not found
    assert not ("Window" in text and "Exchange SinglePartition" in text)


def test_cluster_description_reads_the_points_once(spark, stored):
    text = plan(C.describe_clusters(
        stored.withColumns({"sa": F.col("ascension"), "sd": F.col("declination")}), "note",
        ["ascension", "declination"], ["sa", "sd"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_orders_of_few_customers_are_not_shuffled(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderkey AS OrderId", "o_custkey AS CustomerId")
    customers = spark.read.parquet(f"{folder}/customer.parquet").selectExpr(
        "c_custkey AS CustomerId", "c_nationkey AS PostalCode")
    places = zips(spark, folder)
    text = plan(orders_near(orders, customers, places))
    assert "Exchange hashpartitioning(CustomerId" not in text and "NestedLoop" not in text
    text = plan(orders_near(orders, customers, places, few_customers=0))
    assert "partial_count(OrderId" in text and "Exchange hashpartitioning(CustomerId" in text


def test_names_of_clusters_go_to_the_points(spark):
    folder, threshold = new_path(spark, "named-items"), "spark.sql.autoBroadcastJoinThreshold"
    (spark.range(400, numPartitions=4).select(
        F.lit(1).alias("l_linenumber"), F.lit(3).alias("l_partkey"),
        *[(F.col("id") % 10 * step).alias(name) for name, step in
          (("l_quantity", 5.0), ("l_extendedprice", 9973.0), ("l_discount", 0.01), ("l_tax", 0.01))],
        F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"))
     .write.parquet(f"{folder}/lineitem.parquet"))
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as where the points are many, and so the names' size not known
    try:
        text = plan(CATALOG["kmeans_assign"].run(spark, folder))
        written = CATALOG["cluster_projection"].run(spark, folder)
        found = written.groupBy("cluster").agg(F.count("*")).collect()
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(map(tuple, found)) == [("A", 134), ("N", 133), ("R", 133)]
    tasks = {(part, name.split("-")[1]) for part, name in (f.split("/")[-2:] for f in written.inputFiles())}
    assert len(tasks) == 12  # each of the four tasks writes to each of the three folders
