"""Scaling, PCA, k-means and cluster descriptions against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldkit.functions.scalars import estimated_shape
from fieldkit.operators import clusters as C
from fieldkit.operators import kmeans as K

DIMS = ["a", "b", "c"]
SCALED = ["sa", "sb", "sc"]


@pytest.fixture(scope="module")
def cloud(spark):
    """A line, a ball, one point and a pile of equal points."""
    rng = np.random.default_rng(2)
    t = rng.uniform(0, 9, 200)
    line = np.column_stack([t, t, t]) + rng.normal(0, 1e-3, (200, 3))
    ball = rng.uniform(-2, 2, (400, 3)) + 40
    rows = ([(*map(float, p), "line") for p in line] + [(*map(float, p), "ball") for p in ball]
            + [(90.0, 1.0, 2.0, "point")] + [(50.0, 0.1, 0.3, "pile")] * 7)
    df = spark.createDataFrame(rows, "a double, b double, c double, label string").repartition(4)
    return rows, C.scale_columns(df, DIMS, SCALED).persist()


def test_both_ways_of_scaling_agree(spark, cloud):
    rows, scaled = cloud
    values = np.array([r[:3] for r in rows])
    want = (values - values.mean(0)) / values.std(0, ddof=1)
    got = np.array(sorted(tuple(r) for r in scaled.select(*SCALED).collect()))
    assert np.allclose(got, np.array(sorted(map(tuple, want))))
    vectors = C.standardize(C.as_vector(scaled, DIMS))
    both = C.vector_columns(vectors, "scaledFeatures", ["x", "y", "z"], SCALED)
    assert both.filter(F.abs(F.col("x") - F.col("sa")) > 1e-9).count() == 0


def test_constant_dimension_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    assert {r["sa"] for r in C.scale_columns(df, ["a", "b"], ["sa", "sb"]).collect()} == {0.0}
    vectors = C.standardize(C.as_vector(df, ["a", "b"]))
    assert {r[0] for r in C.vector_columns(vectors, "scaledFeatures", ["a", "b"]).collect()} == {0.0}


def test_descriptions(cloud):
    rows, scaled = cloud
    found = {r["cluster"]: r for r in C.describe_clusters(scaled, "label", DIMS, SCALED).collect()}
    assert {k: r["shape"] for k, r in found.items()} == {
        "line": "Line", "ball": "Sphere or Cube/Cuboid", "point": "Point", "pile": "Point"}
    assert {k: r["dimensions"] for k, r in found.items()} == {
        "line": 1, "ball": 3, "point": None, "pile": None}
    assert found["pile"]["ratios"] is None and found["pile"]["points"] == 7
    ball = np.array([r[:3] for r in rows if r[3] == "ball"])
    ranges = np.round(ball.max(0) - ball.min(0), 2)
    assert [found["ball"][f"range_{c}"] for c in DIMS] == pytest.approx(ranges)
    assert found["ball"]["size"] == pytest.approx(ranges.sum())
    assert found["ball"]["extent"] == pytest.approx(ranges.max())
    assert [found["ball"][f"mean_{c}"] for c in DIMS] == pytest.approx(np.round(ball.mean(0), 2))
    for r in found.values():
        if r["ratios"] is not None:
            assert sum(r["ratios"]) == pytest.approx(1)
            assert r["ratios"] == sorted(r["ratios"], reverse=True)


def test_ratios_from_sums_equal_covariances_and_spark_pca(cloud):
    _, scaled = cloud
    by_sums = {r["cluster"]: r["ratios"]
               for r in C.describe_clusters(scaled, "label", DIMS, SCALED).collect()}
    by_cov = {r["cluster"]: r["ratios"] for r in C.explained_variance(
        C.cluster_covariance(scaled, "label", SCALED), SCALED).collect()}
    assert set(by_sums) == set(by_cov)
    for label, ratios in by_cov.items():
        assert (by_sums[label] is None) == (ratios is None)
        if ratios is not None:
            assert by_sums[label] == pytest.approx(ratios, abs=1e-9)
    ball = C.as_vector(scaled.filter("label = 'ball'"), SCALED, "scaledFeatures")
    variance = C.pca_variance(ball, C.fit_pca(ball, 3)).orderBy("component").collect()
    assert [r["ratio"] for r in variance] == pytest.approx(by_cov["ball"], abs=1e-8)


def test_profile_is_part_of_the_description(cloud):
    _, scaled = cloud
    profile = C.cluster_profile(scaled, "label", DIMS, SCALED)
    described = C.describe_clusters(scaled, "label", DIMS, SCALED).select(*profile.columns)
    assert sorted(map(tuple, profile.collect())) == sorted(map(tuple, described.collect()))


@pytest.mark.parametrize("dims,ranges,shape", [
    (1, [1, 9, 9], "Line"), (2, [1, 9, 9], "Plane or Disk"),
    (3, [1.0, 1.2, 0.8], "Sphere or Cube/Cuboid"), (3, [1.0, 1.21, 1.0], "Ellipsoid or Rectangular Prism"),
    (3, [1.0, 1.0, 0.79], "Ellipsoid or Rectangular Prism"), (4, [1, 1, 1], "Higher-dimensional shape"),
    (0, [1, 1, 1], "Higher-dimensional shape"), (None, [0, 0, 0], "Point")])
def test_shapes(spark, dims, ranges, shape):
    df = spark.createDataFrame([(dims, *map(float, ranges))], "d int, x double, y double, z double")
    assert df.select(estimated_shape(F.col("d"), [F.col(c) for c in "xyz"])).first()[0] == shape


def test_report_text(cloud):
    _, scaled = cloud
    described = C.describe_clusters(scaled, "label", DIMS, SCALED)
    blocks = {r["cluster"]: r["line"] for r in C.cluster_report(described, DIMS, SCALED).collect()}
    lines = blocks["pile"].split("\n")
    assert lines[0] == "Object (Cluster pile):"
    assert lines[2] == "Location (mean, original): [50.0, 0.1, 0.3]"
    assert lines[3:] == ["Size (variance per dimension): []", "Primary Dimensions: 0",
                         "Shape: Point", "Dimension Ranges: [0.0, 0.0, 0.0]", "Points: 7", ""]
    summary = C.cluster_summary(described, DIMS, SCALED)
    assert len(summary.columns) == 9
    assert {r["Object"]: r["Dimension"] for r in summary.collect()}["Cluster line"] == "1D"


def test_kmeans_sweep_and_silhouette(cloud):
    _, scaled = cloud
    vectors = C.as_vector(scaled.filter("label in ('line', 'ball')"), SCALED, "pcaFeatures")
    table, best = K.kmeans_sweep(vectors, [2, 3, 4])
    rows = table.orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4]
    assert all(-1 <= r["silhouette"] <= 1 and r["cost"] >= 0 for r in rows)
    chosen = [r for r in rows if r["is_best"]]
    assert len(chosen) == 1 and chosen[0]["silhouette"] == max(r["silhouette"] for r in rows)
    assert len(best.clusterCenters()) == chosen[0]["k"] == 2
    assigned = best.transform(vectors)
    assert C.cluster_labels(assigned).count() == 2
    means = {r["prediction"]: list(r)[1:] for r in assigned.groupBy("prediction")
             .agg(*[F.avg(c) for c in SCALED]).collect()}
    for i, centre in enumerate(best.clusterCenters()):
        assert means[i] == pytest.approx(list(centre), abs=1e-6)
    projected = C.cluster_projection(assigned, dims=2)
    assert projected.columns == ["cluster", "x", "y"]
    density = C.projection_density(projected, {"x": 0.5, "y": 0.5})
    assert density.agg(F.sum("points")).first()[0] == projected.count()


def test_tight_clusters_keep_their_shape(spark):
    rng = np.random.default_rng(2)
    for spread in (1e-9, 1e-7, 1.0):
        near = 3 + rng.normal(size=(1000, 3)) * [spread, spread, 0.05 * spread]
        wide = rng.normal(size=(1000, 3)) * 5
        rows = [(name, *map(float, p)) for name, part in (("near", near), ("wide", wide))
                for p in part]
        df = spark.createDataFrame(rows, "label string, a double, b double, c double")
        df = df.withColumns({s: F.col(c) for s, c in zip(SCALED, DIMS)})
        found = {r["cluster"]: r for r in C.describe_clusters(df, "label", DIMS, SCALED).collect()}
        vectors = C.as_vector(df.filter("label = 'near'"), DIMS, "scaledFeatures")
        pca = C.fit_pca(vectors, 3).explainedVariance.toArray()
        assert found["near"]["ratios"] == pytest.approx(list(pca), abs=1e-3 if spread < 1e-8 else 1e-6)
        centred = near - near.mean(axis=0)
        exact = np.linalg.eigvalsh(centred.T @ centred)[::-1]
        assert found["near"]["ratios"] == pytest.approx(list(exact / exact.sum()), abs=1e-6)
        assert found["near"]["dimensions"] == 2 and found["near"]["shape"] == "Plane or Disk"


def test_projection_has_two_or_three_dimensions(cloud):
    _, scaled = cloud
    with pytest.raises(ValueError):
        C.cluster_projection(C.as_vector(scaled, SCALED, "pcaFeatures"), dims=4)
