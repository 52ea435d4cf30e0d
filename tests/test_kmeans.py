"""k-means for many k in shared scans."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector

from fieldkit.operators import kmeans as K


def vectors(spark, rows, partitions=3):
    df = spark.createDataFrame([([float(v) for v in r],) for r in rows], "a array<double>")
    return df.repartition(partitions).select(array_to_vector("a").alias("pcaFeatures"))


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0], [30, 0, 5], [0, 40, -5], [25, 25, 60]])
    return np.concatenate([c + rng.normal(size=(300 + 40 * i, 3)) for i, c in enumerate(centres)])


def test_sweep_finds_the_groups_and_scores_them_as_the_evaluator_does(spark, groups):
    df = vectors(spark, groups).cache()
    table, best = K.kmeans_sweep(df, range(2, 8))
    rows = {r.k: r for r in table.collect()}
    assert [k for k, r in rows.items() if r.is_best] == [4]
    assert rows[4].silhouette == max(r.silhouette for r in rows.values())
    assigned = best.transform(df)
    assert sorted(r["count"] for r in assigned.groupBy("prediction").count().collect()) == [
        300, 340, 380, 420]
    points = K.pack(df, "pcaFeatures", 1)
    fits = K.fit_all(points, range(2, 8))
    for k, (value, cost) in zip(range(2, 8), K.scores(points, fits), strict=True):
        found = K.Clustering(fits[k - 2], "pcaFeatures").transform(df)
        library = ClusteringEvaluator(featuresCol="pcaFeatures").evaluate(found)
        assert value == pytest.approx(library, abs=1e-9) == rows[k].silhouette
        away = ((groups[:, None] - fits[k - 2][None]) ** 2).sum(axis=2).min(axis=1)
        assert cost == pytest.approx(away.sum(), rel=1e-12) == rows[k].cost


def test_steps_equal_plain_descent(spark, groups):
    points = K.pack(vectors(spark, groups), "pcaFeatures", 1)
    start = K.fit_all(points, [3, 5], max_iter=0)
    for k, centres, got in zip([3, 5], start, K.fit_all(points, [3, 5], max_iter=2), strict=True):
        for _ in range(2):
            label = ((groups[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.stack([groups[label == i].mean(axis=0) for i in range(k)])
        assert np.allclose(got, centres, atol=1e-12)


def test_results_do_not_depend_on_how_points_are_dealt(spark, groups):
    """Bit for bit, on few and on many partitions and in any order."""
    found = []
    for n in (2, 8, 211):
        shuffled = groups[np.random.default_rng(n).permutation(len(groups))]
        table, best = K.kmeans_sweep(vectors(spark, shuffled, n), [2, 4, 6])
        found.append((sorted(map(tuple, table.collect())), best.centres.tolist()))
    assert found[0] == found[1] == found[2]


def test_sums_of_whole_numbers_are_exact():
    rng = random.Random(2)
    values = np.array([rng.uniform(-8, 8) * 10 ** rng.randint(-9, 0) for _ in range(500)])
    sums = K.Sums(2, 1)
    sums.add(np.arange(500) % 2, values[:, None], [8.0])
    for i in range(2):
        got = K._whole(sums.high[i, 0], sums.low[i, 0], 8.0)
        assert got == pytest.approx(values[i::2].sum(), abs=500 * 8 * 2.0 ** -59)
    turned = K.Sums(2, 1)
    for i in rng.sample(range(500), 500):
        turned.add(np.array([i % 2]), values[[i]][:, None], [8.0])
    assert (turned.high == sums.high).all() and (turned.low == sums.low).all()


def test_copies_few_points_and_constants(spark):
    same = vectors(spark, [[1, 2]] * 50)
    table, best = K.kmeans_sweep(same, [2, 3])
    assert best.centres.tolist() == [[1.0, 2.0]]
    assert [tuple(r) for r in table.collect()] == [(2, 0.0, 0.0, True), (3, 0.0, 0.0, False)]
    # a third of the rows are one point; its copies do not crowd the others out of the seeding
    hot = vectors(spark, [[0, 0]] * 400 + [[i % 7 * 100, i % 5 * 100] for i in range(800)])
    table, _ = K.kmeans_sweep(hot, [35])
    assert table.first()["cost"] == 0.0
    two = vectors(spark, [[0.0], [5.0]])
    assert sorted(K.fit_kmeans(two, 4).centres.ravel().tolist()) == [0.0, 5.0]
    with pytest.raises(ValueError):
        K.fit_kmeans(two.limit(0), 2)


def test_labels_are_those_of_the_nearest_centre(spark):
    df = vectors(spark, [[0, 0], [4, 0], [2, 0], [9, 9]])
    model = K.Clustering(np.array([[0.0, 0.0], [4.0, 0.0], [8.0, 8.0]]), "pcaFeatures")
    got = {tuple(r.pcaFeatures): r.prediction for r in model.transform(df).collect()}
    assert got == {(0, 0): 0, (4, 0): 1, (2, 0): 0, (9, 9): 2}


def test_scans_grow_with_steps_and_not_with_the_number_of_k(spark, groups, monkeypatch):
    df = vectors(spark, groups).cache()
    scans = []

    def counting(points, *rest):
        scans.append(1)
        return summed(points, *rest)

    summed = K._summed
    monkeypatch.setattr(K, "_summed", counting)
    for ks in ([4], range(2, 11)):
        scans.clear()
        K.kmeans_sweep(df, ks)
        # the weights, at most MAX_ITER steps, and two scans for all scores
        assert len(scans) <= K.MAX_ITER + 3


def test_points_are_cut_and_placed_once_for_all_clusterings(monkeypatch):
    """The halves of a coordinate serve every k; labels are those of the whole distances."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (500, 3)) / 2.0
    fits = [rng.integers(0, 6, (k, 3)) / 2.0 for k in (1, 2, 7)]
    fits[2][3] = fits[2][1]  # equally near: the first
    cuts, halves = [], K.halves
    monkeypatch.setattr(K, "halves", lambda v, s: cuts.append(len(v)) or halves(v, s))
    sums = K.Sums(10, 3)
    K.add_nearest(sums, x, fits, [4.0] * 3)
    assert cuts == [500] * 3
    at = 0
    for centres in fits:
        away = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        label, least = K.nearest(np.ascontiguousarray(x.T), centres)
        assert (label == away.argmin(axis=1)).all() and (least == away.min(axis=1)).all()
        for i in range(len(centres)):
            assert sums.n[at + i] == (label == i).sum()
            for c in range(3):
                whole = K._whole(sums.high[at + i, c], sums.low[at + i, c], 4.0)
                assert whole == x[label == i, c].sum()
        at += len(centres)
    assert sums.n[4] + sums.n[6] > 0 and sums.n[6] == 0
