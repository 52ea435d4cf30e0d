"""Networks with dropout, mini-batches and momentum."""

import numpy as np
import pytest

from fieldkit.operators import experiments as E
from fieldkit.operators import networks as N


def frame(spark, x, y, partitions=3):
    rows = [([float(v) for v in row], int(c)) for row, c in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "features array<double>, label int").repartition(partitions)


@pytest.fixture(scope="module")
def rings():
    rng = np.random.default_rng(3)
    y = np.arange(600) % 3
    return np.array([[0, 0], [5, 0], [0, 5]])[y] + rng.normal(size=(600, 2)) * 0.5, y


def test_gradient_is_the_slope_of_the_loss(rings):
    x, y = rings
    widths = [2, 5, 4, 3]
    weights = N.start(widths, 2) + 0.01
    slope, loss, right = N.gradient(weights, widths, x, y, (0.0, 0.0), np.random.default_rng(0))
    assert right == (N.outputs(weights, widths, x).argmax(axis=1) == y).sum()
    for i in range(len(weights)):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        ends = [N.gradient(weights + s, widths, x, y, (), np.random.default_rng(0))[1]
                for s in (step, -step)]
        assert slope[i] == pytest.approx((ends[0] - ends[1]) / 2e-6 / len(y), abs=1e-6)
    assert loss > 0


def test_dropout_leaves_units_out_and_keeps_their_mean(rings):
    x, y = rings
    widths = [2, 400, 3]
    weights = N.start(widths, 2)
    plain = N.gradient(weights, widths, x, y, (), np.random.default_rng(0))[0]
    same = [N.gradient(weights, widths, x, y, (0.5,), np.random.default_rng(7))[0] for _ in "ab"]
    other = N.gradient(weights, widths, x, y, (0.5,), np.random.default_rng(8))[0]
    assert (same[0] == same[1]).all() and not (same[0] == other).all()
    assert not (same[0] == plain).all()


@pytest.mark.parametrize("shard_rows", [1000, 60])
def test_a_batch_of_all_rows_is_full_descent(spark, rings, shard_rows):
    """However many shards there are, and loss by loss."""
    x, y = rings
    shards = N.pack_shards(frame(spark, x, y), "features", "label", shard_rows=shard_rows)
    run = N.Run((0.0, 0.0), 0.1, 1000, 4)
    (got,), history = N.fit_runs(shards, 3, [run], hidden=(5, 4))
    widths = [2, 5, 4, 3]
    weights, momentum, losses = N.start(widths, 1), 0.0, []
    for _ in range(4):
        slope, loss, _ = N.gradient(weights, widths, x, y, (), np.random.default_rng(0))
        momentum = N.MOMENTUM * momentum - 0.1 * slope
        weights = weights + momentum
        losses.append(loss / len(y))
    assert np.allclose(got, weights, atol=1e-9)
    rows = history.orderBy("epoch").collect()
    assert [r.loss for r in rows] == pytest.approx(losses, abs=1e-9)
    assert losses[-1] < losses[0]


def test_one_shard_descends_batch_by_batch(spark, rings):
    x, y = rings
    shards = N.pack_shards(frame(spark, x, y), "features", "label")
    block = shards.blocks.collect()[0]
    run = N.Run((0.3, 0.2), 0.05, 32, 2)
    (got,), _ = N.fit_runs(shards, 3, [run], hidden=(5, 4))
    widths, weights, momentum = [2, 5, 4, 3], N.start([2, 5, 4, 3], 1), 0.0
    rows, labels = np.frombuffer(block.x).reshape(-1, 2), np.frombuffer(block.y, "<i4")
    for epoch in range(2):
        order = np.argsort(N._mixed(np.frombuffer(block.h, np.uint64), epoch), kind="stable")
        for number, at in enumerate(range(0, 600, 32)):
            part = order[at:at + 32]
            rng = np.random.default_rng([1, 0, epoch, 0, number])
            slope = N.gradient(weights, widths, rows[part], labels[part], run.dropout, rng)[0]
            momentum = N.MOMENTUM * momentum - 0.05 * slope
            weights = weights + momentum
    assert np.allclose(got, weights, atol=1e-9)


def test_every_parameter_acts_and_layout_does_not(spark, rings):
    x, y = rings
    base = N.Run((0.25, 0.5), 0.1, 16, 3)
    runs = [base, base._replace(dropout=(0.3, 0.5)), base._replace(dropout=(0.25, 0.6)),
            base._replace(rate=0.05), base._replace(batch=32), base._replace(epochs=2)]
    found = [N.fit_runs(N.pack_shards(frame(spark, x, y, n), "features", "label", shard_rows=200),
                        3, runs)[0] for n in (1, 5)]
    for i in range(len(runs)):
        assert np.allclose(found[0][i], found[1][i], atol=1e-9)
        assert i == 0 or not np.allclose(found[0][0], found[0][i], atol=1e-6)


def test_search_on_separable_classes_copies_and_empty_parts(spark, rings):
    x, y = rings
    df = frame(spark, np.concatenate([x, np.repeat(x[:1], 300, axis=0)]),
               np.concatenate([y, np.repeat(y[:1], 300)]))
    grid = E.param_grid(**{**E.SEARCHED, "Learning Rate": [0.1], "Dropout1": [0.25],
                           "Epochs": [12, 15]})
    found = N.network_search(df, df, df.limit(0), grid, 3, shard_rows=100).collect()
    assert [tuple(r)[:5] for r in found] == [tuple(g[p] for p in E.PARAMETERS) for g in grid]
    assert all(r["Validation Accuracy"] > 0.98 and r[E.SCORE] is None for r in found)
    shards = N.pack_shards(df, "features", "label", shard_rows=100)
    assert shards.size == 900 and sorted(r.n for r in shards.blocks.collect())[-1] < 200
    with pytest.raises(ValueError):
        N.pack_shards(df.limit(0), "features", "label")


def test_networks_of_one_batch_size_descend_side_by_side(rings):
    """Several networks on one batch give what each gives alone, draws included."""
    x, y = rings
    widths, dropouts = [2, 6, 4, 3], [(0.3, 0.5), (0.0, 0.2), ()]
    weights = np.stack([N.start(widths, s) + 0.01 for s in range(3)])
    step, loss, right = N.gradients(weights, widths, x[:50], y[:50], dropouts,
                                    [np.random.default_rng(s) for s in range(3)])
    for i, dropout in enumerate(dropouts):
        alone = N.gradient(weights[i], widths, x[:50], y[:50], dropout, np.random.default_rng(i))
        assert np.allclose(step[i], alone[0], atol=1e-13)
        assert (loss[i], right[i]) == (pytest.approx(alone[1], abs=1e-10), alone[2])
    runs = [(i, N.Run((), 0.1, batch, 1)) for i, batch in enumerate((64, 32, 64))]
    assert {k: [r[0] for r in g] for k, g in N.alike(runs).items()} == {64: [0, 2], 32: [1]}
