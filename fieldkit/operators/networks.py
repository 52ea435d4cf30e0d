"""Small networks with dropout, trained by mini-batches with momentum, all runs of a grid at once."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.operators.experiments import PARAMETERS, SCORE
from fieldkit.session import settle

SHARD_ROWS = 50_000
MOMENTUM = 0.9
_SHARD = "shard bigint, n bigint, x binary, y binary, h binary"


class Run(NamedTuple):
    """One run of a grid: what is left out of each hidden layer, and how it descends."""

    dropout: tuple[float, ...]
    rate: float
    batch: int
    epochs: int


class Shards(NamedTuple):
    """Rows packed by hash into shards on shared files, their number and their width."""

    blocks: DataFrame
    size: int
    width: int


def run_of(row: Mapping) -> Run:
    """A run from a row of the five parameters."""
    return Run((row["Dropout1"], row["Dropout2"]), row["Learning Rate"], row["Batch Size"],
               row["Epochs"])


def pack_shards(df: DataFrame, features: str, label: str, seed: int = 1,
                shard_rows: int = SHARD_ROWS) -> Shards:
    """Rows of an array column and a class number, in shards of about ``shard_rows`` by their hash.

    A row's shard depends on its values, on a running number among equal rows and on the number of
    rows, so it is the same however the rows came; equal rows are spread over all shards.
    """
    x, y = F.col(features).cast("array<double>"), F.col(label).cast("int")
    counted = settle(df.select(x.alias("x"), y.alias("y")).groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("n")), "counted-rows")
    size = counted.agg(F.sum("n")).first()[0] or 0
    if not size:
        raise ValueError("there are no rows to learn from")
    shards = -(-size // shard_rows)
    h = F.xxhash64("x", "y", F.lit(seed))
    # A row that stands for many is dealt to the shards one by one, in as many rows as there are.
    each = F.sequence(F.lit(0).cast("bigint"), F.least(F.col("n"), F.lit(shards)) - 1)
    dealt = counted.withColumn("h", h).withColumn("i", F.explode(each)).select(
        F.pmod(F.col("h") + F.col("i"), F.lit(shards)).alias("shard"), "x", "y", "h",
        F.floor((F.col("n") - 1 - F.col("i")) / F.lit(shards) + 1).cast("bigint").alias("times"))

    def packed(group: pa.Table) -> pa.Table:
        times = group.column("times").to_numpy()
        lists = group.column("x").combine_chunks()
        if len(lists.value_lengths().unique()) > 1:
            raise ValueError("rows differ in width")
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
        hashes = group.column("h").to_numpy()
        order = np.lexsort((group.column("y").to_numpy(), hashes))
        order = np.repeat(order, times[order])
        copy = np.arange(len(order)) - np.searchsorted(hashes[order], hashes[order])
        return pa.table({
            "shard": [group.column("shard")[0].as_py()], "n": [len(order)],
            "x": [x[order].tobytes()], "y": [group.column("y").to_numpy()[order].astype("<i4").tobytes()],
            "h": [(hashes[order].astype(np.uint64) + copy.astype(np.uint64)).tobytes()]})

    blocks = settle(dealt.groupBy("shard").applyInArrow(packed, _SHARD), "shards")
    return Shards(blocks, size, len(counted.select("x").first()["x"]))


def start(widths: Sequence[int], seed: int) -> np.ndarray:
    """Weights to begin with, layer after layer, each with its offsets behind; uniform by layer size."""
    rng = np.random.default_rng(seed)
    parts = []
    for before, after in zip(widths, widths[1:], strict=False):
        edge = np.sqrt(6.0 / (before + after))
        parts += [rng.uniform(-edge, edge, before * after), np.zeros(after)]
    return np.concatenate(parts)


def _layers(weights: np.ndarray, widths: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    found, at = [], 0
    for before, after in zip(widths, widths[1:], strict=False):
        end = at + before * after
        found.append((weights[at:end].reshape(before, after), weights[end:end + after]))
        at = end + after
    return found


def outputs(weights: np.ndarray, widths: Sequence[int], x: np.ndarray) -> np.ndarray:
    """Class scores without dropout."""
    layers = _layers(weights, widths)
    for i, (matrix, offset) in enumerate(layers):
        x = x @ matrix + offset
        if i < len(layers) - 1:
            x = np.maximum(x, 0.0)
    return x


def gradient(weights: np.ndarray, widths: Sequence[int], x: np.ndarray, y: np.ndarray,
             dropout: Sequence[float], rng: np.random.Generator) -> tuple[np.ndarray, float, int]:
    """Mean gradient of the cross entropy over a batch, its summed loss and its right answers.

    A unit of a hidden layer is left out of a row by a draw, and those that stay count for more.
    """
    step, loss, right = gradients(weights[None], widths, x, y, [dropout], [rng])
    return step[0], float(loss[0]), int(right[0])


def gradients(weights: np.ndarray, widths: Sequence[int], x: np.ndarray, y: np.ndarray,
              dropouts: Sequence[Sequence[float]], rngs: Sequence[np.random.Generator]
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for several networks on one batch, each with its own weights, rates and draws."""
    layers, at = [], 0
    for before, after in zip(widths, widths[1:], strict=False):
        end = at + before * after
        layers.append((weights[:, at:end].reshape(-1, before, after), weights[:, None, end:end + after]))
        at = end + after
    held, masks = [x], []
    for i, (matrix, offset) in enumerate(layers):
        x = x @ matrix
        x += offset
        if i < len(layers) - 1:
            mask = (x > 0).astype(float)
            for kept, dropout, rng in zip(mask, dropouts, rngs, strict=True):
                share = dropout[i] if i < len(dropout) else 0.0
                if share:
                    kept *= (rng.random(kept.shape) >= share) / (1.0 - share)
            x *= mask
            masks.append(mask)
            held.append(x)
    x -= x.max(axis=2, keepdims=True)
    rows = np.arange(len(y))
    right = (x.argmax(axis=2) == y).sum(axis=1)
    chance = np.exp(x, out=x)
    chance /= chance.sum(axis=2, keepdims=True)
    loss = -np.log(np.maximum(chance[:, rows, y], 1e-300)).sum(axis=1)
    chance[:, rows, y] -= 1.0
    chance /= len(y)
    back, parts = chance, []
    for i in reversed(range(len(layers))):
        parts += [back.sum(axis=1), (held[i].swapaxes(-1, -2) @ back).reshape(len(weights), -1)]
        if i:
            back = (back @ layers[i][0].swapaxes(1, 2)) * masks[i - 1]
    return np.concatenate(parts[::-1], axis=1), loss, right


def _mixed(hashes: np.ndarray, epoch: int) -> np.ndarray:
    """Another order of the rows for each epoch."""
    z = (hashes ^ np.uint64((epoch + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    z = (z ^ (z >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return z ^ (z >> np.uint64(33))


def fit_runs(shards: Shards, classes: int, runs: Sequence[Run], hidden: Sequence[int] = (16, 8),
             seed: int = 1) -> tuple[list[np.ndarray], DataFrame]:
    """Weights of each run, and ``run, epoch, loss, accuracy`` while it trained.

    An epoch is one scan for all runs. In a shard, rows come in batches by a hash of row and epoch;
    each batch gives one gradient, and a step with momentum follows it. At the end of the epoch the
    shards' weights and momenta are averaged, by their rows. So a table of one shard descends batch
    by batch, batches as large as the shards give full descent however many shards there are, and
    tables of any size take as many tasks as they have shards. Masks are drawn by seed, run, epoch,
    shard and batch, so work done again gives the same weights.
    """
    widths = [shards.width, *hidden, classes]
    weights = [start(widths, seed) for _ in runs]
    momenta = [np.zeros_like(w) for w in weights]
    history = []
    for epoch in range(max(run.epochs for run in runs)):
        live = [i for i, run in enumerate(runs) if epoch < run.epochs]
        sent = shards.blocks.sparkSession.sparkContext.broadcast(
            [(i, runs[i], weights[i], momenta[i]) for i in live])
        sums = _epoch(shards, widths, sent, epoch, seed)
        for i in live:
            parts = sums[i]
            n = len(weights[i])
            weights[i], momenta[i] = parts[:n] / shards.size, parts[n:2 * n] / shards.size
            history.append((i, epoch + 1, *[float(p) / shards.size for p in parts[-2:]]))
        sent.unpersist()
    return weights, shards.blocks.sparkSession.createDataFrame(
        history, "run int, epoch int, loss double, accuracy double")


def alike(runs: Sequence[tuple]) -> dict[int, list[tuple]]:
    """Runs by batch size: those of one size see the same batches and descend side by side."""
    groups: dict[int, list[tuple]] = {}
    for run in runs:
        groups.setdefault(run[1].batch, []).append(run)
    return groups


def _epoch(shards: Shards, widths: Sequence[int], sent, epoch: int, seed: int) -> dict[int, np.ndarray]:
    """Each run's weights and momenta summed over rows, then its losses and right answers."""
    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):  # one shard at a time, its bytes left where they are
                shard, n = batch.column("shard")[row].as_py(), batch.column("n")[row].as_py()
                x, y, h = (batch.column(c)[row].as_buffer() for c in "xyh")
                order = np.argsort(_mixed(np.frombuffer(h, np.uint64), epoch), kind="stable")
                x = np.frombuffer(x).reshape(n, -1)[order]
                y = np.frombuffer(y, "<i4")[order]
                for size, group in alike(sent.value).items():
                    weights = np.stack([g[2] for g in group])
                    momentum = np.stack([g[3] for g in group])
                    rates = np.array([[g[1].rate] for g in group])
                    dropouts, loss, right = [g[1].dropout for g in group], 0.0, 0
                    for number, at in enumerate(range(0, n, size)):
                        rngs = [np.random.default_rng([seed, g[0], epoch, shard, number]) for g in group]
                        step, lost, good = gradients(weights, widths, x[at:at + size], y[at:at + size],
                                                     dropouts, rngs)
                        momentum = MOMENTUM * momentum - rates * step
                        weights = weights + momentum
                        loss, right = loss + lost, right + good
                    found = np.concatenate([n * weights, n * momentum, loss[:, None], right[:, None]], axis=1)
                    for (i, *_), part in zip(group, found, strict=True):
                        sums[i] = sums[i] + part if i in sums else part
        yield pa.RecordBatch.from_pydict({
            "run": pa.array(list(sums), pa.int32()),
            "parts": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))})

    rows = (shards.blocks.mapInArrow(trained, "run int, parts array<double>")
            .select("run", F.posexplode("parts").alias("place", "part"))
            .groupBy("run", "place").agg(F.sum("part").alias("part"))
            .groupBy("run").agg(F.array_sort(F.collect_list(F.struct("place", "part")))["part"]
                                .alias("parts")).collect())
    return {row["run"]: np.array(row["parts"]) for row in rows}


def accuracies(df: DataFrame, features: str, label: str, widths: Sequence[int],
               weights: Sequence[np.ndarray]) -> list[float]:
    """Share of rows whose class each run gets right, from one scan for all of them."""
    sent = df.sparkSession.sparkContext.broadcast(list(weights))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n = np.zeros(len(sent.value), np.int64), 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x, y = x.reshape(batch.num_rows, -1), batch.column("y").to_numpy()
            right += [int((outputs(w, widths, x).argmax(axis=1) == y).sum()) for w in sent.value]
            n += batch.num_rows
        yield pa.RecordBatch.from_pydict({"run": np.arange(len(right)), "right": right,
                                          "n": np.full(len(right), n)})

    rows = df.select(F.col(features).cast("array<double>").alias("x"),
                     F.col(label).cast("int").alias("y")).mapInArrow(
        scored, "run bigint, right bigint, n bigint").groupBy("run").agg(
            (F.sum("right") / F.nullif(F.sum("n"), F.lit(0))).alias("share")).collect()
    found = {row["run"]: row["share"] for row in rows}
    return [found.get(i) for i in range(len(weights))]


def network_search(train: DataFrame, validation: DataFrame, test: DataFrame,
                   grid: Sequence[Mapping], classes: int, features: str = "features",
                   label: str = "label", hidden: Sequence[int] = (16, 8), seed: int = 1,
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per grid row with its five parameters and the accuracy on both other parts.

    All five act: dropout rates, learning rate, batch size and epochs. Choose by ``Validation
    Accuracy``; ``Test Accuracy`` is for reporting. A part without rows has null accuracies.
    """
    shards = pack_shards(train, features, label, seed, shard_rows)
    weights, _ = fit_runs(shards, classes, [run_of(row) for row in grid], hidden, seed)
    widths = [shards.width, *hidden, classes]
    scores = [accuracies(part, features, label, widths, weights) for part in (validation, test)]
    rows = [(*[row[p] for p in PARAMETERS], *both) for row, *both in zip(grid, *scores, strict=True)]
    kinds = ["double", "double", "double", "int", "int", "double", "double"]
    names = [*PARAMETERS, "Validation Accuracy", SCORE]
    return train.sparkSession.createDataFrame(
        rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, kinds, strict=True)))
