"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkit.llm.components import component_roots, local_roots
from fieldkit.llm.pieces import prepare
from fieldkit.llm.tiles import TILE_ROWS, compared_blocks, in_runs, tile_pairs, whole_runs
from fieldkit.session import settle

RECALL = 0.97
BUCKET_LOAD = 64
LEAST_HASHES = 2
SEED = 20
COMPARED_AT_ONCE = 30_000_000
NAMES = 2**31 - 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, whose length is a power of two."""
    rows, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(rows, d // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, d) / np.sqrt(d)


def signatures(x: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """The buckets of each unit vector: ``hashes + 1`` in each table.

    A hash is the nearest of the signed axes after three random sign flips, each followed by a
    Hadamard transform. A bucket is one axis for each hash: the nearest of all, and as probes the same
    with the second nearest of one hash.
    """
    rows, d = x.shape
    width = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((rows, width))
    padded[:, :d] = x
    flips = np.random.default_rng([seed, width]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    found = np.empty((rows, tables, hashes + 1), dtype=np.int64)
    for table in range(tables):
        codes = np.full(rows, table, dtype=np.int64)
        changes = np.zeros((rows, hashes), dtype=np.int64)
        for h in range(hashes):
            turned = padded
            for flip in flips[table, h]:
                turned = hadamard(turned * flip)
            near = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :2]
            axis = 2 * near + (np.take_along_axis(turned, near, axis=1) < 0)
            codes = codes * (2 * width) + axis[:, 0]
            changes[:, h] = (axis[:, 1] - axis[:, 0]) * (2 * width) ** (hashes - 1 - h)
        found[:, table, 0] = codes
        found[:, table, 1:] = codes[:, None] + changes
    return found.reshape(rows, -1)


class BucketPlan(NamedTuple):
    """How vectors of one length are put into buckets."""

    tables: int
    hashes: int


@lru_cache(maxsize=4096)
def meeting_rate(dim: int, cosine: float, hashes: int, tables: int = 8, pairs: int = 500) -> float:
    """The share of random pairs at this cosine that a table puts together, by a fixed trial."""
    if dim == 1:
        return 1.0
    rng = np.random.default_rng([dim, 7])
    x, z = unit(rng.normal(size=(pairs, dim))), rng.normal(size=(pairs, dim))
    z = unit(z - x * (x * z).sum(axis=1, keepdims=True))
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * z
    a, b = (signatures(v, tables, hashes, SEED + 1).reshape(pairs, tables, -1) for v in (x, y))
    return float((a[:, :, :, None] == b[:, :, None, :]).any(axis=(2, 3)).mean())


def bucket_plan(rows: int, dim: int, threshold: float, recall: float = RECALL,
                load: int = BUCKET_LOAD) -> BucketPlan:
    """Enough hashes to spread ``rows`` vectors over buckets of about ``load``, and enough tables to find
    pairs at the threshold with chance ``recall``.

    Hashes grow with the logarithm of the rows, so the pairs to verify grow with the rows and not with
    their square; the tables that make up for it grow with the hashes.
    """
    axes = 2 * max(2, 1 << (dim - 1).bit_length())
    hashes = LEAST_HASHES
    while rows * (hashes + 1) > load * axes ** hashes:
        hashes += 1
    met = max(meeting_rate(dim, threshold, hashes), 0.0005)
    tables = 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log(1 - met))
    return BucketPlan(tables, hashes)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1 in double precision, whatever their size."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(vector: Column) -> Column:
    """Whether all components are finite numbers and not all are zero."""
    double = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(double, lambda x: x != 0.0), F.lit(False))


def _plans(classes: DataFrame, threshold: float, recall: float, load: int) -> dict[int, BucketPlan]:
    """A plan for each length of vectors, by the largest label of that length."""
    sizes = (classes.groupBy("label", F.size("embedding").alias("dim"))
             .agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(F.max("n").alias("n")))
    return {row["dim"]: bucket_plan(row["n"], row["dim"], threshold, recall, load)
            for row in sizes.collect()}


def _hashed(classes: DataFrame, plans: dict[int, BucketPlan], seed: int) -> DataFrame:
    """The vector of each class as bytes of its own kind of number, and its buckets."""
    kind = "<f4" if classes.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            raw: list = [None] * len(vectors)
            buckets: list = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = np.array([vectors[i] for i in at], dtype=kind)
                # Buckets are named by 32 bits; two of the same name are compared as one.
                found = signatures(unit(x), *plans[int(d)], seed) % NAMES
                for i, row, codes in zip(at, x, found.astype(np.int32), strict=True):
                    raw[i], buckets[i] = row.tobytes(), codes
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("class", "label", "copies")),
                 pa.array(sizes, pa.int32()), pa.array(raw, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int32()))],
                names=["class", "label", "copies", "dim", "vector", "buckets"])

    return classes.select("class", "label", "copies", "embedding").mapInArrow(
        added, "class bigint, label string, copies bigint, dim int, vector binary, "
               "buckets array<int>")


def _first_meetings(mine: np.ndarray, yours: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether a bucket is the smallest that both rows of a pair are in."""
    shared = (mine[:, :, None] == yours[:, None, :]).any(axis=2)
    return np.where(shared, mine, NAMES).min(axis=1) == bucket


def _linked(threshold: float):
    """Compares the rows of each run: links per class, and edges that join the same classes."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_runs(batches, ["run"]):
            ids, copies = frame["class"].to_numpy(), frame["copies"].to_numpy()
            bucket, dims = frame["bucket"].to_numpy(), frame["dim"].to_numpy()
            raw, sets = frame["vector"].to_numpy(), frame["buckets"].to_numpy()
            counted, edges = [], []
            for left, right, same in compared_blocks(
                    starts, len(frame), frame["is_cross"].to_numpy(), frame["is_second"].to_numpy()):
                for d in np.unique(dims[left[:, 0]]):
                    of_dim = dims[left[:, 0]] == d
                    rows, cols = left[of_dim], right[of_dim]
                    kind = f"<f{len(raw[rows[0, 0]]) // d}"
                    x, y = (unit(np.frombuffer(b"".join(raw[part.ravel()]), kind).reshape(-1, d))
                            .reshape(*part.shape, d) for part in (rows, cols))
                    g, i, j = np.nonzero(x @ y.transpose(0, 2, 1) >= threshold)
                    if same:
                        g, i, j = (k[i < j] for k in (g, i, j))
                    a, b = rows[g, i], cols[g, j]
                    step = max(1, COMPARED_AT_ONCE // len(sets[rows[0, 0]]) ** 2)
                    for p in range(0, len(a), step):
                        u, v = a[p:p + step], b[p:p + step]
                        first = _first_meetings(np.stack(sets[u]), np.stack(sets[v]), bucket[u])
                        u, v = u[first], v[first]
                        edges.append((ids[u], ids[v]))
                        counted += [(ids[u], copies[v]), (ids[v], copies[u])]
            if counted:
                who, n = (np.concatenate(x) for x in zip(*counted, strict=True))
                nodes, at = np.unique(who, return_inverse=True)
                links = np.zeros(len(nodes), dtype=np.int64)
                np.add.at(links, at, n)
                yield pd.DataFrame({"a": nodes, "b": nodes, "links": links})
                a, b = local_roots(*(np.concatenate(x) for x in zip(*edges, strict=True)))
                yield pd.DataFrame({"a": a, "b": b, "links": np.zeros(len(a), dtype=np.int64)})

    return compare


def near_vectors(rows: DataFrame, threshold: float = 0.93, id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label",
                 recall: float = RECALL, bucket_load: int = BUCKET_LOAD, seed: int = SEED,
                 tile_rows: int = TILE_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link when their labels are equal, their vectors are equally long and their cosine in double
    precision is at least ``threshold``. Candidates share a bucket in some table; every pair of a
    bucket is verified, tile by tile, and counted only in the smallest bucket its rows share. Equal
    vectors are one class, so copies cost nothing. A bucket yields link counts and the edges of a
    forest, never its pairs. The numbers of hashes and tables follow from the number of vectors
    (``bucket_plan``): buckets hold about ``bucket_load`` vectors at any size, unless these are truly
    close, and a pair at the threshold is found with a chance of about ``recall``, a closer one with more.

    A vector that is null, zero or holds a null, an infinity or not-a-number, or whose label is null,
    has no links and is its own component. A null id belongs to its group but names no component,
    so its group's ``component_id`` is the smallest other id, null if there is none; ``kept`` is
    then false. Repeated rows are vectors of their own. An empty table gives none; other columns are
    not read.
    """
    prepare(rows.sparkSession)
    read = settle(rows.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).cast("string")
        .alias("label"), F.col(vector_column).alias("embedding"))
        .withColumn("usable", F.col("label").isNotNull() & _usable(F.col("embedding"))), "vectors")
    key = ["label", "embedding"]
    classes = settle(read.filter("usable").groupBy(*key).agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()), "classes")
    plans = _plans(classes, threshold, recall, bucket_load)
    hashed = settle(_hashed(classes, plans, seed), "hashed")
    entries = hashed.select("class", "label", "dim",
                            F.explode(F.array_distinct("buckets")).alias("bucket"))
    met = settle(tile_pairs(entries, ["label", "dim", "bucket"], "class", tile_rows=tile_rows)
                 .select("run", "class", "bucket", "is_cross", "is_second"), "met")
    # Only now do the vectors come, once for each bucket that they share with another.
    found = settle(
        in_runs(met.join(hashed.drop("label"), "class"), "class")
        .mapInPandas(_linked(threshold), "a bigint, b bigint, links bigint"), "links")
    links = found.filter("links > 0").groupBy(F.col("a").alias("class")).agg(
        F.sum("links").alias("links"))
    roots = component_roots(found.filter("links = 0").select("a", "b"))
    rooted = settle(classes.select("class", "copies", "least").join(links, "class", "left").join(
        roots.withColumnsRenamed({"a": "class", "b": "root"}), "class", "left")
        .withColumn("root", F.coalesce("root", "class")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(
        "class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id")
    by_vector = settle(classes.select(*key, "class").join(named, "class").drop("class"), "named")
    linked = read.filter("usable").join(by_vector, key).select("vec_id", "n_links", "component_id")
    alone = read.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
