"""Document quality by co-training: a classifier of the text and one of the page's metadata."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.joins import checked
from fieldkit.llm.pieces import prepare
from fieldkit.session import settle

TEXT_CELLS = 512
NAME_CELLS = 24
LAYOUT_CELLS = 8
SHORT_BYTES = 64
METADATA = ("source", "lang")
MAX_LABELLED = 4000
ROUNDS = 3
ROUND_SHARE = 0.1
CONFIDENT = 0.95
RIDGE = 1.0
STEPS = 8
SMALL_STEP = 1e-3
SURE_BINS = 4096
BINS_PER_DOUBLING = 256
KEEP_FROM = 0.5
CALIBRATION_PART = 4
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_MARK = np.array([33 <= b <= 126 and not chr(b).isalnum() for b in range(256)])


def trust(raw: bytes) -> float:
    """How much a text's shares tell, from 0 for an empty one towards 1."""
    return len(raw) / (len(raw) + SHORT_BYTES)


def text_features(raw: bytes) -> np.ndarray:
    """Trust, and shares of hashed byte trigrams of a whole text, by square root."""
    counts = np.zeros(TEXT_CELLS)
    for i in range(0, len(raw), 1 << 22):  # parts overlap by two bytes, so no trigram is lost
        part = np.frombuffer(raw[i:i + (1 << 22) + 2], np.uint8).astype(np.uint32)
        if len(part) > 2:
            mixed = (part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA77)
                     ^ part[2:] * np.uint32(0xC2B2AE3D))
            counts += np.bincount(mixed >> np.uint32(23), minlength=TEXT_CELLS)
    return np.append(trust(raw), np.sqrt(counts / max(1.0, counts.sum())))


def metadata_features(raw: bytes, names: list[str | None]) -> np.ndarray:
    """Trust, where a page is from, and measures of its size and layout."""
    tags = np.zeros(NAME_CELLS * len(names))
    for i, name in enumerate(names):
        tags[i * NAME_CELLS + zlib.crc32((name or "").encode()) % NAME_CELLS] = 1.0
    n = max(1, len(raw))
    bytes_seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = raw.count(b"\n") + 1
    layout = [np.log1p(len(raw)), np.log1p(lines), np.log1p(len(raw) / lines),
              bytes_seen[_UPPER].sum() / n, bytes_seen[_DIGIT].sum() / n, bytes_seen[_MARK].sum() / n,
              len(set(words)) / max(1.0, len(words) ** 0.8), len(words) / n]
    return np.concatenate([[trust(raw)], tags, layout])


class View(NamedTuple):
    """A logistic model of one view, and what turns its score into a calibrated one."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def inside(self, x: np.ndarray) -> np.ndarray:
        """Features by how far they are from the mean; a short text's, which tell little, less."""
        return np.clip((x[:, 1:] - self.mean) / self.scale, -8.0, 8.0) * x[:, :1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (self.inside(x) @ self.weights[1:] + self.weights[0]) + self.shift


class Model(NamedTuple):
    """Both views and the prior log odds; ``views`` is empty where labels told nothing."""

    views: tuple[View, ...]
    prior: float


def sigmoid(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -35.0, 35.0)))


def _derivatives(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gradient and upper triangle of the curvature of a log likelihood, one after the other."""
    full = np.column_stack([np.ones(len(x)), x])
    p = sigmoid(full @ weights)
    curve = (full * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ full
    return np.concatenate([full.T @ (y - p), curve[np.triu_indices(len(curve))]])


def _newton(derivatives: Callable[[np.ndarray], np.ndarray], weights: np.ndarray,
            ridge: float, small: float = 0.0) -> np.ndarray:
    """Weights of a ridge logistic regression after Newton steps, until one is ``small``."""
    width = len(weights)
    penalty = np.full(width, ridge)
    penalty[0] = 1e-3
    for _ in range(STEPS):
        found = derivatives(weights)
        curve = np.zeros((width, width))
        curve[np.triu_indices(width)] = found[width:]
        curve += np.triu(curve, 1).T + np.diag(penalty)
        step = np.linalg.solve(curve, found[:width] - penalty * weights)
        weights = weights + step / max(1.0, np.abs(step).max() / 4.0)
        if np.abs(step).max() <= small:
            break
    return weights


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression, by Newton steps."""
    return _newton(lambda weights: _derivatives(x, y, weights), np.zeros(x.shape[1] + 1), ridge)


# The sum of what a function gives for parts of the pool; it takes the views and the ties of a part.
Total = Callable[[Callable[[list[np.ndarray], np.ndarray], np.ndarray]], np.ndarray]


class Lesson(NamedTuple):
    """What one view taught the other: for good and bad the least bin of surety, and the share of
    that bin that was taken."""

    teacher: int
    learner: int
    view: View
    least: tuple[tuple[int, float], ...]


def surety(score: np.ndarray) -> np.ndarray:
    """Bins of log odds, finer than any choice needs; -1 for what is not ``CONFIDENT``."""
    sure = np.log(CONFIDENT / (1 - CONFIDENT))
    bins = np.log2(np.maximum(score, sure) / sure) * BINS_PER_DOUBLING
    return np.where(score < sure, -1, np.minimum(bins, SURE_BINS - 1).astype(int))


def taught(lessons: list[Lesson], learner: int, pool: list[np.ndarray],
           ties: np.ndarray) -> np.ndarray:
    """The labels that pool rows have been given for a view; the first one given stays."""
    given = np.full(len(ties), np.nan)
    for lesson in lessons:
        if lesson.learner == learner:
            score, free = lesson.view.scores(pool[lesson.teacher]), np.isnan(given)
            for label, (least, share) in zip((1.0, 0.0), lesson.least, strict=True):
                at = surety(score if label else -score)
                given[free & (at >= 0) & ((at > least) | (at == least) & (ties < share))] = label
    return given


def _least(counts: np.ndarray, most: int) -> tuple[int, float]:
    """The least bin, and the share of it, that take ``most`` of the counted rows from the top."""
    above = np.cumsum(counts[::-1])[::-1]
    if above[0] <= most:
        return 0, 1.0
    least = int(np.flatnonzero(above >= most)[-1])
    return least, float((most - above[least] + counts[least]) / counts[least])


def _moments(pool: list[np.ndarray], ties: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(ties)], *[f(x[:, 1:]) for x in pool for f in (
        lambda v: v.sum(axis=0), lambda v: (v * v).sum(axis=0))]])


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray] | Total,
             calibrate: np.ndarray) -> Model:
    """Two views that teach each other, calibrated on the labelled rows that ``calibrate`` marks.

    In each round either view labels the pool rows it is surest of, over the whole pool, for the
    other one: ``ROUND_SHARE`` of the pool at most, in the classes' proportions. A row already given
    a label keeps it. Equally sure rows are told apart by their ties. The pool is read only as sums,
    of counts by surety and of gradients and curvatures; labels given are worked out anew each time.
    """
    if len(set(y[~calibrate])) < 2 or len(set(y[calibrate])) < 2:
        return Model((), float(y.mean()) if len(y) else 1.0)
    prior = y.mean()
    own = [x[~calibrate] for x in labelled]
    own_y = y[~calibrate]
    if callable(pool):
        total: Total = pool
    else:
        ties = np.arange(len(pool[0])) * 0.6180339887498949 % 1.0

        def total(of):
            return of(pool, ties)

    seen = total(_moments)
    size, moments = int(seen[0]), seen + _moments(own, own_y)
    views, start = [], 1
    for x in own:
        width = x.shape[1] - 1
        mean, square = moments[start:start + 2 * width].reshape(2, width) / moments[0]
        deviation = np.sqrt(np.maximum(square - mean * mean, 0.0))
        views.append(View(mean, np.maximum(deviation, 1e-3), np.zeros(width + 1)))
        start += 2 * width
    lessons: list[Lesson] = []

    def fit(view: int) -> None:
        model, known = views[view], list(lessons)

        def derivatives(weights: np.ndarray) -> np.ndarray:
            def of(pool: list[np.ndarray], ties: np.ndarray) -> np.ndarray:
                given = taught(known, view, pool, ties)
                told = ~np.isnan(given)
                return _derivatives(model.inside(pool[view][told]), given[told], weights)

            mine = _derivatives(model.inside(own[view]), own_y, weights)
            return mine + total(of) if any(x.learner == view for x in known) else mine

        views[view] = model._replace(weights=_newton(
            derivatives, model.weights, RIDGE * np.sqrt(own[view].shape[1]), SMALL_STEP))

    for _ in range(ROUNDS if size else 0):
        for teacher, learner in ((0, 1), (1, 0)):
            fit(teacher)
            view, known = views[teacher], list(lessons)

            def counts(pool: list[np.ndarray], ties: np.ndarray, teacher: int = teacher,
                       learner: int = learner, view: View = view,
                       known: list[Lesson] = known) -> np.ndarray:
                free = np.isnan(taught(known, learner, pool, ties))
                score = view.scores(pool[teacher])[free]
                bins = [surety(s) for s in (score, -score)]
                return np.concatenate([np.bincount(b[b >= 0], minlength=SURE_BINS) for b in bins])

            found = total(counts).reshape(2, SURE_BINS)
            lessons.append(Lesson(teacher, learner, view, tuple(
                _least(n, max(1, round(ROUND_SHARE * size * share)))
                for n, share in zip(found, (prior, 1 - prior), strict=True))))
    for view in range(len(labelled)):
        fit(view)
        raw = views[view]
        slope, shift = fit_logistic(raw.scores(labelled[view][calibrate])[:, None], y[calibrate],
                                    1.0)[::-1]
        views[view] = raw._replace(slope=float(max(slope, 0.0)), shift=float(shift))
    return Model(tuple(views), float(np.log(prior / (1 - prior))))


def combined(model: Model, features: list[np.ndarray]) -> np.ndarray:
    """Probability of good quality: the views' calibrated log odds, the prior counted once."""
    if not model.views:
        return np.full(len(features[0]), model.prior)
    scores = sum(v.scores(x) for v, x in zip(model.views, features, strict=True))
    return sigmoid(scores - (len(model.views) - 1) * model.prior)


def _features(batch: pa.RecordBatch, text: str, metadata: tuple[str, ...]) -> list[np.ndarray]:
    raw = [(t.as_py() or "").encode() for t in batch.column(text)]
    names = [[None if v is None else str(v) for v in batch.column(c).to_pylist()] for c in metadata]
    return [np.stack([text_features(r) for r in raw]), np.stack(
        [metadata_features(r, [column[i] for column in names]) for i, r in enumerate(raw)])]


def _sample_features(docs: DataFrame, ids: DataFrame, id_column: str, text_column: str,
                     metadata: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and features of the documents in ``ids``, whose number is bounded.

    Of an id with several rows the one that sorts first is taken, so the bound holds for rows too.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text, page = _features(batch, "_text", tuple(f"_m{i}" for i in range(len(metadata))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_good"), *(pa.array([r.astype("<f4").tobytes() for r in x],
                                                       pa.binary()) for x in (text, page))],
                    names=["good", "text", "page"])

    chosen = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"), *[
        F.col(c).cast("string").alias(f"_m{i}") for i, c in enumerate(metadata)]).join(
            F.broadcast(ids), "_id")
    page = ["_text", *[f"_m{i}" for i in range(len(metadata))]]
    one = chosen.groupBy("_id", "_good").agg(F.min(F.struct(*page)).alias("page"))
    rows = one.select("_good", "page.*").mapInArrow(made, "good double, text binary, page binary").toPandas()
    rows = rows.sort_values(["good", "text", "page"], ignore_index=True)  # order of no matter
    width = (1 + TEXT_CELLS, 1 + NAME_CELLS * len(metadata) + LAYOUT_CELLS)
    return rows["good"].to_numpy(float), [
        np.frombuffer(b"".join(rows[c]), "<f4").reshape(len(rows), w).astype(float)
        for c, w in zip(("text", "page"), width, strict=True)]


def _pool(docs: DataFrame, known: DataFrame, id_column: str, text_column: str,
          metadata: tuple[str, ...]) -> DataFrame:
    """``tie, text, page``: a number in [0, 1) and the features of every row without a label."""
    names = tuple(f"_m{i}" for i in range(len(metadata)))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text, page = _features(batch, "_text", names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("tie"),
                     pa.array([r.tobytes() for r in text.astype("<f2")], pa.binary()),
                     pa.array([r.tobytes() for r in page.astype("<f4")], pa.binary())],
                    names=["_id", "tie", "text", "page"])

    mixed = F.shiftrightunsigned(F.xxhash64(id_column, text_column), 11)
    rows = docs.select(F.col(id_column).alias("_id"), (mixed / F.lit(2.0 ** 53)).alias("tie"),
                       F.col(text_column).alias("_text"), *[
                           F.col(c).cast("string").alias(n)
                           for c, n in zip(metadata, names, strict=True)])
    kind = rows.schema["_id"].dataType.simpleString()
    # Features are smaller than texts, so they are what moves where the labels are many.
    return rows.mapInArrow(made, f"_id {kind}, tie double, text binary, page binary").join(
        checked(known.select("_id")), "_id", "left_anti").drop("_id")


def _total_over(pool: DataFrame, sizes: tuple[int, int]) -> Total:
    """Sums over all rows of a settled pool, added within tasks, then in groups of tasks."""
    tasks = max(1, min(pool.rdd.getNumPartitions(),
                       2 * pool.sparkSession.sparkContext.defaultParallelism))
    groups = isqrt(tasks)

    def total(of: Callable[[list[np.ndarray], np.ndarray], np.ndarray]) -> np.ndarray:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = None
            for batch in batches:
                if batch.num_rows:
                    views = [np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(
                        -1, n).astype(float) for c, kind, n in zip(
                            ("text", "page"), ("<f2", "<f4"), sizes, strict=True)]
                    part = of(views, batch.column("tie").to_numpy()).astype(float)
                    done = part if done is None else done + part
            if done is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId() % groups], pa.int32()),
                     pa.array([done.tobytes()], pa.binary())], names=["part", "sums"])

        def merged(table: pa.Table) -> pa.Table:
            done = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
            return pa.table({"sums": pa.array([done.tobytes()], pa.binary())})

        rows = pool.coalesce(tasks).mapInArrow(summed, "part int, sums binary").groupBy(
            "part").applyInArrow(merged, "sums binary").collect()
        if not rows:
            return of([np.zeros((0, n)) for n in sizes], np.zeros(0))
        return sum(np.frombuffer(row.sums) for row in rows)

    return total


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", metadata: tuple[str, ...] = METADATA,
          max_labelled: int = MAX_LABELLED, max_pool: int | None = None) -> Model:
    """Co-train on up to ``max_labelled`` labelled and on all unlabelled documents.

    The labelled ones are those of the smallest hashes of the id, so the sample does not depend on
    how the tables are dealt out. An id with labels of both kinds is unlabelled, and so is a null
    id; each row of the pool counts. ``max_pool`` bounds the pool where that is wanted.
    """
    prepare(docs.sparkSession)
    known = settle(
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(label_column).alias("low"), F.max(label_column).alias("high"))
        .filter("low = high").select("_id", (F.col("low") > 0).cast("double").alias("_good")),
        "labels")
    ids = docs.select(F.col(id_column).alias("_id")).filter("_id IS NOT NULL").distinct()
    labelled = known.join(ids, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(
        max_labelled)
    y, views = _sample_features(docs, settle(labelled, "sample"), id_column, text_column, metadata)
    calibrate = np.arange(len(y)) % CALIBRATION_PART == 0
    if len(set(y[~calibrate])) < 2 or len(set(y[calibrate])) < 2:  # the pool would not be read
        return co_train(views, y, [v[:0] for v in views], calibrate)
    pool = _pool(docs, known, id_column, text_column, metadata)
    if max_pool is not None:
        pool = pool.orderBy("tie", "text", "page").limit(max_pool)
    return co_train(views, y, _total_over(settle(pool, "pool"), tuple(v.shape[1] for v in views)),
                    calibrate)


def score_documents(docs: DataFrame, model: Model, id_column: str = "doc_id",
                    text_column: str = "text", metadata: tuple[str, ...] = METADATA,
                    keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, quality_score, text_score, page_score, kept`` of every row and whole text.

    Scores are probabilities of good quality, the first from both views. A null text is scored as an
    empty one, null metadata as an empty name; a null id stays null; repeated rows each give a row;
    an empty table gives none; other columns are not read. Without labels of both kinds all scores
    are the share of good labels (1 without any), and so every row is kept or none.
    """
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = tuple(f"_m{i}" for i in range(len(metadata)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            features = _features(batch, "_text", names)
            both = combined(sent.value, features)
            single = [sigmoid(v.scores(x)) for v, x in zip(sent.value.views, features, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(s) for s in [both, *(single or [both, both])]),
                 pa.array(both >= keep_from)],
                names=["doc_id", "quality_score", "text_score", "page_score", "kept"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).alias("_text"), *[
                           F.col(c).cast("string").alias(n)
                           for c, n in zip(metadata, names, strict=True)]).mapInArrow(
        scored, "doc_id bigint, quality_score double, text_score double, page_score double, "
                "kept boolean")


def good_documents(docs: DataFrame, model: Model, text_column: str = "text",
                   metadata: tuple[str, ...] = METADATA,
                   keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with all their columns."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = combined(sent.value, _features(batch, text_column, metadata)) >= keep_from
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(kept, docs.schema)
