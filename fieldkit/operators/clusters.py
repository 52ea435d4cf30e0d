"""Points in many dimensions: scaling, PCA, silhouette, and what describes each cluster."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.functions.scalars import array_columns, bucket, count_above, estimated_shape
from fieldkit.functions.text import float_list_text


def as_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Number columns into one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def array_as_vector(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """Array column into a vector column."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def vector_columns(df: DataFrame, vector: str, names: Sequence[str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Vector column into one column per dimension, in one projection."""
    return (df.withColumn("_values", vector_to_array(vector))
            .select(*keep, *array_columns(F.col("_values"), names)))


def standardize(df: DataFrame, vector: str = "features",
                output: str = "scaledFeatures") -> DataFrame:
    """Subtract the mean and divide by the sample deviation; a constant dimension becomes 0."""
    scaler = StandardScaler(inputCol=vector, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)


def scale_columns(df: DataFrame, columns: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Standardise plain number columns into ``outputs``, as ``standardize`` does a vector.

    Means and deviations come from one aggregation and enter the projection as literals.
    """
    found = df.agg(*[f(c) for c in columns for f in (F.avg, F.stddev_samp)]).first()
    scaled = {}
    for i, (column, output) in enumerate(zip(columns, outputs)):
        mean, deviation = found[2 * i], found[2 * i + 1]
        centred = F.col(column) - F.lit(mean)
        scaled[output] = centred / F.lit(deviation) if deviation else centred * F.lit(0.0)
    return df.withColumns(scaled)


def fit_pca(df: DataFrame, components: int = 3, vector: str = "scaledFeatures",
            output: str = "pcaFeatures") -> PCAModel:
    """Principal components of a vector column."""
    return PCA(k=components, inputCol=vector, outputCol=output).fit(df)


def pca_variance(df: DataFrame, model: PCAModel) -> DataFrame:
    """Explained variance ratio per component, 1-based; one row per component of the model."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double")


def silhouette(df: DataFrame, vector: str = "pcaFeatures", label: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums in linear time."""
    return ClusteringEvaluator(predictionCol=label, featuresCol=vector,
                               metricName="silhouette").evaluate(df)


def cluster_labels(df: DataFrame, label: str = "prediction") -> DataFrame:
    """The different cluster labels."""
    return df.select(F.col(label).alias("cluster")).distinct()


def _pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def covariances(columns: Sequence[str]) -> list[Column]:
    """Sample covariance of each pair of columns as ``cov_<a>_<b>``, to aggregate by."""
    return [F.covar_samp(a, b).alias(f"cov_{a}_{b}") for a, b in _pairs(columns)]


def cluster_covariance(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of each pair of columns per cluster, ``cov_<a>_<b>``, in one pass."""
    return df.groupBy(F.col(label).alias("cluster")).agg(*covariances(columns))


def explained_variance(covariances: DataFrame, columns: Sequence[str],
                       keep: Sequence[str] = ("cluster",)) -> DataFrame:
    """Falling variance ratios of each row's covariance matrix, as ``ratios array<double>``.

    The input has one small row per cluster. Spark has no eigenvalue function for columns, so
    these rows go through Arrow batches where they are, without a shuffle. A cluster without
    any variance, or of one point, has null ratios.
    """
    width = len(columns)
    upper = np.triu_indices(width)
    names = [f"cov_{a}_{b}" for a, b in _pairs(columns)]

    def ratios(values: np.ndarray) -> list[float] | None:
        if np.isnan(values).any():
            return None
        matrix = np.zeros((width, width))
        matrix[upper] = values
        matrix = matrix + np.triu(matrix, 1).T
        spread = np.clip(np.linalg.eigvalsh(matrix)[::-1], 0.0, None)
        return (spread / spread.sum()).tolist() if spread.sum() > 0 else None

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[names].to_numpy(dtype=float)
            yield batch[list(keep)].assign(ratios=[ratios(row) for row in values])

    fields = [f"`{c}` {covariances.schema[c].dataType.simpleString()}" for c in keep]
    return (covariances.select(*keep, *names)
            .mapInPandas(solve, ", ".join([*fields, "ratios array<double>"])))


def primary_dimensions(ratios: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Count the variance ratios over ``threshold``."""
    return ratios.withColumn("dimensions", count_above(F.col("ratios"), threshold))


def cluster_profile(df: DataFrame, label: str, original: Sequence[str],
                    scaled: Sequence[str] = ()) -> DataFrame:
    """Points, centres, ranges and size of every cluster from one aggregation.

    ``points``, ``mean_<c>`` for all columns, ``range_<c>`` for the original ones, ``size``, the
    sum of the ranges, and ``extent``, the largest. Means and ranges are rounded to two decimals
    before they are added.
    """
    ranges = [bucket(F.max(c) - F.min(c), 2).alias(f"range_{c}") for c in original]
    profile = df.groupBy(F.col(label).alias("cluster")).agg(
        F.count(F.lit(1)).alias("points"),
        *[bucket(F.avg(c), 2).alias(f"mean_{c}") for c in [*original, *scaled]],
        *ranges)
    return _with_size(profile, original)


def _with_size(profile: DataFrame, original: Sequence[str]) -> DataFrame:
    spans = [F.col(f"range_{c}") for c in original]
    total = spans[0]
    for span in spans[1:]:
        total = total + span
    return profile.withColumn("size", total).withColumn(
        "extent", F.greatest(*spans) if len(spans) > 1 else spans[0])


def cluster_shape(profile: DataFrame, original: Sequence[str]) -> DataFrame:
    """Add the shape implied by ``dimensions`` and the first three ranges."""
    return profile.withColumn("shape", estimated_shape(
        F.col("dimensions"), [F.col(f"range_{c}") for c in original]))


def describe_clusters(df: DataFrame, label: str, original: Sequence[str],
                      scaled: Sequence[str]) -> DataFrame:
    """Profile, variance ratios, primary dimensions and shape per cluster.

    ``scaled`` are the standardised ``original`` columns, in the same order. One aggregation of
    the points gives everything; what follows works on one row per cluster. Covariances are Spark's
    own, which keep their precision in a cluster that is tight against its distance from zero.
    """
    every = [*original, *scaled]
    sums = df.groupBy(F.col(label).alias("cluster")).agg(
        F.count(F.lit(1)).alias("points"), *[F.avg(c).alias(f"avg_{c}") for c in every],
        *[f(c).alias(f"{f.__name__}_{c}") for c in original for f in (F.min, F.max)],
        *covariances(scaled))
    profile = sums.withColumns(
        {f"mean_{c}": bucket(F.col(f"avg_{c}"), 2) for c in every}
        | {f"range_{c}": bucket(F.col(f"max_{c}") - F.col(f"min_{c}"), 2) for c in original})
    plain = ["cluster", "points", *[f"mean_{c}" for c in every], *[f"range_{c}" for c in original]]
    solved = primary_dimensions(explained_variance(profile, scaled, plain))
    return cluster_shape(_with_size(solved, original), original)


def _arrays(prefix: str, columns: Sequence[str]):
    return F.array(*[F.col(f"{prefix}_{c}") for c in columns])


# Columns of the summary table, labels of the report, and the orientation entry.
SUMMARY_COLUMNS = ["Object", "Dimension", "Estimated Shape", "Ranges in each Dim.", "Size/Spr",
                   "Location (original)", "Location (normalized)", "Orientation", "Points"]
REPORT_LABELS = ["Object (Cluster ", "Location (mean, normalized): ", "Location (mean, original): ",
                 "Size (variance per dimension): ", "Primary Dimensions: ", "Shape: ",
                 "Dimension Ranges: ", "Points: "]
NO_ORIENTATION = "NA/not attempted"


def cluster_summary(described: DataFrame, original: Sequence[str],
                    scaled: Sequence[str]) -> DataFrame:
    """One row per cluster with the nine columns of the summary table."""
    dimensions = F.coalesce("dimensions", F.lit(0)).cast("string")
    values = [F.concat(F.lit("Cluster "), F.col("cluster").cast("string")),
              F.concat(dimensions, F.lit("D")), F.col("shape"), _arrays("range", original),
              F.col("size"), _arrays("mean", original), _arrays("mean", scaled),
              F.lit(NO_ORIENTATION), F.col("points")]
    return described.select(*[v.alias(name) for v, name in zip(values, SUMMARY_COLUMNS)])


def cluster_report(described: DataFrame, original: Sequence[str], scaled: Sequence[str],
                   decimals: int = 6) -> DataFrame:
    """One block of labelled text lines per cluster, for a text sink."""
    ratios = F.transform("ratios", lambda r: bucket(r, decimals))
    texts = [F.concat(F.col("cluster").cast("string"), F.lit("):")),
             float_list_text(_arrays("mean", scaled)), float_list_text(_arrays("mean", original)),
             F.coalesce(float_list_text(ratios), F.lit("[]")),
             F.coalesce("dimensions", F.lit(0)).cast("string"), F.col("shape"),
             float_list_text(_arrays("range", original)),
             F.concat(F.col("points").cast("string"), F.lit("\n"))]
    lines = [F.concat(F.lit(label), text) for label, text in zip(REPORT_LABELS, texts)]
    return described.select("cluster", F.concat_ws("\n", *lines).alias("line"))


def cluster_projection(df: DataFrame, vector: str = "pcaFeatures", label: str = "prediction",
                       dims: int = 3) -> DataFrame:
    """Each point's first two or three components beside its cluster, for plotting."""
    if dims not in (2, 3):
        raise ValueError(f"a plot has two or three dimensions, not {dims}")
    return (df.withColumn("_values", vector_to_array(vector))
            .select(F.col(label).alias("cluster"),
                    *array_columns(F.col("_values"), ["x", "y", "z"][:dims])))


def projection_density(points: DataFrame, widths: dict[str, float],
                       label: str = "cluster") -> DataFrame:
    """Points per cell of a plot grid, so a plot needs cells and not all points."""
    cells = [F.floor(F.col(c) / F.lit(float(w))).alias(f"{c}_bin") for c, w in widths.items()]
    return points.groupBy(F.col(label).alias("cluster"), *cells).agg(
        F.count(F.lit(1)).alias("points"))
