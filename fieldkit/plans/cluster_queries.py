"""Points, scaling, clusters and their description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.functions.scalars import count_above, scale_array
from fieldkit.functions.text import float_text
from fieldkit.operators import clusters as C
from fieldkit.operators import kmeans as K
from fieldkit.plans.stand_ins import (BLOB_COLUMNS, POINT_COLUMNS, POINTS_SQL, Query, blobs,
                                      blobs_sql, points, table)
from fieldkit.session import new_path, settle
from fieldkit.sources.places import is_point, reject_places
from fieldkit.sources.readers import Parsed, read_images, read_points
from fieldkit.sources.records import read_image_records
from fieldkit.sources.writers import write_lines, write_profile, write_projection

SCALED = [f"s{i}" for i in range(len(POINT_COLUMNS))]


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Points written as lines with commas and spaces, and parsed again."""
    return _read_back(spark, points(spark, folder).select(_point_line().alias("line"))).rows


def _point_line() -> Column:
    return F.concat_ws(",  ", *[float_text(F.col(c)) for c in POINT_COLUMNS])


def _read_back(spark: SparkSession, lines: DataFrame) -> Parsed:
    """Point lines written to files and read from there."""
    path = new_path(spark, "point-lines")
    write_lines(lines, path)
    return read_points(spark, path, len(POINT_COLUMNS))


# What is put behind every so many lines, by order number; each makes the line a reject.
_BROKEN = {7: " 5d", 11: " NaN", 13: " 0x1p3", 17: " 1.0", 19: " words"}


def _point_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which some are broken by their order's number, in their own order."""
    ends = F.concat(*[F.when(F.col("l_orderkey") % n == 0, F.lit(text)).otherwise("")
                      for n, text in _BROKEN.items()])
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, folder, "lineitem").select(*parts, F.concat(
        F.concat_ws(" ", *parts, F.lit("0.5,"), F.lit(",-1e3")), ends).alias("line"))


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that give no point."""
    return _read_back(spark, _point_lines(spark, folder).select("line")).rejects


def _reject_places(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each line that gives no point, of lines written in order."""
    path = new_path(spark, "ordered-lines")
    lines = _point_lines(spark, folder).orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    write_lines(lines, path)
    found = reject_places(spark.read.text(path), is_point(len(POINT_COLUMNS)))
    return found.select("row", "value")


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    """Original and scaled columns with the given label."""
    return C.scale_columns(points(spark, folder), POINT_COLUMNS, SCALED)


def _scaled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return C.as_vector(_scaled(spark, folder), SCALED, "scaledFeatures")


def _round(df: DataFrame, decimals: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, decimals) for n in names})


def _standardized(spark: SparkSession, folder: str) -> DataFrame:
    return _round(_scaled(spark, folder).select(*SCALED, "label"), 6, *SCALED)


def _standardized_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = C.standardize(C.as_vector(points(spark, folder), POINT_COLUMNS))
    return _round(C.vector_columns(vectors, "scaledFeatures", SCALED, ["label"]), 6, *SCALED)


def _covariance(spark: SparkSession, folder: str) -> DataFrame:
    found = C.cluster_covariance(_scaled(spark, folder), "label", SCALED)
    return _round(found, 6, *[c for c in found.columns if c.startswith("cov_")])


def _ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Variance ratios and primary dimensions per cluster."""
    found = C.explained_variance(
        C.cluster_covariance(_scaled(spark, folder), "label", SCALED), SCALED)
    return C.primary_dimensions(found)


def _variance(spark: SparkSession, folder: str) -> DataFrame:
    return _ratios(spark, folder).select(
        "cluster", F.transform("ratios", lambda r: F.round(r, 6)).alias("ratios"))


def _described(spark: SparkSession, folder: str) -> DataFrame:
    return C.describe_clusters(_scaled(spark, folder), "label", POINT_COLUMNS, SCALED)


def _shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Shape of each cluster for each possible number of dimensions."""
    profile = C.cluster_profile(points(spark, folder), "label", POINT_COLUMNS)
    each = profile.withColumn("dimensions", F.explode(F.sequence(F.lit(1), F.lit(4))))
    return C.cluster_shape(each, POINT_COLUMNS).select("cluster", "dimensions", "shape")


def _pca(spark: SparkSession, folder: str) -> DataFrame:
    scaled = _scaled_vectors(spark, folder)
    found = C.pca_variance(scaled, C.fit_pca(scaled, 3))
    return _round(found, 6, "ratio")


def _reduced(spark: SparkSession, folder: str) -> DataFrame:
    """Points with their original, scaled and three principal components, settled."""
    scaled = _scaled_vectors(spark, folder)
    return settle(C.fit_pca(scaled, 3).transform(scaled), "reduced")


def _blobs(spark: SparkSession, folder: str) -> DataFrame:
    """Separated points with their scaled columns and three principal components, settled."""
    scaled = C.scale_columns(blobs(spark, folder), BLOB_COLUMNS, SCALED)
    vectors = C.as_vector(scaled, SCALED, "scaledFeatures")
    return settle(C.fit_pca(vectors, 3).transform(vectors), "blobs")


def _hunt(spark: SparkSession, folder: str) -> DataFrame:
    """Scale, reduce, try each k, keep the best and describe its clusters.

    Cluster numbers depend on the fit and are left out.
    """
    reduced = _blobs(spark, folder)
    _, best = K.kmeans_sweep(reduced)
    described = C.describe_clusters(best.transform(reduced), "prediction", BLOB_COLUMNS, SCALED)
    return C.cluster_summary(described, BLOB_COLUMNS, SCALED).drop("Object")


def _best_k(spark: SparkSession, folder: str) -> DataFrame:
    """The best k on the scaled points themselves, with its scores."""
    table_of_k, _ = K.kmeans_sweep(_blobs(spark, folder), vector="scaledFeatures")
    return _round(table_of_k.filter("is_best"), 4, "silhouette", "cost").drop("is_best")


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """Points with the cluster that k-means puts them in, named by the flag most of it has.

    The names, one row per cluster, go to all tasks. A join by shuffle would send every point to as
    many tasks as there are clusters.
    """
    reduced = _blobs(spark, folder)
    assigned = settle(K.fit_kmeans(reduced, 3).transform(reduced), "assigned")
    names = assigned.groupBy("prediction").agg(F.mode("label", True).alias("cluster"))
    return assigned.join(F.broadcast(names), "prediction")


def _axes(spark: SparkSession, folder: str) -> DataFrame:
    """Size of each point's first three components; their signs are arbitrary."""
    parts = C.cluster_projection(_reduced(spark, folder), label="label")
    return parts.select("cluster", *[F.round(F.abs(c), 4).alias(c) for c in "xyz"])


def _projection(spark: SparkSession, folder: str) -> DataFrame:
    """Plot points written with one folder per cluster and read back.

    Sizes of components only, since their signs are arbitrary.
    """
    path = new_path(spark, "projection")
    write_projection(C.cluster_projection(_named(spark, folder), label="cluster", dims=2), path)
    return spark.read.parquet(path).select(
        "cluster", *[F.round(F.abs(c), 4).alias(c) for c in "xy"])


def _profile_file(spark: SparkSession, folder: str) -> DataFrame:
    """The profile written as JSON and read back."""
    path = new_path(spark, "profile")
    profile = C.cluster_profile(points(spark, folder), "label", POINT_COLUMNS)
    write_profile(profile, path)
    return spark.read.schema(profile.schema).json(path)


def _report_file(spark: SparkSession, folder: str) -> DataFrame:
    """The report written as text, and its lines read back."""
    path = new_path(spark, "report")
    write_lines(_report(spark, folder), path)
    return spark.read.text(path).filter("value <> ''").withColumnRenamed("value", "line")


def _images(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors written as labelled images, read back and scaled."""
    path = new_path(spark, "images")
    table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").alias("pixels")).write.parquet(path)
    return read_images(spark, path).select(
        F.col("id").alias("vec_id"), "label", F.transform(
            scale_array(F.col("pixels")), lambda x: F.round(x, 8)).alias("pixels"))


def _image_records(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors written as records of a label byte, a byte per number and a line feed, and read back."""
    path, size = new_path(spark, "image-records"), 64
    byte = F.transform("embedding", lambda x: F.char(
        F.pmod(F.floor(x.cast("double") * 1000), F.lit(95)) + 32))
    write_lines(table(spark, folder, "embeddings").filter(F.size("embedding") == size).select(
        F.concat(F.char(F.col("label") + 48), F.array_join(byte, "")).alias("line")), path)
    return read_image_records(spark, path, size, padding=1)


def _silhouette(spark: SparkSession, folder: str) -> DataFrame:
    vectors = C.array_as_vector(table(spark, folder, "embeddings"), "embedding")
    score = C.silhouette(vectors, "features", "label")
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def _density(spark: SparkSession, folder: str) -> DataFrame:
    placed = points(spark, folder).select(
        "label", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return C.projection_density(placed, {"x": 5.0, "y": 5000.0}, "label")


def _scaled_sql(columns: list[str], source: str, members: str) -> str:
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(columns))
    scaled = ", ".join(f"({c} - m{i})/d{i} AS s{i}" for i, c in enumerate(columns))
    return f"""{members}, stats AS (SELECT {stats} FROM {source}),
      scaled AS (SELECT {source}.*, {scaled} FROM {source}, stats)"""


_SCALED_SQL = _scaled_sql(POINT_COLUMNS, "points", POINTS_SQL)
_STANDARDIZED_SQL = f"""WITH {_SCALED_SQL} SELECT label,
  {", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in SCALED)} FROM scaled"""
_PAIRS = [(a, b) for i, a in enumerate(SCALED) for b in SCALED[i:]]


def jacobi_sql(matrices: str, width: int, sweeps: int = 10, vectors: bool = False) -> str:
    """``WITH`` members that turn ``matrices(cluster, a)`` into ``ratios(cluster, ratios)``.

    ``a`` is a symmetric matrix as one list. Cyclic Jacobi rotations bring it to a diagonal, whose
    sorted shares are the explained variance ratios. With ``vectors``, ``picked`` also keeps the
    product of the rotations, whose columns are the eigenvectors.
    """
    pairs = [(p, q) for p in range(width) for q in range(p + 1, width)]
    ps, qs = [p for p, _ in pairs], [q for _, q in pairs]
    steps, cells, n = len(pairs) * sweeps, width * width, width
    diagonal = ", ".join(f"a[{i * n + i + 1}]" for i in range(n))

    def turned(m: str) -> str:
        return f"""list_transform(range({cells}), lambda x:
          CASE x % {n} WHEN p THEN c*{m}[x//{n}*{n}+p+1] - s*{m}[x//{n}*{n}+q+1]
            WHEN q THEN s*{m}[x//{n}*{n}+p+1] + c*{m}[x//{n}*{n}+q+1] ELSE {m}[x+1] END)"""

    unit = [float(i == j) for i in range(n) for j in range(n)] if vectors else [0.0]
    return f"""picked(cluster, step, a, v) AS (
      SELECT cluster, 0, a, {unit}::DOUBLE[] FROM {matrices}
      UNION ALL
      SELECT cluster, step + 1, {turned("r")}, {turned("v") if vectors else "v"}
      FROM (SELECT *, list_transform(range({cells}), lambda x:
        CASE x // {n} WHEN p THEN c*a[p*{n}+x%{n}+1] - s*a[q*{n}+x%{n}+1]
                      WHEN q THEN s*a[p*{n}+x%{n}+1] + c*a[q*{n}+x%{n}+1] ELSE a[x+1] END) AS r
      FROM (SELECT *, t/sqrt(t*t + 1) AS s, 1/sqrt(t*t + 1) AS c
      FROM (SELECT *, CASE WHEN a[p*{n}+q+1] = 0 THEN 0.0::DOUBLE
        WHEN theta >= 0 THEN 1/(theta + sqrt(theta*theta + 1))
        ELSE -1/(-theta + sqrt(theta*theta + 1)) END AS t
      FROM (SELECT *, CASE WHEN a[p*{n}+q+1] = 0 THEN 0.0::DOUBLE
        ELSE (a[q*{n}+q+1] - a[p*{n}+p+1]) / (2*a[p*{n}+q+1]) END AS theta
      FROM (SELECT cluster, step, a, v, ({ps})[step % {len(pairs)} + 1] AS p,
        ({qs})[step % {len(pairs)} + 1] AS q FROM picked WHERE step < {steps})))))),
    spread AS (SELECT cluster, list_reverse_sort([{diagonal}]) AS d FROM picked
      WHERE step = {steps}),
    ratios AS (SELECT cluster, list_transform(d, lambda x: x/list_sum(d)) AS ratios FROM spread)"""


def _matrix_sql(columns: list[str], group: str = "") -> str:
    cells = ", ".join(f"covar_samp({a}, {b})" for a in columns for b in columns)
    return (f"matrices AS (SELECT {'label' if group else '0'} AS cluster, [{cells}] AS a "
            f"FROM scaled {group})")


def _ratios_sql(scaled: str) -> str:
    return (f"WITH RECURSIVE {scaled}, {_matrix_sql(SCALED, 'GROUP BY label')}, "
            f"{jacobi_sql('matrices', len(SCALED))}")


_RATIOS_SQL = _ratios_sql(_SCALED_SQL)


def _profile_sql(columns: list[str], source: str, scaled: list[str] = ()) -> str:
    # adding zero turns -0.0 into 0.0, which is how decimal rounding gives it
    means = [f"round_even(avg({c}), 2) + 0.0::DOUBLE AS mean_{c}" for c in [*columns, *scaled]]
    ranges = [f"round_even(max({c}) - min({c}), 2) AS range_{c}" for c in columns]
    spans = [f"range_{c}" for c in columns]
    return f"""profile AS (SELECT *, {" + ".join(spans)} AS size,
      greatest({", ".join(spans)}) AS extent
      FROM (SELECT label AS cluster, COUNT(*) AS points, {", ".join([*means, *ranges])}
      FROM {source} GROUP BY label))"""


def _shape_sql(columns: list[str]) -> str:
    a, b, c = (f"range_{name}" for name in columns[:3])
    near = " AND ".join(f"abs({x} - {a}) <= 1e-8::DOUBLE + 0.2::DOUBLE*abs({a})" for x in (b, c))
    return f"""CASE WHEN dimensions IS NULL THEN 'Point' WHEN dimensions = 1 THEN 'Line'
      WHEN dimensions = 2 THEN 'Plane or Disk'
      WHEN dimensions = 3 AND {near} THEN 'Sphere or Cube/Cuboid'
      WHEN dimensions = 3 THEN 'Ellipsoid or Rectangular Prism'
      ELSE 'Higher-dimensional shape' END"""


def _described_sql(columns: list[str], scaled: str) -> str:
    return f"""{_ratios_sql(scaled)}, {_profile_sql(columns, "scaled", SCALED)},
      described AS (SELECT *, {_shape_sql(columns)} AS shape
      FROM (SELECT profile.*, ratios, CAST(len(list_filter(ratios, lambda x: x > 0.1::DOUBLE))
      AS INTEGER) AS dimensions FROM profile JOIN ratios USING (cluster)))"""


_DESCRIBED_SQL = _described_sql(POINT_COLUMNS, _SCALED_SQL)


def _list_sql(prefix: str, columns: list[str]) -> str:
    return "[" + ", ".join(f"{prefix}_{c}" for c in columns) + "]"


def _list_text(values: str) -> str:
    return (f"'[' || array_to_string(list_transform({values}, lambda x: CAST(x AS VARCHAR)), ', ')"
            " || ']'")


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return C.cluster_report(_described(spark, folder), POINT_COLUMNS, SCALED, decimals=6)


_REPORT_SQL = f"""{_DESCRIBED_SQL} SELECT cluster, concat_ws(chr(10),
  'Object (Cluster ' || cluster || '):',
  'Location (mean, normalized): ' || {_list_text(_list_sql("mean", SCALED))},
  'Location (mean, original): ' || {_list_text(_list_sql("mean", POINT_COLUMNS))},
  'Size (variance per dimension): ' ||
    {_list_text("list_transform(ratios, lambda y: round_even(y, 6))")},
  'Primary Dimensions: ' || CAST(dimensions AS VARCHAR),
  'Shape: ' || shape,
  'Dimension Ranges: ' || {_list_text(_list_sql("range", POINT_COLUMNS))},
  'Points: ' || CAST(points AS VARCHAR) || chr(10)) AS line FROM described"""

def _summary_sql(columns: list[str]) -> str:
    return f"""CAST(dimensions AS VARCHAR) || 'D' AS "Dimension", shape AS "Estimated Shape",
      {_list_sql("range", columns)} AS "Ranges in each Dim.", size AS "Size/Spr",
      {_list_sql("mean", columns)} AS "Location (original)",
      {_list_sql("mean", SCALED)} AS "Location (normalized)",
      'NA/not attempted' AS "Orientation", points AS "Points" FROM described"""


_SILHOUETTE_SQL = """WITH pairs AS (SELECT a.vec_id, a.label AS own, b.label AS other,
  list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])**2 AS dist, a.vec_id = b.vec_id AS self
  FROM embeddings a, embeddings b),
  means AS (SELECT vec_id, own, other, sum(dist) AS total, COUNT(*) AS n FROM pairs GROUP BY ALL),
  sides AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN total/(n - 1) END) AS a,
  max(CASE WHEN own = other THEN n END) AS n, min(CASE WHEN own <> other THEN total/n END) AS b
  FROM means GROUP BY vec_id)
  SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a)/greatest(a, b) END), 6) AS silhouette
  FROM sides"""

_BLOBS_SQL = _scaled_sql(BLOB_COLUMNS, "blobs", blobs_sql())


def _best_k_sql() -> str:
    """Scores of the clustering by flag, from per-cluster sums."""
    square = " + ".join(f"{c}*{c}" for c in SCALED)
    sums = ", ".join(f"sum({c}) AS t_{c}" for c in SCALED)
    dot = " + ".join(f"p.{c}*k.t_{c}" for c in SCALED)
    cost = " + ".join(f"var_pop({c})*COUNT(*)" for c in SCALED)
    return f"""WITH {_BLOBS_SQL}, p AS (SELECT *, {square} AS q, row_number() OVER () AS id FROM scaled),
      k AS (SELECT label AS other, COUNT(*) AS n, sum(q) AS tq, {sums} FROM p GROUP BY label),
      d AS (SELECT id, label, other, n, n*q + tq - 2*({dot}) AS total FROM p, k),
      sides AS (SELECT id, max(CASE WHEN label = other THEN total/(n - 1) END) AS a,
      min(CASE WHEN label <> other THEN total/n END) AS b FROM d GROUP BY id)
      SELECT CAST(3 AS INTEGER) AS k, round(avg((b - a)/greatest(a, b)), 4) AS silhouette,
      (SELECT round(sum(c), 4) FROM (SELECT {cost} AS c FROM scaled GROUP BY label)) AS cost
      FROM sides"""


def _axes_sql(members: str = _SCALED_SQL, axes: str = "xyz") -> str:
    """Eigenvectors of the correlation matrix by the same rotations, applied to each point."""
    n = len(SCALED)
    order = ("list_sort([" + ", ".join(
        f"{{'l': a[{i * n + i + 1}], 'v': [" + ", ".join(f"v[{j * n + i + 1}]" for j in range(n))
        + "]}" for i in range(n)) + "], 'DESC')")
    parts = ", ".join(
        "round(abs(" + " + ".join(f"{c}*e[{k}].v[{j + 1}]" for j, c in enumerate(SCALED))
        + f"), 4) AS {axis}" for k, axis in enumerate(axes, 1))
    return f"""WITH RECURSIVE {members}, {_matrix_sql(SCALED)},
      {jacobi_sql("matrices", n, vectors=True)},
      axes AS (SELECT {order} AS e FROM picked WHERE step = (SELECT max(step) FROM picked))
      SELECT label AS cluster, {parts} FROM scaled, axes"""


_LINE_SQL = "concat_ws(' ', l_orderkey, l_linenumber, l_partkey, l_suppkey, '0.5,', ',-1e3') || " + " || ".join(
    f"CASE WHEN l_orderkey % {n} = 0 THEN '{text}' ELSE '' END" for n, text in _BROKEN.items())
_BROKEN_SQL = "(" + " OR ".join(f"l_orderkey % {n} = 0" for n in _BROKEN) + ")"

QUERIES = {
    "parse_points": Query(
        _parsed, f"""WITH {POINTS_SQL} SELECT [{", ".join(POINT_COLUMNS)}] AS features
        FROM points"""),
    "vector_columns": Query(
        lambda s, d: C.vector_columns(C.as_vector(points(s, d), POINT_COLUMNS), "features",
                                      POINT_COLUMNS, ["label"]),
        f"WITH {POINTS_SQL} SELECT * FROM points"),
    "pixel_scale": Query(
        lambda s, d: table(s, d, "embeddings").select(
            "vec_id", "label", F.transform(scale_array(F.col("embedding")),
                                           lambda x: F.round(x, 8)).alias("pixels")),
        """SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE/255, 8))
        AS pixels FROM embeddings"""),
    "count_above": Query(
        lambda s, d: table(s, d, "embeddings").select(
            "vec_id", count_above(F.col("embedding"), 0.1).alias("n")),
        """SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x::DOUBLE > 0.1::DOUBLE))
        AS INTEGER) AS n FROM embeddings"""),
    "standardize": Query(_standardized_vectors, _STANDARDIZED_SQL),
    "scale_columns": Query(_standardized, _STANDARDIZED_SQL),
    "cluster_labels": Query(
        lambda s, d: C.cluster_labels(table(s, d, "embeddings"), "label"),
        "SELECT DISTINCT label AS cluster FROM embeddings"),
    "cluster_profile": Query(
        lambda s, d: C.cluster_profile(points(s, d), "label", POINT_COLUMNS),
        f"WITH {POINTS_SQL}, {_profile_sql(POINT_COLUMNS, "points")} SELECT * FROM profile"),
    "cluster_covariance": Query(
        _covariance, f"""WITH {_SCALED_SQL} SELECT label AS cluster, {", ".join(
            f"round(covar_samp({a}, {b}), 6) + 0.0::DOUBLE AS cov_{a}_{b}" for a, b in _PAIRS)}
        FROM scaled GROUP BY label"""),
    "cluster_variance": Query(
        _variance, f"""{_RATIOS_SQL} SELECT cluster,
        list_transform(ratios, lambda x: round(x, 6)) AS ratios FROM ratios"""),
    "primary_dimensions": Query(
        lambda s, d: _ratios(s, d).select("cluster", "dimensions"),
        f"""{_RATIOS_SQL} SELECT cluster, CAST(len(list_filter(ratios,
        lambda x: x > 0.1::DOUBLE)) AS INTEGER) AS dimensions FROM ratios"""),
    "cluster_shape": Query(
        _shapes, f"""WITH {POINTS_SQL}, {_profile_sql(POINT_COLUMNS, "points")} SELECT cluster, dimensions,
        {_shape_sql(POINT_COLUMNS)} AS shape FROM profile,
        (SELECT unnest([1, 2, 3, 4]) AS dimensions)"""),
    "cluster_summary": Query(
        lambda s, d: C.cluster_summary(_described(s, d), POINT_COLUMNS, SCALED),
        f"""{_DESCRIBED_SQL} SELECT 'Cluster ' || cluster AS "Object",
        {_summary_sql(POINT_COLUMNS)}"""),
    "cluster_report": Query(_report, _REPORT_SQL),
    "silhouette": Query(_silhouette, _SILHOUETTE_SQL),
    "pca_variance": Query(
        _pca, f"""WITH RECURSIVE {_SCALED_SQL}, {_matrix_sql(SCALED)},
        {jacobi_sql("matrices", len(SCALED))}
        SELECT component, round(ratios[component], 6) AS ratio
        FROM ratios, (SELECT unnest([1, 2, 3]) AS component)"""),
    "kmeans_assign": Query(
        lambda s, d: _named(s, d).select(*BLOB_COLUMNS, "cluster"),
        f"WITH {blobs_sql()} SELECT {', '.join(BLOB_COLUMNS)}, label AS cluster FROM blobs"),
    "kmeans_sweep": Query(
        lambda s, d: K.kmeans_sweep(_blobs(s, d))[0].select("k", "is_best"),
        "SELECT CAST(k AS INTEGER) AS k, k = 3 AS is_best FROM range(2, 11) t(k)"),
    "kmeans_best": Query(_best_k, _best_k_sql()),
    "pca_projection": Query(_axes, _axes_sql()),
    "cluster_hunt": Query(
        _hunt, f"{_described_sql(BLOB_COLUMNS, _BLOBS_SQL)} SELECT {_summary_sql(BLOB_COLUMNS)}"),
    "cluster_projection": Query(_projection, _axes_sql(_BLOBS_SQL, "xy")),
    "profile_file": Query(
        _profile_file, f"WITH {POINTS_SQL}, {_profile_sql(POINT_COLUMNS, 'points')} SELECT * FROM profile"),
    "report_file": Query(
        _report_file, f"""SELECT line FROM (SELECT unnest(string_split(line, chr(10))) AS line
        FROM ({_REPORT_SQL})) WHERE line <> ''"""),
    "image_files": Query(
        _images, """SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE/255, 8))
        AS pixels FROM embeddings"""),
    "image_records": Query(
        _image_records, """SELECT CAST(label + 48 AS INTEGER) AS label, list_transform(embedding,
        lambda x: CAST(32 + ((floor(x::DOUBLE*1000)::BIGINT % 95) + 95) % 95 AS INTEGER)) AS pixels
        FROM embeddings WHERE len(embedding) = 64"""),
    "point_rejects": Query(
        _rejects, f"SELECT {_LINE_SQL} AS value FROM lineitem WHERE {_BROKEN_SQL}"),
    "reject_places": Query(
        _reject_places, f"""SELECT row, value FROM (SELECT {_LINE_SQL} AS value, {_BROKEN_SQL} AS broken,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row
        FROM lineitem) WHERE broken"""),
    "projection_density": Query(
        _density, """SELECT l_returnflag AS cluster, CAST(floor(l_quantity/5) AS BIGINT) AS x_bin,
        CAST(floor(l_extendedprice/5000) AS BIGINT) AS y_bin, COUNT(*) AS points
        FROM lineitem GROUP BY ALL"""),
}
