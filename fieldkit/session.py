"""Session defaults and the one way this library cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_ONE_PROCESS = re.compile(r"local(\[[^\]]*\])?")
_local_dirs: dict[str, str] = {}


def local_session(app: str = "fieldkit", cpus: int | str = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder that only ``SparkContext.setCheckpointDir`` was told is taken next. Only a session whose
    driver and executors are one process may name none: it gets a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        told = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = told.get() if told.isDefined() else None
    if folder is None:
        if not _ONE_PROCESS.fullmatch(spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="fieldkit-")
        folder = _local_dirs[app]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/fieldkit/{app}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled", **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back; ``options`` go to the writer.

    Used where a frame is read several times, or where its values depend on how it was
    partitioned and must not change when a lost executor's work is redone. A written table
    survives executor loss, keeps column pruning and pushdown, and tells Catalyst its true
    size, so later joins are broadcast only when they really are small.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_settled(spark: SparkSession) -> None:
    """Delete what this application settled; call when its results are no longer needed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/fieldkit/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
