"""Session helpers: a tuned local session for tests / bench, and the shared
scratch location taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "mercantile") -> SparkSession:
    """Session used by tests and bench.  On a cluster the caller's own session
    is used instead; nothing in the library depends on these settings except
    the checkpoint folder, which is read from the session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = str(shuffle_partitions or int(cpus))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.default.parallelism", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it as
    is.  Only when it is unset (local tests) do we create our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="mercantile-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` as rows in the checkpoint folder.  Join an aggregate or distinct
    keys only after this: AQE splits a hot key of the other side only where both
    sides of the join come straight from a shuffle."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables
    (lineage cuts, export round trips, stream inputs and sinks).  All of an
    application's folders share a parent that goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/mercantile/{app}-{uuid.uuid4().hex[:8]}"
        where = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _scratch[app] = root
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so a job
    runs from any working directory and on executors without the repository."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="mercantile-package-")  # the driver's own copy, served by Spark
    archive = os.path.join(folder, "mercantile_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for where, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
