"""Spark session helpers.

The library never depends on a particular session: every operator takes
DataFrames and returns DataFrames. ``get_session`` is a convenience for
scripts and tests; on a cluster the caller brings its own session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library is tuned for. AQE re-plans joins (broadcast vs
# sort-merge) and splits skewed join partitions at runtime; ANSI mode is
# the Spark 4 default, so dirty input goes through try_* functions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE merges post-shuffle partitions by bytes (at least 1 MB each by
    # default). Text cleaning costs ~36 regex passes per byte, so a 1 MB
    # partition of comments is seconds of CPU in one task; a smaller floor
    # keeps such stages parallel. Only shuffles of a few MB in total are
    # affected; large shuffles stay far above it.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoints (lineage cuts) are deleted once the checkpointed frame is
    # garbage-collected on the driver, so repeated jobs do not fill the
    # shared checkpoint folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "threadscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("THREADSCOPE_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Spark applies ``spark.checkpoint.dir`` to the context at start-up, so
    the context's folder is used when there is one. Where none is set, a
    local run (one machine, as in tests) gets a fresh scratch folder; on a
    cluster each executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="threadscope-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Pandas UDFs and ``mapInPandas`` functions are pickled by reference to
    their module, so workers must be able to import ``threadscope``. The
    package's sources are zipped once per application into the shared
    checkpoint folder (written through the Hadoop FileSystem API) and
    distributed from there with ``SparkContext.addPyFile``, as ``--py-files``
    would."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    path = scratch_path(spark, f"py/{sc.applicationId}/threadscope.zip")
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
