"""Session construction and cluster-wide settings."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

# Settings every encore job relies on. They are applied on top of whatever the
# cluster already sets; nothing here pins the master or the memory sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Suggested additions on a large cluster (applied with ``build_session(cluster=True)``).
# Shuffle partitions start high and AQE coalesces them to ~256 MB each; skewed
# join partitions above 1 GB (and 5x the median) are split; file scans are cut
# into 256 MB splits; streaming state lives in RocksDB instead of the JVM heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # slice width of the sliced folds/lookups: with one key holding a third of
    # 100 TB over 30 days, 60 s slices keep that key's slice under ~1 GB
    "encore.slice.seconds": "60",
}

# encore's own knob (read with ``conf_int``).
SLICE_SECONDS = "encore.slice.seconds"

_DEFAULTS = {
    SLICE_SECONDS: 3600,
}


def build_session(master: str | None = None, app: str = "encore",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, str(v))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``encore`` importable in the Python workers (as ``--py-files`` would).

    State functions and pandas functions are pickled by module reference, so
    the executors need the package. It is zipped once per SparkContext and
    handed to ``addPyFile``; Spark distributes it with the job's files.
    """
    sc = spark.sparkContext
    if id(sc) in _SHIPPED or spark.conf.get("encore.shipPackage", "true").lower() == "false":
        return          # e.g. the cluster already passes the package with --py-files
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = ensure_checkpoint_dir(spark)
    if folder.startswith("file:"):
        folder = folder[len("file:"):]
    if "://" in folder:             # remote storage: Python cannot write there directly
        fd, path = tempfile.mkstemp(prefix="encore-pyfiles-", suffix=".zip")
        os.close(fd)
    else:                           # the shared folder the cluster names
        os.makedirs(os.path.join(folder, "pyfiles"), exist_ok=True)
        path = os.path.join(folder, "pyfiles", f"encore-{os.getpid()}-{id(sc)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(id(sc))


def conf_int(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, str(_DEFAULTS[key])))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is used as is. Where it is unset, a folder under
    ``spark.sql.warehouse.dir`` is. On a cluster that folder must not be one of the
    driver's own disk (the default), which executors do not see.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local[") and master != "local" and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share; "
                             f"{warehouse} is a local one")
        d = os.path.join(warehouse, "_encore_scratch")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for tables a job writes.

    What is written there lasts as long as the driver.
    """
    path = os.path.join(ensure_checkpoint_dir(spark), name)
    if not _SCRATCH:
        atexit.register(_clear_scratch)
    _SCRATCH[path] = spark
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    return path


_SCOPE = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables that this thread writes inside are removed at the end (a micro-batch's, say)."""
    outer, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        done, _SCOPE.paths = _SCOPE.paths, outer
        for path in done:
            remove_path(spark, path)
            _SCRATCH.pop(path, None)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clear_scratch() -> None:
    for path, spark in _SCRATCH.items():
        try:
            remove_path(spark, path)
        except Exception:           # the session is gone already: nothing left to reach the folder with
            return
