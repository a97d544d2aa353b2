"""Session settings, shared scratch space and shipping of the package to executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime settings that the jobs rely on. Broadcasts are left to the size check of the
# optimizer, and joins whose partitions turn out uneven are split at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Filters on the names and lengths of objects are applied before objects are opened.
    "spark.sql.python.filterPushdown.enabled": "true",
    # The memory of seen files outgrows the heap of an executor, so it is kept on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_shipped: set[str] = set()
# The temporary folder of local sessions, once one is needed.
_local_scratch: list[str] = []
# By application and folder: the executors that wrote to the folder when it was tried.
_tried: dict[tuple[str, str], set[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    # Many small log files: a listing task for each of them would cost more than the listing.
    listing_tasks = min(10_000, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", listing_tasks)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, empty folder below the shared folder named by ``spark.checkpoint.dir``.

    A folder without a scheme is one of Hadoop's default file system. If that is the disk of each
    machine, ``file://`` in the setting says that the folder is a shared mount; without it a cluster tries
    whether it is one, and refuses a folder in which rows of executors get lost.
    Only a session on this machine alone without that setting gets a temporary folder; all executors of
    ``local-cluster`` are processes of this machine, so they share its disk.
    """
    local = spark.conf.get("spark.master", "local").split("[")[0] in ("local", "local-cluster")
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not local:
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        if not _local_scratch:
            # Without links, which other processes may see differently (as those below /proc/self).
            _local_scratch.append("file://" + os.path.realpath(tempfile.mkdtemp(prefix="quayside-")))
            atexit.register(shutil.rmtree, _local_scratch[0].removeprefix("file://"), ignore_errors=True)
        base = _local_scratch[0]
    if base.startswith("/"):
        default_fs = default_file_system(spark)
        if not default_fs.startswith("file:"):
            base = default_fs.rstrip("/") + base
        else:
            base = "file://" + base
            if not local:
                _try_shared(spark, base)
    return f"{base.rstrip('/')}/quayside/{label}-{uuid.uuid4().hex}"


def _try_shared(spark: SparkSession, base: str) -> None:
    """Raise ValueError unless the driver sees what the executors write to the folder.

    A table is written by as many tasks as every idle executor gets one, and read again: what a task leaves on a disk
    of its own is not among its rows. This is done once for a folder, and again when executors have come.
    """
    try:
        tried = _tried.setdefault((spark.sparkContext.applicationId, base), set())
        while not (there := _executors(spark)) <= tried:
            rows = 2 * max(len(there), spark.sparkContext.defaultParallelism)
            path = f"{base.rstrip('/')}/quayside/shared-{uuid.uuid4().hex}"
            spark.range(rows, numPartitions=rows).write.parquet(path)
            found = spark.read.schema("id long").parquet(path).count()
            if found != rows:
                raise OSError(f"{found} of {rows} rows came back")
            tried |= there
    except Exception as error:  # whatever it is, the folder is not known to be shared
        raise ValueError(
            f"{CHECKPOINT_DIR} has no scheme, and not all executors share {base}: name a folder that they share"
        ) from error


def _executors(spark: SparkSession) -> set[str]:
    """Addresses of the executors that there are now, and of the driver."""
    found = spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()
    return {f"{executor.host()}:{executor.port()}" for executor in found}


def default_file_system(spark: SparkSession) -> str:
    """``fs.defaultFS`` as Hadoop's own files and Spark's settings give it."""
    found = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return spark.conf.get("spark.hadoop.fs.defaultFS", None) or found or "file:///"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers of the session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(package)
    folder = tempfile.mkdtemp(prefix="quayside-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "quayside.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for root, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(root, name)
                    out.write(path, os.path.relpath(path, parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def register_source(spark: SparkSession, source: type) -> None:
    """Register a Python data source of this package.

    The process on the driver that plans a stream does not get what is shipped to executors, so the
    source is registered with the path of this package.
    """
    ship_package(spark)
    parent = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment, key = spark.sparkContext.environment, "PYTHONPATH"
    before = environment.get(key)
    environment[key] = os.pathsep.join(filter(None, [parent, before]))
    try:
        spark.dataSource.register(source)
    finally:
        if before is None:
            del environment[key]
        else:
            environment[key] = before
