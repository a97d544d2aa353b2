"""Runs queries on executors that are processes of their own, as on a standalone cluster; run by test_standalone."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

root, names = sys.argv[1], sys.argv[2:]
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402
from quayside.session import CHECKPOINT_DIR, scratch_dir  # noqa: E402

spark = (
    SparkSession.builder.master("local-cluster[2,1,1024]")
    .config("spark.executor.memory", "700m")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.host", "127.0.0.1")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.legacy.setCommandRejectsSparkCoreConfs", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
# No port is opened for a cluster; the session only says that it is one.
spark.conf.set("spark.master", "spark://another-machine:7077")

# Below this link each process sees a folder of its own, as machines do with their disks.
spark.conf.set(CHECKPOINT_DIR, "/proc/self/cwd/own")
try:
    print("accepted", scratch_dir(spark, "x"), flush=True)
except ValueError as error:
    print("refused", error, flush=True)

spark.conf.set(CHECKPOINT_DIR, f"{root}/shared")  # without a scheme
folders = [scratch_dir(spark, "x") for _ in range(3)]
assert all(folder.startswith(f"file://{root}/shared/quayside/x-") for folder in folders), folders
print("tried", len([name for name in os.listdir(f"{root}/shared/quayside") if name.startswith("shared-")]), flush=True)
known = __spark_entry__.queries()
for name in names:
    try:
        found = known[name](spark, f"{root}/tables")
        # Columns that are always null have no type in files.
        empty = {column: found[column].cast("string") for column, kind in found.dtypes if kind == "void"}
        found.withColumns(empty).write.parquet(f"file://{root}/out/{name}")
    except ValueError as error:
        print(name, error, flush=True)
print("done", flush=True)
os._exit(0)  # the master of a local cluster takes its time to stop
