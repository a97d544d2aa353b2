"""Runs registered queries on executors that are processes of their own; run by test_cluster."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

root, names = sys.argv[1], sys.argv[2:]
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans import driver_queries  # noqa: E402

spark = (
    SparkSession.builder.master("local-cluster[2,1,1024]")
    .config("spark.executor.memory", "700m")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.host", "127.0.0.1")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", f"{root}/shared")  # without a scheme
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
for name in names:
    found = driver_queries.QUERIES[name](spark, f"{root}/tables")
    # Columns that are always null have no type in files.
    empty = {column: found[column].cast("string") for column, kind in found.dtypes if kind == "void"}
    found.withColumns(empty).write.parquet(f"file://{root}/out/{name}")
print("done", flush=True)
os._exit(0)  # the master of a local cluster takes its time to stop
