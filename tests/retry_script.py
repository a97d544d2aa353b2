"""Copies objects while every stage loses its first finished task; run by test_retry."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

root = sys.argv[1]
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans import copy_job  # noqa: E402
from quayside.schemas import MANIFEST  # noqa: E402
from quayside.settings import TransferSettings  # noqa: E402


def losing_first_result(stage, name):
    """The stage does its work, then fails once before its result is handed over."""

    def work(batches):
        for result in stage(batches):
            marker = os.path.join(root, name)
            if not os.path.exists(marker):
                with open(marker, "w"):
                    pass
                raise RuntimeError(f"{name} lost a task")
            yield result

    return work


measure, copier, finisher = copy_job._measurer, copy_job._copier, copy_job._finisher
copy_job._measurer = lambda *a: losing_first_result(measure(*a), "measure")
copy_job._copier = lambda *a: losing_first_result(copier(*a), "copy")
copy_job._finisher = lambda *a: losing_first_result(finisher(*a), "finish")


def address(**properties):
    return {"type": "T", "keyName": properties.pop("key", "k"), "properties": properties}


spark = (
    SparkSession.builder.master("local[4,4]")  # tasks may fail three times
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
names = sorted(os.listdir(os.path.join(root, "in")))
manifest = spark.createDataFrame(
    [(n, address(key=f"copy/{n}", bucketName="in", blobName=n), address(bucketName="out")) for n in names],
    MANIFEST,
)
registry = spark.createDataFrame([], "key_name STRING, has_token BOOLEAN, expires_at TIMESTAMP")
settings = TransferSettings("T", "d", "c", f"file://{root}", f"file://{root}")
status = copy_job.copy_objects(manifest, registry, settings, f"file://{root}/work", chunk_bytes=1000)
assert status.where("status <> 'ok'").isEmpty()
assert status.count() == len(names)
