from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quayside.operators import logs as L
from quayside.settings import Deployment

LEVELS = ["TRACE", "DEBUG", "INFO", "WARN", "ERROR", "OTHER", None]
RECORD = "message STRING, file STRING, pid LONG, source_type STRING, metadata STRUCT<level STRING, module_path STRING>"


@pytest.mark.parametrize(
    ("threshold", "kept"),
    [
        ("TRACE", LEVELS),
        ("DEBUG", LEVELS[1:]),
        ("INFO", LEVELS[2:]),
        ("WARN", LEVELS[3:]),
        ("ERROR", LEVELS[4:]),
        ("FATAL", []),
        ("NONE", []),
    ],
)
def test_threshold(spark, threshold, kept):
    records = spark.createDataFrame([("m", None, 1, "s", (level, "mod")) for level in LEVELS], RECORD)
    found = [row["metadata"]["level"] for row in L.filter_level(records, threshold).collect()]
    assert sorted(map(str, found)) == sorted(map(str, kept))


def test_unknown_threshold(spark):
    with pytest.raises(KeyError):
        L.keeps_level(F.col("level"), "LOUD")


def test_flatten(spark):
    records = spark.createDataFrame(
        [("a", "agent.log", 1, "s", ("INFO", "topology")), ("b", None, 1, "s", (None, None))], RECORD
    )
    flat = L.flatten_records(records)
    assert flat.columns == ["message", "processed_file", "container", "level", "logger"]
    assert [tuple(row) for row in flat.collect()] == [
        ("a", "agent.log", "vector", "INFO", "topology"),
        ("b", None, "vector", None, None),
    ]
    assert "processed_file" not in L.flatten_records(records.drop("file")).columns


def test_java_lines_keep_message_after_prefix(spark):
    lines = spark.createDataFrame([("INFO: started",)], "message STRING")
    assert tuple(L.java_lines(lines).first()) == ("Java Logging: INFO: started", "ROOT", "INFO")


def test_union_keeps_equal_lines(spark):
    lines = spark.createDataFrame([("same",), ("same",)], "message STRING")
    both = L.standard_streams(lines, lines)
    assert sorted(row["level"] for row in both.collect()) == ["ERROR", "ERROR", "INFO", "INFO"]


def test_labels(spark):
    events = spark.createDataFrame([("a", "k1"), ("b", "k9"), ("c", None)], "message STRING, k STRING")
    one = L.label(events, Deployment("ns", "cl", "ro", "rg")).first()
    assert tuple(one)[2:] == ("ns", "cl", "ro", "rg")
    deployments = spark.createDataFrame(
        [("k1", "n1", "c1", "r1", "g1")],
        "k STRING, namespace STRING, cluster STRING, role STRING, roleGroup STRING",
    )
    found = {row["message"]: tuple(row)[2:] for row in L.label_by(events, deployments, "k").collect()}
    assert found == {"a": ("n1", "c1", "r1", "g1"), "b": (None,) * 4, "c": (None,) * 4}


def test_search_prunes_partitions(spark, tmp_path):
    events = spark.range(0, 400).select(
        F.timestamp_seconds(F.col("id") * 6 * 3600).alias("timestamp"),
        *[F.lit("x").alias(name) for name in L.SEARCH_COLUMNS[1:]],
    )
    path = str(tmp_path / "store")
    events.withColumn("log_date", F.to_date("timestamp")).write.partitionBy("log_date").parquet(path)
    found = L.search(spark.read.parquet(path), "1970-01-03 06:00:00", "1970-01-05 00:00:00")
    assert found.columns == list(L.SEARCH_COLUMNS)
    assert found.count() == 8
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
