"""Word searches open only the files that may hold the words."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import log_index as I

COLUMNS = "timestamp TIMESTAMP, pod STRING, container STRING, logger STRING, level STRING, message STRING, log_date DATE"


@pytest.fixture
def store(spark, tmp_path):
    """Twenty files of two dates; each has a word of its own, and one word is in all of them."""
    path = f"file://{tmp_path}/store"
    for n in range(20):
        day = f"2024-01-0{1 + n % 2}"
        rows = spark.createDataFrame(
            [(f"Common word{n} of-file number {n}", None), (f"été_{n} ÜBER {'rare' if n in (4, 6) else 'x'}", None), ("", 1)],
            "message STRING, none INT",
        ).select(
            F.lit(f"{day} 10:00:00").cast("timestamp").alias("timestamp"),
            *(F.lit(c).alias(c) for c in ("pod", "container", "logger", "level")),
            F.when(F.col("none").isNull(), F.col("message")).alias("message"),
            F.lit(day).cast("date").alias("log_date"),
        )
        rows.coalesce(1).write.mode("append").partitionBy("log_date").parquet(path)
    I.index_files(spark, path, f"file://{tmp_path}/index")
    return path, f"file://{tmp_path}/index"


def test_only_files_with_the_words_are_opened(spark, store):
    path, index = store

    def files(*words, first="2024-01-01", last="2024-01-02"):
        return I.files_with(spark, path, index, list(words), first, last).count()

    assert files("common") == 20 and files("common", first="2024-01-02") == 10
    assert files("word7") == 1 and files("word7", last="2024-01-01") == 0
    assert files("rare") == 2 and files("rare", "word6") == 1 and files("rare", "word7") == 0
    assert files("nowhere") == 0 and files("über", "été_3") == 1
    found = I.search_words(spark, path, index, "RARE über", "2024-01-01 00:00:00", "2024-01-02 23:00:00")
    assert len(found.inputFiles()) == 2 and sorted(r.message for r in found.collect()) == ["été_4 ÜBER rare", "été_6 ÜBER rare"]
    nothing = I.search_words(spark, path, index, "common rare", "2024-01-01 00:00:00", "2024-01-02 23:00:00")
    assert nothing.count() == 0 and nothing.columns == found.columns
    every = I.search_words(spark, path, index, " - ", "2024-01-01 00:00:00", "2024-01-01 23:00:00")
    assert every.count() == 30


def test_files_beyond_the_index_are_opened(spark, store, monkeypatch):
    path, index = store
    spark.read.parquet(path).where("message LIKE '%word3 %'").withColumn("message", F.lit("late RARE")).coalesce(1).write.mode(
        "append"
    ).partitionBy("log_date").parquet(path)
    time = ("2024-01-01 00:00:00", "2024-01-02 23:00:00")
    found = I.search_words(spark, path, index, "rare", *time)
    assert len(found.inputFiles()) == 3 and found.count() == 3
    # Indexing a date again replaces its part of the index only.
    I.index_files(spark, path, index, ["2024-01-02"])
    assert len(I.search_words(spark, path, index, "late", *time).inputFiles()) == 1
    assert len(I.search_words(spark, path, index, "rare", *time).inputFiles()) == 3
    monkeypatch.setattr(I, "NAMED_FILES", 2)
    assert I.search_words(spark, path, index, "rare", *time).count() == 3


def test_long_texts_and_bits(spark, tmp_path):
    """Thousands of words of one file are all found in its bitmaps."""
    path = f"file://{tmp_path}/store"
    text = " ".join(f"w{i}" for i in range(5000))
    spark.createDataFrame([(text,)], "message STRING").withColumn("log_date", F.lit("2024-01-01").cast("date")).write.partitionBy(
        "log_date"
    ).parquet(path)
    I.index_files(spark, path, f"file://{tmp_path}/index")
    for word in ("w0", "w4999", "w1234"):
        assert I.files_with(spark, path, f"file://{tmp_path}/index", [word], "2024-01-01", "2024-01-01").count() == 1
    missed = [f"v{i}" for i in range(40)]
    assert sum(I.files_with(spark, path, f"file://{tmp_path}/index", [w], "2024-01-01", "2024-01-01").count() for w in missed[:5]) <= 1
    assert os.path.isdir(tmp_path / "index")
