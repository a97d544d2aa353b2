"""Golden rows for lines, paths and JSON text."""

from __future__ import annotations

import re
import time
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import text as X
from quayside.operators import logs as L

ESC = "\x1b"
STAMP = datetime(2024, 7, 24, 10, 11, 12, 123456)
HALF = datetime(2024, 7, 24, 10, 11, 12, 500000)

LINES = [
    # file, line, level, event_ts, message
    ("svc.stdout.log", "plain line", "INFO", None, "plain line"),
    ("svc.stdout.log", f"{ESC}[31mWARN  2024-07-24T10:11:12.123456 hello world{ESC}[0m", "WARN", STAMP, "hello world"),
    ("svc.stderr.log", "boom", "ERROR", None, "boom"),
    ("svc.stderr.log", "xx SEVERE 2024-07-24T10:11:12.5 bad thing", "SEVERE", HALF, "bad thing"),
    ("svc.stdout.log", "[INFO] 2024-07-24T10:11:12.5 z", "INFO", None, "[INFO] 2024-07-24T10:11:12.5 z"),
    ("svc.stdout.log", "WARN 2024-13-24T10:11:12.5 x", "INFO", None, "WARN 2024-13-24T10:11:12.5 x"),
    # a date that the pattern lets through but that does not exist
    ("svc.stdout.log", "WARN 2024-02-31T10:11:12.5 x", "INFO", None, "WARN 2024-02-31T10:11:12.5 x"),
    # another separator before the fraction is found, but is no valid time
    ("svc.stdout.log", "WARN 2024-07-24T10:11:12,5 x", "INFO", None, "WARN 2024-07-24T10:11:12,5 x"),
    ("svc.stdout.log", "WARN 2024-07-24T10:11:12+05 x", "INFO", None, "WARN 2024-07-24T10:11:12+05 x"),
    ("svc.stdout.log", "WARN 2024-07-24T10:11:12 5 x", "INFO", None, "WARN 2024-07-24T10:11:12 5 x"),
    # times glued together: the last one counts
    ("svc.stdout.log", "WARN 2024-01-01T00:00:00.52024-07-24T10:11:12.5 x", "WARN", HALF, "x"),
    ("svc.stdout.log", "WARN 2024-01-01T00:00:00 52024-07-24T10:11:12.5 x", "WARN", HALF, "x"),
    # no room for a message: nothing follows the time but spaces that are stripped
    ("svc.stdout.log", "WARN 2024-07-24T10:11:12.5  ", "INFO", None, "WARN 2024-07-24T10:11:12.5  "),
    ("svc.stdout.log", "\t\u00a0 WARN 2024-07-24T10:11:12.5   two  words \u2003", "WARN", HALF, "two  words"),
    ("svc.stdout.log", "Größe 2024-07-24T10:11:12.5 ok", "Größe", HALF, "ok"),
    ("svc.stdout.log", "", "INFO", None, ""),
]


def test_golden_lines(spark):
    lines = spark.createDataFrame(
        [(n, f"file:///logs/svc/{file}", line) for n, (file, line, *_) in enumerate(LINES)],
        "n INT, file STRING, message STRING",
    )
    stderr = F.col("file").endswith(".stderr.log")
    both = L.standard_streams(lines.where(~stderr), lines.where(stderr))
    parsed = L.parse_lines(L.split_path(both, "/logs")).orderBy("n").collect()
    assert len(parsed) == len(LINES)
    for row, (file, line, level, event_ts, message) in zip(parsed, LINES, strict=True):
        assert row["level"] == level, line
        assert row["event_ts"] == event_ts, line
        assert row["message"] == message, line
        assert (row["logger"], row["container"], row["file"]) == ("ROOT", "svc", file)


# The plain form of the line pattern, as the log agent's configuration describes it.
PLAIN = re.compile(
    r"(?P<level>\w+)[ ]+(?P<time>[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[1-2][0-9]|3[0-1])"
    r"T(?:2[0-3]|[01][0-9]):[0-5][0-9]:[0-5][0-9].[0-9]+)+[ ]+(?P<message>.*)"
)
PIECES = [
    "WARN", " ", "  ", "2024-07-24T10:11:12.5", "2024-02-30T00:00:00.1", "2024-07-24T10:11:12",
    "2024-07-24T10:11:12.123456789", "T", "1", "_", "[", "]", "x y", "é", "\t", ".", "-",
]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=30, max_size=60))
def test_lines_match_plain_pattern(spark, lines):
    table = spark.createDataFrame(list(enumerate(lines)), "n INT, message STRING")
    parsed = L.parse_lines(L.with_constants(table, "INFO")).orderBy("n").collect()
    for row, line in zip(parsed, lines, strict=True):
        expected = ("INFO", line)
        found = PLAIN.search(line.strip())
        if found:
            try:
                text = found["time"]
                datetime.strptime(text[:26], "%Y-%m-%dT%H:%M:%S.%f")
                expected = (found["level"], found["message"])
            except ValueError:
                pass
        assert (row["level"], row["message"]) == expected, line


def test_long_word_is_searched_in_linear_time(spark):
    line = spark.createDataFrame([("a" * 400_000,), (" " * 400_000 + "x",)], "message STRING")
    started = time.time()
    assert L.parse_lines(L.with_constants(line, "INFO")).count() == 2
    L.parse_lines(L.with_constants(line, "INFO")).collect()
    assert time.time() - started < 20


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (f"{ESC}[1;31mred{ESC}[0m", "red"),
        (f"{ESC}]0;title\x07text", "text"),
        (f"{ESC}(Bplain{ESC}[K ", "plain"),
        (" \u2003 both \n", "both"),
        (None, None),
    ],
)
def test_clean_line(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "m STRING").select(X.clean_line(F.col("m")))
    assert df.first()[0] == clean


@pytest.mark.parametrize(
    ("path", "container", "file"),
    [
        ("/logs/svc/svc.0.logger", "svc", "svc.0.logger"),
        ("file:///logs/svc/a%20b+c.log", "svc", "a b+c.log"),
        ("s3a://bucket/logs/svc/deep/x.log", "svc", "deep/x.log"),
        ("/other/svc/x.log", None, "/other/svc/x.log"),
        ("/logs/x.log", None, "/logs/x.log"),
        (None, None, None),
    ],
)
def test_split_path(spark, path, container, file):
    df = spark.createDataFrame([(path,)], "file STRING")
    row = L.split_path(df, "/logs/").first()
    assert (row["container"], row["file"]) == (container, file)


def test_split_path_with_pod_and_special_root(spark):
    df = spark.createDataFrame([("/a.b(c)/pod-1/svc/x.log", "s"), ("/aXb(c)/p/s/x", "s")], "file STRING, source_type STRING")
    found = L.split_path(df, "/a.b(c)", with_pod=True)
    assert "source_type" not in found.columns
    first, second = found.collect()
    assert (first["pod"], first["container"], first["file"]) == ("pod-1", "svc", "x.log")
    assert (second["pod"], second["container"], second["file"]) == (None, None, "/aXb(c)/p/s/x")


def test_json_text(spark):
    df = spark.createDataFrame(
        [('{"dcat:dataset":{"odrl:hasPolicy":{"@id":"o:1"}},"@id":"n"}',), ("not json",)], "d STRING"
    )
    found = df.select(
        X.json_text(F.col("d"), "dcat:dataset", "odrl:hasPolicy", "@id"),
        X.json_text(F.col("d"), "@id"),
    )
    assert [tuple(row) for row in found.collect()] == [("o:1", "n"), (None, None)]
    with pytest.raises(ValueError):
        X.json_text(F.col("d"), "it's")
