"""Streams give what the batch form gives; re-delivered files add nothing."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import logs as L
from quayside.settings import Deployment
from quayside.streaming import log_stream as LS

DEPLOYMENT = Deployment("ns", "cl", "ro", "rg")


def land(root, path, text):
    target = os.path.join(root, path)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(target, "w") as out:
        out.write(text)


def events(spark, root, streaming):
    return LS.log_events(
        root,
        DEPLOYMENT,
        "WARN",
        stdout=LS.read_lines(spark, f"{root}/*", LS.STDOUT_FILES, streaming),
        stderr=LS.read_lines(spark, f"{root}/*", LS.STDERR_FILES, streaming),
        java=LS.read_lines(spark, f"{root}/*", LS.JAVA_FILES, streaming),
        agent=LS.read_agent_records(spark, f"{root}/agent/*", streaming),
    )


def test_stream_equals_batch(spark, tmp_path, rows):
    root = str(tmp_path / "logs")
    land(root, "svc/svc.stdout.log", "plain\nWARN 2024-07-24T10:11:12.5 hello\n")
    land(root, "svc/svc.stderr.log", "boom\r\na\rb\n")
    land(root, "svc/svc.0.logger", "INFO: started\n\n")
    land(root, "svc/ignored.txt", "nothing\n")
    land(
        root,
        "agent/a.json",
        '{"message":"m1","file":"f","pid":1,"pod":"p","timestamp":"2024-07-24T00:00:00.000001Z",'
        '"metadata":{"level":"WARN","module_path":"x"}}\n{"message":"m2","metadata":{"level":"INFO"}}\n'
        'no {record\r\n',
    )
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    LS.start_store(events(spark, root, True), store, checkpoint).awaitTermination()
    stored = spark.read.parquet(store)
    batch = events(spark, root, False)
    assert rows(stored.select(*L.LOG_COLUMNS)) == rows(batch.select(*L.LOG_COLUMNS))
    found = {
        (row["container"], row["file"], row["processed_file"], row["level"], row["message"])
        for row in stored.collect()
    }
    assert found == {
        ("svc", "svc.stdout.log", None, "INFO", "plain"),
        ("svc", "svc.stdout.log", None, "WARN", "hello"),
        ("svc", "svc.stderr.log", None, "ERROR", "boom"),
        ("svc", "svc.stderr.log", None, "ERROR", "a\rb"),
        ("vector", None, None, "ERROR", "no {record"),
        ("svc", "svc.0.logger", None, "INFO", "Java Logging: INFO: started"),
        ("svc", "svc.0.logger", None, "INFO", "Java Logging: "),
        ("vector", None, "f", "WARN", "m1"),
    }
    assert stored.where(F.col("log_date") != F.to_date("timestamp")).isEmpty()

    # A second run reads only what is new.
    land(root, "other/new.stdout.log", "later\n")
    LS.start_store(events(spark, root, True), store, checkpoint, files_per_date=3).awaitTermination()
    assert spark.read.parquet(store).where("message = 'later'").count() == 1
    assert spark.read.parquet(store).count() == 9


def land_closed(root, pod, container, base, text):
    digest = hashlib.sha256(text.encode()).hexdigest()
    land(root, f"{pod}/{container}/{base}.{digest}.logger", text)


def test_rotation(spark, tmp_path):
    root = str(tmp_path / "landing")
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        closed = LS.read_closed_files(spark, f"{root}/*/*")
        kept = LS.drop_copies(closed, root)
        found = LS.log_events(root, DEPLOYMENT, java=LS.file_lines(kept))
        LS.start_store(found, store, checkpoint).awaitTermination()
        return sorted(
            (row["pod"], row["container"], row["file"], row["message"])
            for row in spark.read.parquet(store).collect()
        )

    prefix = "Java Logging: "
    land_closed(root, "p1", "svc", "svc.0", "same\nsame\n\r\nend")
    first = [("p1", "svc", "svc.0.logger", prefix + line) for line in ("", "end", "same", "same")]
    assert run() == first

    # Again under other names, many times over, and one new file with a known line.
    for n in range(1, 200):
        land_closed(root, "p1", "svc", f"svc.{n}", "same\nsame\n\r\nend")
    land_closed(root, "p1", "svc", "svc.0", "same\nnew\n")
    land_closed(root, "p2", "svc", "svc.0", "same\nsame\n\r\nend")
    land_closed(root, "p2", "svc", "svc.1", "")
    expected = sorted(
        first
        + [("p1", "svc", "svc.0.logger", prefix + line) for line in ("same", "new")]
        + [("p2", "svc", "svc.0.logger", prefix + line) for line in ("", "end", "same", "same")]
    )
    assert run() == expected
    assert run() == expected


def test_old_files_that_arrive_late_are_kept(spark, tmp_path):
    root = str(tmp_path / "landing")
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        closed = LS.read_closed_files(spark, f"{root}/*/*", options={"maxFilesPerTrigger": 1})
        kept = LS.drop_copies(closed, root, "1 hour")
        found = LS.log_events(root, DEPLOYMENT, java=LS.file_lines(kept))
        LS.start_store(found, store, checkpoint).awaitTermination()
        return sorted(row["message"][-1] for row in spark.read.parquet(store).collect())

    for n, text in enumerate("abc"):
        land_closed(root, "p", "svc", f"svc.{n}", text)
    assert run() == ["a", "b", "c"]
    # Far older than anything seen so far; the copy of a known file is as old.
    for n, text in ((7, "d"), (8, "e"), (9, "a")):
        land_closed(root, "p", "svc", f"svc.{n}", text)
    for folder, _, names in os.walk(root):
        for name in names:
            if name[4] in "789":
                os.utime(os.path.join(folder, name), (1_000_000_000, 1_000_000_000))
    assert run() == ["a", "b", "c", "d", "e"]


def test_copies_in_one_batch(spark, tmp_path):
    """Two hundred copies that arrive together leave one file."""
    root = str(tmp_path / "landing")
    for n in range(200):
        land_closed(root, "p", "svc", f"svc.{n}", "a\nb\n")
    closed = LS.read_closed_files(spark, f"{root}/*/*")
    found = LS.log_events(root, DEPLOYMENT, java=LS.file_lines(LS.drop_copies(closed, root)))
    LS.start_store(found, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    batch = LS.drop_copies(LS.read_closed_files(spark, f"{root}/*/*", streaming=False), root)
    assert LS.file_lines(batch).count() == 2


@pytest.mark.parametrize("salted, hot", [(False, None), (True, None), (True, ["hot", "unknown"])])
def test_stream_is_labelled_from_a_large_table(spark, tmp_path, rows, salted, hot):
    """Without broadcasts, while a third of the lines come from one source."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    root = str(tmp_path / "logs")
    for n in range(30):
        container = "hot" if n % 3 == 0 else f"c{n}"
        land(root, f"{container}/f{n}.stdout.log", f"line {n}\nline {n}\n")
    names = "container STRING, namespace STRING, cluster STRING, role STRING, roleGroup STRING"
    deployments = spark.createDataFrame(
        [(name, f"ns-{name}", "c", "r", "g") for name in ("hot", "c1", "c2", "unused")], names
    )

    def labelled(streaming):
        lines = LS.read_lines(spark, f"{root}/*", LS.STDOUT_FILES, streaming)
        return L.label_by(L.split_path(lines, root), deployments, "container", salted=salted, hot=hot)

    try:
        query = (
            labelled(True).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).select("container", "message", "namespace")
        assert rows(found) == rows(labelled(False).select("container", "message", "namespace"))
        assert found.count() == 60
        assert found.where("namespace = 'ns-hot'").count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
