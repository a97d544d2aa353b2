"""Log sources, removal of re-delivered files, and the log store.

Batch and stream share every transformation; only the readers and the sink differ.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside import schemas as S
from quayside.operators import logs as L
from quayside.settings import Deployment

# Names of the files of each source (fixed values).
STDOUT_FILES = "*.stdout.log"
STDERR_FILES = "*.stderr.log"
JAVA_FILES = "*.logger"

# Copies of one file are spread over this many tasks before they meet in one.
COPY_SALTS = 64


_starting = threading.Lock()

# The file source ignores files that are this much older than the newest it has seen.
MAX_FILE_AGE = "36500d"


def _reader(spark: SparkSession, streaming: bool, options: dict | None):
    """Reader for files; ``options`` are those of Spark's file source.

    No file is skipped for its age. Where files carry the time at which they landed, a shorter
    ``maxFileAge`` together with ``cleanSource`` bounds what the driver remembers of them.
    """
    if not streaming:
        return spark.read.options(**(options or {}))
    return spark.readStream.options(**{"maxFileAge": MAX_FILE_AGE, **(options or {})})


def read_lines(
    spark: SparkSession,
    folders: str,
    names: str,
    streaming: bool = True,
    options: dict | None = None,
) -> DataFrame:
    """Lines of the files called ``names`` in ``folders``, with path and time of the file.

    Folders are given apart from names, so that folders are listed and not single files.
    """
    return (
        _reader(spark, streaming, options)
        .format("text")
        .option("lineSep", "\n")
        .option("pathGlobFilter", names)
        .load(folders)
        .select(
            F.regexp_replace("value", r"\r\z", "").alias("message"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )
    )


def read_agent_records(
    spark: SparkSession, path: str, streaming: bool = True, options: dict | None = None
) -> DataFrame:
    """Structured records, one JSON document per line.

    A line that is no record becomes an event of its own: its text as the message, with level
    ERROR and the time of its file.
    """
    broken, schema = "_broken", S.AGENT_RECORD
    records = (
        _reader(spark, streaming, options)
        .schema(T.StructType([*schema, T.StructField(broken, T.StringType())]))
        .option("lineSep", "\n")
        .option("columnNameOfCorruptRecord", broken)
        .json(path)
        .select("*", F.col("_metadata.file_modification_time").alias("_file_time"))
    )
    is_broken = F.col(broken).isNotNull()
    level = schema["metadata"].dataType
    fields = [
        (F.lit("ERROR") if f.name == "level" else F.lit(None).cast(f.dataType)).alias(f.name) for f in level
    ]
    given = {
        "message": F.regexp_replace(broken, r"\r\z", ""),
        "timestamp": F.col("_file_time"),
        "metadata": F.struct(*fields),
    }
    return records.select(
        *[
            F.when(is_broken, given[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in given
            else F.col(f.name)
            for f in schema
            if f.name != broken
        ]
    )


def read_closed_files(
    spark: SparkSession,
    folders: str,
    names: str = JAVA_FILES,
    streaming: bool = True,
    options: dict | None = None,
) -> DataFrame:
    """Rotated files as a whole, with a hash of their content.

    Rotation bounds the size of such a file. Files must land under names that are never used
    again, ``<pod>/<container>/<base>.<sha256>.logger``, because the file source remembers
    names: new content under a known name would be skipped.
    """
    return (
        _reader(spark, streaming, options)
        .format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", names)
        .load(folders)
        .select(
            F.col("value").alias("content"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
            F.sha2("value", 256).alias("file_id"),
        )
    )


def drop_copies(files: DataFrame, log_root: str, delay: str = "7 days") -> DataFrame:
    """Keep one of the files of a container that have the same content.

    ``delay`` is how long a file is remembered after its arrival, so it must exceed the time
    within which copies are delivered. The time of arrival and not the time of the file moves the
    watermark: a file is never late, however old it is. Copies are first removed per salt, which
    leaves at most one per salt for the second step, however many copies one file has.
    """
    located = L.split_path(files, log_root, with_pod=True)
    identity = ["pod", "container", "file_id"]
    if not files.isStreaming:
        return located.dropDuplicates(identity)
    salt = F.pmod(F.xxhash64("pod", "container", "file"), F.lit(COPY_SALTS))
    return (
        located.withColumns({"salt": salt, "arrived": F.current_timestamp()})
        .withWatermark("arrived", delay)
        .dropDuplicatesWithinWatermark([*identity, "salt"])
        .drop("salt")
        .dropDuplicatesWithinWatermark(identity)
        .drop("arrived")
    )


def file_lines(files: DataFrame) -> DataFrame:
    """Lines of whole files with their number; the hash is cut from the file name again."""
    lines = F.split(F.regexp_replace("content", r"\r?\n\z", ""), r"\r?\n")
    return files.where(F.col("content") != "").select(
        "pod",
        "container",
        F.regexp_replace("file", r"\.[0-9a-f]{64}(\.[^.]*)$", "$1").alias("file"),
        "timestamp",
        F.posexplode(lines).alias("line_number", "message"),
    )


def log_events(
    log_root: str,
    deployment: Deployment | DataFrame,
    threshold: str = "INFO",
    stdout: DataFrame | None = None,
    stderr: DataFrame | None = None,
    java: DataFrame | None = None,
    agent: DataFrame | None = None,
    with_pod: bool = False,
    pod: str | None = None,
) -> DataFrame:
    """Events of all given sources in the columns of the log store.

    ``deployment`` is the one that all events come from, or a table of many
    (``container, namespace, cluster, role, roleGroup``).

    ``stdout`` and ``stderr`` are lines with paths, ``java`` is the result of ``file_lines``
    (or lines with paths), ``agent`` are structured records. The pod comes from the record or,
    ``with_pod``, from the path; ``pod`` is the value for events that name none.
    """
    parts = []
    captured = [
        L.with_constants(lines, level)
        for lines, level in ((stdout, L.STDOUT_LEVEL), (stderr, L.STDERR_LEVEL))
        if lines is not None
    ]
    if captured:
        parts.append(L.parse_lines(L.split_path(L.fan_in(*captured), log_root, with_pod)))
    if java is not None:
        located = java if "container" in java.columns else L.split_path(java, log_root, with_pod)
        parts.append(L.java_lines(located))
    if agent is not None:
        parts.append(L.flatten_records(L.filter_level(agent, threshold)))
    merged = L.fan_in(*parts)
    one = isinstance(deployment, Deployment)
    events = L.as_log_events(
        L.label(merged, deployment) if one else L.label_by(merged, deployment, "container")
    )
    if pod is not None:
        events = events.withColumn("pod", F.coalesce("pod", F.lit(pod)))
    stored = events.withColumn("timestamp", F.coalesce("event_ts", "timestamp"))
    return stored.withColumn("log_date", F.to_date("timestamp"))


def start_store(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_date: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append events to the log store, by default until all landed files are read.

    Every task writes one file per date it sees. Live traffic has one or two dates per batch,
    so nothing is moved. To catch up on many dates, set ``files_per_date``: each date of a
    batch then goes to that many tasks, however many rows it has.

    ``state_partitions`` is the number of partitions for remembered files, by default that of
    all shuffles. It is fixed by the first run with a checkpoint.
    """
    if files_per_date:
        spread = F.pmod(F.xxhash64("pod", "container", "file", "message"), F.lit(files_per_date))
        events = events.repartition("log_date", spread)
    writer = (
        events.writeStream.format("parquet")
        .partitionBy("log_date")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if not state_partitions:
        return writer.start()
    # A stream keeps the settings of its session as they are when it starts, so one starts at a time.
    settings, key = events.sparkSession.conf, "spark.sql.shuffle.partitions"
    with _starting:
        before = settings.get(key)
        settings.set(key, state_partitions)
        try:
            return writer.start()
        finally:
            settings.set(key, before)
