"""Log pipeline steps; every one works on batch and on streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import text as X
from quayside.operators.lookups import lookup_join
from quayside.schemas import LOG_COLUMNS
from quayside.settings import Deployment

# Constants per stream (fixed values).
ROOT_LOGGER = "ROOT"
STDOUT_LEVEL = "INFO"
STDERR_LEVEL = "ERROR"
JAVA_LEVEL = "INFO"
JAVA_PREFIX = "Java Logging: "
AGENT_CONTAINER = "vector"

# Levels that a threshold drops (fixed values); FATAL and NONE drop everything.
DROPPED_LEVELS = {
    "TRACE": (),
    "DEBUG": ("TRACE",),
    "INFO": ("TRACE", "DEBUG"),
    "WARN": ("TRACE", "DEBUG", "INFO"),
    "ERROR": ("TRACE", "DEBUG", "INFO", "WARN"),
}
DROP_ALL = ("FATAL", "NONE")

SEARCH_COLUMNS = ("timestamp", "pod", "container", "logger", "level", "message")


def with_constants(lines: DataFrame, level: str) -> DataFrame:
    """Give lines the default logger and the default level of their stream."""
    return lines.withColumns({"logger": F.lit(ROOT_LOGGER), "level": F.lit(level)})


def standard_streams(stdout: DataFrame, stderr: DataFrame) -> DataFrame:
    """Union of both capture streams with their defaults; equal lines are kept."""
    return with_constants(stdout, STDOUT_LEVEL).unionByName(with_constants(stderr, STDERR_LEVEL))


def split_path(lines: DataFrame, log_root: str, with_pod: bool = False) -> DataFrame:
    """Take container and file name (and pod) from the path in ``file``.

    A path that does not lie below ``log_root`` is left as it is, with a null container.
    """
    path = X.bare_path(F.col("file"))
    first = 2 if with_pod else 1
    taken = {
        "container": X.path_part(path, log_root, first, with_pod),
        "file": F.coalesce(X.path_part(path, log_root, first + 1, with_pod), F.col("file")),
    }
    if with_pod:
        taken["pod"] = X.path_part(path, log_root, 1, with_pod)
    # withColumns evaluates all of these on the old columns.
    return lines.withColumns(taken).drop("source_type")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Read level, time and message from lines that have them; leave the others unchanged."""
    event, rest, time = F.col("__event"), F.col("__rest"), F.col("__time")
    # One search per line; the parts are then cut from what it found, step by step, so that
    # no step is computed twice.
    cut = (
        lines.withColumn("__event", X.find_event(X.clean_line(F.col("message"))))
        .withColumn("__rest", X.after_first_word(event))
        .withColumn("__time", X.event_time(event, rest))
        .withColumn("event_ts", X.parse_utc(time))
    )
    parsed = F.col("event_ts").isNotNull()
    return cut.withColumns(
        {
            "level": F.when(parsed, X.first_word(event)).otherwise(F.col("level")),
            "message": F.when(parsed, X.event_message(event, rest, time)).otherwise(
                F.col("message")
            ),
        }
    ).drop("__event", "__rest", "__time")


def java_lines(lines: DataFrame) -> DataFrame:
    """Defaults and message prefix of the Java logging stream."""
    return with_constants(lines, JAVA_LEVEL).withColumn(
        "message", F.concat(F.lit(JAVA_PREFIX), F.col("message"))
    )


def keeps_level(level: Column, threshold: str) -> Column:
    """Whether a threshold keeps a level. Unknown and null levels pass below FATAL."""
    if threshold in DROP_ALL:
        return F.lit(False)
    dropped = DROPPED_LEVELS[threshold]
    return ~F.coalesce(level.isin(*dropped), F.lit(False)) if dropped else F.lit(True)


def filter_level(records: DataFrame, threshold: str) -> DataFrame:
    """Apply the threshold to ``metadata.level`` of structured records."""
    return records.where(keeps_level(F.col("metadata.level"), threshold))


def flatten_records(records: DataFrame) -> DataFrame:
    """Turn structured agent records into log events."""
    flat = records.withColumns(
        {
            "container": F.lit(AGENT_CONTAINER),
            "level": F.col("metadata.level"),
            "logger": F.col("metadata.module_path"),
        }
    ).drop("metadata", "pid", "source_type")
    return flat.withColumnRenamed("file", "processed_file")


def fan_in(*streams: DataFrame) -> DataFrame:
    """Union of event streams with different fields."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return merged


def label(events: DataFrame, deployment: Deployment) -> DataFrame:
    """Add the labels of the one deployment that all events come from."""
    return events.withColumns(
        {
            "namespace": F.lit(deployment.namespace),
            "cluster": F.lit(deployment.cluster),
            "role": F.lit(deployment.role),
            "roleGroup": F.lit(deployment.role_group),
        }
    )


def label_by(
    events: DataFrame, deployments: DataFrame, on: str, salted: bool = False, hot: list | None = None
) -> DataFrame:
    """Add the labels of many deployments, found by the key of the source.

    ``salted`` spreads the events of hot keys, of streams those in ``hot``; see ``lookup_join``.
    """
    labels = deployments.select(on, "namespace", "cluster", "role", "roleGroup")
    return lookup_join(events, labels, on, salted=salted, hot=hot)


def as_log_events(events: DataFrame) -> DataFrame:
    """Bring events to the fixed columns of the log store; absent ones become null."""
    present = set(events.columns)

    def column(name: str) -> Column:
        if name in present:
            return F.col(name)
        kind = "timestamp" if name in ("timestamp", "event_ts") else "string"
        return F.lit(None).cast(kind).alias(name)

    return events.select(*[column(name) for name in LOG_COLUMNS])


def search(store: DataFrame, start, end) -> DataFrame:
    """Log view between two times. The derived date predicate prunes partitions."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    bounded = store.where(F.col("timestamp").between(low, high))
    if "log_date" in store.columns:
        bounded = bounded.where(F.col("log_date").between(F.to_date(low), F.to_date(high)))
    return bounded.select(*SEARCH_COLUMNS)
