"""The registered queries and the SQL they are checked against.

Every query reads the given tables as a whole. Where an operator needs requests, documents or
log lines, Spark derives them from table rows, one per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import schemas as S
from quayside.functions import addresses as A
from quayside.functions.text import json_text
from quayside.operators import logs as L
from quayside.operators import metadata as M
from quayside.operators import outcomes as O
from quayside.operators import provisioning as P
from quayside.operators import requests as R
from quayside.operators.log_index import index_files, search_words
from quayside.plans.copy_job import copy_objects
from quayside.plans.transfer import run_transfers
from quayside.session import configure, scratch_dir
from quayside.settings import Deployment, TransferSettings
from quayside.sources import documents as D
from quayside.sources.objects import (
    fetch_objects,
    list_objects,
    scan_objects,
    with_object_name,
    write_objects,
)
from quayside.streaming import log_stream as LS
from quayside.streaming.growing_files import read_growing_lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SETTINGS = TransferSettings(
    store_type="ObjectStore",
    default_endpoint="store.example.org",
    connector_endpoint="connector.example.org",
)
DEPLOYMENT = Deployment("default", "exchange", "server", "main")
LOG_ROOT = "/var/log/services"


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name together with its SQL."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _id(prefix: str, *columns: str | Column) -> Column:
    """``<prefix><value>-<value>...``"""
    return F.concat(F.lit(prefix), F.concat_ws("-", *columns))


def _customer_name(key: Column) -> Column:
    """Name of the customer with this key, as in the customer table."""
    return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))


def _address(kind: Column, key_name: Column, **properties: Column) -> Column:
    entries = [part for key, value in properties.items() for part in (F.lit(key), value)]
    return F.struct(
        kind.alias("type"), key_name.alias("keyName"), F.create_map(*entries).alias("properties")
    )


# ---------------------------------------------------------------- objects


def _settings_below(root: str) -> TransferSettings:
    return replace(SETTINGS, source_root=root, target_root=root)


def _page_parts(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.lit("pages").alias("bucket"),
        F.format_string("page-%d.html", "page_id").alias("name"),
        F.encode("html", "UTF-8").alias("content"),
    )


def _written_pages(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "objects")
    write_objects(_page_parts(_table(spark, sf_dir, "pages")), root, create_buckets=True)
    return root


@query("""
SELECT 'pages' AS bucket, 'page-' || page_id || '.html' AS name,
       CAST(octet_length(encode(html)) AS BIGINT) AS length, sha256(html) AS sha256,
       CAST(NULL AS VARCHAR) AS error
FROM pages
UNION ALL
SELECT CASE WHEN page_id % 20 = 5 THEN 'gone' ELSE 'pages' END,
       CASE page_id % 20 WHEN 3 THEN 'null-' WHEN 5 THEN 'page-' ELSE 'twice-' END || page_id || '.html', NULL, NULL,
       CASE page_id % 20 WHEN 3 THEN 'part null-' || page_id || '.html has no bytes'
            WHEN 5 THEN 'the bucket does not exist' ELSE 'the name is used for several parts' END
FROM pages, (VALUES (0), (1)) AS copies(c)
WHERE page_id % 20 IN (3, 5, 7) AND (c = 0 OR page_id % 20 = 7)
""")
def q_object_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are written and read again; parts that can't be written are rows with an error."""
    pages, root = _table(spark, sf_dir, "pages"), scratch_dir(spark, "objects")
    variant = F.col("page_id") % 20
    write_objects(_page_parts(pages.where(variant < 10)), root, create_buckets=True)
    kind = F.when(variant == 3, "null-%d.html").when(variant == 5, "page-%d.html").otherwise("twice-%d.html")
    bad = pages.where(variant.isin(3, 5, 7)).select(
        F.when(variant == 5, "gone").otherwise("pages").alias("bucket"),
        F.replace(kind, F.lit("%d"), _text("page_id")).alias("name"),
        F.when(variant != 3, F.encode("html", "UTF-8")).alias("content"),
        variant.alias("variant"),
    )
    twice = bad.where("variant = 7")
    more = _page_parts(pages.where(variant >= 10)).unionByName(bad.unionByName(twice).drop("variant"))
    refused = write_objects(more, root).where("error IS NOT NULL")
    found = with_object_name(scan_objects(spark, root), root)
    columns = ["bucket", "name", "length", "sha256", "error"]
    return (
        found.withColumn("sha256", F.sha2("content", 256)).select(columns)
        .unionByName(refused.withColumn("sha256", F.lit(None).cast("string")).select(columns))
    )


@query("""
SELECT 'page-' || page_id || '.html' AS name,
       CAST(octet_length(encode(html)) AS BIGINT) AS length
FROM pages
""")
def q_object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written_pages(spark, sf_dir)
    # Shares of few files, so that the folder of all pages is listed by several tasks.
    listed = with_object_name(list_objects(spark, root, "*.html", task_files=200), root)
    return listed.select("name", "length")


@query("""
SELECT CASE WHEN page_id % 4 = 1 THEN 'missing-' ELSE 'page-' END || page_id || '.html' AS name,
       CASE WHEN page_id % 4 <> 1 THEN CAST(octet_length(encode(html)) AS BIGINT) END AS length,
       CASE WHEN page_id % 4 <> 1 THEN sha256(html) END AS sha256,
       CASE WHEN page_id % 4 = 1 THEN 'the object does not exist' END AS error
FROM pages
""")
def q_object_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written_pages(spark, sf_dir)
    pattern = F.when(F.col("page_id") % 4 == 1, "missing-").otherwise("page-")
    names = _table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("bucket"),
        F.concat(pattern, _text("page_id"), F.lit(".html")).alias("name"),
    )
    return fetch_objects(names, root).select(
        "name", "length", F.sha2("content", 256).alias("sha256"), "error"
    )


@query("""
WITH requests AS (
  SELECT 'request-' || page_id AS request_id, page_id, html, page_id % 20 AS variant,
         CASE WHEN page_id % 3 = 0 THEN 'latest.html' ELSE 'page-' || page_id || '.html' END AS target
  FROM pages),
checked AS (
  SELECT *, CASE
      WHEN variant = 7 THEN 'blobName must not be empty'
      WHEN variant = 11 THEN 'the source type is not served here'
      WHEN variant = 3 THEN 'Error writing the copies/' || target
           || ' object on the pages bucket: the source object does not exist' END AS error
  FROM requests),
ranked AS (
  SELECT *, max(page_id) FILTER (WHERE error IS NULL) OVER (PARTITION BY target) AS last_request,
         octet_length(encode(html)) AS size
  FROM checked),
pieces AS (
  SELECT page_id, i, sha256(unhex(substr(hex(encode(html)), 5000 * i + 1, 5000))) AS digest
  FROM (SELECT page_id, html, unnest(range(greatest(1, CAST(ceil(size / 2500) AS BIGINT)))) AS i FROM ranked)),
hashed AS (SELECT page_id, sha256(string_agg(digest, '' ORDER BY i)) AS digest FROM pieces GROUP BY page_id)
SELECT request_id,
       CASE WHEN error IS NOT NULL THEN 'error' WHEN page_id < last_request THEN 'superseded'
            ELSE 'ok' END AS status,
       CASE WHEN error IS NULL AND page_id = last_request THEN CAST(size AS BIGINT) END AS bytes,
       CASE WHEN error IS NULL AND page_id = last_request THEN digest END AS range_sha256,
       CASE WHEN error IS NULL AND page_id = last_request AND size <= 2500 THEN sha256(html) END AS sha256,
       error
FROM ranked JOIN hashed USING (page_id)
""")
def q_object_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written_pages(spark, sf_dir)
    pages = _table(spark, sf_dir, "pages")
    variant = F.col("page_id") % 20
    name = F.format_string("page-%d.html", "page_id")
    # A third of all requests share one target.
    target = F.when(F.col("page_id") % 3 == 0, F.lit("latest.html")).otherwise(name)
    blob = F.when(variant == 7, "").when(variant == 3, "missing.html").otherwise(name)
    kind = F.when(variant == 11, "Other").otherwise(SETTINGS.store_type)
    manifest = pages.select(
        _id("request-", "page_id").alias("request_id"),
        F.col("page_id").alias("sequence"),
        _address(
            kind, F.concat(F.lit("copies/"), target), bucketName=F.lit("Pages"), blobName=blob
        ).alias("src"),
        _address(
            F.lit(SETTINGS.store_type),
            _customer_name(F.col("page_id")),
            bucketName=F.lit("PAGES"),
        ).alias("dst"),
    )
    work_dir = scratch_dir(spark, "copy")
    # Pages are short, so that short ranges are needed to have several of an object.
    status = copy_objects(
        manifest, _registry(spark, sf_dir), _settings_below(root), work_dir, chunk_bytes=2500
    )
    return status.select("request_id", "status", "bytes", "range_sha256", "sha256", "error")


@query("""
SELECT 'transfer-' || page_id AS request_id,
       CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN error IS NULL THEN CAST(octet_length(encode(html)) AS BIGINT) END AS bytes,
       CASE WHEN error IS NULL THEN sha256(html) END AS sha256,
       error,
       page_id % 10 NOT IN (5, 6) AS complete
FROM (SELECT *, CASE WHEN page_id % 10 = 5 THEN 'Error writing the received/' || page_id
                          || '.html object on the absent bucket: the bucket does not exist'
                     WHEN page_id % 5 = 1 THEN 'no such agreement'
                     WHEN page_id % 5 = 2 THEN 'agreement is for another asset'
                     WHEN page_id % 5 = 4 THEN 'Bucket:PAGES exists' END AS error
      FROM pages)
""")
def q_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset and transfer documents are read and resolved, buckets provided, objects copied and audited."""
    root = _written_pages(spark, sf_dir)
    pages, documents = _table(spark, sf_dir, "pages"), scratch_dir(spark, "documents")
    page, variant = F.col("page_id"), F.col("page_id") % 5
    pages.select(
        F.format_string(
            '{"asset":{"@id":"asset-%d","properties":{"name":"page"}},"dataAddress":{"type":"Outer",'
            '"properties":{"type":"%s","bucketName":"Pages","blobName":"page-%d.html",'
            '"keyName":"received/%d.html"}}}',
            page, F.lit(SETTINGS.store_type), page, page,
        ).alias("value")
    ).write.text(f"{documents}/assets")
    pages.select(
        F.format_string(
            '{"@id":"transfer-%d","contractId":"contract-%d","assetId":"asset-%d","dataDestination":'
            '{"type":"%s","bucketName":"%s","keyName":"Customer#%09d"},"managedResources":%s}',
            page, F.when(variant == 1, -1).otherwise(page), page,
            F.lit(SETTINGS.store_type), F.when(variant == 3, F.format_string("New-%d", page % 100))
            .when(variant == 4, "PAGES").when((page % 10).isin(5, 6), "Absent").otherwise("pages"), page,
            F.when(variant >= 3, "true").otherwise("false"),
        ).alias("value")
    ).write.text(f"{documents}/transfers")
    agreements = pages.select(
        _id("contract-", page).alias("contract_id"),
        F.format_string("asset-%d", F.when(variant == 2, page + 1).otherwise(page)).alias("agreed_asset"),
    )
    # Every agreement is there twice, as it is when replies are read twice.
    agreements = agreements.unionByName(agreements)
    status = run_transfers(
        D.read_transfers(spark, f"{documents}/transfers"),
        agreements,
        D.read_assets(spark, f"{documents}/assets"),
        _registry(spark, sf_dir),
        _settings_below(root),
        scratch_dir(spark, "transfer"),
    )
    return status.select("request_id", "status", "bytes", "sha256", "error", "complete")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_delimited_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    path = scratch_dir(spark, "delimited")
    D.write_delimited(supplier, path)
    return D.read_delimited(spark, path, supplier.schema)


# ---------------------------------------------------------------- log pipeline, batch


def _event_messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat_ws(" ", "event_type", "props").alias("message"),
        F.concat(
            F.lit(f"{LOG_ROOT}/"), "event_type", F.lit("/"), _text("user_id"), F.lit(".stdout.log")
        ).alias("file"),
    )


@query("""
SELECT event_type || ' ' || props AS message,
       '/var/log/services/' || event_type || '/' || user_id || '.stdout.log' AS file,
       'ROOT' AS logger, 'INFO' AS level
FROM events
UNION ALL
SELECT text, '/var/log/services/' || role || '/' || conv_id || '.stderr.log', 'ROOT', 'ERROR'
FROM conversations
""")
def q_log_constants_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    stderr = _table(spark, sf_dir, "conversations").select(
        F.col("text").alias("message"),
        F.concat(
            F.lit(f"{LOG_ROOT}/"), "role", F.lit("/"), _text("conv_id"), F.lit(".stderr.log")
        ).alias("file"),
    )
    return L.standard_streams(_event_messages(_table(spark, sf_dir, "events")), stderr)


@query("""
SELECT event_type || ' ' || props AS message, 'ROOT' AS logger, 'INFO' AS level,
       event_type AS container, user_id || '.stdout.log' AS file,
       CAST(NULL AS VARCHAR) AS processed_file
FROM events
UNION ALL
SELECT 'Java Logging: ' || text, 'ROOT', 'INFO', source, lang || '.0.logger', NULL FROM documents
UNION ALL
SELECT text, 'turn', role, 'vector', NULL, 'conversation-' || conv_id FROM conversations
""")
def q_log_fanin(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = L.split_path(
        L.with_constants(_event_messages(_table(spark, sf_dir, "events")), L.STDOUT_LEVEL), LOG_ROOT
    )
    java = L.java_lines(
        _table(spark, sf_dir, "documents").select(
            F.col("text").alias("message"),
            F.col("source").alias("container"),
            F.concat("lang", F.lit(".0.logger")).alias("file"),
        )
    )
    agent = L.flatten_records(
        _table(spark, sf_dir, "conversations").select(
            F.col("text").alias("message"),
            F.concat(F.lit("conversation-"), _text("conv_id")).alias("file"),
            F.lit(1).cast("long").alias("pid"),
            F.lit("internal_logs").alias("source_type"),
            F.struct(F.col("role").alias("level"), F.lit("turn").alias("module_path")).alias(
                "metadata"
            ),
        )
    )
    return L.fan_in(captured, java, agent).select(
        "message", "logger", "level", "container", "file", "processed_file"
    )


@query(r"""
WITH paths AS (
  SELECT page_id, '/var/log/services/' || regexp_replace(url, '://', '/') AS path FROM pages)
SELECT page_id,
       nullif(regexp_extract(path, '^/var/log/services/([^/]*)/(.*?)/(.*?)$', 1), '') AS pod,
       nullif(regexp_extract(path, '^/var/log/services/([^/]*)/(.*?)/(.*?)$', 2), '') AS container,
       coalesce(nullif(regexp_extract(path, '^/var/log/services/([^/]*)/(.*?)/(.*?)$', 3), ''),
                'file://' || path) AS file
FROM paths
""")
def q_log_path_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit(f"file://{LOG_ROOT}/"), F.regexp_replace("url", "://", "/")).alias("file"),
    )
    return L.split_path(lines, LOG_ROOT, with_pod=True).select("page_id", "pod", "container", "file")


def _event_lines(events: DataFrame) -> DataFrame:
    """One log line per event: plain, coloured, prefixed, bracketed, or with an invalid date."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    level = F.upper("event_type")
    tail = F.concat(F.lit(" user "), _text("user_id"), F.lit(" "), F.col("props"))
    variant = F.col("event_id") % 5
    line = (
        F.when(variant == 0, F.concat(F.lit("  plain "), level, tail))
        .when(variant == 1, F.concat(F.lit("\x1b[31m "), level, F.lit("  "), time, tail, F.lit(" \x1b[0m ")))
        .when(variant == 2, F.concat(F.lit("xx "), level, F.lit(" "), time, F.lit(" "), tail))
        .when(variant == 3, F.concat(F.lit("["), level, F.lit("] "), time, tail))
        .otherwise(F.concat(level, F.lit(" 2024-02-31T10:11:12.5"), tail))
    )
    return events.select("event_id", "event_type", line.alias("message"))


_SQL_LINES = r"""
lines AS (
  SELECT event_id, event_type,
         CASE event_id % 5
           WHEN 0 THEN '  plain ' || lvl || tail
           WHEN 1 THEN chr(27) || '[31m ' || lvl || '  ' || time || tail || ' ' || chr(27) || '[0m '
           WHEN 2 THEN 'xx ' || lvl || ' ' || time || ' ' || tail
           WHEN 3 THEN '[' || lvl || '] ' || time || tail
           ELSE lvl || ' 2024-02-31T10:11:12.5' || tail END AS line
  FROM (SELECT *, upper(event_type) AS lvl, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS time,
               ' user ' || user_id || ' ' || props AS tail FROM events)),
parts AS (
  SELECT *, regexp_extract(
      trim(regexp_replace(line, '\x1b\[[0-9;]*[A-Za-z]', '', 'g')),
      '(\w+) +([0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[1-2][0-9]|3[0-1])T(?:2[0-3]|[01][0-9]):[0-5][0-9]:[0-5][0-9].[0-9]+) +(.*)',
      ['level', 'time', 'message']) AS p
  FROM lines),
parsed AS (
  SELECT event_id, event_type, try_cast(p.time AS TIMESTAMP) AS event_ts,
         CASE WHEN try_cast(p.time AS TIMESTAMP) IS NULL THEN NULL ELSE p.level END AS level,
         CASE WHEN try_cast(p.time AS TIMESTAMP) IS NULL THEN line ELSE p.message END AS message
  FROM parts)
"""


def _naive(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


@query(f"""
WITH {_SQL_LINES}
SELECT event_id, 'ROOT' AS logger, coalesce(level, 'INFO') AS level, event_ts, message FROM parsed
""")
def q_log_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _event_lines(_table(spark, sf_dir, "events"))
    parsed = L.parse_lines(L.with_constants(lines, L.STDOUT_LEVEL))
    return parsed.select("event_id", "logger", "level", _naive("event_ts"), "message")


def _event_level() -> Column:
    known = {"click": "TRACE", "view": "DEBUG", "signup": "INFO", "purchase": "WARN"}
    level = F.when(F.col("event_id") % 7 == 0, F.lit(None))
    for kind, name in known.items():
        level = level.when(F.col("event_type") == kind, name)
    return level.otherwise("ERROR")


_SQL_LEVEL = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_type = 'click' THEN 'TRACE'
    WHEN event_type = 'view' THEN 'DEBUG' WHEN event_type = 'signup' THEN 'INFO'
    WHEN event_type = 'purchase' THEN 'WARN' ELSE 'ERROR' END"""


@query(f"""
WITH levels AS (SELECT event_id, {_SQL_LEVEL} AS level FROM events),
thresholds(threshold, dropped) AS (VALUES ('TRACE', []), ('DEBUG', ['TRACE']),
  ('INFO', ['TRACE', 'DEBUG']), ('WARN', ['TRACE', 'DEBUG', 'INFO']),
  ('ERROR', ['TRACE', 'DEBUG', 'INFO', 'WARN']))
SELECT threshold, event_id, level FROM levels, thresholds
WHERE NOT coalesce(list_contains(dropped, level), false)
""")
def q_log_level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "events").select("event_id", _event_level().alias("level"))
    # All seven thresholds in one pass; filter_level applies a single one.
    kept = [
        F.when(L.keeps_level(F.col("level"), threshold), F.lit(threshold))
        for threshold in (*L.DROPPED_LEVELS, *L.DROP_ALL)
    ]
    return records.select(
        F.explode(F.array_compact(F.array(*kept))).alias("threshold"), "event_id", "level"
    )


def _agent_records(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat_ws(" ", "event_type", _text("event_id")).alias("message"),
        F.when(F.col("event_id") % 2 == 0, F.format_string("agent-%d.log", "user_id")).alias("file"),
        F.col("user_id").alias("pid"),
        F.lit("internal_logs").alias("source_type"),
        _id("pod-", "user_id").alias("pod"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.struct(
            _event_level().alias("level"), json_text(F.col("props"), "k").alias("module_path")
        ).alias("metadata"),
    )


_SQL_AGENT = f"""
SELECT event_type || ' ' || event_id AS message,
       CASE WHEN event_id % 2 = 0 THEN 'agent-' || user_id || '.log' END AS processed_file,
       'pod-' || user_id AS pod, ts AS timestamp, 'vector' AS container,
       {_SQL_LEVEL} AS level, json_extract_string(props, '$.k') AS logger
FROM events
"""


@query(_SQL_AGENT)
def q_log_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = L.flatten_records(_agent_records(_table(spark, sf_dir, "events")))
    return flat.withColumn("timestamp", _naive("timestamp"))


@query("""
SELECT event_id, user_id AS source, r_name AS namespace, n_name AS cluster, c_mktsegment AS role,
       c_name AS "roleGroup"
FROM events LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey
                       JOIN region ON n_regionkey = r_regionkey) ON user_id * 11 = c_custkey
""")
def q_log_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    deployments = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("deployment"),
            F.col("r_name").alias("namespace"),
            F.col("n_name").alias("cluster"),
            F.col("c_mktsegment").alias("role"),
            F.col("c_name").alias("roleGroup"),
        )
    )
    events = _table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("source"), (F.col("user_id") * 11).alias("deployment")
    )
    return L.label_by(events, deployments, "deployment").drop("deployment")


@query("""
SELECT ts AS timestamp, 'pod-' || user_id AS pod, event_type AS container, 'ROOT' AS logger,
       'INFO' AS level, props AS message
FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'
""")
def q_log_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        _id("pod-", "user_id").alias("pod"),
        F.col("event_type").alias("container"),
        F.lit(L.ROOT_LOGGER).alias("logger"),
        F.lit(L.STDOUT_LEVEL).alias("level"),
        F.col("props").alias("message"),
    )
    found = L.search(store, "2024-01-03 06:00:00", "2024-01-20 18:30:00")
    return found.withColumn("timestamp", _naive("timestamp"))


@query("""
SELECT ts AS timestamp, 'pod-' || user_id AS pod, event_type AS container, 'ROOT' AS logger,
       'INFO' AS level, event_type || ' ' || props AS message
FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'
  AND event_type = 'purchase' AND list_contains(regexp_extract_all(lower(props), '[0-9a-z_]+'), 'k')
""")
def q_log_word_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two words in a stored log, found through the index; the files of the last dates are not indexed."""
    root = scratch_dir(spark, "log-index")
    events = _table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        _id("pod-", "user_id").alias("pod"),
        F.col("event_type").alias("container"),
        F.lit(L.ROOT_LOGGER).alias("logger"),
        F.lit(L.STDOUT_LEVEL).alias("level"),
        F.concat_ws(" ", "event_type", "props").alias("message"),
        F.to_date("ts").alias("log_date"),
    )
    early = F.col("log_date") < F.lit("2024-01-15").cast("date")
    events.where(early).write.partitionBy("log_date").parquet(f"{root}/store")
    index_files(spark, f"{root}/store", f"{root}/index")
    events.where(~early).write.partitionBy("log_date").mode("append").parquet(f"{root}/store")
    found = search_words(
        spark, f"{root}/store", f"{root}/index", "K Purchase", "2024-01-03 06:00:00", "2024-01-20 18:30:00"
    )
    return found.withColumn("timestamp", _naive("timestamp"))


# ---------------------------------------------------------------- metadata


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, 'offer:' || event_id AS offer_id,
       'negotiation-' || event_id AS negotiation_id, 'agreement-' || user_id AS agreement_id
FROM events
""")
def q_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.format_string(
        '{"dcat:dataset":{"@id":"d","odrl:hasPolicy":{"@id":"offer:%d","odrl:permission":[]}},'
        '"@id":"negotiation-%d","v:contractAgreementId":"agreement-%d"}',
        "event_id",
        "event_id",
        "user_id",
    )
    replies = _table(spark, sf_dir, "events").select(
        "event_id", json_text(F.col("props"), "k").alias("k"), reply.alias("document")
    )
    found = M.agreement_id(M.negotiation_id(M.catalogue_offer_id(replies)), "v")
    return found.drop("document")


@query("""
WITH written AS (
  SELECT *, '{"@id":"request-' || c_custkey || '","@type":"TransferRequestDto","connectorId":"consumer",'
      || '"protocol":"message-http","contractId":"contract-' || c_custkey || '","protocol":"message-http",'
      || '"assetId":"' || c_name || '","dataDestination":{"type":"' || c_mktsegment || '","storage":'
      || CASE WHEN c_custkey % 4 = 0 THEN 'null' ELSE '"store-' || c_nationkey || '"' END
      || ',"bucketName":"' || lower(c_mktsegment) || '-bucket","keyName":"' || c_name || '","secretKey":"***"}' AS document
  FROM customer)
SELECT 'request-' || c_custkey AS request_id, 'contract-' || c_custkey AS contract_id,
       c_name AS asset_id, 'message-http' AS protocol, c_mktsegment AS dst_type,
       lower(c_mktsegment) || '-bucket' AS dst_bucket,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'store-' || c_nationkey END AS dst_storage,
       c_name AS dst_key, c_custkey % 2 = 0 AS managed_resources, NULL AS broken
FROM written WHERE c_custkey % 50 NOT IN (7, 9)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE c_custkey % 50 WHEN 7 THEN left(document, 60) ELSE document END
FROM written WHERE c_custkey % 50 IN (7, 9)
""")
def q_metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The documents repeat the key "protocol"; the later entry counts.
    storage = F.when(F.col("c_custkey") % 4 == 0, F.lit("null")).otherwise(
        F.format_string('"store-%d"', "c_nationkey")
    )
    document = F.format_string(
        '{"@id":"request-%d","@type":"TransferRequestDto","connectorId":"consumer",'
        '"protocol":"message-http","contractId":"contract-%d","protocol":"message-http",'
        '"assetId":"%s","dataDestination":{"type":"%s","storage":%s,"bucketName":"%s-bucket",'
        '"keyName":"%s","secretKey":"hidden"},"managedResources":%s}',
        F.col("c_custkey"),
        F.col("c_custkey"),
        F.col("c_name"),
        F.col("c_mktsegment"),
        storage,
        F.lower("c_mktsegment"),
        F.col("c_name"),
        (F.col("c_custkey") % 2 == 0).cast("string"),
    )
    # Some documents are cut off, at different places.
    kept = F.when(F.col("c_custkey") % 50 == 7, 60).when(F.col("c_custkey") % 50 == 9, F.instr("value", ',"managed') - 1)
    documents = _table(spark, sf_dir, "customer").select("c_custkey", document.alias("value"))
    path = scratch_dir(spark, "transfers")
    documents.select(F.left("value", F.coalesce(kept, F.length("value"))).alias("value")).write.text(path)
    target = F.col("dst")
    return D.read_transfers(spark, path).select(
        # Broken documents have ids made from their text.
        F.when(F.col("broken").isNull(), F.col("request_id")).alias("request_id"),
        "contract_id",
        "asset_id",
        "protocol",
        target["type"].alias("dst_type"),
        A.property_of(target, S.BUCKET_NAME).alias("dst_bucket"),
        A.property_of(target, S.STORAGE).alias("dst_storage"),
        target["keyName"].alias("dst_key"),
        "managed_resources",
        "broken",
    )


@query("""
SELECT 'asset-' || p_partkey AS asset_id, p_name AS name, 'application/json' AS content_type,
       CASE WHEN p_size % 2 = 0 THEN 'ObjectStore' ELSE 'Other' END AS src_type,
       p_name || '.csv' AS src_key, p_brand AS bucket, p_name || '.csv' AS blob,
       CAST(NULL AS VARCHAR) AS secret
FROM part
""")
def q_asset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    file_name = F.concat("p_name", F.lit(".csv"))
    properties = F.create_map(
        F.lit("bucketName"), F.col("p_brand"), F.lit("blobName"), file_name,
        F.lit("keyName"), file_name, F.lit("secretKey"), F.lit("hidden"),
        F.lit("type"), F.when(F.col("p_size") % 2 == 0, SETTINGS.store_type),
    )
    document = F.struct(
        F.struct(
            _id("asset-", "p_partkey").alias("@id"),
            F.struct(
                F.col("p_name").alias("name"), F.lit("application/json").alias("contenttype")
            ).alias("properties"),
        ).alias("asset"),
        F.struct(F.lit("Other").alias("type"), properties.alias("properties")).alias("dataAddress"),
    )
    path = scratch_dir(spark, "assets")
    _table(spark, sf_dir, "part").select(F.to_json(document).alias("value")).write.text(path)
    source = F.col("src")
    return D.read_assets(spark, path).select(
        "asset_id",
        "name",
        "content_type",
        source["type"].alias("src_type"),
        source["keyName"].alias("src_key"),
        A.property_of(source, S.BUCKET_NAME).alias("bucket"),
        A.property_of(source, S.BLOB_NAME).alias("blob"),
        A.property_of(source, "secretKey").alias("secret"),
    )


@query("""
SELECT 'request-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS request_id,
       o_custkey IS NOT NULL AS agreed, p_name AS source_object,
       CASE WHEN o_orderkey IS NULL THEN 'no such agreement'
            WHEN o_orderkey % 997 <> r.asset_id THEN 'agreement is for another asset'
            WHEN p_partkey IS NULL THEN 'no such asset' ELSE 'resolved' END AS resolution
FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN -l_orderkey - 1 ELSE l_orderkey END AS contract_id,
             CASE WHEN l_linenumber = 7 THEN l_partkey ELSE l_orderkey % 997 END AS asset_id
      FROM lineitem) r
LEFT JOIN orders ON r.contract_id = o_orderkey LEFT JOIN part ON r.asset_id = p_partkey
""")
def q_request_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    requests = _table(spark, sf_dir, "lineitem").select(
        _id("request-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("request_id"),
        F.when(line == 1, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")).alias("contract_id"),
        F.when(line == 7, F.col("l_partkey")).otherwise(F.col("l_orderkey") % 997).alias("asset_id"),
    )
    agreements = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("contract_id"), (F.col("o_orderkey") % 997).alias("agreed_asset")
    )
    assets = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asset_id"), F.struct(F.col("p_name").alias("blobName")).alias("src")
    )
    return M.resolve_requests(requests, agreements, assets).select(
        "request_id",
        F.col("agreed_asset").isNotNull().alias("agreed"),
        F.col("src.blobName").alias("source_object"),
        "resolution",
    )


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey AS definition_id, l_partkey * 2 AS asset_id,
       d.access_policy_id, d.contract_policy_id,
       CASE WHEN d.s_suppkey IS NULL THEN 'no such definition'
            WHEN d.s_acctbal < 0 THEN 'asset selectors are not supported'
            WHEN a.c_custkey IS NULL THEN 'no such access policy'
            WHEN c.c_custkey IS NULL THEN 'no such contract policy'
            WHEN p_partkey IS NULL THEN 'no such asset' ELSE 'offered' END AS status
FROM lineitem
LEFT JOIN (SELECT s_suppkey, s_acctbal, s_suppkey * 17 AS access_policy_id,
                  s_suppkey * 16 AS contract_policy_id FROM supplier) d ON l_suppkey = d.s_suppkey
LEFT JOIN customer a ON d.access_policy_id = a.c_custkey
LEFT JOIN customer c ON d.contract_policy_id = c.c_custkey
LEFT JOIN part ON l_partkey * 2 = p_partkey
""")
def q_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    definitions = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("definition_id"),
        (F.col("s_suppkey") * 17).alias("access_policy_id"),
        (F.col("s_suppkey") * 16).alias("contract_policy_id"),
        F.when(F.col("s_acctbal") < 0, F.array("s_name"))
        .otherwise(F.array().cast("array<string>"))
        .alias("assets_selector"),
    )
    policies = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("policy_id"))
    assets = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asset_id"))
    offers = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("definition_id"),
        (F.col("l_partkey") * 2).alias("asset_id"),
    )
    return M.resolve_offers(offers, definitions, policies, assets)


@query("""
SELECT 'agreement-' || o_orderkey AS contract_id, 'asset-' || o_custkey AS agreed_asset
FROM orders WHERE o_orderstatus <> 'P'
""")
def q_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a negotiation; pending ones have replies, but no agreement yet."""
    orders = _table(spark, sf_dir, "orders")
    negotiations = orders.select(
        _id("negotiation-", "o_orderkey").alias("negotiation_id"),
        _id("asset-", "o_custkey").alias("asset_id"),
    )
    early = orders.select(
        F.concat(F.lit('{"@id":"negotiation-'), "o_orderkey", F.lit('"}')).alias("document")
    )
    agreed = F.concat(
        F.lit('{"@id":"negotiation-'), "o_orderkey", F.lit('","v:contractAgreementId":"agreement-'),
        "o_orderkey", F.lit('"}'),
    )
    pending = F.concat(F.lit('{"@id":"negotiation-'), "o_orderkey", F.lit('"}'))
    late = orders.select(
        F.when(F.col("o_orderstatus") == "P", pending).otherwise(agreed).alias("document")
    )
    replies = early.unionByName(late).unionByName(late)
    return M.reached_agreements(negotiations, replies, "v")


# ---------------------------------------------------------------- requests


def _order_manifest(orders: DataFrame, kind: Column) -> DataFrame:
    key = F.col("o_orderkey")
    blob = F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, "").otherwise(
        _id("object-", key)
    )
    source_bucket = F.when(key % 4 == 0, "  ").otherwise(F.col("o_orderstatus"))
    target_bucket = F.when(key % 5 == 0, F.lit(None)).otherwise(F.lit("Target"))
    storage = F.when(key % 3 == 0, F.lit(None)).when(key % 3 == 1, "").otherwise(
        _id("store-", key)
    )
    return orders.select(
        _text("o_orderkey").alias("request_id"),
        _address(kind, _text("o_orderkey"), blobName=blob, bucketName=source_bucket).alias("src"),
        _address(
            kind,
            _customer_name(F.col("o_custkey") * 2),
            bucketName=target_bucket,
            storage=storage,
        ).alias("dst"),
    )


@query("""
WITH checked AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 3 <> 2 THEN 'blobName must not be empty' END AS e1,
         CASE WHEN o_orderkey % 4 = 0 THEN 'bucketName must not be empty' END AS e2,
         CASE WHEN o_orderkey % 5 = 0 THEN 'bucketName must not be empty' END AS e3
  FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       CAST((e1 IS NOT NULL)::INT + (e2 IS NOT NULL)::INT AS INTEGER) AS source_failures,
       CAST((e3 IS NOT NULL)::INT AS INTEGER) AS destination_failures,
       nullif(concat_ws(', ', e1, e2, e3), '') AS error
FROM checked
""")
def q_address_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _order_manifest(_table(spark, sf_dir, "orders"), F.lit(SETTINGS.store_type))
    return R.validate_requests(manifest).select(
        "request_id",
        F.size("source_errors").alias("source_failures"),
        F.size("destination_errors").alias("destination_failures"),
        "error",
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, o_orderpriority AS source_type,
       coalesce(o_orderpriority = '1-URGENT', false) AS routed
FROM orders
""")
def q_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = TransferSettings("1-URGENT", "", "")
    manifest = _order_manifest(_table(spark, sf_dir, "orders"), F.col("o_orderpriority"))
    return R.route_requests(manifest, settings).select(
        "request_id", F.col("src.type").alias("source_type"), "routed"
    )


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("key_name"),
        (F.col("c_acctbal") > 0).alias("has_token"),
        F.lit(None).cast("timestamp").alias("expires_at"),
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS request_id, coalesce(c_acctbal > 0, false) AS has_token,
       'connector.example.org' AS source_endpoint,
       CASE WHEN coalesce(c_acctbal > 0, false) THEN
              CASE o_orderkey % 3 WHEN 0 THEN 'store.example.org' WHEN 1 THEN ''
                   ELSE 'store-' || o_orderkey END
            ELSE 'connector.example.org' END AS target_endpoint
FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey
""")
def q_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _order_manifest(_table(spark, sf_dir, "orders"), F.lit(SETTINGS.store_type))
    return R.resolve_endpoints(manifest, _registry(spark, sf_dir), SETTINGS).select(
        "request_id", "has_token", "source_endpoint", "target_endpoint"
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS request_id, c_mktsegment AS source_bucket_raw,
       lower(c_mktsegment) AS source_bucket, 'target-' || lower(c_mktsegment) AS target_bucket,
       's3a://' || lower(c_mktsegment) || '/' || c_name AS source_uri,
       's3a://target-' || lower(c_mktsegment) || '/key-' || c_custkey AS target_uri,
       'target-' || lower(c_mktsegment) || '-key' AS key_name,
       c_custkey || '-container' AS resource_name
FROM customer
""")
def q_bucket_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("request_id"),
        _address(
            F.lit(SETTINGS.store_type),
            _id("key-", "c_custkey"),
            bucketName=F.col("c_mktsegment"),
            blobName=F.col("c_name"),
        ).alias("src"),
        _address(
            F.lit(SETTINGS.store_type),
            F.lit("unused"),
            bucketName=F.concat(F.lit("Target-"), "c_mktsegment"),
        ).alias("dst"),
    )
    return R.name_objects(manifest, SETTINGS).select(
        "request_id",
        "source_bucket_raw",
        "source_bucket",
        "target_bucket",
        "source_uri",
        "target_uri",
        A.key_name(F.col("target_bucket")).alias("key_name"),
        A.resource_name(F.col("request_id")).alias("resource_name"),
    )


@query("SELECT event_id, epoch_us(ts + INTERVAL 1 HOUR) // 1000 AS expires_ms FROM events")
def q_token_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued = F.col("ts").cast("timestamp")
    return _table(spark, sf_dir, "events").select(
        "event_id", A.token_expiry(issued).alias("expires_ms")
    )


# ---------------------------------------------------------------- provisioning, outcomes


def _definitions(orders: DataFrame) -> DataFrame:
    return orders.select(
        _text("o_orderkey").alias("definition_id"),
        _id("process-", "o_orderkey").alias("transfer_process_id"),
        _customer_name(F.col("o_custkey") * 2).alias("bucket_raw"),
        F.lit(None).cast("string").alias("storage"),
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS definition_id, 'customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') AS bucket,
       CASE WHEN c_custkey IS NULL THEN 'create' ELSE 'conflict' END AS action,
       CASE WHEN c_custkey IS NOT NULL
            THEN 'Bucket:Customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') || ' exists' END AS error
FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey
""")
def q_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = _table(spark, sf_dir, "customer").select(F.upper("c_name").alias("bucket"))
    definitions = _definitions(_table(spark, sf_dir, "orders"))
    return P.preflight(definitions, inventory).select("definition_id", "bucket", "action", "error")


@query("""
SELECT 'customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') AS id,
       'process-' || o_orderkey AS "transferProcessId", sha256('process-' || o_orderkey) AS "resourceDefinitionId",
       sha256('process-' || o_orderkey) || '-container' AS "resourceName",
       'customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') AS "bucketName",
       CASE WHEN o_orderkey % 2 = 0 THEN 'store' END AS storage
FROM orders
""")
def q_provision(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _table(spark, sf_dir, "orders").select(
        _id("process-", "o_orderkey").alias("request_id"),
        _address(
            F.lit(SETTINGS.store_type),
            F.lit("key"),
            bucketName=_customer_name(F.col("o_custkey") * 2),
            storage=F.when(F.col("o_orderkey") % 2 == 0, "store"),
        ).alias("dst"),
    )
    resources = P.provisioned_resources(P.resource_definitions(requests, SETTINGS))
    # Resources go through their document form and back.
    return P.resource_from_json(P.resource_to_json(resources))


@query("""
WITH first AS (
  SELECT l_orderkey, arg_min('P' || l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) AS bucket
  FROM lineitem GROUP BY l_orderkey),
known AS (SELECT CASE WHEN p_size > 25 THEN 'p' || p_partkey ELSE 'b' || p_partkey END AS bucket FROM part)
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       lower(coalesce(first.bucket, 'B' || o_custkey)) AS checked_bucket,
       known.bucket IS NOT NULL AS complete
FROM orders LEFT JOIN first ON o_orderkey = l_orderkey
LEFT JOIN known ON lower(coalesce(first.bucket, 'B' || o_custkey)) = known.bucket
""")
def q_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("request_id"),
        _id("B", "o_custkey").alias("dest_bucket"),
    )
    resources = _table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("request_id"),
        # Line numbers repeat within an order, so the part key decides between equal ones.
        F.struct("l_linenumber", "l_partkey").alias("ord"),
        _id("P", "l_partkey").alias("bucket"),
    )
    name = F.when(F.col("p_size") > 25, _id("P", "p_partkey")).otherwise(
        _id("B", "p_partkey")
    )
    inventory = _table(spark, sf_dir, "part").select(name.alias("bucket"))
    return P.completion(requests, resources, inventory).select(
        "request_id", "checked_bucket", "complete"
    )


# Line numbers repeat within an order; together these columns do not.
_PART_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("request_id"),
        *_PART_ORDER,
        (F.col("l_returnflag") != "R").alias("ok"),
        F.when(
            F.col("l_returnflag") == "R",
            A.write_failure(
                _id("part-", "l_partkey"),
                _id("supplier-", "l_suppkey"),
                F.lit("returned"),
            ),
        ).alias("error"),
    )


_SQL_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(f"""
SELECT l_orderkey AS request_id, {_SQL_ORDER},
       CASE WHEN coalesce(max((l_returnflag = 'R')::INT) OVER w, 0) = 1 THEN 'not_attempted'
            WHEN l_returnflag = 'R' THEN 'failed' ELSE 'ok' END AS status
FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_SQL_ORDER}
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def q_part_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.part_status(_parts(spark, sf_dir), _PART_ORDER).drop("ok", "error")


@query(f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY (l_returnflag = 'R') DESC, {_SQL_ORDER}) AS rn
  FROM lineitem)
SELECT l_orderkey AS request_id,
       CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'success' END AS status,
       CASE WHEN l_returnflag = 'R' THEN 'Error writing the part-' || l_partkey
            || ' object on the supplier-' || l_suppkey || ' bucket: returned' END AS error
FROM ranked WHERE rn = 1
""")
def q_request_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.request_outcome(_parts(spark, sf_dir), _PART_ORDER)


# ---------------------------------------------------------------- log pipeline, streams

_LINES_PER_FILE = 500


def _as_files(lines: DataFrame, *names: str) -> DataFrame:
    """Closed files of at most 500 lines, cut by id range: ``<names>, file_no, content``."""
    numbered = lines.withColumn("file_no", F.floor(F.col("event_id") / _LINES_PER_FILE))
    in_order = F.array_sort(F.collect_list(F.struct("event_id", "message")))
    text = F.array_join(F.transform(in_order, lambda line: line["message"]), "\n")
    return numbered.groupBy(*names, "file_no").agg(
        F.encode(F.concat(text, F.lit("\n")), "UTF-8").alias("content")
    )


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@query(f"""
WITH {_SQL_LINES}
SELECT event_type AS container,
       'events-' || (event_id // 500) || CASE WHEN event_type = 'error' THEN '.stderr.log' ELSE '.stdout.log' END AS file,
       'ROOT' AS logger,
       coalesce(level, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END) AS level,
       event_ts, message, 'default' AS namespace, 'exchange' AS cluster, 'server' AS role,
       'main' AS "roleGroup"
FROM parsed
""")
def q_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds; in the second one every file has grown, from wherever in a line the first one found it."""
    root = scratch_dir(spark, "log-stream")
    files = _as_files(_event_lines(_table(spark, sf_dir, "events")), "event_type")
    suffix = F.when(F.col("event_type") == "error", ".stderr.log").otherwise(".stdout.log")
    landed = files.select(
        F.col("event_type").alias("bucket"),
        F.concat(F.lit("events-"), _text("file_no"), suffix).alias("name"),
        "content",
    )

    def run() -> None:
        events = LS.log_events(
            f"{_below_scheme(root)}/landing",
            DEPLOYMENT,
            stdout=read_growing_lines(spark, f"{root}/landing", LS.STDOUT_FILES),
            stderr=read_growing_lines(spark, f"{root}/landing", LS.STDERR_FILES),
        )
        LS.start_store(events, f"{root}/store", f"{root}/checkpoint", files_per_date=2).awaitTermination()

    part = F.expr("substring(content, 1, cast(length(content) * 0.6 as int))")
    write_objects(landed.withColumn("content", part), f"{root}/landing", create_buckets=True)
    run()
    write_objects(landed, f"{root}/landing")
    run()
    return _stored(spark, f"{root}/store").select(
        "container", "file", "logger", "level", _naive("event_ts"), "message",
        "namespace", "cluster", "role", "roleGroup",
    )


def _below_scheme(uri: str) -> str:
    scheme, found, rest = uri.partition("://")
    return "/" + rest.partition("/")[2] if found else scheme


@query(f"""
SELECT message, processed_file, pod, timestamp, container, level, logger,
       CAST(timestamp AS DATE) AS log_date
FROM ({_SQL_AGENT}) WHERE level IS NULL OR level NOT IN ('TRACE', 'DEBUG')
""")
def q_agent_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "agent-stream")
    _agent_records(_table(spark, sf_dir, "events")).write.option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(f"{root}/landing")
    events = LS.log_events(
        LOG_ROOT, DEPLOYMENT, "INFO", agent=LS.read_agent_records(spark, f"{root}/landing")
    )
    LS.start_store(events, f"{root}/store", f"{root}/checkpoint", files_per_date=2).awaitTermination()
    return _stored(spark, f"{root}/store").select(
        "message", "processed_file", "pod", _naive("timestamp"), "container", "level", "logger",
        "log_date",
    )


@query("""
SELECT 'pod-a' AS pod, event_type AS container, 'Java Logging: ' || event_type || ' ' || event_id AS message,
       'service.' || (event_id // 500) % 10 || '.logger' AS file, 'INFO' AS level
FROM events
""")
def q_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of landed files; the second delivers every file of the first again."""
    root = scratch_dir(spark, "rotation")
    lines = _table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.concat_ws(" ", "event_type", _text("event_id")).alias("message")
    )
    files = _as_files(lines, "event_type")

    def landed(files: DataFrame, index: Column) -> DataFrame:
        return files.select(
            F.lit("pod-a").alias("bucket"),
            F.concat(
                "event_type", F.lit("/service."), index.cast("string"), F.lit("."),
                F.sha2("content", 256), F.lit(".logger"),
            ).alias("name"),
            "content",
        )

    def run() -> None:
        closed = LS.read_closed_files(spark, f"{root}/landing/*/*")
        kept = LS.drop_copies(closed, f"{_below_scheme(root)}/landing")
        events = LS.log_events(LOG_ROOT, DEPLOYMENT, java=LS.file_lines(kept))
        LS.start_store(
            events,
            f"{root}/store",
            f"{root}/checkpoint",
            state_partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()

    # Rotation gives a re-delivered file the next index.
    index = F.col("file_no") % 10
    early = F.col("file_no") % 2 == 0
    write_objects(landed(files.where(early), index), f"{root}/landing", create_buckets=True)
    run()
    again = landed(files.where(early), index + 1).unionByName(landed(files.where(~early), index))
    write_objects(again, f"{root}/landing", create_buckets=True)
    run()
    return _stored(spark, f"{root}/store").select("pod", "container", "message", "file", "level")


@query("""
SELECT event_type AS container, 'Java Logging: ' || event_type || ' ' || event_id AS message, 'INFO' AS level
FROM events
UNION ALL
SELECT 'twins', 'Java Logging: click ' || event_id, 'INFO' FROM events, (VALUES (0), (1)) WHERE event_type = 'click'
""")
def q_rotated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of a rotation by numbers: files get the next numbers while their last lines are still unread.

    The newest file of a container is ``service.0``, and in the first round it is not complete. Container ``twins`` has
    every file of another one twice; files of equal content are files of their own.
    """
    root = scratch_dir(spark, "rotated")
    lines = _table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.concat_ws(" ", "event_type", _text("event_id")).alias("message")
    )
    files = _as_files(lines, "event_type")
    newest = files.agg(F.max("file_no")).first()[0] or 0

    def landed(last: int) -> DataFrame:
        there = files.where(F.col("file_no") <= last)
        growing = F.expr("substring(content, 1, cast(length(content) * 0.7 as int))")
        content = F.when((F.col("file_no") == last) & (F.lit(last) < newest), growing).otherwise(F.col("content"))
        own = there.select(
            F.col("event_type").alias("bucket"),
            F.format_string("service.%d.logger", F.lit(last) - F.col("file_no")).alias("name"),
            content.alias("content"),
        )
        both = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("twin")
        twins = there.where("event_type = 'click'").select("file_no", "content", both)
        return own.unionByName(
            twins.select(
                F.lit("twins").alias("bucket"),
                F.format_string("%s.%d.logger", "twin", F.lit(last) - F.col("file_no")).alias("name"),
                "content",
            )
        )

    def run() -> None:
        lines = read_growing_lines(spark, f"{root}/landing", LS.JAVA_FILES)
        events = LS.log_events(f"{_below_scheme(root)}/landing", DEPLOYMENT, java=lines)
        LS.start_store(events, f"{root}/store", f"{root}/checkpoint", files_per_date=2).awaitTermination()

    for last in (newest // 2, newest):
        write_objects(landed(last), f"{root}/landing", create_buckets=True)
        run()
    return _stored(spark, f"{root}/store").select("container", "message", "level")


@query(f"""
WITH {_SQL_LINES},
found AS (
  SELECT event_type AS container, 'ROOT' AS logger, message, event_ts AS found_at, 'ns-' || event_type AS namespace,
         coalesce(level, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END) AS level
  FROM parsed
  UNION ALL
  SELECT event_type, 'ROOT', 'Java Logging: ' || event_type || ' ' || event_id, NULL, 'ns-' || event_type, 'INFO'
  FROM events
  UNION ALL
  SELECT container, logger, message, timestamp, NULL, level
  FROM ({_SQL_AGENT}) WHERE level IS NULL OR level NOT IN ('TRACE', 'DEBUG'))
SELECT container, logger, level, message, namespace FROM found
WHERE found_at IS NULL OR found_at >= TIMESTAMP '2024-01-10 12:00:00'
""")
def q_log_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output, error output, Java logs and agent records of many deployments, stored and searched."""
    root = scratch_dir(spark, "log-pipeline")
    events = _table(spark, sf_dir, "events")
    files = _as_files(_event_lines(events), "event_type")
    suffix = F.when(F.col("event_type") == "error", ".stderr.log").otherwise(".stdout.log")
    captured = files.select(
        F.concat(F.lit("pod-a/"), "event_type", F.lit("/events-"), _text("file_no"), suffix).alias("name"),
        "content",
    )
    lines = events.select(
        "event_id", "event_type", F.concat_ws(" ", "event_type", _text("event_id")).alias("message")
    )
    java = _as_files(lines, "event_type").select(
        F.concat(
            F.lit("pod-a/"), "event_type", F.lit("/service."), _text("file_no"), F.lit("."),
            F.sha2("content", 256), F.lit(".logger"),
        ).alias("name"),
        "content",
    )
    landed = captured.unionByName(java).withColumn("bucket", F.lit("landing"))
    write_objects(landed, root, create_buckets=True)
    _agent_records(events).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(
        f"{root}/agent"
    )
    deployments = events.select(F.col("event_type").alias("container")).distinct().select(
        "container", F.concat(F.lit("ns-"), "container").alias("namespace"),
        F.lit("c").alias("cluster"), F.lit("r").alias("role"), F.lit("g").alias("roleGroup"),
    )
    log_root, folders = f"{_below_scheme(root)}/landing", f"{root}/landing/*/*"
    stream = LS.log_events(
        log_root,
        deployments,
        stdout=LS.read_lines(spark, folders, LS.STDOUT_FILES),
        stderr=LS.read_lines(spark, folders, LS.STDERR_FILES),
        java=LS.file_lines(LS.drop_copies(LS.read_closed_files(spark, folders), log_root)),
        agent=LS.read_agent_records(spark, f"{root}/agent"),
        with_pod=True,
    )
    LS.start_store(
        stream,
        f"{root}/store",
        f"{root}/checkpoint",
        files_per_date=2,
        state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    # Events without a time of their own have that of their file, which is now.
    found = _stored(spark, f"{root}/store").where("log_date >= DATE '2024-01-10'")
    return found.where(F.col("timestamp") >= F.lit("2024-01-10 12:00:00").cast("timestamp")).select(
        "container", "logger", "level", "message", "namespace"
    )
