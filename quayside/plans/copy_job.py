"""Bulk copy of objects by manifest.

Stages that each end in a table below the work folder, so that a lost executor never causes finished
work to be planned or copied again:

1. ``plan``: validation, routing, endpoints, names, length and time of change of every source object;
2. ``uploads``: an upload is opened for every object that goes to an object store in parts;
3. ``ledger``: the bytes, copied in pieces by tasks of about equal size, a row for each piece;
4. ``status``: objects that came in pieces get their name, or are dropped; one row per request.

Large objects are cut into pieces, so one object keeps many tasks busy: ranges of a hidden file on
mounted file systems, parts of an upload on stores with the S3 interface. Until all of them are there the
target stays as it was. Other stores take whole objects. No task ever holds more than one block of an object in memory.

A run that was broken off, its driver lost, is carried on by calling the copy again with its work folder.
The tasks' rows enter the ledger as each task ends. Pieces that it holds are not copied again
if source, length and time of change are the same and what was written is still there.

Of several requests for one target the last one in their order counts. If it fails while it is
copied, the others follow, the latest first, until one succeeds.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.addresses import write_failure
from quayside.operators.lookups import lookup_join
from quayside.operators.requests import (
    name_objects,
    resolve_endpoints,
    route_requests,
    validate_requests,
)
from quayside.session import ship_package
from quayside.settings import TransferSettings
from quayside.sources.s3_requests import LEAST_PART_BYTES, MOST_PART_BYTES, MOST_PARTS

CHUNK_BYTES = 500 * 1024 * 1024
TASK_BYTES = 2 * 1024 * 1024 * 1024
TASK_CHUNKS = 20_000

NOT_ROUTED = "the source type is not served here"
NO_SOURCE = "the source object does not exist"
NO_ID = "the request has no id"
REPEATED_ID = "the request id is not unique"
EXPIRED = "the credential has expired"

_PLAN_COLUMNS = [
    "request_id", "source_uri", "source_endpoint", "source_bucket", "source_object",
    "target_uri", "target_endpoint", "target_alias", "target_bucket", "target_object", "plan_error",
]
_MEASURED = (
    ", ".join(f"{name} STRING" for name in _PLAN_COLUMNS)
    + ", sequence LONG, managed BOOLEAN, length LONG, modified LONG, target_length LONG, store_error STRING"
)
# What a piece is known by, and what became of it.
_PIECE = (
    "request_id STRING, source_uri STRING, target_uri STRING, length LONG, modified LONG, "
    "upload STRING, chunks LONG, chunk LONG, offset LONG, size LONG"
)
_COPIED = f"{_PIECE}, bytes LONG, digest STRING, ranges STRING, tag STRING, store_error STRING, attempt STRING"
_PIECE_NAMES = [field.split()[0] for field in _PIECE.split(", ")]
_WORK = [*_PIECE_NAMES, "source_endpoint", "target_endpoint", "target_alias", "by_store", "upload_error"]
_FINISHED = (
    "request_id STRING, chunks LONG, bytes LONG, sha256 STRING, range_sha256 STRING, store_error STRING"
)


def _measurer(credentials_root: str | None, with_target: bool):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Look up the length of every source object, and of targets if a run is carried on."""
        from quayside.sources.store_io import Store

        store = Store(credentials_root)
        for batch in batches:
            found = [_measured(store, row, with_target) for row in batch.to_pylist()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds))],
                names=[*batch.schema.names, "length", "modified", "target_length", "store_error"],
            )

    return measure


def _measured(store, row: dict, with_target: bool) -> tuple[int | None, int | None, int | None, str | None]:
    from quayside.sources.store_io import FAILURES, check_address

    if row["plan_error"] is not None:
        return None, None, None, None
    try:
        check_address(row["source_bucket"], row["source_object"])
        check_address(row["target_bucket"], row["target_object"])
        source = store.measure(row["source_uri"], row["source_endpoint"])
        place = (row["target_endpoint"], row["target_alias"])
        target = (row["target_uri"], row["target_object"], *place)
        if source is None:
            return None, None, None, NO_SOURCE
        if row["managed"]:
            store.create_bucket(*target)
        else:
            store.require_bucket(*target)
        there = store.measure(row["target_uri"], *place) if with_target else None
        return *source, there[0] if there else None, None
    except FAILURES as failure:
        return None, None, None, str(failure)


def _opener(credentials_root: str | None, attempt: str):
    def open_uploads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Open an upload for each target."""
        from quayside.sources.store_io import FAILURES, Store

        store = Store(credentials_root)
        for batch in batches:
            uploads, errors = [], []
            for row in batch.to_pylist():
                upload, error = None, None
                try:
                    client, bucket, key = store.client(
                        row["target_uri"], row["target_endpoint"], row["target_alias"]
                    )
                    upload = client.start_upload(bucket, key)
                except FAILURES as failure:
                    error = str(failure)
                uploads.append(upload)
                errors.append(error)
            known = [batch.column(name) for name in _UPLOAD_KEY]
            yield pa.RecordBatch.from_arrays(
                [
                    *known,
                    pa.array(uploads, pa.string()),
                    pa.array(errors, pa.string()),
                    pa.array([attempt] * batch.num_rows, pa.string()),
                ],
                names=[*_UPLOAD_KEY, "upload", "upload_error", "attempt"],
            )

    return open_uploads


_UPLOAD_KEY = ["request_id", "source_uri", "target_uri", "length", "modified"]
_OPENED = (
    "request_id STRING, source_uri STRING, target_uri STRING, length LONG, modified LONG, "
    "upload STRING, upload_error STRING, attempt STRING"
)


def _mark(run: str, row: dict) -> str:
    """What tells the collected ranges of a request from those of others for the same target."""
    return f"{run} {row['request_id']}"


def _hidden_path(target_uri: str, run: str) -> str:
    """File that collects the ranges of an object until all of them are there."""
    from quayside.sources.store_io import collecting_name, local_path

    folder, base = os.path.split(local_path(target_uri))
    # A hash, as a name that is long already would become too long.
    return os.path.join(folder, collecting_name(hashlib.sha256(f"{base} {run}".encode()).hexdigest()))


def _copied(store, row: dict, run: str, chunk_bytes: int, attempt: str) -> dict:
    """Copy one piece, or a whole object if it is the only one."""
    from quayside.sources.store_io import FAILURES, Digests

    result, target = row | {"attempt": attempt}, row["target_uri"]
    if row["upload_error"] is not None:
        return result | {"store_error": row["upload_error"]}

    def blocks():
        return store.blocks(row["source_uri"], row["offset"], row["size"], row["source_endpoint"])

    try:
        if row["upload"] is not None:
            client, bucket, key = store.client(target, row["target_endpoint"], row["target_alias"])
            part = (bucket, key, row["upload"], row["chunk"] + 1)
            if row["by_store"]:
                source = row["source_uri"].partition("://")[2].split("/", 1)
                result["tag"] = client.copy_part(*part, tuple(source), row["offset"], row["size"])
                return result | {"bytes": row["size"]}
            digests = []

            def digested():
                digests.append(Digests(chunk_bytes))
                for block in blocks():
                    digests[-1].update(block)
                    yield block

            result["tag"] = client.put_part(*part, row["size"], digested)
            result |= {"bytes": digests[-1].length, "ranges": digests[-1].ranges()}
        elif row["chunks"] == 1:
            done = store.write(target, blocks(), row["target_endpoint"], chunk_bytes, row["target_alias"])
            result |= {"bytes": done.length, "digest": done.whole(), "ranges": done.ranges()}
        else:
            done = store.write_range(_hidden_path(target, _mark(run, row)), row["offset"], blocks())
            result |= {"bytes": done.length, "ranges": done.whole()}
    except FAILURES as failure:
        result["store_error"] = str(failure)
    return result


def _copier(run: str, chunk_bytes: int, credentials_root: str | None, attempt: str):
    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import Store

        store = Store(credentials_root)
        for batch in batches:
            rows = batch.to_pylist()
            yield _batch([_copied(store, row, run, chunk_bytes, attempt) for row in rows], _COPIED)

    return copy


def _finisher(run: str, credentials_root: str | None = None):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give objects that were copied in pieces their name; safe to run twice."""
        from quayside.sources.store_io import FAILURES, Store

        store = Store(credentials_root)
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                try:
                    if row["upload"] is not None:
                        _end_upload(store, row)
                    elif row["store_error"] is None:
                        _publish(row["target_uri"], _mark(run, row), row["bytes"])
                    else:
                        _discard(row["target_uri"], _mark(run, row))
                except FAILURES as failure:
                    row["store_error"] = row["store_error"] or str(failure)
                done.append(row)
            yield _batch(done, _FINISHED)

    return finish


def _end_upload(store, row: dict) -> None:
    client, bucket, key = store.client(row["target_uri"], row["target_endpoint"], row["target_alias"])
    if row["store_error"] is not None:
        client.abort_upload(bucket, key, row["upload"])
        return
    try:
        client.complete_upload(bucket, key, row["upload"], row["tags"], row["bytes"])
    except OSError:
        client.abort_upload(bucket, key, row["upload"])
        raise


def _publish(target_uri: str, run: str, length: int) -> None:
    from quayside.sources.store_io import local_path

    hidden, path = _hidden_path(target_uri, run), local_path(target_uri)
    if os.path.exists(hidden):
        if os.path.getsize(hidden) != length:
            _discard(target_uri, run)
            raise OSError("the collected ranges have another length")
        os.replace(hidden, path)
    elif not os.path.exists(path) or os.path.getsize(path) != length:
        raise OSError("the collected ranges are gone")


def _discard(target_uri: str, run: str) -> None:
    hidden = _hidden_path(target_uri, run)
    if os.path.exists(hidden):
        os.remove(hidden)


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"STRING": pa.string(), "LONG": pa.int64()}
    fields = [field.split() for field in ddl.split(", ")]
    arrays = [pa.array([row.get(name) for row in rows], kinds[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def plan_copies(manifest: DataFrame, registry: DataFrame, settings: TransferSettings) -> DataFrame:
    """Everything about a request that is known without touching the stores."""
    checked = route_requests(validate_requests(_with_checked_ids(manifest)), settings)
    planned = name_objects(resolve_endpoints(checked, registry, settings), settings)
    expired = F.col("has_token") & (F.col("expires_at") <= F.current_timestamp())
    error = F.coalesce(
        "id_error", "error", F.when(~F.col("routed"), F.lit(NOT_ROUTED)), F.when(expired, F.lit(EXPIRED))
    )
    alias = F.when(F.col("has_token"), F.col("key_name"))
    return planned.withColumns({"plan_error": error, "target_alias": alias}).select(
        *_PLAN_COLUMNS, "sequence", "managed"
    )


def _with_checked_ids(manifest: DataFrame) -> DataFrame:
    """Requests with ``sequence``, ``managed`` and, if their id is null or not unique, ``id_error``."""
    for name, kind in (("sequence", "long"), ("managed", "boolean")):
        if name not in manifest.columns:
            manifest = manifest.withColumn(name, F.lit(None).cast(kind))
    repeated = (
        manifest.groupBy("request_id")
        .agg(F.count(F.lit(1)).alias("uses"))
        .where("uses > 1 AND request_id IS NOT NULL")
    )
    error = F.when(F.col("request_id").isNull(), NO_ID).when(F.col("uses").isNotNull(), REPEATED_ID)
    return (
        lookup_join(manifest, repeated, "request_id")
        .withColumns({"id_error": error, "sequence": F.col("sequence").cast("long")})
        .drop("uses")
    )


def _is_ready() -> Column:
    return F.col("plan_error").isNull() & F.col("store_error").isNull()


def _order() -> Column:
    """Order of the requests for one target: by sequence; without one, by a hash of the id."""
    return F.struct(
        F.col("sequence").isNotNull().alias("given"),
        "sequence",
        F.xxhash64("request_id").alias("hash"),
        "request_id",
    )


def _last_requests(ready: DataFrame) -> DataFrame:
    """Of several requests for one target keep the last one.

    Carried out one after the other they would leave the same object; side by side they would
    leave any of them.
    """
    contested = (
        ready.groupBy("target_uri")
        .agg(F.count(F.lit(1)).alias("requests"), F.max(_order()).alias("last"))
        .where(F.col("requests") > 1)
        .select("target_uri", F.col("last.request_id").alias("last_request"))
    )
    marked = lookup_join(ready, contested, "target_uri")
    is_last = F.coalesce(F.col("last_request") == F.col("request_id"), F.lit(True))
    return marked.where(is_last).drop("last_request")


def _substitutes(ready: DataFrame, copied: DataFrame) -> DataFrame:
    """Requests that were not carried out for targets of which all requests so far have failed."""
    tried = copied.groupBy("request_id").agg(F.max(F.col("store_error").isNotNull()).alias("failed"))
    failed = (
        ready.join(tried, "request_id")
        .groupBy("target_uri")
        .agg(F.min("failed").alias("failed"))
        .where("failed")
        .select("target_uri")
    )
    return ready.join(failed, "target_uri", "left_semi").join(tried, "request_id", "left_anti")


def _same_store(settings: TransferSettings) -> Column:
    """Whether the store itself copies a request's object."""
    s3 = [F.col(f"{side}_uri").rlike("^s3[an]?://") for side in ("source", "target")]
    same = F.col("source_endpoint").eqNullSafe(F.col("target_endpoint"))
    alone = F.lit(settings.credentials_root is None) | F.col("target_alias").isNull()
    return F.lit(settings.copy_by_store) & s3[0] & s3[1] & same & alone & (F.col("length") > 0)


def _with_pieces(ready: DataFrame, chunk_bytes: int, settings: TransferSettings) -> DataFrame:
    """Bytes and number of the pieces of each object, and whether they go to an upload.

    A part of an upload is as many whole ranges as make it long enough, and the parts few enough.
    """
    target = F.col("target_uri")
    local = target.startswith("file:") | target.startswith("/")
    least = F.greatest(F.lit(LEAST_PART_BYTES).cast("double"), F.col("length") / MOST_PARTS)
    part = (F.ceil(least / chunk_bytes) * chunk_bytes).cast("long")
    piece = F.when(local, F.lit(chunk_bytes).cast("long")).when(target.rlike("^s3[an]?://"), part)
    chunks = F.greatest(F.ceil(F.col("length") / F.col("piece")).cast("long"), F.lit(1).cast("long"))
    by_store = _same_store(settings)
    return (
        ready.withColumn("piece", F.coalesce(piece, F.greatest("length", F.lit(1).cast("long"))))
        .withColumns({"chunks": chunks, "by_store": by_store})
        .withColumn("in_upload", ~local & ((F.col("chunks") > 1) | F.col("by_store")))
    )


def _cut(pieced: DataFrame) -> DataFrame:
    """One row per piece."""
    cut = pieced.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    offset = F.col("chunk") * F.col("piece")
    cut = cut.where("upload_error IS NULL OR chunk = 0")
    return cut.withColumns({"offset": offset, "size": F.least("piece", F.col("length") - offset)})


def _opened(uploads: DataFrame, work_dir: str, credentials_root: str | None) -> DataFrame:
    """The upload of each object that needs one; those of a run that is carried on are used again."""
    spark, path = uploads.sparkSession, f"{work_dir}/uploads"
    spark.createDataFrame([], _OPENED).write.mode("append").parquet(path)
    spark.createDataFrame([], "upload STRING").write.mode("append").parquet(f"{work_dir}/closed")
    closed = spark.read.schema("upload STRING").parquet(f"{work_dir}/closed")

    def known() -> DataFrame:
        rows = spark.read.schema(_OPENED).parquet(path).join(closed, "upload", "left_anti")
        # A request has one upload; should a lost driver have left two, the same one is taken every time.
        return rows.where("upload IS NOT NULL").groupBy(*_UPLOAD_KEY).agg(F.min("upload").alias("upload"))

    def same(rows: DataFrame, others: DataFrame) -> list[Column]:
        return [rows[c].eqNullSafe(others[c]) for c in _UPLOAD_KEY]

    mark, usable = uuid.uuid4().hex, known()
    new = uploads.join(usable, same(uploads, usable), "left_anti")
    new.select(*_UPLOAD_KEY, "target_endpoint", "target_alias").repartition(
        spark.sparkContext.defaultParallelism, "request_id"
    ).mapInArrow(_opener(credentials_root, mark), _OPENED).write.mode("append").parquet(path)
    failed = spark.read.schema(_OPENED).parquet(path).where((F.col("attempt") == mark) & F.col("upload").isNull())
    return known().select("request_id", "upload").join(
        failed.select("request_id", "upload_error"), "request_id", "full"
    )


def _close_uploads(status: DataFrame, work_dir: str) -> None:
    """Note the uploads that failed and were aborted, so that no later run uses them."""
    opened = status.sparkSession.read.schema(_OPENED).parquet(f"{work_dir}/uploads").where("upload IS NOT NULL")
    failed = status.where("status = 'error'").select("request_id")
    opened.join(failed, "request_id", "left_semi").select("upload").write.mode("append").parquet(f"{work_dir}/closed")


def _task_count(ready_bytes: int, ready_chunks: int, parallelism: int) -> int:
    by_bytes = -(-ready_bytes // TASK_BYTES)
    by_chunks = -(-ready_chunks // TASK_CHUNKS)
    return max(1, by_bytes, by_chunks, min(parallelism, ready_chunks))


def _range_checksum() -> Column:
    """Hash of the joined hashes of the ranges, which are the same for every kind of target."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "ranges")))
    known = F.count("ranges") == F.count(F.lit(1))
    return F.when(known, F.sha2(F.array_join(F.transform(ordered, lambda part: part["ranges"]), ""), 256))


def copy_objects(
    manifest: DataFrame,
    registry: DataFrame,
    settings: TransferSettings,
    work_dir: str,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Carry out a manifest ``request_id, src, dst``; gives the status table.

    A column ``sequence`` (a number) orders the requests for one target; without it their order is
    arbitrary, but the same in every run. A column ``managed`` tells which requests create their
    bucket; for others it must be there. Requests whose id is null or used twice are errors.

    The work folder stands for the run: with that of an earlier one, only what it did not finish is
    copied. The result is read from ``<work_dir>/status``: ``request_id, source_uri, target_uri,
    status, bytes, range_sha256, sha256, chunks, error`` with status ``ok``, ``error`` or
    ``superseded``. ``range_sha256`` is the hash of the joined hashes of the object's ranges of
    ``chunk_bytes``, for every object and target, null if the store copied it; ``sha256`` is the hash
    of the content where it was copied in one piece, else null.
    """
    if chunk_bytes > MOST_PART_BYTES:
        raise ValueError(f"ranges have {MOST_PART_BYTES} bytes at most")
    spark = manifest.sparkSession
    ship_package(spark)
    run = os.path.basename(work_dir.rstrip("/"))
    attempt = uuid.uuid4().hex
    earlier = _earlier(spark, work_dir)

    planned = plan_copies(manifest, registry, settings)
    # Looking up lengths waits on the store, so it is spread out whatever its size in bytes.
    spread = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    measured = planned.repartition(spread, "request_id").mapInArrow(
        _measurer(settings.credentials_root, earlier is not None), _MEASURED
    )
    measured.write.mode("overwrite").parquet(f"{work_dir}/plan")
    plan = spark.read.parquet(f"{work_dir}/plan")
    ready = plan.where(_is_ready())

    load = _with_pieces(ready, chunk_bytes, settings).agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"),
        F.coalesce(F.max("chunks"), F.lit(0)).alias("most_chunks"),
        F.count_if("in_upload").alias("uploads"),
    ).first()
    tasks = _task_count(load["bytes"], load["chunks"], spark.sparkContext.defaultParallelism)

    chosen, held = _last_requests(ready), None
    while True:
        pieced = _with_pieces(chosen, chunk_bytes, settings)
        if load["uploads"]:
            opened = _opened(pieced.where("in_upload"), work_dir, settings.credentials_root)
            pieced = pieced.join(opened.select("request_id", "upload", "upload_error"), "request_id", "left")
        else:
            nothing = F.lit(None).cast("string")
            pieced = pieced.withColumns({"upload": nothing, "upload_error": nothing})
        todo = _cut(pieced)
        if earlier is not None:
            ours = _held(todo, earlier)
            held = ours if held is None else held.unionByName(ours)
            todo = todo.join(ours.select("request_id", "chunk"), ["request_id", "chunk"], "left_anti")
        todo.select(*_WORK).repartition(tasks, "request_id", "chunk").mapInArrow(
            _copier(run, chunk_bytes, settings.credentials_root, attempt), _COPIED
        ).write.mode("append").options(**_AT_ONCE).parquet(f"{work_dir}/ledger")
        copied = spark.read.schema(_COPIED).parquet(f"{work_dir}/ledger").where(F.col("attempt") == attempt)
        if held is not None:
            copied = copied.unionByName(held)
        if copied.where("store_error IS NOT NULL").isEmpty():
            break
        # A round for each request of a target that fails while it is copied, the latest one first.
        chosen = _last_requests(_substitutes(ready, copied))
        if chosen.isEmpty():
            break

    tags = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "tag"))), lambda part: part["tag"])
    results = (
        copied.groupBy("request_id")
        .agg(
            F.count(F.lit(1)).alias("chunks"),
            F.sum("bytes").alias("bytes"),
            F.max("digest").alias("sha256"),
            _range_checksum().alias("range_sha256"),
            F.min(F.when(F.col("store_error").isNotNull(), F.struct("chunk", "store_error")))
            .alias("failure"),
            F.max("upload").alias("upload"),
            # An upload has a bounded number of parts.
            F.when(F.max("upload").isNotNull(), tags).alias("tags"),
        )
        .withColumn("store_error", F.col("failure.store_error"))
        .drop("failure")
    )
    if load["most_chunks"] > 1 or load["uploads"]:
        results = _finish_ranges(results, plan, run, settings.credentials_root)
    # One row per request on both sides.
    known = plan.withColumnRenamed("store_error", "plan_store_error").join(
        results.drop("upload", "tags"), "request_id", "left"
    )
    _with_status(known).write.mode("overwrite").parquet(f"{work_dir}/status")
    status = spark.read.parquet(f"{work_dir}/status")
    if load["uploads"]:
        _close_uploads(status, work_dir)
    return status


# Rows of a task are in the table once the task has ended, whatever becomes of its job.
_AT_ONCE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _earlier(spark: SparkSession, work_dir: str) -> DataFrame | None:
    """The pieces that earlier runs with this work folder copied, null if there are none."""
    path = f"{work_dir}/ledger"
    spark.createDataFrame([], _COPIED).write.mode("append").parquet(path)
    ledger = spark.read.schema(_COPIED).parquet(path).where("store_error IS NULL")
    return None if ledger.isEmpty() else ledger


def _held(pieces: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows of earlier runs for pieces that need not be copied again.

    Whole objects must be there with their length; collected ranges and parts are looked at when they get their name.
    """
    whole = (F.col("chunks") == 1) & F.col("upload").isNull()
    there = ~whole | F.col("target_length").eqNullSafe(F.col("length"))
    pieces = pieces.where(there & F.col("upload_error").isNull()).select(*_PIECE_NAMES)
    same = [earlier[n].eqNullSafe(pieces[n]) for n in _PIECE_NAMES]
    return earlier.join(pieces, same, "left_semi").dropDuplicates(["request_id", "chunk"])


def _finish_ranges(
    results: DataFrame, plan: DataFrame, run: str, credentials_root: str | None = None
) -> DataFrame:
    """Give the objects that were copied in pieces their names, or drop what is incomplete."""
    in_pieces = (F.col("chunks") > 1) | F.col("upload").isNotNull()
    place = ["target_uri", "target_endpoint", "target_alias"]
    finished = (
        results.where(in_pieces)
        .join(plan.select("request_id", *place), "request_id")
        .select(*results.columns, *place)
        .mapInArrow(_finisher(run, credentials_root), _FINISHED)
    )
    return results.where(~in_pieces).select(*finished.columns).unionByName(finished)


def drop_uploads(spark: SparkSession, work_dir: str, settings: TransferSettings) -> int:
    """Abort all open uploads of a run that is not to be carried on; gives their number."""
    ship_package(spark)
    opened = spark.read.schema(_OPENED).parquet(f"{work_dir}/uploads").where("upload IS NOT NULL")
    plan = spark.read.parquet(f"{work_dir}/plan").select("request_id", "target_endpoint", "target_alias")
    rows = opened.select("request_id", "target_uri", "upload").join(plan, "request_id")

    def abort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import Store

        store = Store(settings.credentials_root)
        for batch in batches:
            for row in batch.to_pylist():
                client, bucket, key = store.client(
                    row["target_uri"], row["target_endpoint"], row["target_alias"]
                )
                client.abort_upload(bucket, key, row["upload"])
            yield batch.select(["request_id"])

    return rows.mapInArrow(abort, "request_id STRING").count()


def _with_status(known: DataFrame) -> DataFrame:
    """Status of every request: one that was ready but not copied gave way to a later one."""
    reason = F.coalesce("plan_store_error", "store_error")
    failed = F.col("plan_error").isNotNull() | reason.isNotNull()
    message = F.coalesce(
        "plan_error",
        F.when(
            reason.isNotNull(), write_failure(F.col("target_object"), F.col("target_bucket"), reason)
        ),
    )
    superseded = F.col("chunks").isNull()
    done = ~failed & ~superseded
    return known.select(
        "request_id",
        "source_uri",
        "target_uri",
        F.when(failed, "error").when(superseded, "superseded").otherwise("ok").alias("status"),
        F.when(done, F.col("bytes")).alias("bytes"),
        F.when(done, F.col("range_sha256")).alias("range_sha256"),
        F.when(done, F.col("sha256")).alias("sha256"),
        F.when(done, F.col("chunks")).alias("chunks"),
        message.alias("error"),
    )
