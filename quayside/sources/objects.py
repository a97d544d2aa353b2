"""Object scan, object listing and the object writer."""

from __future__ import annotations

import hashlib
import operator
import os
import uuid
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import translate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as DS
from pyspark.sql import functions as F

from quayside.functions.text import without_scheme
from quayside.operators.lookups import lookup_join
from quayside.session import register_source, scratch_dir, ship_package

# What a listing gives, and what is still to be listed: ``todo`` is null for an object, ``folder`` for a
# folder, ``file`` for a file that is to be measured, ``keys`` for keys of a store that begin with the path and
# come after ``after``.
_LISTED = "path STRING, modificationTime TIMESTAMP, length LONG, todo STRING, after STRING"
_LISTED_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("modificationTime", pa.timestamp("us", "UTC")),
        ("length", pa.int64()),
        ("todo", pa.string()),
        ("after", pa.string()),
    ]
)
_LISTED_ROWS = 10_000
#: What is listed for one row of work before the rest is left to other tasks: files, and pages of keys.
TASK_FILES, TASK_PAGES = 20_000, 20
# No key begins like another one and goes on with this character.
LAST = "\U0010ffff"


def _lister(endpoint: str | None, task_files: int, task_pages: int, collecting: bool = False):
    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import Store

        store = Store()
        found = _found(store, _work(batches), endpoint, task_files, task_pages, collecting)
        rows = []
        for row in found:
            rows.append(row)
            if len(rows) == _LISTED_ROWS:
                yield _listed(rows)
                rows = []
        if rows:
            yield _listed(rows)

    return listing


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str | None]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["path"], row["todo"], row["after"]


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(column) for column in zip(*rows)]
    columns[1] = [None if at is None else int(at * 1_000_000) for at in columns[1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _LISTED_SCHEMA)], schema=_LISTED_SCHEMA
    )


def _found(
    store, work, endpoint: str | None, task_files: int, task_pages: int, collecting: bool = False
) -> Iterator[tuple]:
    """Objects, and what is left to other tasks."""
    for path, todo, after in work:
        if todo == "keys":
            yield from _keys(store, path, after, endpoint, task_pages, collecting)
        elif todo == "file":
            measure = store.stat(path, endpoint)
            if measure:
                yield path, *measure, None, None
        else:
            # What a row of work brings with it is bounded; the row itself is always done.
            left, folders = task_files, deque([path])
            while folders:
                if left <= 0:
                    yield folders.popleft(), None, None, "folder", None
                    continue
                base = folders.popleft()
                base = base if base.endswith("/") else base + "/"
                for name, folder, measure in store.entries(base, endpoint, collecting):
                    left -= 1
                    if folder:
                        folders.append(base + name)
                    elif left > 0:
                        yield base + name, *measure(), None, None
                    else:
                        yield base + name, None, None, "file", None


def _keys(
    store, path: str, after: str | None, endpoint: str | None, pages: int, collecting: bool = False
) -> Iterator[tuple]:
    """Objects of a store by pages; what is left after some pages is divided by the next characters."""
    client, bucket, prefix = store.client(path, endpoint)
    base, after = path[: len(path) - len(prefix)], after or ""
    skip, first = after[:-1] if after.endswith(LAST) else None, None
    for _ in range(pages):
        keys, more = client.page(bucket, prefix, after)
        for key, seconds, length in keys:
            # Keys that end like folders and hold nothing stand for folders; collected parts are no objects yet.
            if (skip is None or not key.startswith(skip)) and _is_wanted(key, length, collecting):
                yield base + key, seconds, length, None, None
        if not more:
            return
        first, after = first or keys[0][0], keys[-1][0]
    for part, later in divided(prefix, first, after):
        yield base + part, None, None, "keys", later


def _is_wanted(key: str, length: int, collecting: bool) -> bool:
    from quayside.sources.store_io import is_collecting

    return not (key.endswith("/") and not length) and is_collecting(key.rpartition("/")[2]) == collecting


def divided(prefix: str, first: str, last: str) -> list[tuple[str, str | None]]:
    """Keys that begin with a prefix and come after ``last``, as (prefix, after) without overlap.

    Keys were read from ``first`` to ``last``, so most of the others go on as these do; they are divided by
    the character after what the two have in common.
    """
    common = os.path.commonprefix([first, last])
    out = [(common[:i], common[: i + 1] + LAST) for i in range(len(prefix), len(common))]
    if len(common) == len(last):
        return [*out, (common, last)]
    here = last[len(common)]
    out.append((common + here, last))
    out += [(common + chr(c), None) for c in range(ord(here) + 1, 127)]
    return [*out, (common, common + max(here, "~") + LAST)]


def list_objects(
    spark: SparkSession,
    path: str,
    name_glob: str | None = None,
    work_dir: str | None = None,
    endpoint: str | None = None,
    task_files: int = TASK_FILES,
    task_pages: int = TASK_PAGES,
    collecting: bool = False,
) -> DataFrame:
    """All objects below a path, empty ones included: ``path, modificationTime, length``.

    With ``collecting``, what writes have not completed or given up is listed instead.

    Listed by tasks in rounds. A task lists its share, whatever the nesting, and leaves the rest to the tasks of
    the next round: folders, files whose length is to be looked up, and on stores with the S3 interface ranges of
    keys, so that a flat bucket is listed by many tasks, a page at a time. What is found goes to tables below the work
    folder; the driver never holds the listing. On S3, keys that end with a slash and hold nothing are no objects.
    """
    ship_package(spark)
    work_dir = work_dir or scratch_dir(spark, "listing")
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    in_bucket = path.startswith(("s3a://", "s3n://", "s3://")) and path.partition("://")[2] != ""
    start = (path.rstrip("/") + "/", "keys", None) if in_bucket else (path, "folder", None)
    work = spark.createDataFrame([start], "path STRING, todo STRING, after STRING")
    rounds = []
    while True:
        rounds.append(f"{work_dir}/round-{len(rounds)}")
        work.mapInArrow(_lister(endpoint, task_files, task_pages, collecting), _LISTED).write.mode("overwrite").parquet(rounds[-1])
        work = spark.read.schema(_LISTED).parquet(rounds[-1]).where("todo IS NOT NULL")
        if work.isEmpty():
            break
        work = work.select("path", "todo", "after").repartition(tasks, "path", "after")
    objects = spark.read.schema(_LISTED).parquet(*rounds).where("todo IS NULL").drop("todo", "after")
    return _with_names(objects, name_glob)


def _with_names(objects: DataFrame, name_glob: str | None) -> DataFrame:
    if not name_glob:
        return objects
    return objects.where(F.substring_index("path", "/", -1).rlike(translate(name_glob)))


def inventory_objects(inventory: DataFrame, root: str, name_glob: str | None = None) -> DataFrame:
    """The listing that an inventory table of a store holds: ``bucket, key, size, last_modified``.

    Stores write such reports of buckets that are too large to be listed each time.
    """
    base = root if root.endswith("/") else root + "/"
    objects = inventory.select(
        F.concat(F.lit(base), F.col("bucket"), F.lit("/"), F.col("key")).alias("path"),
        F.col("last_modified").cast("timestamp").alias("modificationTime"),
        F.col("size").cast("long").alias("length"),
    )
    return _with_names(objects.where(~(F.col("path").endswith("/") & (F.col("length") == 0))), name_glob)


def _bucket_asker(root: str):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import FAILURES, Store, check_address

        stores: dict[str | None, Store] = {}
        for batch in batches:
            there = []
            for row in batch.to_pylist():
                store = stores.setdefault(row["credentials_root"], Store(row["credentials_root"]))
                try:
                    check_address(row["bucket"], "any")
                    there.append(store.has_bucket(f"{root}/{row['bucket']}", row["endpoint"], row["alias"]))
                except FAILURES:
                    there.append(False)
            found = pa.array(there, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("bucket").filter(found)], names=["bucket"])

    return ask


def existing_buckets(buckets: DataFrame, root: str, credentials_root: str | None = None) -> DataFrame:
    """Those of the buckets ``bucket, endpoint, alias`` that are there now, each asked for once, by tasks."""
    spark = buckets.sparkSession
    ship_package(spark)
    asked = buckets.select("bucket", "endpoint", "alias").distinct()
    asked = asked.withColumn("credentials_root", F.lit(credentials_root).cast("string"))
    return asked.mapInArrow(_bucket_asker(root.rstrip("/")), "bucket STRING").distinct()


def with_object_name(objects: DataFrame, root: str) -> DataFrame:
    """Add ``bucket`` and ``name`` of objects below a root."""
    base = root if root.endswith("/") else root + "/"
    skip = F.length(without_scheme(F.lit(base)))
    # Listings begin with the root as it was given; other readers may write the scheme differently.
    below = F.when(
        F.col("path").startswith(base), F.substring(F.col("path"), len(base) + 1, F.length("path"))
    ).otherwise(F.substring(without_scheme(F.col("path")), skip + 1, F.length("path")))
    return objects.withColumns(
        {
            "bucket": F.substring_index(below, "/", 1),
            "name": F.substring(below, F.instr(below, "/") + 1, F.length(below)),
        }
    )


# Bytes of an object that one row holds; longer objects are several rows.
RANGE_BYTES = 64 * 1024 * 1024
_MEASURED = "bucket STRING, name STRING, uri STRING, length LONG, error STRING"


def _measurer(root: str, endpoint: str | None):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import FAILURES, Store, StoreError, check_address

        store = Store()
        for batch in batches:
            uris, lengths, errors = [], [], []
            for row in batch.to_pylist():
                length, error = None, None
                uri = f"{root}/{row['bucket']}/{row['name']}"
                try:
                    check_address(row["bucket"], row["name"])
                    length = store.length(uri, endpoint)
                    if length is None:
                        raise StoreError("the object does not exist")
                except FAILURES as failure:
                    error = str(failure)
                uris.append(uri)
                lengths.append(length)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("bucket"),
                    batch.column("name"),
                    pa.array(uris, pa.string()),
                    pa.array(lengths, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names=["bucket", "name", "uri", "length", "error"],
            )

    return measure


# Bytes of objects in one batch of rows and in one partition, requests of a task at a time.
BATCH_BYTES = 16 * 1024 * 1024
PARTITION_BYTES = 128 * 1024 * 1024
REQUESTS = 8


def _contents(store, rows: list[dict], range_bytes: int, endpoint: str | None) -> Iterator[tuple[dict, bytes | None, str | None]]:
    """Bytes or the error of each range, in order; the next ones are read while one is handed on."""
    from quayside.sources.store_io import FAILURES

    def read(row: dict) -> tuple[bytes | None, str | None]:
        if row["error"] is not None:
            return None, row["error"]
        size = min(range_bytes, row["length"] - row["offset"])
        try:
            return b"".join(store.blocks(row["uri"], row["offset"], size, endpoint)), None
        except FAILURES as failure:
            return None, str(failure)

    if len(rows) == 1:
        yield rows[0], *read(rows[0])
        return
    with ThreadPoolExecutor(REQUESTS) as pool:
        waiting = deque()
        for row in rows:
            waiting.append((row, pool.submit(read, row)))
            # Long ranges are read one at a time, so that few of them are in memory.
            if len(waiting) > REQUESTS or (row["length"] or 0) > BATCH_BYTES // REQUESTS:
                first, found = waiting.popleft()
                yield first, *found.result()
        while waiting:
            first, found = waiting.popleft()
            yield first, *found.result()


def _packed(found, names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows with content and error, as many in a batch as its bytes allow."""
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([row[n] for row in rows], kind) for n, kind in zip(names, kinds)], names=names
        )

    for row, content, error in found:
        rows.append(row | {"content": content, "error": error})
        held += len(content or b"")
        if held >= BATCH_BYTES or len(rows) == _LISTED_ROWS:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _reader(endpoint: str | None, range_bytes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import Store

        store = Store()
        for batch in batches:
            kept = [f for f in batch.schema if f.name not in ("uri", "error")]
            names = [*(f.name for f in kept), "content", "error"]
            kinds = [*(f.type for f in kept), pa.binary(), pa.string()]
            yield from _packed(_contents(store, batch.to_pylist(), range_bytes, endpoint), names, kinds)

    return read


def _ranged(objects: DataFrame, range_bytes: int) -> DataFrame:
    """A row with ``offset`` for every range of objects, one for an empty object."""
    last = F.greatest(F.ceil(F.coalesce("length", F.lit(0)) / range_bytes) - 1, F.lit(0))
    cut = objects.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return cut.withColumn("offset", F.col("place") * range_bytes).drop("place")


def _ranges(objects: DataFrame, endpoint: str | None, range_bytes: int) -> DataFrame:
    """Rows with ``offset, content, error`` for every range of objects ``uri, length, error``.

    Ranges are dealt to tasks one by one, so a long object keeps many of them busy.
    """
    spark = objects.sparkSession
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    cut = _ranged(objects, range_bytes)
    kept = [f"`{n}` {kind}" for n, kind in cut.dtypes if n not in ("uri", "error")]
    return cut.repartition(tasks, "uri", "offset").mapInArrow(
        _reader(endpoint, range_bytes), ", ".join([*kept, "content BINARY", "error STRING"])
    )


def fetch_objects(
    names: DataFrame, root: str, endpoint: str | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Bytes of the objects named by rows ``bucket, name``.

    Gives ``bucket, name, length, offset, content, error``: a row for each range of an object, one
    for an empty object, and a row with an ``error`` and no content for what can't be read. Nothing
    is listed.
    """
    ship_package(names.sparkSession)
    measured = names.select("bucket", "name").mapInArrow(
        _measurer(root.rstrip("/"), endpoint), _MEASURED
    )
    return _ranges(measured, endpoint, range_bytes)


SCANNED = "path STRING, modificationTime TIMESTAMP, length LONG, offset LONG, content BINARY, error STRING"
_MANIFEST = ["path", "modificationTime", "length", "offset"]
_COMPARED = {
    "EqualTo": operator.eq,
    "GreaterThan": operator.gt,
    "GreaterThanOrEqual": operator.ge,
    "LessThan": operator.lt,
    "LessThanOrEqual": operator.le,
    "In": lambda value, among: value in among,
    "StringStartsWith": str.startswith,
    "StringEndsWith": str.endswith,
    "StringContains": operator.contains,
}


@dataclass
class Manifest(DS.InputPartition):
    path: str


class ObjectReader(DS.DataSourceReader):
    """Reads the ranges of a manifest; one of its files is a partition, whose objects come packed in batches."""

    def __init__(self, options: dict) -> None:
        self.manifest, self.endpoint = options["manifest"], options.get("endpoint")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[DS.Filter]) -> Iterator[DS.Filter]:
        """Path, length and offset are compared before an object is opened."""
        for one in filters:
            kind, name = type(one).__name__, getattr(one, "attribute", ("",))
            if kind == "IsNotNull" and name[0] in _MANIFEST:
                self.filters.append((name[0], "NotNull", None))
            elif kind in _COMPARED and len(name) == 1 and name[0] in ("path", "length", "offset"):
                self.filters.append((name[0], kind, one.value))
            else:
                yield one

    def _wanted(self, row: dict) -> bool:
        return all(
            row[name] is not None and (kind == "NotNull" or _COMPARED[kind](row[name], value))
            for name, kind, value in self.filters
        )

    def partitions(self) -> list[Manifest]:
        from quayside.sources.store_io import Store

        system, path = Store().locate(self.manifest)
        from pyarrow import fs

        files = system.get_file_info(fs.FileSelector(path))
        base = self.manifest.rstrip("/")
        return [Manifest(f"{base}/{f.base_name}") for f in files if f.base_name.endswith(".parquet")]

    def read(self, partition: Manifest) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        from quayside.sources.store_io import Store

        store = Store()
        system, path = store.locate(partition.path)
        with system.open_input_file(path) as source:
            for batch in parquet.ParquetFile(source).iter_batches(_LISTED_ROWS, columns=_MANIFEST):
                rows = [row | {"uri": row["path"], "error": None} for row in batch.to_pylist()]
                rows = [row for row in rows if self._wanted(row)]
                kinds = [_LISTED_SCHEMA.field(n).type for n in _MANIFEST[:3]]
                kinds += [pa.int64(), pa.binary(), pa.string()]
                found = _contents(store, rows, self.range_bytes, self.endpoint) if rows else ()
                yield from _packed(found, [*_MANIFEST, "content", "error"], kinds)


class ObjectSource(DS.DataSource):
    """``format("objects")``: the bytes of the objects in a manifest, a table of ranges in a shared folder.

    Options are ``manifest``, its folder, ``endpoint`` and ``rangeBytes``. ``scan_objects`` writes the manifest.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return SCANNED

    def reader(self, schema) -> ObjectReader:
        return ObjectReader(self.options)


def scan_objects(
    spark: SparkSession,
    path: str,
    name_glob: str | None = None,
    endpoint: str | None = None,
    range_bytes: int = RANGE_BYTES,
    listed: DataFrame | None = None,
) -> DataFrame:
    """All objects below a path with their bytes, whatever their names and lengths.

    Gives ``path, modificationTime, length, offset, content, error``, a row for each range of an
    object, one for an empty object. Filters on path, length and offset are applied before objects are
    opened. ``listed`` is a listing to be used, as of ``inventory_objects``.
    """
    register_source(spark, ObjectSource)
    listed = list_objects(spark, path, name_glob, endpoint=endpoint) if listed is None else _with_names(listed, name_glob)
    cut = _ranged(listed, range_bytes).select(*_MANIFEST)
    size = F.least(F.lit(range_bytes), F.col("length") - F.col("offset"))
    total = cut.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(-(-total[0] // PARTITION_BYTES), -(-total[1] // (4 * _LISTED_ROWS)))
    parts = max(1, parts, min(spark.sparkContext.defaultParallelism, total[1]))
    manifest = scratch_dir(spark, "manifest")
    cut.repartition(parts, "path", "offset").write.parquet(manifest)
    options = {"manifest": manifest, "rangeBytes": str(range_bytes)} | ({"endpoint": endpoint} if endpoint else {})
    return spark.read.format("objects").options(**options).load()


def _run_mark(run: str) -> str:
    return hashlib.sha256(run.encode()).hexdigest()[:16]


REPEATED_NAME = "the name is used for several parts"
_STAGED = "bucket STRING, name STRING, mark STRING, length LONG, error STRING"
_WRITTEN = "bucket STRING, name STRING, length LONG, error STRING"


def _stager(root: str, endpoint: str | None, create_buckets: bool, run: str):
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write the parts beside their targets."""
        from quayside.sources.store_io import FAILURES, Store, StoreError, check_address

        store = Store()
        for batch in batches:
            contents, marks, lengths, errors = batch.column("content"), [], [], []
            for place, (bucket, name) in enumerate(
                zip(batch.column("bucket").to_pylist(), batch.column("name").to_pylist())
            ):
                mark = length = error = None
                try:
                    check_address(bucket, name)
                    if not contents[place].is_valid:
                        raise StoreError(f"part {name} has no bytes")
                    uri, content = f"{root}/{bucket}/{name}", contents[place].as_buffer()
                    (store.create_bucket if create_buckets else store.require_bucket)(uri, name, endpoint)
                    # The same part gets the same mark, so a task that runs again leaves nothing behind.
                    told = f"{name} {hashlib.sha256(content).hexdigest()}"
                    mark = f"{_run_mark(run)}-{hashlib.sha256(told.encode()).hexdigest()}"
                    length = store.stage(uri, mark, [content], endpoint).length
                except FAILURES as failure:
                    mark, error = None, str(failure)
                marks.append(mark)
                lengths.append(length)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("bucket"),
                    batch.column("name"),
                    pa.array(marks, pa.string()),
                    pa.array(lengths, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names=["bucket", "name", "mark", "length", "error"],
            )

    return stage


def _publisher(root: str, endpoint: str | None):
    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give staged parts their names, or remove them."""
        from quayside.sources.store_io import FAILURES, Store

        store = Store()
        for batch in batches:
            errors = []
            for row in batch.to_pylist():
                error, uri = row["error"], f"{root}/{row['bucket']}/{row['name']}"
                try:
                    if error is None:
                        store.publish(uri, row["mark"], endpoint, row["length"])
                    elif row["mark"] is not None:
                        store.discard(uri, row["mark"], endpoint)
                except FAILURES as failure:
                    error = error or str(failure)
                errors.append(error)
            lengths = [n if e is None else None for n, e in zip(batch.column("length").to_pylist(), errors)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("bucket"),
                    batch.column("name"),
                    pa.array(lengths, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names=["bucket", "name", "length", "error"],
            )

    return publish


def write_objects(
    parts: DataFrame,
    root: str,
    endpoint: str | None = None,
    create_buckets: bool = False,
    work_dir: str | None = None,
) -> DataFrame:
    """Write rows ``bucket, name, content`` as objects, rows holding whole objects; gives a status table.

    Two jobs: parts are written beside their targets, and only when all of them are there they get their
    names. If the first job fails, no object has changed, and ``discard_staged`` removes what it left. The
    status, ``bucket, name, length, error``, has a row for each part. Parts without bytes, with a bad name, for a
    missing bucket (unless ``create_buckets``) or of a name that several parts share are errors and
    change nothing.

    This is no ``DataFrame.write``, since the names of all parts would have to pass the driver at its end.
    """
    spark, root = parts.sparkSession, root.rstrip("/")
    ship_package(spark)
    work_dir = work_dir or scratch_dir(spark, "written")
    run = os.path.basename(work_dir.rstrip("/")) or uuid.uuid4().hex
    stage = _stager(root, endpoint, create_buckets, run)
    parts.select("bucket", "name", "content").mapInArrow(stage, _STAGED).write.mode("overwrite").options(
        **{"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    ).parquet(f"{work_dir}/staged")
    staged = spark.read.schema(_STAGED).parquet(f"{work_dir}/staged")
    repeated = (
        staged.where("error IS NULL")
        .groupBy("bucket", "name")
        .agg(F.count(F.lit(1)).alias("uses"))
        .where("uses > 1")
    )
    checked = lookup_join(staged, repeated, ["bucket", "name"])
    checked = checked.withColumn("error", F.coalesce("error", F.when(F.col("uses") > 1, F.lit(REPEATED_NAME))))
    checked.drop("uses").mapInArrow(_publisher(root, endpoint), _WRITTEN).write.mode("overwrite").parquet(
        f"{work_dir}/status"
    )
    return spark.read.schema(_WRITTEN).parquet(f"{work_dir}/status")


def discard_staged(spark: SparkSession, root: str, work_dir: str, endpoint: str | None = None) -> int:
    """Remove the parts that a failed write left beside their targets; gives their number.

    All folders below the root are looked at, as tasks that were lost have told nothing of what they wrote.
    """
    ship_package(spark)
    mark = _run_mark(os.path.basename(work_dir.rstrip("/")))
    left = list_objects(spark, root, f".quayside-{mark}-*", endpoint=endpoint, collecting=True)

    def discard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quayside.sources.store_io import Store

        store = Store()
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store.remove(uri, endpoint)
            yield batch

    return left.select("path").mapInArrow(discard, "path STRING").count()
