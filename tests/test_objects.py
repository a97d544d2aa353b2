from __future__ import annotations

import hashlib
import os
from datetime import datetime

import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.plans import copy_job
from quayside.plans.copy_job import copy_objects
from quayside.schemas import MANIFEST
from quayside.settings import TransferSettings
from quayside.sources.objects import (
    discard_staged,
    fetch_objects,
    inventory_objects,
    list_objects,
    scan_objects,
    with_object_name,
    write_objects,
)
from quayside.sources import store_io
from quayside.sources.store_io import Store, StoreError

REGISTRY = "key_name STRING, has_token BOOLEAN, expires_at TIMESTAMP"


def test_round_trip(spark, tmp_path, rows):
    root = f"file://{tmp_path}/store"
    parts = [
        ("b", "x.bin", b"\x00\xff" * 5000),
        ("b", "deep/ü 100%25+.txt", b"text"),
        ("b", "empty", b""),
        ("c", "x.bin", b"1"),
    ]
    table = spark.createDataFrame(parts, "bucket STRING, name STRING, content BINARY")
    write_objects(table, root, create_buckets=True)

    def found(df):
        return sorted((r["bucket"], r["name"], bytes(r["content"])) for r in df.collect())

    assert found(with_object_name(scan_objects(spark, root), root)) == sorted(parts)
    ranges = fetch_objects(table, root, range_bytes=999).where("name = 'x.bin' AND bucket = 'b'").collect()
    assert [r["offset"] for r in sorted(ranges, key=lambda r: r["offset"])] == list(range(0, 10_000, 999))
    joined = b"".join(bytes(r["content"]) for r in sorted(ranges, key=lambda r: r["offset"]))
    assert joined == parts[0][2]
    assert found(fetch_objects(table, root)) == sorted(parts)
    listed = with_object_name(list_objects(spark, root, "*.bin"), root)
    assert rows(listed.select("bucket", "name", "length")) == [("b", "x.bin", 10_000), ("c", "x.bin", 1)]


def test_fetch_answers_every_row(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    names = spark.createDataFrame(
        [("b", "n"), ("b", "../n"), ("b", "a\0"), ("b", None), (None, "n")], "bucket STRING, name STRING"
    )
    found = fetch_objects(names, root).select("bucket", "name", "content", "error")
    assert rows(found) == [
        ("b", "../n", None, "the object name leaves its bucket"),
        ("b", "a\0", None, "the object name is not valid"),
        ("b", "n", None, "the object does not exist"),
        ("b", None, None, "the object has no name"),
        (None, "n", None, "the bucket name is not valid"),
    ]


def test_listing_finds_everything(spark, tmp_path, rows):
    root = f"file://{tmp_path}/store"
    names = ["a/x.html", "a/b/c/d/x.html", "a/empty", "a/_under", "a/.dot", "b/ü %20.html", "b/x.tmp"]
    names += ["a/.x.tmp", "a/.0123.tmp"]
    for name in [*names, "a/.quayside-0123.part"]:
        path = tmp_path / "store" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_bytes(b"" if name == "a/empty" else b"12")
    os.makedirs(tmp_path / "store" / "bare")
    listed = list_objects(spark, root)
    found = with_object_name(listed, root).select(F.concat_ws("/", "bucket", "name"), "length")
    assert rows(found) == sorted((name, 0 if name == "a/empty" else 2) for name in names)
    seconds = listed.select(F.unix_seconds(F.min("modificationTime"))).first()[0]
    assert abs(seconds - os.path.getmtime(tmp_path / "store" / "a" / "x.html")) < 60
    assert list_objects(spark, root, "*.html").count() == 3
    # Shares of a few entries leave folders and files to the tasks of further rounds.
    work = f"file://{tmp_path}/rounds"
    small = with_object_name(list_objects(spark, root, work_dir=work, task_files=2), root)
    assert rows(small.select(F.concat_ws("/", "bucket", "name"), "length")) == rows(found)
    assert rows(small.select("modificationTime")) == rows(listed.select("modificationTime"))
    kinds = spark.read.parquet(f"{work}/round-0", f"{work}/round-1").where("todo IS NOT NULL").select("todo")
    assert {r.todo for r in kinds.collect()} == {"folder", "file"}
    assert list_objects(spark, f"{root}/bare").count() == 0
    assert scan_objects(spark, f"{root}/bare").count() == 0
    everything = with_object_name(listed, root).select("bucket", "name")
    assert fetch_objects(everything, root).where("error IS NULL").count() == len(names)


def test_inventory_table_as_listing(spark, tmp_path, rows):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.html").write_bytes(b"12345")
    report = spark.createDataFrame(
        [("b", "x.html", 5, datetime(2024, 1, 1)), ("b", "x.tmp", 7, None), ("b", "folder/", 0, None)],
        "bucket STRING, key STRING, size LONG, last_modified TIMESTAMP",
    )
    root = f"file://{tmp_path}"
    listed = inventory_objects(report, root, "*.html")
    assert rows(listed.select("path", "length")) == [(f"{root}/b/x.html", 5)]
    found = scan_objects(spark, root, listed=listed).collect()
    assert [(r.offset, bytes(r.content), r.error) for r in found] == [(0, b"12345", None)]


def test_filters_keep_objects_closed(spark, tmp_path):
    """Objects that a filter on name or length leaves out can't be read, and need not be."""
    (tmp_path / "b").mkdir()
    for n in range(20):
        (tmp_path / "b" / f"o{n}.{'html' if n < 3 else 'bin'}").write_bytes(b"x" * n)
    found = scan_objects(spark, f"file://{tmp_path}", range_bytes=4)
    assert found.where("error IS NOT NULL").isEmpty()
    for n in range(3, 20):
        os.remove(tmp_path / "b" / f"o{n}.bin")
    assert found.where("error IS NOT NULL").count() == sum(-(-n // 4) for n in range(3, 20))
    kept = found.where("path LIKE '%.html'")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "StringEndsWith" in plan or "EndsWith(path" not in plan
    assert sorted((r.length, r.offset, r.error) for r in kept.collect()) == [(0, 0, None), (1, 0, None), (2, 0, None)]
    few = found.where("length < 3 AND path LIKE '%/b/o%' AND offset = 0 AND error IS NULL")
    assert sorted(r.length for r in few.collect()) == [0, 1, 2]
    assert found.where("length IN (1, 2) OR length = 0").count() == 3


def test_small_objects_share_batches(tmp_path):
    """Contents come in order and in batches by bytes, whatever the number of objects."""
    from quayside.sources import objects

    rows = []
    for n in range(300):
        (tmp_path / str(n)).write_bytes(bytes([n % 256]) * n)
        rows.append({"uri": f"file://{tmp_path}/{n}", "path": str(n), "length": n, "offset": 0, "error": None})
    rows[7] |= {"error": "no"}
    rows[9] |= {"uri": f"file://{tmp_path}/gone"}
    found = objects._contents(Store(), rows, 1 << 20, None)
    kinds = [objects.pa.string(), objects.pa.binary(), objects.pa.string()]
    batches = list(objects._packed(found, ["path", "content", "error"], kinds))
    assert len(batches) == 1
    for n, row in enumerate(batches[0].to_pylist()):
        assert row["path"] == str(n)
        assert (row["error"] is None) == (n not in (7, 9))
        assert row["content"] == (bytes([n % 256]) * n if n not in (7, 9) else None)


def test_writer_answers_every_part(spark, tmp_path, rows):
    """What can't be written is a row with an error, and nothing of it stays."""
    os.makedirs(tmp_path / "b")
    (tmp_path / "b" / "old").write_bytes(b"old")
    parts = [
        ("b", "n", b"x"), ("b", "old", b"new"), ("gone", "n", b"x"), ("b", "../n", b"x"), ("b", "none", None),
        ("b", None, b"x"), (None, "n", b"x"), ("b", "twice", b"1"), ("b", "twice", b"2"), ("b", "same", b"1"),
        ("b", "same", b"1"), ("b", "deep/k", b""),
    ]
    table = spark.createDataFrame(parts, "bucket STRING, name STRING, content BINARY")
    status = write_objects(table, f"file://{tmp_path}")
    repeated = "the name is used for several parts"
    assert rows(status) == sorted(
        [
            ("b", "n", 1, None), ("b", "old", 3, None), ("b", "deep/k", 0, None),
            ("gone", "n", None, "the bucket does not exist"), ("b", "../n", None, "the object name leaves its bucket"),
            ("b", "none", None, "part none has no bytes"), ("b", None, None, "the object has no name"),
            (None, "n", None, "the bucket name is not valid"), ("b", "twice", None, repeated),
            ("b", "twice", None, repeated), ("b", "same", None, repeated), ("b", "same", None, repeated),
        ],
        key=repr,
    )
    assert sorted(os.listdir(tmp_path / "b")) == ["deep", "n", "old"]
    assert os.listdir(tmp_path / "b" / "deep") == ["k"] and (tmp_path / "b" / "old").read_bytes() == b"new"


def test_failed_write_changes_no_object(spark, tmp_path):
    """The job that collects the parts fails: targets stay as they were, and what it left can be removed."""
    os.makedirs(tmp_path / "b")
    (tmp_path / "b" / "k0").write_bytes(b"old")
    good = spark.range(0, 40, 1, 4).selectExpr("concat('k', id) as name", "id", "spark_partition_id() as p")
    broken = "if(p = 3, cast(raise_error('the source broke') as binary), encode(concat('new', id), 'UTF-8'))"
    parts = good.selectExpr("'b' as bucket", "name", f"{broken} as content").repartition(4, "name")
    slow = good.selectExpr("'b' as bucket", "name", f"{broken} as content")
    for table in (parts, slow):
        work = f"file://{tmp_path}/work-{table is parts}"
        with pytest.raises(Exception, match="the source broke"):
            write_objects(table, f"file://{tmp_path}", work_dir=work)
        assert (tmp_path / "b" / "k0").read_bytes() == b"old"
        names = [n for n in os.listdir(tmp_path / "b") if not n.startswith(".quayside-")]
        assert names == ["k0"] and list_objects(spark, f"file://{tmp_path}/b").count() == 1
        discard_staged(spark, f"file://{tmp_path}", work)
    assert os.listdir(tmp_path / "b") == ["k0"]


def test_publish_of_a_part_may_run_again(tmp_path):
    store, uri = Store(), f"file://{tmp_path}/b/k"
    store.stage(uri, "m", [b"abc"])
    assert not os.path.exists(tmp_path / "b" / "k")
    for _ in range(2):
        store.publish(uri, "m", length=3)
    assert os.listdir(tmp_path / "b") == ["k"]
    with pytest.raises(StoreError):
        store.publish(uri, "m", length=4)
    store.discard(uri, "m")


def address(kind="ObjectStore", key="key", **properties):
    return {"type": kind, "keyName": key, "properties": properties}


@pytest.fixture
def store(tmp_path):
    """Source objects of several sizes and an empty target bucket."""
    contents = {f"o{n}": os.urandom(n * 1000) for n in (0, 1, 2, 5, 20)}
    os.makedirs(tmp_path / "src" / "in")
    os.makedirs(tmp_path / "dst" / "out")
    for name, content in contents.items():
        (tmp_path / "src" / "in" / name).write_bytes(content)
    settings = TransferSettings(
        "ObjectStore", "d", "c", f"file://{tmp_path}/src", f"file://{tmp_path}/dst"
    )
    return tmp_path, contents, settings


def run(spark, tmp_path, settings, requests, **options):
    sequence = [n if isinstance(n := r[0], int) else None for r in requests]
    requests = [(None if r[0] is None else str(r[0]), *r[1:], s) for r, s in zip(requests, sequence)]
    table = spark.createDataFrame(requests, T.StructType([*MANIFEST, T.StructField("sequence", T.LongType())]))
    registry = spark.createDataFrame([], REGISTRY)
    status = copy_objects(table, registry, settings, f"file://{tmp_path}/work", **options)
    return {row["request_id"]: row.asDict() for row in status.collect()}


@pytest.mark.parametrize("chunk_bytes", [1500, 5000, copy_job.CHUNK_BYTES])
def test_copy_matches_source_bytes(spark, store, chunk_bytes):
    tmp_path, contents, settings = store
    requests = [
        (name, address(key=f"copy/{name}", bucketName="IN", blobName=name), address(bucketName="Out"))
        for name in contents
    ]
    found = run(spark, tmp_path, settings, requests, chunk_bytes=chunk_bytes)
    for name, content in contents.items():
        assert found[name]["status"] == "ok", found[name]
        assert found[name]["bytes"] == len(content)
        assert (tmp_path / "dst" / "out" / "copy" / name).read_bytes() == content
        pieces = [content[at : at + chunk_bytes] for at in range(0, len(content), chunk_bytes)]
        assert found[name]["chunks"] == max(len(pieces), 1)
        joined = "".join(hashlib.sha256(piece).hexdigest() for piece in pieces or [b""])
        assert found[name]["range_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        whole = hashlib.sha256(content).hexdigest()
        assert found[name]["sha256"] == (whole if len(pieces) <= 1 else None)
    assert not [name for name in os.listdir(tmp_path / "dst" / "out" / "copy") if name.startswith(".")]


def test_copy_errors_become_rows(spark, store):
    tmp_path, contents, settings = store
    good = address(key="k1", bucketName="in", blobName="o1")
    to = address(bucketName="out")
    found = run(
        spark, tmp_path, settings,
        [
            ("ok", good, to),
            ("missing", address(key="k2", bucketName="in", blobName="nope"), to),
            ("no-bucket", address(key="k3", bucketName="in", blobName="o1"), address(bucketName="gone")),
            ("invalid", address(key="k4", bucketName="", blobName=None), address()),
            ("foreign", address("Other", "k5", bucketName="in", blobName="o1"), to),
            ("escape", address(key="../../k6", bucketName="in", blobName="o1"), to),
            ("spy", address(key="k7", bucketName="in", blobName="../../work"), to),
            ("up", address(key="k8", bucketName="..", blobName="src/in/o1"), to),
            ("nameless", address(key=None, bucketName="in", blobName="o1"), to),
            ("nul", address(key="a\0b", bucketName="in", blobName="o1"), to),
            ("twice", address(key="k9", bucketName="in", blobName="o1"), to),
            ("twice", address(key="k10", bucketName="in", blobName="o1"), to),
            (None, address(key="k11", bucketName="in", blobName="o1"), to),
        ],
    )
    assert len(found) == 12
    assert found["ok"]["error"] is None and found["ok"]["status"] == "ok"
    errors = {name: row["error"] for name, row in found.items() if name != "ok"}
    assert errors == {
        "missing": "Error writing the k2 object on the out bucket: the source object does not exist",
        "no-bucket": "Error writing the k3 object on the gone bucket: the bucket does not exist",
        "invalid": "blobName must not be empty, bucketName must not be empty, bucketName must not be empty",
        "foreign": "the source type is not served here",
        "escape": "Error writing the ../../k6 object on the out bucket: the object name leaves its bucket",
        "spy": "Error writing the k7 object on the out bucket: the object name leaves its bucket",
        "up": "Error writing the k8 object on the out bucket: the bucket name is not valid",
        "nameless": "Error writing the null object on the out bucket: the object has no name",
        "nul": "Error writing the a\0b object on the out bucket: the object name is not valid",
        "twice": "the request id is not unique",
        None: "the request has no id",
    }
    assert {row["status"] for name, row in found.items() if name != "ok"} == {"error"}
    assert not (tmp_path / "k6").exists()


def test_many_requests_for_one_target(spark, store):
    """A third of all requests write one object: one is carried out, all are reported."""
    tmp_path, contents, settings = store
    names = sorted(contents)
    requests = [
        (
            n,
            address(key="same" if n % 3 == 0 else f"t{n}", bucketName="in", blobName=names[n % 5]),
            address(bucketName="out"),
        )
        for n in range(300)
    ]
    found = run(spark, tmp_path, settings, requests)
    states = [found[str(n)]["status"] for n in range(300)]
    assert states.count("superseded") == 99
    assert [n for n in range(0, 300, 3) if states[n] == "ok"] == [297]
    assert (tmp_path / "dst" / "out" / "same").read_bytes() == contents[names[297 % 5]]


def test_failed_last_request_does_not_hide_an_earlier_one(spark, store):
    tmp_path, contents, settings = store
    found = run(
        spark, tmp_path, settings,
        [
            ("1", address(key="t", bucketName="in", blobName="o2"), address(bucketName="out")),
            ("2", address(key="t", bucketName="in", blobName="nope"), address(bucketName="out")),
        ],
    )
    assert (found["1"]["status"], found["2"]["status"]) == ("ok", "error")
    assert (tmp_path / "dst" / "out" / "t").read_bytes() == contents["o2"]


def test_request_that_fails_while_it_is_copied_gives_way(spark, store):
    """The last two requests read a file that is shorter than it says; then the latest one counts."""
    tmp_path, contents, settings = store
    os.symlink("/sys/kernel/mm/transparent_hugepage/enabled", tmp_path / "src" / "in" / "short")
    blobs = ["o1", "o2", "o5", "short", "short"]
    requests = [
        (n, address(key="t", bucketName="in", blobName=blob), address(bucketName="out"))
        for n, blob in zip((7, 8, 9, 10, 11), blobs)
    ]
    found = run(spark, tmp_path, settings, requests, chunk_bytes=1500)
    states = [found[str(n)]["status"] for n in (7, 8, 9, 10, 11)]
    assert states == ["superseded", "superseded", "ok", "error", "error"]
    assert (tmp_path / "dst" / "out" / "t").read_bytes() == contents["o5"]
    assert found["10"]["error"].endswith("the source object became shorter")


def test_objects_of_a_store_appear_whole(tmp_path):
    """An Arrow file system stands for an object store: keys are copied, never renamed."""
    os.makedirs(tmp_path / "b")
    store = Store()
    store._systems = {("s3a", None, None): fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())}

    def blocks():
        yield b"some"
        raise StoreError("the source object became shorter")

    digests = store.write("s3a://b/k", [b"abc", b"defg"], range_bytes=2)
    assert digests.length == 7
    assert digests.ranges() == "".join(hashlib.sha256(p).hexdigest() for p in (b"ab", b"cd", b"ef", b"g"))
    with pytest.raises(StoreError):
        store.write("s3a://b/k", blocks())
    assert os.listdir(tmp_path / "b") == ["k"]
    assert (tmp_path / "b" / "k").read_bytes() == b"abcdefg"


def test_bucket_below_a_bare_scheme(spark, rows):
    paths = spark.createDataFrame([("s3a://pages/x/y.html",), ("s3a://b/k",)], "path STRING")
    assert rows(with_object_name(paths, "s3a://").select("bucket", "name")) == [("b", "k"), ("pages", "x/y.html")]
    files = spark.createDataFrame([("file:/r/b/k",)], "path STRING")
    assert rows(with_object_name(files, "file:///r").select("bucket", "name")) == [("b", "k")]


def test_two_aliases_in_one_run(tmp_path, monkeypatch):
    """Each alias opens the store with its own key pair, without one the environment counts."""
    for alias in ("one", "two"):
        os.makedirs(tmp_path / alias)
        (tmp_path / alias / "access_key").write_text(f"id-{alias}\n")
        (tmp_path / alias / "secret_key").write_text(f"key-{alias}\n")
    monkeypatch.setattr(store_io.fs, "S3FileSystem", lambda **options: options)
    store = Store(f"file://{tmp_path}")
    pairs = [store.locate("s3a://b/k", "e", alias)[0] for alias in ("one", "two", None)]
    assert [p.get("access_key") for p in pairs] == ["id-one", "id-two", None]
    assert [p.get("secret_key") for p in pairs] == ["key-one", "key-two", None]
    assert {p["endpoint_override"] for p in pairs} == {"e"}
    for alias in ("gone", "../one", ""):
        with pytest.raises(StoreError, match="credential"):
            store.locate("s3a://b/k", "e", alias)
    assert Store().locate("s3a://b/k", "e", "gone")[0] == {"endpoint_override": "e"}


def test_expired_credential_is_an_error(spark, store):
    tmp_path, contents, settings = store
    requests = [
        (name, address(key=name, bucketName="in", blobName="o1"), address(key=name, bucketName="out"), None)
        for name in ("old", "new", "none")
    ]
    schema = T.StructType([*MANIFEST, T.StructField("sequence", T.LongType())])
    registry = spark.createDataFrame(
        [("old", True, datetime(2020, 1, 1)), ("new", True, datetime(2999, 1, 1))], REGISTRY
    )
    status = copy_objects(
        spark.createDataFrame(requests, schema), registry, settings, f"file://{tmp_path}/work"
    )
    found = {row["request_id"]: row["error"] for row in status.collect()}
    assert found == {"old": "the credential has expired", "new": None, "none": None}
    plan = spark.read.parquet(f"{tmp_path}/work/plan")
    aliases = {row["request_id"]: row["target_alias"] for row in plan.collect()}
    assert aliases == {"old": "old", "new": "new", "none": None}


def test_copy_may_run_again(spark, store):
    tmp_path, contents, settings = store
    requests = [("r", address(key="k", bucketName="in", blobName="o20"), address(bucketName="out"))]
    first = run(spark, tmp_path, settings, requests, chunk_bytes=3000)
    second = run(spark, tmp_path, settings, requests, chunk_bytes=3000)
    assert first == second
    assert (tmp_path / "dst" / "out" / "k").read_bytes() == contents["o20"]


def test_publish_may_run_again(tmp_path):
    target = f"file://{tmp_path}/k"
    hidden = copy_job._hidden_path(target, "run")
    with open(hidden, "wb") as out:
        out.write(b"12345")
    copy_job._publish(target, "run", 5)
    copy_job._publish(target, "run", 5)
    assert (tmp_path / "k").read_bytes() == b"12345"
    with pytest.raises(OSError):
        copy_job._publish(target, "run", 6)


def test_no_secret_reaches_the_plan(spark, store):
    tmp_path, _, settings = store
    request = ("r", address(bucketName="in", blobName="o1", secretKey="s3cr3t"), address(bucketName="out"))
    plan = copy_job.plan_copies(
        spark.createDataFrame([request], MANIFEST), spark.createDataFrame([], REGISTRY), settings
    )
    assert "s3cr3t" not in str(plan.collect())
    assert plan.where(F.col("plan_error").isNotNull()).isEmpty()


def test_failed_write_leaves_nothing(tmp_path):
    store, target = Store(), f"file://{tmp_path}/b/k"

    def blocks():
        yield b"some"
        raise StoreError("the source object became shorter")

    store.write(target, [b"old"])
    with pytest.raises(StoreError):
        store.write(target, blocks())
    assert os.listdir(tmp_path / "b") == ["k"]
    assert (tmp_path / "b" / "k").read_bytes() == b"old"


def test_addresses_of_other_stores():
    store = Store()
    store._systems = {
        ("s3a", None, None): "plain", ("s3a", "e", None): "named", ("hdfs://h:1", None, None): "hdfs",
    }
    assert store.locate("s3a://bucket/deep/k#?%20") == ("plain", "bucket/deep/k#?%20")
    assert store.locate("s3a://bucket/k", "e") == ("named", "bucket/k")
    assert store.locate("hdfs://h:1/bucket/k") == ("hdfs", "/bucket/k")


def test_failed_range_drops_the_collected_ranges(spark, store):
    """One of several ranges fails: the request is an error and no part of it stays."""
    tmp_path, contents, settings = store
    target = f"file://{tmp_path}/dst/out/k"
    hidden = copy_job._hidden_path(target, "work r")
    with open(hidden, "wb") as out:
        out.write(b"123")
    schema = "request_id STRING, chunks LONG, bytes LONG, sha256 STRING, range_sha256 STRING, store_error STRING"
    schema += ", upload STRING, tags ARRAY<STRING>"
    results = spark.createDataFrame([("r", 2, 3, None, "x", "broken", None, None)], schema)
    schema = "request_id STRING, target_uri STRING, target_endpoint STRING, target_alias STRING"
    plan = spark.createDataFrame([("r", target, None, None)], schema)
    assert copy_job._finish_ranges(results, plan, "work").first()["store_error"] == "broken"
    assert not os.path.exists(hidden) and not os.path.exists(tmp_path / "dst" / "out" / "k")
