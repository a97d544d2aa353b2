"""A whole transfer: documents in, object copied, outcome reported."""

from __future__ import annotations

import json
import os

from quayside.plans.transfer import run_transfers
from quayside.settings import TransferSettings
from quayside.sources import documents as D


def test_demo_transfer(spark, tmp_path):
    os.makedirs(tmp_path / "store" / "source-bucket")
    os.makedirs(tmp_path / "store" / "target-bucket")
    content = b"id;temp\n0;22.5\n"
    (tmp_path / "store" / "source-bucket" / "device.csv").write_bytes(content)

    asset = {
        "asset": {"@id": "asset-1", "properties": {"name": "n", "contenttype": "application/json"}},
        "dataAddress": {
            "type": "Outer",
            "properties": {
                "type": "ObjectStore", "bucketName": "source-bucket", "container": "source-bucket",
                "blobName": "device.csv", "storage": "s", "keyName": "device-copy.csv",
            },
        },
    }

    def transfer(request_id, contract, asset_id):
        return {
            "@id": request_id, "contractId": contract, "assetId": asset_id, "managedResources": False,
            "dataDestination": {
                "type": "ObjectStore", "storage": "s", "bucketName": "Target-Bucket", "keyName": "alias",
            },
        }

    (tmp_path / "assets.json").write_text(json.dumps(asset))
    requests = [transfer("t1", "c1", "asset-1"), transfer("t2", "c9", "asset-1"), transfer("t3", "c2", "gone")]
    (tmp_path / "transfers.json").write_text("\n".join(map(json.dumps, requests)))

    root = f"file://{tmp_path}/store"
    settings = TransferSettings("ObjectStore", "default", "connector", root, root)
    agreements = spark.createDataFrame(
        [("c1", "asset-1"), ("c1", "asset-1"), ("c2", "gone")], "contract_id STRING, agreed_asset STRING"
    )
    registry = spark.createDataFrame([], "key_name STRING, has_token BOOLEAN, expires_at TIMESTAMP")
    status = run_transfers(
        D.read_transfers(spark, str(tmp_path / "transfers.json")),
        agreements,
        D.read_assets(spark, str(tmp_path / "assets.json")),
        registry,
        settings,
        f"file://{tmp_path}/work",
    )
    assert {row["request_id"]: row["complete"] for row in status.collect()} == {"t1": True, "t2": True, "t3": True}
    found = {row["request_id"]: (row["status"], row["bytes"], row["error"]) for row in status.collect()}
    assert found == {
        "t1": ("ok", len(content), None),
        "t2": ("error", None, "no such agreement"),
        "t3": ("error", None, "no such asset"),
    }
    assert (tmp_path / "store" / "target-bucket" / "device-copy.csv").read_bytes() == content


def test_audit_asks_the_store(spark, tmp_path):
    """Buckets that are not there, that a run creates, and that others hold; a run may be carried on."""
    os.makedirs(tmp_path / "src")
    os.makedirs(tmp_path / "held")
    (tmp_path / "src" / "o").write_bytes(b"1")

    def address(bucket, **more):
        return {"type": "T", "keyName": "k", "properties": {"bucketName": bucket, **more}}

    rows = [("a", "held", False), ("b", "gone", False), ("c", "New", True), ("d", "Held", True), ("e", "..", False)]
    requests = spark.createDataFrame(
        [(i, f"c{i}", "asset", address(b), m, None) for i, b, m in rows]
        + [("f", "none", "asset", address("held"), False, None), ("g", "x", None, address("gone"), True, None)]
        + [("h", None, None, None, None, "{broken")],
        "request_id STRING, contract_id STRING, asset_id STRING, dst STRUCT<type STRING, keyName STRING, "
        "properties MAP<STRING, STRING>>, managed_resources BOOLEAN, broken STRING",
    )
    agreements = spark.createDataFrame([(f"c{i}", "asset") for i, _, _ in rows], "contract_id STRING, agreed_asset STRING")
    assets = spark.createDataFrame(
        [("asset", address("src", blobName="o"))],
        "asset_id STRING, src STRUCT<type STRING, keyName STRING, properties MAP<STRING, STRING>>",
    )
    registry = spark.createDataFrame([], "key_name STRING, has_token BOOLEAN, expires_at TIMESTAMP")
    settings = TransferSettings("T", "d", "c", f"file://{tmp_path}", f"file://{tmp_path}")
    for _ in range(2):
        status = run_transfers(requests, agreements, assets, registry, settings, f"file://{tmp_path}/work")
        found = {r["request_id"]: (r["status"], r["complete"]) for r in status.collect()}
        assert found == {
            "a": ("ok", True), "b": ("error", False), "c": ("ok", True), "d": ("error", True),
            "e": ("error", False), "f": ("error", True), "g": ("error", False), "h": ("error", False),
        }
    errors = {r["request_id"]: r["error"] for r in status.collect()}
    assert errors["d"] == "Bucket:Held exists" and errors["h"] == "the document is broken"
