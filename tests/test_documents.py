from __future__ import annotations

import json
from datetime import datetime

from quayside.schemas import SENSOR_READING
from quayside.sources import documents as D


def write(tmp_path, *documents):
    path = tmp_path / "documents.json"
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


def test_assets_take_inner_type_and_drop_secrets(spark, tmp_path):
    def asset(**properties):
        return {
            "@context": {},
            "asset": {"@id": "a1", "properties": {"name": "n", "contenttype": "application/json"}},
            "dataAddress": {"type": "Outer", "properties": properties},
        }

    path = write(
        tmp_path,
        asset(type="Inner", bucketName="b", keyName="k", accessKey="x", secretKey="y"),
        asset(bucketName="b"),
    )
    first, second = D.read_assets(spark, path).collect()
    assert (first["asset_id"], first["name"], first["content_type"]) == ("a1", "n", "application/json")
    assert (first["src"]["type"], first["src"]["keyName"]) == ("Inner", "k")
    assert set(first["src"]["properties"]) == {"type", "bucketName", "keyName"}
    assert (second["src"]["type"], second["src"]["keyName"]) == ("Outer", None)


def test_policies_definitions_negotiations(spark, tmp_path):
    rules = {"odrl:permission": [], "odrl:prohibition": [], "odrl:obligation": []}
    path = write(tmp_path, {"@id": "p", "policy": {"@type": "set", **rules}})
    assert tuple(D.read_policies(spark, path).first()) == ("p", "set", [], [], [], None)
    path = write(tmp_path, {"id": "1", "accessPolicyId": "p", "contractPolicyId": "q", "assetsSelector": []})
    assert tuple(D.read_contract_definitions(spark, path).first()) == ("1", "p", "q", [], None)
    path = write(
        tmp_path,
        {
            "connectorId": "c", "connectorAddress": "u", "consumerId": "x", "providerId": "y",
            "protocol": "m", "offer": {"offerId": "o", "assetId": "a", "policy": {"@id": "o", **rules}},
        },
    )
    assert tuple(D.read_negotiations(spark, path).first()) == ("c", "u", "x", "y", "m", "o", "a", None)


def test_transfer_with_repeated_key(spark, tmp_path):
    path = write(
        tmp_path,
        '{"@type":"TransferRequestDto","connectorId":"c","connectorAddress":"u","protocol":"m",'
        '"contractId":"k","protocol":"m","assetId":"a","dataDestination":{"type":"T","storage":"s",'
        '"bucketName":"b","keyName":"n","secretKey":"y"},"managedResources":false}',
    )
    row = D.read_transfers(spark, path).first()
    assert (row["contract_id"], row["asset_id"], row["protocol"], row["managed_resources"]) == ("k", "a", "m", False)
    assert row["dst"]["properties"] == {"bucketName": "b", "storage": "s"}
    assert (row["dst"]["type"], row["dst"]["keyName"]) == ("T", "n")


def test_sensor_asset(spark, tmp_path, rows):
    path = tmp_path / "device.csv"
    names = ";".join(SENSOR_READING.fieldNames())
    path.write_text(f"{names}\n0;1;2020-01-25 14:05:09.917;1;5;22.5;41.6;158.5;552.0;0;0;0;1\n")
    row = D.read_delimited(spark, str(path), SENSOR_READING).first()
    assert row["abstimestamp"] == datetime(2020, 1, 25, 14, 5, 9, 917000)
    assert (row["nodeid"], row["temp"], row["window"]) == (5, 22.5, 1)
    copy = str(tmp_path / "copy")
    table = D.read_delimited(spark, str(path), SENSOR_READING)
    D.write_delimited(table, copy)
    assert rows(D.read_delimited(spark, copy, SENSOR_READING)) == rows(table)


def test_transfers_without_an_id_get_one(spark, tmp_path):
    documents = [
        '{"contractId":"c1","assetId":"a1","dataDestination":{"type":"t"}}',
        '{"contractId":"c1","assetId":"a1","dataDestination":{"type":"t"}}',
        '{"contractId":"c2","assetId":"a1","dataDestination":{"type":"t"}}',
        '{"@id":"own","contractId":"c2","assetId":"a1","dataDestination":{"type":"t"}}',
    ]
    (tmp_path / "transfers.json").write_text("\n".join(documents))
    found = [r["request_id"] for r in D.read_transfers(spark, str(tmp_path / "transfers.json")).collect()]
    assert None not in found and len(set(found)) == 4 and "own" in found
    again = [r["request_id"] for r in D.read_transfers(spark, str(tmp_path / "transfers.json")).collect()]
    assert sorted(found) == sorted(again)


def test_broken_documents_keep_their_text_without_secrets(spark, tmp_path):
    path = write(
        tmp_path,
        '{"@id":"t1","contractId":"c","dataDestination":{"type":"t","secretKey":"s3cr\\"et", "accessKey" : "ab',
        "no json",
        '{"@id":"t3","contractId":["c"],"managedResources":"x"}',
        '{"@id":"t4","contractId":"c","dataDestination":{"secretKey":"s3cret"}}',
        '{"secretKey: s3cret, "x":1',
    )
    found = {r["broken"]: r for r in D.read_transfers(spark, path).collect()}
    assert len(found) == 5 and found[None]["request_id"] == "t4"
    assert "no json" in found and not any("s3cr" in text or "et\"" in text for text in found if text)
    first = next(text for text in found if text and "t1" in text)
    assert first == (
        '{"@id":"t1","contractId":"c","dataDestination":{"type":"t","secretKey":"***", "accessKey" : "***"'
    )
    assert all(r["request_id"] for r in found.values())
    (tmp_path / "a.json").write_text('{"asset":{"@id":"a"},"dataAddress":\n{"asset":{"@id":"b"}}')
    assets = {r["asset_id"]: r["broken"] for r in D.read_assets(spark, str(tmp_path / "a.json")).collect()}
    assert assets == {None: '{"asset":{"@id":"a"},"dataAddress":', "b": None}
