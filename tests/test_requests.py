from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.functions import addresses as A
from quayside.operators import metadata as M
from quayside.operators import provisioning as P
from quayside.operators import requests as R
from quayside.schemas import MANIFEST
from quayside.settings import TransferSettings

SETTINGS = TransferSettings("ObjectStore", "default.example", "connector.example", "s3a://", "s3a://")


def address(kind="ObjectStore", key="key", **properties):
    return {"type": kind, "keyName": key, "properties": properties}


def manifest(spark, *requests):
    return spark.createDataFrame([(str(n), src, dst) for n, (src, dst) in enumerate(requests)], MANIFEST)


def test_validation_collects_all_failures(spark):
    full = address(bucketName="b", blobName="o")
    table = manifest(
        spark,
        (full, address(bucketName="b")),
        (address(bucketName="b"), address(bucketName="b")),
        (address(bucketName="", blobName=""), address(bucketName="b")),
        (full, address()),
        (address(bucketName="b", blobName=" "), address(bucketName=None)),
    )
    errors = [row["error"] for row in R.validate_requests(table).orderBy("request_id").collect()]
    blob, bucket = "blobName must not be empty", "bucketName must not be empty"
    assert errors == [None, blob, f"{blob}, {bucket}", bucket, f"{blob}, {bucket}"]


def test_route_looks_at_the_source_only(spark):
    table = manifest(
        spark,
        (address(), address("Other")),
        (address("Other"), address()),
        (address(None), address()),
    )
    routed = [row["routed"] for row in R.route_requests(table, SETTINGS).orderBy("request_id").collect()]
    assert routed == [True, False, False]


def test_endpoints(spark):
    src = address(bucketName="b", blobName="o", storage="ignored")
    table = manifest(
        spark,
        (src, address(key="known", storage="s")),
        (src, address(key="known", storage="")),
        (src, address(key="known")),
        (src, address(key="unknown", storage="s")),
        (src, address(key=None, storage="s")),
    )
    registry = spark.createDataFrame([("known", True, None)], "key_name STRING, has_token BOOLEAN, expires_at TIMESTAMP")
    found = R.resolve_endpoints(table, registry, SETTINGS).orderBy("request_id").collect()
    assert [row["target_endpoint"] for row in found] == [
        "s", "", "default.example", "connector.example", "connector.example",
    ]
    assert {row["source_endpoint"] for row in found} == {"connector.example"}


def test_names(spark):
    table = manifest(
        spark,
        (address(key="source-key", bucketName="Bucket-A", blobName="blob"), address(key="target-key", bucketName="BUCKET-a")),
    )
    row = R.name_objects(table, SETTINGS).first()
    assert row["source_uri"] == "s3a://bucket-a/blob"
    assert row["target_uri"] == "s3a://bucket-a/source-key"
    assert (row["source_bucket_raw"], row["target_bucket_raw"]) == ("Bucket-A", "BUCKET-a")


def test_token_expiry_is_milliseconds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 1999),)], "t TIMESTAMP")
    assert df.select(A.token_expiry(F.col("t"))).first()[0] == 1704070800001


def test_provisioned_resource_survives_json(spark):
    table = manifest(
        spark,
        (address(), address(bucketName="Bucket-A", storage="s")),
        (address(), address("Other", bucketName="b")),
    )
    definitions = P.resource_definitions(table, SETTINGS)
    resources = P.provisioned_resources(definitions)
    assert resources.count() == 1
    row = resources.first()
    assert row["keyName"] == "bucket-a-key"
    assert row["resourceName"] == row["resourceDefinitionId"] + "-container"
    back = P.resource_from_json(P.resource_to_json(resources)).first()
    assert back.asDict() == {name: row[name] for name in back.asDict()}
    assert back["bucketName"] == "bucket-a"


def test_preflight(spark):
    definitions = spark.createDataFrame(
        [("d1", "p1", "Bucket-A", None), ("d2", "p2", "new", None), ("d3", "p3", None, None)],
        "definition_id STRING, transfer_process_id STRING, bucket_raw STRING, storage STRING",
    )
    inventory = spark.createDataFrame([("BUCKET-A",), ("bucket-a",), (None,)], "bucket STRING")
    found = P.preflight(definitions, inventory).orderBy("definition_id").collect()
    assert [(row["action"], row["error"]) for row in found] == [
        ("conflict", "Bucket:Bucket-A exists"),
        ("create", None),
        ("create", None),
    ]


def test_completion_checks_first_resource_only(spark):
    requests = spark.createDataFrame(
        [("r1", "there"), ("r2", "there"), ("r3", "gone"), ("r4", "There")],
        "request_id STRING, dest_bucket STRING",
    )
    resources = spark.createDataFrame(
        [("r2", 2, "there"), ("r2", 1, "gone"), ("r3", 1, "THERE"), ("r3", 2, "gone")],
        "request_id STRING, ord INT, bucket STRING",
    )
    inventory = spark.createDataFrame([("there",)], "bucket STRING")
    found = P.completion(requests, resources, inventory).orderBy("request_id").collect()
    assert [row["complete"] for row in found] == [True, False, True, True]


def test_request_resolution(spark):
    requests = spark.createDataFrame(
        [("r1", "c1", "a1"), ("r2", "c9", "a1"), ("r3", "c1", "a2"), ("r4", "c2", "a9"), ("r5", None, None)],
        "request_id STRING, contract_id STRING, asset_id STRING",
    )
    agreements = spark.createDataFrame([("c1", "a1"), ("c2", "a9")], "contract_id STRING, agreed_asset STRING")
    assets = spark.createDataFrame([("a1", ("t",)), ("a2", ("t",))], "asset_id STRING, src STRUCT<type STRING>")
    found = M.resolve_requests(requests, agreements, assets).orderBy("request_id").collect()
    assert [row["resolution"] for row in found] == [
        "resolved",
        "no such agreement",
        "agreement is for another asset",
        "no such asset",
        "no such agreement",
    ]


def test_offers(spark):
    definitions = spark.createDataFrame(
        [("d1", "p1", "p1", []), ("d2", "p1", "p1", ["x"]), ("d3", "p9", "p1", []), ("d4", "p1", "p9", None)],
        "definition_id STRING, access_policy_id STRING, contract_policy_id STRING, assets_selector ARRAY<STRING>",
    )
    policies = spark.createDataFrame([("p1",)], "policy_id STRING")
    assets = spark.createDataFrame([("a1",), ("a2",)], "asset_id STRING")
    offers = spark.createDataFrame(
        [(1, "d1", "a1"), (2, "d1", "a9"), (3, "d2", "a1"), (4, "d3", "a1"), (5, "d4", "a1"), (6, "d9", "a1"), (7, "d1", "a2")],
        "n INT, definition_id STRING, asset_id STRING",
    )
    found = M.resolve_offers(offers, definitions, policies, assets).orderBy("n").collect()
    assert [row["status"] for row in found] == [
        "offered",
        "no such asset",
        "asset selectors are not supported",
        "no such access policy",
        "no such contract policy",
        "no such definition",
        "offered",
    ]


@pytest.mark.parametrize("vocabulary", ["v", "other"])
def test_reply_ids(spark, vocabulary):
    document = '{"@id":"n1","%s:contractAgreementId":"c1","dcat:dataset":{"odrl:hasPolicy":{"@id":"o1"}}}' % vocabulary
    replies = spark.createDataFrame([(document,)], "document STRING")
    row = M.agreement_id(M.negotiation_id(M.catalogue_offer_id(replies)), vocabulary).first()
    assert (row["offer_id"], row["negotiation_id"], row["agreement_id"]) == ("o1", "n1", "c1")


def test_reached_agreements(spark, rows):
    negotiations = spark.createDataFrame(
        [("n1", "a1"), ("n2", "a2"), ("n3", "a3")], "negotiation_id STRING, asset_id STRING"
    )
    documents = [
        '{"@id":"n1","v:state":"REQUESTED"}',
        '{"@id":"n1","v:contractAgreementId":"c1"}',
        '{"@id":"n1","v:contractAgreementId":"c1"}',
        '{"@id":"n2","v:contractAgreementId":"c2"}',
        '{"@id":"n9","v:contractAgreementId":"c9"}',
    ]
    replies = spark.createDataFrame([(document,) for document in documents], "document STRING")
    assert rows(M.reached_agreements(negotiations, replies, "v")) == [
        ("c1", "a1"), ("c2", "a2"), ("c9", None),
    ]


def test_repeated_and_contradicting_lookup_rows(spark):
    requests = spark.createDataFrame(
        [("r1", "c1", "a1"), ("r2", "c2", "a1"), ("r3", "c3", "a3"), ("r4", "c4", "a1")],
        "request_id STRING, contract_id STRING, asset_id STRING",
    )
    agreements = spark.createDataFrame(
        [("c1", "a1"), ("c1", "a1"), ("c2", "a1"), ("c2", "a2"), ("c3", "a3"), ("c4", "a1"), ("c4", None)],
        "contract_id STRING, agreed_asset STRING",
    )
    assets = spark.createDataFrame(
        [("a1", ("t", {"x": "1", "y": "2"})), ("a1", ("t", {"y": "2", "x": "1"})), ("a3", ("t", {})), ("a3", ("u", {}))],
        "asset_id STRING, src STRUCT<type STRING, properties MAP<STRING, STRING>>",
    )
    found = M.resolve_requests(requests, agreements, assets).collect()
    assert {row["request_id"]: row["resolution"] for row in found} == {
        "r1": "resolved",
        "r2": "agreements contradict each other",
        "r3": "descriptions of the asset contradict each other",
        "r4": "agreements contradict each other",
    }
    assert len(found) == 4
