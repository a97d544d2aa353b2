"""Schemas of documents, manifests and log events."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Property names of an object address (fixed values).
STORAGE = "storage"
BUCKET_NAME = "bucketName"
BLOB_NAME = "blobName"
SECRET_PROPERTIES = ("accessKey", "secretKey")

ADDRESS = _struct(type=T.StringType(), keyName=T.StringType(), properties=STRING_MAP)

MANIFEST = _struct(request_id=T.StringType(), src=ADDRESS, dst=ADDRESS)

# Documents, as posted: field names are fixed values of the document formats.
ASSET_DOCUMENT = _struct(
    asset=T.StructType(
        [
            T.StructField("@id", T.StringType()),
            T.StructField("properties", _strings("name", "contenttype")),
        ]
    ),
    dataAddress=_struct(type=T.StringType(), properties=STRING_MAP),
)

_RULES = T.ArrayType(T.StringType())

POLICY_DOCUMENT = T.StructType(
    [
        T.StructField("@id", T.StringType()),
        T.StructField(
            "policy",
            T.StructType(
                [
                    T.StructField("@type", T.StringType()),
                    T.StructField("odrl:permission", _RULES),
                    T.StructField("odrl:prohibition", _RULES),
                    T.StructField("odrl:obligation", _RULES),
                ]
            ),
        ),
    ]
)

CONTRACT_DEFINITION_DOCUMENT = _struct(
    id=T.StringType(),
    accessPolicyId=T.StringType(),
    contractPolicyId=T.StringType(),
    assetsSelector=T.ArrayType(T.StringType()),
)

NEGOTIATION_DOCUMENT = _struct(
    connectorId=T.StringType(),
    connectorAddress=T.StringType(),
    consumerId=T.StringType(),
    providerId=T.StringType(),
    protocol=T.StringType(),
    offer=_strings("offerId", "assetId"),
)

TRANSFER_DOCUMENT = T.StructType(
    [
        T.StructField("@id", T.StringType()),
        T.StructField("connectorId", T.StringType()),
        T.StructField("connectorAddress", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("contractId", T.StringType()),
        T.StructField("assetId", T.StringType()),
        # The credentials a destination may carry are left out on purpose.
        T.StructField("dataDestination", _strings("type", "storage", "bucketName", "keyName")),
        T.StructField("managedResources", T.BooleanType()),
    ]
)

PROVISIONED_RESOURCE = _strings(
    "id", "transferProcessId", "resourceDefinitionId", "resourceName", "bucketName", "storage"
)

# Record of the agent's own log stream.
AGENT_RECORD = _struct(
    message=T.StringType(),
    file=T.StringType(),
    pid=T.LongType(),
    source_type=T.StringType(),
    pod=T.StringType(),
    timestamp=T.TimestampType(),
    metadata=_strings("level", "module_path"),
)

LOG_COLUMNS = (
    "timestamp",
    "event_ts",
    "pod",
    "container",
    "file",
    "processed_file",
    "logger",
    "level",
    "message",
    "namespace",
    "cluster",
    "role",
    "roleGroup",
)

# Columns of the sensor asset (fixed values).
SENSOR_READING = _struct(
    id=T.IntegerType(),
    eid=T.IntegerType(),
    abstimestamp=T.TimestampType(),
    reltimestamp=T.IntegerType(),
    nodeid=T.IntegerType(),
    temp=T.DoubleType(),
    humidity=T.DoubleType(),
    light1=T.DoubleType(),
    light2=T.DoubleType(),
    occupants=T.IntegerType(),
    activity=T.IntegerType(),
    door=T.IntegerType(),
    window=T.IntegerType(),
)
