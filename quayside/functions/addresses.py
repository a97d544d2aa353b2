"""Expressions over object addresses ``struct<type, keyName, properties>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import WHITE_SPACE
from quayside.schemas import BLOB_NAME, BUCKET_NAME, STORAGE
from quayside.settings import TransferSettings

# Message of a failed part (fixed value).
WRITE_FAILURE = "Error writing the %s object on the %s bucket: %s"


def property_of(address: Column, key: str) -> Column:
    """Value of a property, null when absent."""
    return F.try_element_at(address["properties"], F.lit(key))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.btrim(value, F.lit(WHITE_SPACE)) == "")


def _missing(address: Column, *keys: str) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(is_blank(property_of(address, key)), F.lit(f"{key} must not be empty"))
                for key in keys
            ]
        )
    )


def source_errors(address: Column) -> Column:
    """All rule failures of a source address, in rule order."""
    return _missing(address, BLOB_NAME, BUCKET_NAME)


def destination_errors(address: Column) -> Column:
    """All rule failures of a destination address."""
    return _missing(address, BUCKET_NAME)


def joined(errors: Column) -> Column:
    """Failures as one message, null when there are none."""
    return F.when(F.size(errors) > 0, F.concat_ws(", ", errors))


def is_routed(address: Column, settings: TransferSettings) -> Column:
    """Whether the source address belongs to this installation; any destination does."""
    return address["type"].eqNullSafe(F.lit(settings.store_type))


def target_endpoint(has_token: Column, address: Column, settings: TransferSettings) -> Column:
    """Endpoint written to. An empty ``storage`` counts as given, only null falls back."""
    named = F.coalesce(property_of(address, STORAGE), F.lit(settings.default_endpoint))
    return F.when(F.coalesce(has_token, F.lit(False)), named).otherwise(
        F.lit(settings.connector_endpoint)
    )


def canonical_bucket(bucket: Column) -> Column:
    return F.lower(bucket)


def key_name(bucket: Column) -> Column:
    """Name under which the key of a provisioned bucket is stored."""
    return F.concat(bucket, F.lit("-key"))


def resource_name(definition_id: Column) -> Column:
    return F.concat(definition_id, F.lit("-container"))


def token_expiry(issued_at: Column) -> Column:
    """Expiry of a temporary key, one hour after issue, as epoch milliseconds."""
    return F.unix_millis(issued_at + F.expr("INTERVAL 1 HOUR"))


def object_uri(root: str, bucket: Column, name: Column) -> Column:
    base = root if root.endswith("/") else root + "/"
    return F.concat(F.lit(base), bucket, F.lit("/"), name)


def write_failure(name: Column, bucket: Column, reason: Column) -> Column:
    """Message of a failed part."""
    return F.when(reason.isNotNull(), F.format_string(WRITE_FAILURE, name, bucket, reason))
