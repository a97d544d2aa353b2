"""Validation, routing and resolution of a table of transfer requests (the manifest)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import addresses as A
from quayside.operators.lookups import lookup_join
from quayside.schemas import BLOB_NAME, BUCKET_NAME
from quayside.settings import TransferSettings


def validate_requests(manifest: DataFrame) -> DataFrame:
    """Check both addresses. Invalid requests stay in the table, with all their failures."""
    checked = manifest.withColumns(
        {
            "source_errors": A.source_errors(F.col("src")),
            "destination_errors": A.destination_errors(F.col("dst")),
        }
    )
    return checked.withColumn("error", A.joined(F.concat("source_errors", "destination_errors")))


def route_requests(manifest: DataFrame, settings: TransferSettings) -> DataFrame:
    """Mark the requests whose source type is served here."""
    return manifest.withColumn("routed", A.is_routed(F.col("src"), settings))


def resolve_endpoints(
    manifest: DataFrame, registry: DataFrame, settings: TransferSettings
) -> DataFrame:
    """Look up the credential alias of each destination and choose the endpoints.

    ``registry`` holds one row per alias: ``key_name, has_token, expires_at``. A missing
    alias is no error. Key values never enter a table.
    """
    keyed = manifest.withColumn("key_name", F.col("dst.keyName"))
    found = lookup_join(keyed, registry.select("key_name", "has_token", "expires_at"), "key_name")
    return found.withColumns(
        {
            "has_token": F.coalesce("has_token", F.lit(False)),
            "source_endpoint": F.lit(settings.connector_endpoint),
            "target_endpoint": A.target_endpoint(F.col("has_token"), F.col("dst"), settings),
        }
    )


def name_objects(manifest: DataFrame, settings: TransferSettings) -> DataFrame:
    """Name source and target objects.

    Buckets are lower-cased for every step. The object is read under the source's blob name
    and written under the source's key name.
    """
    source_bucket = A.property_of(F.col("src"), BUCKET_NAME)
    target_bucket = A.property_of(F.col("dst"), BUCKET_NAME)
    named = manifest.withColumns(
        {
            "source_bucket_raw": source_bucket,
            "source_bucket": A.canonical_bucket(source_bucket),
            "target_bucket_raw": target_bucket,
            "target_bucket": A.canonical_bucket(target_bucket),
            "source_object": A.property_of(F.col("src"), BLOB_NAME),
            "target_object": F.col("src.keyName"),
        }
    )
    return named.withColumns(
        {
            "source_uri": A.object_uri(
                settings.source_root, F.col("source_bucket"), F.col("source_object")
            ),
            "target_uri": A.object_uri(
                settings.target_root, F.col("target_bucket"), F.col("target_object")
            ),
        }
    )
