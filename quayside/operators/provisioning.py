"""Resource definitions, the pre-flight check and the completion audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import addresses as A
from quayside.operators.lookups import lookup_join
from quayside.schemas import BUCKET_NAME, PROVISIONED_RESOURCE, STORAGE
from quayside.settings import TransferSettings


def resource_definitions(requests: DataFrame, settings: TransferSettings) -> DataFrame:
    """One definition per request whose destination type is served here.

    ``definition_id`` derives from the request, so a repeated run gives the same id.
    """
    return requests.where(F.col("dst.type").eqNullSafe(F.lit(settings.store_type))).select(
        F.sha2(F.col("request_id").cast("string"), 256).alias("definition_id"),
        F.col("request_id").alias("transfer_process_id"),
        A.property_of(F.col("dst"), BUCKET_NAME).alias("bucket_raw"),
        A.property_of(F.col("dst"), STORAGE).alias("storage"),
    )


def provisioned_resources(definitions: DataFrame) -> DataFrame:
    """Resource that provisioning a definition yields, with the names of resource and key."""
    bucket = A.canonical_bucket(F.col("bucket_raw"))
    return definitions.select(
        bucket.alias("id"),
        F.col("transfer_process_id").alias("transferProcessId"),
        F.col("definition_id").alias("resourceDefinitionId"),
        A.resource_name(F.col("definition_id")).alias("resourceName"),
        bucket.alias("bucketName"),
        F.col("storage"),
        A.key_name(bucket).alias("keyName"),
    )


def resource_to_json(resources: DataFrame) -> DataFrame:
    fields = [F.col(name) for name in PROVISIONED_RESOURCE.fieldNames()]
    return resources.select(F.to_json(F.struct(*fields)).alias("document"))


def resource_from_json(documents: DataFrame) -> DataFrame:
    return documents.select(F.from_json("document", PROVISIONED_RESOURCE).alias("r")).select("r.*")


def _known_buckets(inventory: DataFrame, name: str) -> DataFrame:
    """Inventory with one row per lower-cased bucket."""
    return (
        inventory.select(A.canonical_bucket(F.col("bucket")).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
        .withColumn("bucket_exists", F.lit(True))
    )


def preflight(definitions: DataFrame, inventory: DataFrame) -> DataFrame:
    """Say for every definition whether its bucket is to be created or already there.

    One join serves both answers: ``action`` is ``create`` or ``conflict``.
    """
    keyed = definitions.withColumn("bucket", A.canonical_bucket(F.col("bucket_raw")))
    found = lookup_join(keyed, _known_buckets(inventory, "bucket"), "bucket")
    conflict = F.coalesce("bucket_exists", F.lit(False))
    return found.withColumns(
        {
            "action": F.when(conflict, "conflict").otherwise("create"),
            "error": F.when(conflict, F.format_string("Bucket:%s exists", "bucket_raw")),
        }
    ).drop("bucket_exists")


def completion(requests: DataFrame, resources: DataFrame, inventory: DataFrame) -> DataFrame:
    """Tell which requests are complete, that is, whose bucket exists.

    ``requests(request_id, dest_bucket)``, ``resources(request_id, ord, bucket)``. Only the
    first provisioned resource of a request counts; without one, the destination does.
    """
    first = resources.groupBy("request_id").agg(
        F.min(F.struct("ord", "bucket")).alias("first_resource")
    )
    # One row per request on both sides, so no key of this join can be hot.
    chosen = requests.join(first, "request_id", "left").withColumn(
        "checked_bucket",
        A.canonical_bucket(
            F.when(F.col("first_resource").isNotNull(), F.col("first_resource.bucket")).otherwise(
                F.col("dest_bucket")
            )
        ),
    )
    found = lookup_join(
        chosen.drop("first_resource"), _known_buckets(inventory, "checked_bucket"),
        "checked_bucket",
    )
    return found.withColumn("complete", F.coalesce("bucket_exists", F.lit(False))).drop(
        "bucket_exists"
    )
