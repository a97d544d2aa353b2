"""Transfers from documents to audited objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import addresses as A
from quayside.operators.metadata import resolve_requests
from quayside.operators.provisioning import (
    completion,
    preflight,
    provisioned_resources,
    resource_definitions,
)
from quayside.plans.copy_job import CHUNK_BYTES, copy_objects
from quayside.schemas import BUCKET_NAME
from quayside.settings import TransferSettings
from quayside.sources.objects import existing_buckets

BROKEN = "the document is broken"


def run_transfers(
    requests: DataFrame,
    agreements: DataFrame,
    assets: DataFrame,
    registry: DataFrame,
    settings: TransferSettings,
    work_dir: str,
    chunk_bytes: int = CHUNK_BYTES,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Resolve transfer requests, provide their buckets, copy what resolves, and audit every request.

    ``requests(request_id, contract_id, asset_id, dst)`` with, if known, ``sequence``,
    ``managed_resources`` and ``broken`` (the text of a document that can't be read);
    ``agreements(contract_id, agreed_asset)``, ``assets(asset_id, src)``, ``inventory(bucket)``, the buckets that
    exist; without it, the store is asked for those of requests with managed resources. The bucket of such a request
    is created by this run, so it must not be there before; requests of one run may share it.

    The result has the columns of ``copy_objects`` and ``complete``: whether the store has the bucket of the
    request at the end, that of its first provisioned resource or else of its destination. Requests that do not
    resolve are errors with the reason.
    """
    spark = requests.sparkSession
    for name, kind in (("sequence", "long"), ("managed_resources", "boolean"), ("broken", "string")):
        if name not in requests.columns:
            requests = requests.withColumn(name, F.lit(None).cast(kind))
    if "broken" in assets.columns:
        assets = assets.where("broken IS NULL")
    bucket = A.property_of(F.col("dst"), BUCKET_NAME)
    resolved = resolve_requests(requests, agreements, assets).withColumn("bucket_raw", bucket)
    managed = F.coalesce("managed_resources", F.lit(False))
    if inventory is None:
        asked = _asked(resolved.where(managed), settings)
        # What was there when the run began counts, also when it is carried on.
        existing_buckets(asked, settings.target_root, settings.credentials_root).write.mode("ignore").parquet(
            f"{work_dir}/inventory"
        )
        inventory = spark.read.schema("bucket STRING").parquet(f"{work_dir}/inventory")
    checked = preflight(resolved, inventory)
    problem = F.coalesce(
        F.when(F.col("broken").isNotNull(), F.lit(BROKEN)),
        F.when(F.col("resolution") != "resolved", F.col("resolution")),
        F.when(managed, F.col("error")),
    )
    resolved_path = f"{work_dir}/resolved"
    checked.select(
        "request_id", "sequence", "src", "dst", "bucket_raw", managed.alias("managed"), problem.alias("problem")
    ).write.mode("overwrite").parquet(resolved_path)
    resolved = spark.read.parquet(resolved_path)

    manifest = resolved.where("problem IS NULL").drop("problem", "bucket_raw")
    status = copy_objects(manifest, registry, settings, work_dir, chunk_bytes)
    refused = resolved.where("problem IS NOT NULL").select(
        "request_id", F.lit("error").alias("status"), F.col("problem").alias("error")
    )
    outcome = status.unionByName(refused, allowMissingColumns=True)
    plan = spark.read.parquet(f"{work_dir}/plan")
    return outcome.join(_audit(resolved, plan, settings), "request_id", "left")


def _asked(requests: DataFrame, settings: TransferSettings) -> DataFrame:
    """The buckets of requests, to be asked for with the credential of the environment."""
    return requests.select(
        A.canonical_bucket(F.col("bucket_raw")).alias("bucket"),
        F.lit(settings.connector_endpoint).alias("endpoint"),
        F.lit(None).cast("string").alias("alias"),
    ).where("bucket IS NOT NULL")


def _audit(resolved: DataFrame, plan: DataFrame, settings: TransferSettings) -> DataFrame:
    """Whether the store has the bucket of each request, now that objects were copied."""
    # Requests without a unique id are errors and have no audit of their own.
    known = (
        resolved.groupBy("request_id")
        .agg(F.min("bucket_raw").alias("dest_bucket"), F.count(F.lit(1)).alias("uses"))
        .where("uses = 1 AND request_id IS NOT NULL")
        .drop("uses")
    )
    managed = resolved.where("managed AND problem IS NULL AND request_id IS NOT NULL")
    provided = provisioned_resources(resource_definitions(managed, settings))
    resources = provided.select(
        F.col("transferProcessId").alias("request_id"), F.lit(0).alias("ord"), F.col("bucketName").alias("bucket")
    )
    # Planned requests are asked for as they are written, the others with the credential of the environment.
    planned = plan.where("target_bucket IS NOT NULL").select(
        F.col("target_bucket").alias("bucket"),
        F.col("target_endpoint").alias("endpoint"),
        F.col("target_alias").alias("alias"),
    )
    others = _asked(resolved.where("problem IS NOT NULL"), settings)
    now = existing_buckets(planned.unionByName(others), settings.target_root, settings.credentials_root)
    return completion(known, resources, now).select("request_id", "complete")
