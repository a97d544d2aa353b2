"""Scans of metadata documents (one JSON document per line) and of delimited assets.

Schemas are given, never inferred, and prefixed keys are renamed while reading. A document that is no
JSON or has other types is a row with its text in ``broken``, without the values of secrets; the other columns
are null as far as nothing could be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import schemas as S


BROKEN = "broken"
# A secret with its value, up to the end of the text if its quotes are broken.
_SECRET = r"""(?i)("?(?:%s)"?\s*[:=]\s*)(?:"(?:[^"\\]|\\.)*"|"?[^,}\s]*"?)""" % "|".join(S.SECRET_PROPERTIES)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Parsed here and not by the file reader, which applies filters while it parses and then loses documents that
    # break after the fields it has looked at. The typed parser accepts documents that repeat a key.
    whole = T.StructType([*schema, T.StructField(BROKEN, T.StringType())])
    document = F.from_json("value", whole, {"columnNameOfCorruptRecord": BROKEN})
    lines = spark.read.text(path).where(F.trim("value") != "")
    documents = lines.select(document.alias("document")).select("document.*")
    return documents.withColumn(BROKEN, F.regexp_replace(BROKEN, _SECRET, '$1"***"'))


def _without_secrets(properties: Column) -> Column:
    return F.map_filter(properties, lambda key, _: ~key.isin(*S.SECRET_PROPERTIES))


def read_assets(spark: SparkSession, path: str) -> DataFrame:
    """``asset_id, name, content_type, src``; a type among the properties is the one that counts."""
    properties = F.col("dataAddress.properties")
    inner = F.try_element_at(properties, F.lit("type"))
    return _read(spark, path, S.ASSET_DOCUMENT).select(
        F.col("asset.`@id`").alias("asset_id"),
        F.col("asset.properties.name").alias("name"),
        F.col("asset.properties.contenttype").alias("content_type"),
        F.struct(
            F.coalesce(inner, F.col("dataAddress.type")).alias("type"),
            F.try_element_at(properties, F.lit("keyName")).alias("keyName"),
            _without_secrets(properties).alias("properties"),
        ).alias("src"),
        BROKEN,
    )


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.POLICY_DOCUMENT).select(
        F.col("`@id`").alias("policy_id"),
        F.col("policy.`@type`").alias("policy_type"),
        F.col("policy.`odrl:permission`").alias("permission"),
        F.col("policy.`odrl:prohibition`").alias("prohibition"),
        F.col("policy.`odrl:obligation`").alias("obligation"),
        BROKEN,
    )


def read_contract_definitions(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.CONTRACT_DEFINITION_DOCUMENT).select(
        F.col("id").alias("definition_id"),
        F.col("accessPolicyId").alias("access_policy_id"),
        F.col("contractPolicyId").alias("contract_policy_id"),
        F.col("assetsSelector").alias("assets_selector"),
        BROKEN,
    )


def read_negotiations(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, S.NEGOTIATION_DOCUMENT).select(
        F.col("connectorId").alias("connector_id"),
        F.col("connectorAddress").alias("connector_address"),
        F.col("consumerId").alias("consumer_id"),
        F.col("providerId").alias("provider_id"),
        "protocol",
        F.col("offer.offerId").alias("offer_id"),
        F.col("offer.assetId").alias("asset_id"),
        BROKEN,
    )


def _with_ids(documents: DataFrame, prefix: str) -> DataFrame:
    """``request_id``: the id of a document or, without one, a hash of the document and its number
    among equal documents."""
    named = documents.where("`@id` IS NOT NULL").withColumn("request_id", F.col("`@id`"))
    whole = F.struct(*[F.col(f"`{name}`") for name in documents.columns])
    unnamed = documents.where("`@id` IS NULL").select(
        whole.alias("document"), F.sha2(F.to_json(whole), 256).alias("digest")
    )
    # Equal documents are counted and not gathered, however many there are.
    numbered = (
        unnamed.groupBy("digest")
        .agg(F.first("document").alias("document"), F.count(F.lit(1)).alias("copies"))
        .withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "document.*",
            F.concat(F.lit(prefix), "digest", F.lit("-"), F.col("number").cast("string")).alias("request_id"),
        )
    )
    return named.unionByName(numbered)


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """``request_id, contract_id, asset_id, dst, managed_resources``.

    Documents need not have an id; one is then made from their content.
    """
    target = F.col("dataDestination")
    return _with_ids(_read(spark, path, S.TRANSFER_DOCUMENT), "transfer-").select(
        "request_id",
        F.col("connectorId").alias("connector_id"),
        F.col("connectorAddress").alias("connector_address"),
        "protocol",
        F.col("contractId").alias("contract_id"),
        F.col("assetId").alias("asset_id"),
        F.struct(
            target["type"].alias("type"),
            target["keyName"].alias("keyName"),
            F.create_map(
                F.lit(S.BUCKET_NAME), target["bucketName"], F.lit(S.STORAGE), target["storage"]
            ).alias("properties"),
        ).alias("dst"),
        F.col("managedResources").alias("managed_resources"),
        BROKEN,
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Semicolon-separated asset with a header; the declared content type plays no part."""
    return (
        spark.read.option("sep", ";").option("header", True).option("enforceSchema", False)
        .schema(schema).csv(path)
    )


def write_delimited(table: DataFrame, path: str) -> None:
    table.write.option("sep", ";").option("header", True).csv(path)
