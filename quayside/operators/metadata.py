"""Joins over asset, policy, contract and agreement tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.text import json_text
from quayside.operators.lookups import lookup_join


def catalogue_offer_id(replies: DataFrame, document: str = "document") -> DataFrame:
    """Offer id of catalogue replies."""
    offer = json_text(F.col(document), "dcat:dataset", "odrl:hasPolicy", "@id")
    return replies.withColumn("offer_id", offer)


def negotiation_id(replies: DataFrame, document: str = "document") -> DataFrame:
    return replies.withColumn("negotiation_id", json_text(F.col(document), "@id"))


def agreement_id(replies: DataFrame, vocabulary: str, document: str = "document") -> DataFrame:
    """Agreement id of negotiation replies, whose key has the prefix of the vocabulary."""
    key = f"{vocabulary}:contractAgreementId"
    return replies.withColumn("agreement_id", json_text(F.col(document), key))


def reached_agreements(
    negotiations: DataFrame, replies: DataFrame, vocabulary: str
) -> DataFrame:
    """Agreements ``contract_id, agreed_asset`` for ``resolve_requests``.

    ``negotiations(negotiation_id, asset_id)`` with unique ids, and ``replies(document)``, of
    which there may be many per negotiation; those without an agreement do not count. A reply to
    an unknown negotiation is an agreement for no asset, which no request can use.
    """
    ids = F.json_tuple("document", "@id", f"{vocabulary}:contractAgreementId")
    reached = (
        replies.select(ids.alias("negotiation_id", "contract_id"))
        .where(F.col("contract_id").isNotNull())
        .distinct()
    )
    assets = negotiations.select("negotiation_id", F.col("asset_id").alias("agreed_asset"))
    # Replies are brought down to one row per agreement first, so no key can be hot here.
    return reached.join(assets, "negotiation_id", "left").select("contract_id", "agreed_asset")


def resolve_requests(requests: DataFrame, agreements: DataFrame, assets: DataFrame) -> DataFrame:
    """Find the source address of every transfer request.

    ``requests(request_id, contract_id, asset_id, dst)``, ``agreements(contract_id,
    agreed_asset)`` and ``assets(asset_id, src)``. Equal rows of these count once; rows that
    contradict each other resolve nothing. Requests that do not resolve stay in the result, with the
    reason in ``resolution``.
    """
    agreed = agreements.groupBy("contract_id").agg(
        F.min("agreed_asset").alias("agreed_asset"),
        F.max("agreed_asset").alias("other_asset"),
        F.count("agreed_asset").alias("named"),
        F.count(F.lit(1)).alias("agreements"),
    )
    # Maps can't be compared, and have no order; as text with sorted entries they can.
    described = F.to_json(
        F.struct(
            *[
                (
                    F.array_sort(F.map_entries(F.col("src")[field.name]))
                    if isinstance(field.dataType, T.MapType)
                    else F.col("src")[field.name]
                ).alias(field.name)
                for field in assets.schema["src"].dataType
            ]
        )
    )
    offered = (
        assets.select("asset_id", "src", described.alias("described"))
        .groupBy("asset_id")
        .agg(
            F.min_by("src", F.coalesce("described", F.lit(""))).alias("src"),
            F.min("described").alias("described"),
            F.max("described").alias("other"),
        )
        .withColumn("has_asset", F.lit(True))
    )
    found = lookup_join(lookup_join(requests, agreed, "contract_id"), offered, "asset_id")
    contradicted = (F.col("agreed_asset") != F.col("other_asset")) | (
        (F.col("named") > 0) & (F.col("named") < F.col("agreements"))
    )
    resolution = (
        F.when(F.col("agreements").isNull(), "no such agreement")
        .when(contradicted, "agreements contradict each other")
        .when(~F.col("agreed_asset").eqNullSafe(F.col("asset_id")), "agreement is for another asset")
        .when(F.col("has_asset").isNull(), "no such asset")
        .when(F.col("described") != F.col("other"), "descriptions of the asset contradict each other")
        .otherwise("resolved")
    )
    return found.withColumn("resolution", resolution).drop(
        "other_asset", "named", "agreements", "described", "other", "has_asset"
    )


def definitions_with_policies(definitions: DataFrame, policies: DataFrame) -> DataFrame:
    """Contract definitions with their access and contract policy looked up."""
    access = policies.select(
        F.col("policy_id").alias("access_policy_id"), F.lit(True).alias("has_access_policy")
    )
    contract = policies.select(
        F.col("policy_id").alias("contract_policy_id"), F.lit(True).alias("has_contract_policy")
    )
    return lookup_join(
        lookup_join(definitions, access, "access_policy_id"), contract, "contract_policy_id"
    )


def resolve_offers(
    offers: DataFrame, definitions: DataFrame, policies: DataFrame, assets: DataFrame
) -> DataFrame:
    """Check requested offers ``(definition_id, asset_id)`` against what is on offer.

    A definition with an empty ``assets_selector`` offers every asset. That set is never
    written out: a requested pair is on offer when its definition, both policies and its
    asset exist, which takes three equi joins. Selectors with content are refused, as their
    meaning is not defined.
    """
    terms = definitions_with_policies(definitions, policies).select(
        "definition_id",
        "access_policy_id",
        "contract_policy_id",
        "has_access_policy",
        "has_contract_policy",
        (F.coalesce(F.size("assets_selector"), F.lit(0)) <= 0).alias("offers_all"),
        F.lit(True).alias("has_definition"),
    )
    listed = assets.select("asset_id", F.lit(True).alias("has_asset"))
    found = lookup_join(lookup_join(offers, terms, "definition_id"), listed, "asset_id")
    status = (
        F.when(F.col("has_definition").isNull(), "no such definition")
        .when(~F.col("offers_all"), "asset selectors are not supported")
        .when(F.col("has_access_policy").isNull(), "no such access policy")
        .when(F.col("has_contract_policy").isNull(), "no such contract policy")
        .when(F.col("has_asset").isNull(), "no such asset")
        .otherwise("offered")
    )
    return found.withColumn("status", status).drop(
        "has_definition", "offers_all", "has_access_policy", "has_contract_policy", "has_asset"
    )
