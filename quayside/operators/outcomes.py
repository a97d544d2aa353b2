"""Outcome of parts and of whole requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.lookups import lookup_join


_REQUEST = "__request"


def _failed() -> Column:
    return ~F.coalesce(F.col("ok"), F.lit(False))


def _position(order: Sequence[str]) -> Column:
    """Place of a part in its request; a single number keeps the aggregation hash-based."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(name) for name in order])


def part_status(parts: DataFrame, order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """Status of each part when a request stops at its first failure.

    ``parts(request_id, ok, error, <order>)``; ``order`` must be unique within a request. A
    part before the first failure is ``ok``, the failure itself is ``failed``, and later parts
    are ``not_attempted``. Parts without a request id are those of one request, and a part
    without a position comes before all others. Instead of a window, which would sort a whole
    request in one task, the first failures are aggregated (partly before the shuffle) and joined
    back.
    """
    position = _position(order)
    nowhere = position.isNull()
    first = (
        parts.where(_failed())
        .groupBy("request_id")
        .agg(F.min(position).alias("first_failure"), F.max(nowhere).alias("failed_nowhere"))
        # A struct with a null inside is no null, so that rows without an id find each other.
        .select(F.struct("request_id").alias(_REQUEST), "first_failure", "failed_nowhere")
    )
    marked = lookup_join(parts.withColumn(_REQUEST, F.struct("request_id")), first, _REQUEST)
    at_start = F.coalesce("failed_nowhere", F.lit(False))
    failed = _failed() & (nowhere | ~at_start) & (nowhere | position.eqNullSafe(F.col("first_failure")))
    before = nowhere | (
        ~at_start & (F.col("first_failure").isNull() | (position < F.col("first_failure")))
    )
    status = F.when(failed, "failed").when(before, "ok").otherwise("not_attempted")
    return marked.withColumn("status", status).drop("first_failure", "failed_nowhere", _REQUEST)


def request_outcome(parts: DataFrame, order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """One row per request: success, or the first failure in part order.

    Each task first brings its parts of a request down to one row, so a request with very many
    parts costs the shuffle no more than one row per task.
    """
    failure = F.when(_failed(), F.struct(_position(order).alias("position"), "error"))
    return (
        parts.groupBy("request_id")
        .agg(F.min(failure).alias("first_failure"))
        .select(
            "request_id",
            F.when(F.col("first_failure").isNull(), "success").otherwise("error").alias("status"),
            F.col("first_failure.error").alias("error"),
        )
    )
