from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.outcomes import part_status, request_outcome

PARTS = "request_id STRING, ordinal INT, ok BOOLEAN, error STRING"


def expected(parts):
    """Plain loop: parts in order, stopping at the first failure."""
    statuses, outcomes = {}, {}
    for request, ordinal, ok, error in sorted(parts, key=lambda part: part[:2]):
        outcomes.setdefault(request, ("success", None))
        if outcomes[request][0] == "error":
            statuses[request, ordinal] = "not_attempted"
        elif ok:
            statuses[request, ordinal] = "ok"
        else:
            statuses[request, ordinal] = "failed"
            outcomes[request] = ("error", error)
    return statuses, outcomes


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("abc"), st.integers(0, 9)), st.sampled_from([True, True, False, None]),
        min_size=1,
    )
)
def test_against_plain_loop(spark, flags):
    parts = [(request, n, ok, None if ok else f"x{n}") for (request, n), ok in flags.items()]
    table = spark.createDataFrame(parts, PARTS)
    statuses, outcomes = expected(parts)
    for order in (("ordinal",), ("ordinal", "request_id")):
        found = part_status(table, order).collect()
        assert {(row["request_id"], row["ordinal"]): row["status"] for row in found} == statuses
        found = request_outcome(table, order).collect()
        assert {row["request_id"]: (row["status"], row["error"]) for row in found} == outcomes


def test_nulls_in_ids_and_positions(spark, rows):
    parts = [
        (None, 1, True, None), (None, 2, False, "x"), (None, 3, True, None),
        ("a", None, False, "y"), ("a", 1, True, None), ("b", None, True, None), ("b", 2, False, "z"),
    ]
    table = spark.createDataFrame(parts, PARTS)
    want = {
        (None, 1): "ok", (None, 2): "failed", (None, 3): "not_attempted", ("a", None): "failed",
        ("a", 1): "not_attempted", ("b", None): "ok", ("b", 2): "failed",
    }
    for order in (("ordinal",), ("ordinal", "request_id")):
        found = part_status(table, order)
        assert found.columns == [*table.columns, "status"]
        assert {(r["request_id"], r["ordinal"]): r["status"] for r in found.collect()} == want
    outcomes = {r["request_id"]: r["error"] for r in request_outcome(table).collect()}
    assert outcomes == {None: "x", "a": "y", "b": "z"}


def test_one_request_may_hold_a_third_of_all_parts(spark):
    n = F.col("id")
    table = spark.range(0, 60_000, 1, 8).select(
        F.when(n % 3 == 0, "hot").otherwise((n % 7000).cast("string")).alias("request_id"),
        n.alias("ordinal"),
        (n != 30_000).alias("ok"),
        F.when(n == 30_000, "late").alias("error"),
    )
    status = part_status(table)
    counts = {row["status"]: row["count"] for row in status.groupBy("status").count().collect()}
    assert counts == {"ok": 60_000 - 10_000, "failed": 1, "not_attempted": 9_999}
    plan = status._jdf.queryExecution().toString()
    assert "Window" not in plan
    hot = request_outcome(table).where("request_id = 'hot'").first()
    assert (hot["status"], hot["error"]) == ("error", "late")


@pytest.mark.parametrize("order", [("ordinal",)])
def test_numeric_order_uses_hash_aggregation(spark, order):
    table = spark.createDataFrame([("a", 1, True, None)], PARTS)
    plan = part_status(table, order)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan
