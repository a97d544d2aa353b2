"""Every registered query against its SQL, and the plans of the large ones."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from quayside.operators import logs, lookups
from quayside.plans import driver_queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def matches_sql(spark, database, name):
    df = driver_queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    result = database.execute(driver_queries.ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = sorted((tuple(row[at] for at in places) for row in result.fetchall()), key=repr)
    assert expected
    assert found == expected


@pytest.mark.parametrize("name", list(driver_queries.QUERIES))
def test_query_matches_sql(spark, database, name):
    matches_sql(spark, database, name)


JOINS = "q_log_enrich q_request_resolve q_offers q_endpoint q_preflight q_completion q_part_status q_object_copy"


@pytest.mark.parametrize("name", JOINS.split())
def test_joins_without_broadcast_and_with_many_hot_keys(spark, database, name, monkeypatch):
    """The same rows when no lookup counts as small and very many keys as hot."""
    measured = lookups.hot_keys
    found = []

    def hot_keys(rows, keys):
        found.append(measured(rows, keys, pieces=4096))
        return found[-1]

    monkeypatch.setattr(lookups, "hot_keys", hot_keys)
    monkeypatch.setattr(lookups.lookup_join, "__defaults__", ("left", True, None))
    monkeypatch.setattr(logs.label_by, "__defaults__", (True, None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matches_sql(spark, database, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any(found)


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


# Their result is read from a written table.
WRITTEN = ("q_object", "q_transfer", "q_log_stream", "q_log_pipeline", "q_agent_stream", "q_rotation")


@pytest.mark.parametrize("name", [n for n in driver_queries.QUERIES if not n.startswith(WRITTEN)])
def test_plans_hold_no_cross_join_and_no_window(spark, name):
    plan = driver_queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF", "MapInPandas"):
        assert word not in plan


def test_scans_read_only_needed_columns(spark):
    plan = driver_queries.QUERIES["q_preflight"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<c_name:string>" in plan


def test_entry_registers_all_of_them():
    assert set(driver_queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
