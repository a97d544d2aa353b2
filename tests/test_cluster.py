"""Queries that keep scratch data, on executors that are processes of their own."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pyspark
import pytest

from quayside.plans import driver_queries

NAMES = (
    "q_asset_scan q_delimited_asset q_log_pipeline q_log_stream q_log_word_search q_metadata_scan q_object_copy "
    "q_object_fetch q_object_inventory q_rotated_files q_object_roundtrip q_transfer"
).split()

TABLES = {
    "supplier": """SELECT i AS s_suppkey, 'Supplier ' || i AS s_name, CAST(i % 5 AS INTEGER) AS s_nationkey,
                          i * 1.5::DOUBLE AS s_acctbal FROM range(20) t(i)""",
    "customer": """SELECT i AS c_custkey, 'Customer#' || lpad(CAST(i AS VARCHAR), 9, '0') AS c_name,
                          CAST(i % 5 AS INTEGER) AS c_nationkey, CAST(i % 7 - 3 AS DOUBLE) AS c_acctbal,
                          'SEGMENT' || i % 3 AS c_mktsegment FROM range(120) t(i)""",
    "part": """SELECT i AS p_partkey, 'part ' || i AS p_name, 'Brand#' || i % 4 AS p_brand, 'T' AS p_type,
                      CAST(i AS INTEGER) AS p_size, 1.5::DOUBLE AS p_retailprice FROM range(30) t(i)""",
    "pages": """SELECT i AS page_id, 'http://h/' || i AS url, repeat('page ñ ' || i || ' ', 1 + CAST(i * 13 AS INTEGER)) AS html
                FROM range(40) t(i)""",
    "events": """SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(i * 1500000123) AS ts,
                        i % 15 AS user_id, ['click', 'purchase', 'error', 'signup', 'view'][i * 7 // 3 % 5 + 1] AS event_type,
                        i / 4 AS value, '{"k": ' || i % 90 || '}' AS props FROM range(1200) t(i)""",
}


@pytest.fixture(scope="module")
def results(tmp_path_factory):
    """A connection with the tables, and the folder of what a local cluster made of them."""
    root = tmp_path_factory.mktemp("cluster")
    database = duckdb.connect()
    os.makedirs(root / "tables")
    for table, rows in TABLES.items():
        path = root / "tables" / f"{table}.parquet"
        database.execute(f"COPY ({rows}) TO '{path}'")
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    # Executors work below the home of Spark, which may be read-only.
    os.makedirs(root / "home" / "work")
    package = os.path.dirname(pyspark.__file__)
    for name in os.listdir(package):
        if name != "work":
            os.symlink(os.path.join(package, name), root / "home" / name)
    script = os.path.join(os.path.dirname(__file__), "cluster_script.py")
    environment = {
        "SPARK_HOME": str(root / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1",
        "SPARK_LOCAL_DIRS": str(root / "local"), "PYSPARK_PYTHON": sys.executable,
    }
    done = subprocess.run(
        [sys.executable, script, str(root), *NAMES],
        capture_output=True, text=True, timeout=600, cwd=root, env=os.environ | environment,
    )
    assert "done" in done.stdout, done.stderr[-3000:]
    return database, root / "out"


@pytest.mark.parametrize("name", NAMES)
def test_scratch_data_of_a_local_cluster(results, name):
    """A scratch folder without a scheme is the disk that driver and executors share."""
    database, out = results
    wanted = database.sql(driver_queries.ORACLES[name])
    columns = ", ".join(f'"{column}"' for column in wanted.columns)
    expected = database.sql(f"SELECT {columns} FROM wanted").fetchall()
    found = database.sql(f"SELECT {columns} FROM '{out / name}/*.parquet'").fetchall()
    assert expected
    assert sorted(found, key=repr) == sorted(expected, key=repr)
