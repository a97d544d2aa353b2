"""Queries that keep scratch data, on a cluster whose machines may or may not share the scratch folder."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pyspark
import pytest

import __spark_entry__ as entry
import test_cluster

NAMES = [
    *test_cluster.NAMES, "q_agent_stream", "q_rotation", "pipeline", "op1_decontaminate", "op2_perspective_rotation",
    "op5_substring_dedup", "op6_jaccard_join", "op7_sampled_splitters", "op9_hash_prefix_forest",
    "op11_source_divergence", "op12_collocations", "op13_simhash",
]

TABLES = test_cluster.TABLES | {
    # Every third document repeats most of another one, every second holds a passage of an item.
    "documents": """SELECT i AS doc_id, ['en', 'de'][i % 2 + 1] AS lang, ['web', 'book'][i // 2 % 2 + 1] AS source,
                           CAST(length(text) AS BIGINT) AS n_chars, text
                    FROM (SELECT i, list_aggregate(list_transform(range(70), lambda j:
                              ['the', 'der'][i % 2 + 1] || ' word' || ((i // 3 + 7) * (j + 3)) % 97), 'string_agg', ' ')
                          || CASE WHEN i % 3 = 0 THEN ' end' ELSE '' END
                          || CASE WHEN i % 2 = 0 THEN '. ten words of an item stand here in a row now' ELSE '' END AS text
                          FROM range(60) t(i))""",
    "benchmark": """SELECT i AS item_id, CASE i WHEN 1 THEN 'ten words of an item stand here in a row now'
                           ELSE 'nothing ' || i END AS text FROM range(3) t(i)""",
    "conversations": """SELECT i // 4 AS conv_id, CAST(i % 4 AS INTEGER) AS turn,
                               ['user', 'assistant'][i % 2 + 1] AS role, 'said ' || i AS text FROM range(48) t(i)""",
    "embeddings": """SELECT i AS vec_id, list_transform(range(16), lambda j:
                            CAST(sin(i * 7 + j * (i % 11 + 1)) AS FLOAT)) AS embedding FROM range(120) t(i)""",
}

# Learning and the dealing of equal rows leave a choice; what is compared has none.
FIXED = {
    "op7_sampled_splitters": ["doc_id", "size", "text_crc32"],
    "pipeline": ["doc_id", "text"],
}


@pytest.fixture(scope="module")
def results(tmp_path_factory):
    """A connection with the tables, their folder, and what the cluster made and said."""
    root = tmp_path_factory.mktemp("standalone")
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
    script = os.path.join(os.path.dirname(__file__), "standalone_script.py")
    environment = {
        "SPARK_HOME": str(root / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1",
        "SPARK_LOCAL_DIRS": str(root / "local"), "PYSPARK_PYTHON": sys.executable,
    }
    done = subprocess.run(
        [sys.executable, script, str(root), *NAMES],
        capture_output=True, text=True, timeout=900, cwd=root, env=os.environ | environment,
    )
    assert "done" in done.stdout, done.stderr[-3000:]
    return database, root, done.stdout


def test_disks_of_executors_are_refused(results):
    """In a folder that each process has for itself the rows that executors write don't come back."""
    assert "refused spark.checkpoint.dir has no scheme" in results[2]
    assert "accepted" not in results[2]


def test_a_folder_is_tried_once_for_all_calls(results):
    """And again at most for each executor that came later."""
    tried = int(results[2].partition("tried ")[2].split()[0])
    assert 1 <= tried <= 3


@pytest.mark.parametrize("name", NAMES)
def test_scratch_data_on_a_shared_folder(results, spark, name):
    """A folder without a scheme serves a cluster if all executors share it."""
    database, root, said = results
    assert f"{name} spark.checkpoint.dir" not in said
    if name in entry.oracle_sql():
        wanted = database.sql(entry.oracle_sql()[name])
        columns = wanted.columns
        expected = wanted.fetchall()
    else:
        here = entry.queries()[name](spark, str(root / "tables"))
        columns = FIXED.get(name, here.columns)
        expected = list(map(tuple, here.select(*columns).collect()))
    assert expected
    found = spark.read.parquet(str(root / "out" / name)).select(*(f"`{column}`" for column in columns))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected), key=repr)
