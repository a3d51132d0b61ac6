"""The registered queries against their SQL, on the given tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from presswork.plans import queries
from presswork.plans.oracles import ORACLES
from presswork.plans.queries import QUERIES

TABLES = Path(os.environ.get("PRESSWORK_TABLES", "/root/testdata/sf0.001"))

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    got = registered.queries()[name](spark, str(TABLES))
    expected = database.sql(registered.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = expected.project(", ".join(f'"{column}"' for column in got.columns)).fetchall()
    assert rows and Counter(map(tuple, got.collect())) == Counter(rows)


@pytest.mark.parametrize("name", ["stream_bounded", "stream_enrich"])
def test_files_of_a_bounded_batch_grow_with_the_documents(spark, monkeypatch, tmp_path, name):
    rows = [(i, f"text {i} " * 9, f"source{i % 3}") for i in range(400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("part-*"))
    monkeypatch.setattr(queries, "_FILE_BYTES", size // 22, raising=False)
    bounds, read = [], queries.read_wire_files

    def noted(reader, path, bound):
        found = len([f for f in os.listdir(path) if f.startswith("part-")])
        bounds.append((bound, found))
        return read(reader, path, bound)

    monkeypatch.setattr(queries, "read_wire_files", noted)
    got = QUERIES[name](spark, str(tmp_path))
    assert bounds == [(5, 20)]
    if name == "stream_bounded":
        assert {r.batch_id for r in got.select("batch_id").distinct().collect()} == {0, 1, 2, 3}


def test_entry(spark):
    assert registered.entry(spark).count() > 0
