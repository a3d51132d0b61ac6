"""The lookup table against its plain form, the query against its SQL, and awkward rows."""

import hashlib
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from presswork.llm import sharding

TABLES = Path(os.environ.get("PRESSWORK_TABLES", "/root/testdata/sf0.001"))


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_table(shards, slots):
    walks = []
    for name in shards:
        offset, skip = number(f"offset:{name}") % slots, number(f"skip:{name}") % (slots - 1) + 1
        walks.append(iter([(offset + j * skip) % slots for j in range(slots)]))
    table = {}
    while len(table) < slots:
        for name, walk in zip(shards, walks, strict=True):
            if len(table) < slots:
                table[next(s for s in walk if s not in table)] = name
    return table


def filled(spark, shards, slots):
    return dict(map(tuple, sharding.lookup_table(spark, shards, slots).collect()))


@pytest.mark.parametrize(
    "shards, slots", [(["a"], 2), (["a", "b", "c"], 3), (["b", "a", "ü"], 101), (list("abcdefgh"), 211)]
)
def test_table(spark, shards, slots):
    assert filled(spark, shards, slots) == plain_table(shards, slots)


def test_the_default_table_is_even(spark):
    table = filled(spark, sharding.SHARDS, sharding.SLOTS)
    assert table == plain_table(sharding.SHARDS, sharding.SLOTS)
    sizes = Counter(table.values())
    assert len(sizes) == len(sharding.SHARDS) and max(sizes.values()) - min(sizes.values()) <= 1


def test_a_shard_that_goes_moves_few_others(spark):
    shards = list("abcdefgh")
    before, after = filled(spark, shards, 1009), filled(spark, shards[:-1], 1009)
    stayed = [slot for slot, shard in before.items() if shard != "h"]
    assert sum(before[slot] == after[slot] for slot in stayed) > 0.8 * len(stayed)


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a"], 9), (list("abcd"), 3)])
def test_what_is_no_table(spark, shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, shards, slots)


def test_rows(spark):
    rows = [(1, "x", 9), (1, "y", 9), (None, "z", 9), (None, None, 9), (2, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    table = sharding.lookup_table(spark, list("abc"), 101)
    expected = plain_table("abc", 101)
    got = sharding.deal(docs, table, 101).collect()
    place = lambda d: number(f"doc:{'' if d is None else d}") % 101
    assert Counter(map(tuple, got)) == Counter((d, t, place(d), expected[place(d)]) for d, t, _ in rows)
    assert sharding.deal(docs.limit(0), table, 101).collect() == []


@pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")
def test_query_equals_its_sql(spark):
    query = entry.queries()["op7_shard_documents"](spark, str(TABLES))
    database = duckdb.connect()
    database.execute(f"create view documents as select * from '{TABLES}/documents.parquet'")
    expected = database.sql(entry.oracle_sql()["op7_shard_documents"])
    assert query.columns == expected.columns
    rows = expected.fetchall()
    assert rows and Counter(map(tuple, query.collect())) == Counter(rows)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan
