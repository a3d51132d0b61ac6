import json
from datetime import datetime, timezone

import pytest
from helpers import ARTICLE, article, wire
from pyspark.sql import functions as F

from presswork.functions import parse_articles, parse_fields, to_wire
from presswork.schemas import ARTICLE_FIELDS, ARTICLE_SCHEMA, KAFKA_FIELDS


def parsed(spark, record):
    frame = parse_articles(wire(spark, record))
    return frame.withColumn("published_at", F.unix_seconds("published_at")).first()


def seconds(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


def test_columns_and_types(spark):
    frame = parse_articles(wire(spark, ARTICLE))
    assert frame.columns == [*ARTICLE_FIELDS, "text_prepped"]
    assert [f.dataType for f in frame.schema][:10] == [f.dataType for f in ARTICLE_SCHEMA]


def test_full_record_from_bytes(spark):
    frame = wire(spark, ARTICLE).select(F.col("value").cast("binary"))
    row = parse_articles(frame).first()
    assert (row.title, row.author, row.text_prepped) == ("Title", "Author", ARTICLE["text"])


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-01-20T10:00:00", seconds(2026, 1, 20, 10)),
        ("2026-01-20T10:00:00Z", seconds(2026, 1, 20, 10)),
        ("2026-01-20T10:00:00+02:00", seconds(2026, 1, 20, 8)),
        ("2026-01-20 10:00:00", seconds(2026, 1, 20, 10)),
        ("2026-01-20", seconds(2026, 1, 20)),
        ("garbage", None),
    ],
)
def test_timestamps_are_utc_unless_they_say_otherwise(spark, text, expected):
    row = parsed(spark, article(published_at=text))
    assert row.published_at == expected
    assert row.title == "Title"


@pytest.mark.parametrize(
    ("record", "field", "expected"),
    [
        (article(title=5), "title", "5"),
        (article(url_hash={"a": 1}), "url_hash", '{"a":1}'),
        ({**ARTICLE, "extra": 1}, "title", "Title"),
        ({"URL": "x"}, "url", None),
        ({"title": None}, "title", None),
    ],
)
def test_irregular_fields(spark, record, field, expected):
    assert parsed(spark, record)[field] == expected


TRUNCATED = '{"url_hash":"h","title":"cut'
UNUSABLE = ["not json", "", None, '[{"title":"a"},{"title":"b"}]', TRUNCATED]


@pytest.mark.parametrize("record", UNUSABLE)
def test_unusable_records_become_one_row_of_nulls(spark, record):
    rows = parse_articles(wire(spark, record)).collect()
    assert [list(row) for row in rows] == [[None] * 11]


def test_the_generator_gives_what_flattening_the_struct_gives(spark):
    irregular = [article(title=5), article(published_at="garbage"), article(author=[1, 2])]
    records = wire(spark, *irregular, *UNUSABLE, '{"url_hash":"h"} and more').repartition(1)
    struct = F.from_json("value", ARTICLE_SCHEMA, {"timeZone": "UTC"})
    plain = records.select(struct.alias("s")).select("s.*")
    assert sorted(map(repr, parse_fields(records).collect())) == sorted(map(repr, plain.collect()))


def test_each_record_is_parsed_once_even_under_filters(spark):
    frame = parse_fields(wire(spark, ARTICLE).repartition(2)).filter(
        F.col("url_hash").isNotNull() & F.coalesce("summary", "title").isNotNull()
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_to_wire_orders_fields_and_leaves_nulls_out(spark):
    frame = parse_articles(wire(spark, article(title="Ü", summary=None)))
    for name in KAFKA_FIELDS[10:]:
        frame = frame.withColumn(name, F.lit(None).cast("string"))
    frame = frame.withColumn("category_score", F.lit(0.5))
    value = frame.select(to_wire().alias("value")).first().value
    record = json.loads(value)
    assert list(record) == [n for n in ARTICLE_FIELDS if n != "summary"] + ["category_score"]
    assert '"title":"Ü"' in value
    assert record["published_at"] == "2029-11-03T06:15:42.000Z"
