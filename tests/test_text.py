import sys

import pytest
from pyspark.sql import functions as F

from presswork.functions import is_blank, normalize_text, scoring_text


def one(spark, expression, **columns):
    fields = ", ".join(f"{name} string" for name in columns)
    frame = spark.createDataFrame([tuple(columns.values())], fields)
    return frame.select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("\n a  b\t", " a b "),
        ("  a\t\n\x0b\f\rb  ", "a b"),
        ("a b", "a b"),
        ("a  b", "a  b"),
        ("", ""),
        ("   ", ""),
        ("\t", " "),
        (None, None),
    ],
)
def test_normalize_trims_spaces_before_it_collapses(spark, text, expected):
    assert one(spark, normalize_text("text"), text=text) == expected


def test_scoring_text_trims_after_it_collapses(spark):
    got = one(spark, scoring_text(), summary=None, title=None, text_prepped=" a b ")
    assert got == "a b"


@pytest.mark.parametrize(
    ("summary", "title", "body", "expected"),
    [
        ("s", "t", "b", "s"),
        (None, "t", "b", "t"),
        (None, None, "b", "b"),
        ("", "t", "b", ""),
        ("  \n", "t", "b", ""),
        (None, None, None, None),
    ],
)
def test_scoring_text_takes_the_first_that_is_not_null(spark, summary, title, body, expected):
    assert one(spark, scoring_text(), summary=summary, title=title, text_prepped=body) == expected


def test_scoring_text_is_cut_after_trimming(spark):
    long = "x" * 1999 + " " + "y" * 1000
    got = one(spark, scoring_text(max_chars=2000), summary=long, title=None, text_prepped=None)
    assert got == "x" * 1999 + " "
    whole = one(spark, scoring_text(), summary=long, title=None, text_prepped=None)
    assert whole == long
    short = one(spark, scoring_text(max_chars=5), summary="😀" * 9, title=None, text_prepped=None)
    assert short == "😀" * 5


@pytest.mark.parametrize(
    "text", ["\n a  b\t", "  \t x \n\n y  ", " ", "", "\r\na", "a\x0b\x0bb", "  a "]
)
def test_raw_body_gives_the_same_scoring_text_as_the_normalised_one(spark, text):
    frame = spark.createDataFrame([(text,)], "text string").select(
        "text", F.lit(None).cast("string").alias("summary")
    )
    frame = frame.withColumn("title", F.col("summary"))
    frame = frame.withColumn("text_prepped", normalize_text("text"))
    row = frame.select(scoring_text().alias("a"), scoring_text(body="text").alias("b")).first()
    assert row.a == row.b


def test_blank_agrees_with_python_on_every_character(spark):
    points = [n for n in range(sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF]
    rows = [(n, chr(n)) for n in points if n < 0x3100 or n in (0xFEFF, 0xFFFD, 0x1F600)]
    frame = spark.createDataFrame(rows, "n int, text string")
    blank = {r.n for r in frame.filter(is_blank("text")).collect()}
    assert blank == {n for n, text in rows if not text.strip()}


def test_blank_of_null_empty_and_mixed(spark):
    frame = spark.createDataFrame([(None,), ("",), ("  \x1c",), (" a ",)], "text string")
    assert [r.x for r in frame.select(is_blank("text").alias("x")).collect()] == [
        True,
        True,
        True,
        False,
    ]
