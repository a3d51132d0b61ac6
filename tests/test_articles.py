from collections import Counter

from helpers import article, wire
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presswork.functions import parse_articles
from presswork.operators import (
    dedup_articles,
    keep_scorable,
    prepare_articles,
    select_base,
)
from presswork.schemas import BASE_FIELDS


def parsed(spark, *records):
    return parse_articles(wire(spark, *records))


def test_base_projection(spark):
    base = select_base(parsed(spark, article(text=" a\n b ")), max_chars=3)
    assert base.columns == BASE_FIELDS
    row = base.first()
    assert (row.text_prepped, row.text_for_inference) == ("a b", "Tit")


def test_filter_wants_key_and_text_but_no_fingerprint(spark):
    base = select_base(
        parsed(
            spark,
            article(url_hash="a", fingerprint=None),
            article(url_hash=None),
            article(url_hash="c", title=None, summary=None, text=None),
            article(url_hash="d", summary=""),
            "not json",
        )
    )
    assert sorted(r.url_hash for r in keep_scorable(base).collect()) == ["a", "d"]


def test_dedup_treats_nulls_as_equal(spark):
    keys = [("a", None), ("a", None), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")]
    base = prepare_articles(
        parsed(spark, *[article(url_hash=u, fingerprint=f) for u, f in keys])
    )
    got = Counter((r.url_hash, r.fingerprint) for r in base.collect())
    assert got == Counter(set(keys))


def test_survivor_is_a_whole_row_and_the_first_by_order(spark):
    copies = [
        article(title="late", author="L", published_at="2026-01-03T00:00:00"),
        article(title="early", author="E", published_at="2026-01-01T00:00:00"),
        article(title="undated", author="U", published_at=None),
    ]
    frame = parsed(spark, *copies)
    first = dedup_articles(frame, ["published_at"]).collect()
    assert [(r.title, r.author) for r in first] == [("undated", "U")]
    last = dedup_articles(frame, [F.col("published_at").desc()]).collect()
    assert [(r.title, r.author) for r in last] == [("late", "L")]
    whichever = dedup_articles(frame).first()
    assert (whichever.title, whichever.author) in {("late", "L"), ("early", "E"), ("undated", "U")}


def test_a_key_with_a_third_of_the_rows_is_thinned_out_before_the_shuffle(spark):
    rows = 30_000
    frame = spark.range(0, rows, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url_hash"),
        F.lit("f").alias("fingerprint"),
        F.lit("text").alias("text"),
        F.col("id").alias("published_at"),
    )
    for order in (None, ["published_at"]):
        frame_out = dedup_articles(frame, order)
        assert frame_out.count() == rows * 2 // 3 + 1
        plan = frame_out._jdf.queryExecution().executedPlan().toString()
        before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
        assert "partial_first" in before_shuffle or "Partial" in before_shuffle


def test_unused_columns_do_not_reach_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "articles")
    parsed(spark, article()).write.parquet(path)
    for order in (None, ["published_at"]):
        kept = prepare_articles(spark.read.parquet(path), order_by=order)
        plan = kept.select("url_hash", "title")._jdf.queryExecution().executedPlan().toString()
        schema = plan[plan.index("ReadSchema") :]
        assert "author" not in schema and "scraped_at" not in schema
        assert "IsNotNull(url_hash)" in plan


words = st.one_of(st.none(), st.sampled_from(["", " ", "a", " a\n b", "c\td "]))
records = st.lists(
    st.tuples(st.sampled_from([None, "u1", "u2"]), st.sampled_from([None, "f1", "f2"]), words),
    max_size=8,
)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=records)
def test_late_derivation_gives_the_same_rows_as_the_plain_composition(spark, rows):
    frame = parsed(
        spark,
        article(),
        *[
            article(url_hash=u, fingerprint=f, title=None, summary=t if n % 2 else None, text=t)
            for n, (u, f, t) in enumerate(rows)
        ],
    )
    order = ["url_hash", "fingerprint", "summary", "text"]
    plain = dedup_articles(keep_scorable(select_base(frame)), order)
    late = prepare_articles(frame, order_by=order)
    assert late.columns == plain.columns
    assert Counter(map(tuple, late.collect())) == Counter(map(tuple, plain.collect()))
