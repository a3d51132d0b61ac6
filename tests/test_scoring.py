import math
import time
from collections import Counter

import pytest
from helpers import STAMP, Recorder, clock, texts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from presswork.operators import CATEGORY, EMPTY_TEXT, SENTIMENT, score, score_all, score_table
from presswork.operators.scoring import answer_chunk
from presswork.schemas import CATEGORY_SCHEMA, SENTIMENT_SCHEMA


def replying(*replies):
    """A factory of scorers that give these replies to any request."""
    return lambda: lambda items: list(replies)


def sentiment(key, label="positive", value=0.9):
    return {"url_hash": key, "sentiment_label": label, "sentiment_score": value}


def scored(spark, rows, factory, spec=SENTIMENT, **options):
    options.setdefault("clock", clock)
    return {r.url_hash: r for r in score(texts(spark, rows), spec, factory, **options).collect()}


def test_each_chunk_misses_its_own(spark):
    """Five rows in chunks of two; the scorer answers the even ones only."""

    def evens(items):
        return [sentiment(i["url_hash"], value=0.25) for i in items if int(i["url_hash"]) % 2 == 0]

    rows = [(str(n), f"story {n}") for n in range(5)]
    got = scored(spark, rows, lambda: evens, chunk_size=2)
    for n in range(5):
        answer = ("positive", 0.25, STAMP, None)
        missing = (None, None, STAMP, "missing sentiment result")
        assert got[str(n)][2:] == (missing if n % 2 else answer)


def test_blanks_between_texts_are_not_sent(spark, tmp_path):
    words = ["rain", "\t", "sun", None, "\x1c\u2003", "", "snow"]
    rows = [(f"k{n}", word) for n, word in enumerate(words)]
    recorder = Recorder(tmp_path, SENTIMENT)
    got = scored(spark, rows, recorder, chunk_size=3)
    blank = {key for key, row in got.items() if row.sentiment_error == EMPTY_TEXT}
    assert blank == {"k1", "k3", "k4", "k5"}
    sent = sorted(item["text"] for request in recorder.requests for item in request)
    assert sent == ["rain", "snow", "sun"]


def test_a_failed_request_spares_the_other_chunks(spark):
    def moody(items):
        if any("storm" in item["text"] for item in items):
            raise OSError("line is down")
        return [{"url_hash": i["url_hash"], "topic_label": "t", "topic_score": 1} for i in items]

    rows = [("p", "calm"), ("q", "mild"), ("r", "storm"), ("s", ""), ("t", "fog"), ("u", "dew")]
    got = scored(spark, rows, lambda: moody, CATEGORY, chunk_size=2)
    errors = {key: row.category_error for key, row in got.items()}
    down = "line is down"
    assert errors == {"p": None, "q": None, "r": down, "s": EMPTY_TEXT, "t": None, "u": None}


def test_whole_texts_reach_the_scorer(spark, tmp_path):
    from presswork.operators import prepare_articles
    from presswork.schemas import ARTICLE_FIELDS

    body = "word " * 3000
    values = {name: "x" for name in ARTICLE_FIELDS} | {"text": body, "title": None, "summary": None}
    fields = ", ".join(f"{name} string" for name in ARTICLE_FIELDS)
    articles = spark.createDataFrame([tuple(values[n] for n in ARTICLE_FIELDS)], fields)
    recorder = Recorder(tmp_path, SENTIMENT)
    score(prepare_articles(articles), SENTIMENT, recorder).collect()
    assert [item["text"] for request in recorder.requests for item in request] == [body.strip()]


def test_each_thread_has_a_scorer_of_its_own(spark):
    class Alone:
        def __init__(self):
            self.busy = False

        def __call__(self, items):
            assert not self.busy
            self.busy = True
            time.sleep(0.02)
            self.busy = False
            return [sentiment(i["url_hash"]) for i in items]

    rows = [(str(n), "x") for n in range(40)]
    got = scored(spark, rows, Alone, chunk_size=1, max_in_flight=8)
    assert all(row.sentiment_error is None for row in got.values())


def test_topic_answers_become_category_columns(spark):
    reply = {"url_hash": "a", "topic_label": "sport", "topic_score": 0.25}
    got = scored(spark, [("a", "x"), ("b", "y")], replying(reply), CATEGORY)
    assert got["a"][2:] == ("sport", 0.25, STAMP, None)
    assert got["b"].category_error == "missing classification result"


@pytest.mark.parametrize(
    ("replies", "expected"),
    [
        ([sentiment("a", "old"), sentiment("a", "new")], ("new", 0.9, None)),
        ([None, "junk", 7, sentiment(None), sentiment("a")], ("positive", 0.9, None)),
        ([sentiment("a", value=1)], ("positive", 1.0, None)),
        ([sentiment("a", value="0.25")], ("positive", 0.25, None)),
        ([sentiment("a", value=None)], ("positive", None, None)),
        ([sentiment("a", label=None)], (None, 0.9, None)),
        ([{"url_hash": "a"}], (None, None, None)),
        ({"url_hash": "a"}, (None, None, "missing sentiment result")),
        ([], (None, None, "missing sentiment result")),
    ],
)
def test_replies(replies, expected):
    (answer,) = answer_chunk([("a", "x")], lambda items: replies, SENTIMENT, clock)
    assert (answer.label, answer.score, answer.error) == expected


@pytest.mark.parametrize("replies", [None, 5, [{"url_hash": ["unhashable"]}]])
def test_unusable_replies_fail_the_request(replies):
    answers = answer_chunk([("a", "x"), ("b", "y")], lambda items: replies, SENTIMENT, clock)
    assert all(a.error and a.label is None for a in answers)
    assert answers[0].error == answers[1].error


def test_a_bad_score_fails_its_row_only():
    replies = [sentiment("a", value="high"), sentiment("b")]
    a, b = answer_chunk([("a", "x"), ("b", "y")], lambda items: replies, SENTIMENT, clock)
    assert (a.label, a.score) == (None, None) and "high" in a.error
    assert (b.label, b.error) == ("positive", None)


def test_positional_scorer_keeps_equal_keys_apart():
    class ByPosition:
        positional = True

        def __call__(self, items):
            return [sentiment(None, item["text"]) for item in items[:2]] + [None]

    rows = [("a", "one"), ("a", "two"), ("a", "three")]
    answers = answer_chunk(rows, ByPosition(), SENTIMENT, clock)
    assert [(a.label, a.error) for a in answers] == [
        ("one", None),
        ("two", None),
        (None, "missing sentiment result"),
    ]
    answers = answer_chunk(rows[:2], ByPosition(), SENTIMENT, clock)
    assert all(a.error == "3 answers to 2 texts" for a in answers)


def test_a_request_has_one_stamp_and_blank_rows_their_own():
    ticks = iter("123456789")
    rows = [("a", "x"), ("b", " "), ("c", "y"), ("d", "")]
    replies = [sentiment("a"), sentiment("c")]
    a, b, c, d = answer_chunk(rows, lambda items: replies, SENTIMENT, lambda: next(ticks))
    assert a.inferred_at == c.inferred_at
    assert len({a.inferred_at, b.inferred_at, d.inferred_at}) == 3


def test_default_stamp_is_utc_iso_text(spark):
    row = score(texts(spark, [("a", "x")]), SENTIMENT, replying(sentiment("a"))).first()
    assert row.sentiment_inferred_at.endswith("Z") and row.sentiment_inferred_at[10] == "T"


@pytest.mark.parametrize("batch_rows", ["10000", "7", "1"])
@pytest.mark.parametrize("in_flight", [1, 3])
def test_chunks_run_on_across_arrow_batches(spark, tmp_path, batch_rows, in_flight):
    recorder = Recorder(tmp_path, SENTIMENT)
    rows = [(f"k{n}", f"t{n}") for n in range(60)]
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, batch_rows)
    try:
        got = scored(spark, rows, recorder, max_in_flight=in_flight)
    finally:
        spark.conf.set(conf, before)
    assert {k: r.sentiment_label for k, r in got.items()} == {k: f"label of {t}" for k, t in rows}
    assert sorted(map(len, recorder.requests)) == [10, 25, 25]


def test_blank_rows_count_toward_the_chunk(spark, tmp_path):
    recorder = Recorder(tmp_path, SENTIMENT)
    scored(spark, [(f"k{n}", "t" if n % 2 else " ") for n in range(50)], recorder)
    assert sorted(map(len, recorder.requests)) == [12, 13]


def test_no_request_without_text_to_send(spark, tmp_path):
    recorder = Recorder(tmp_path, SENTIMENT)
    got = scored(spark, [(f"k{n}", " ") for n in range(3)], recorder)
    assert len(got) == 3 and recorder.requests == []


def test_one_failed_chunk_leaves_the_others(spark, tmp_path):
    recorder = Recorder(tmp_path, SENTIMENT, fail_on="t30")
    got = scored(spark, [(f"k{n}", f"t{n}") for n in range(50)], recorder)
    assert Counter(r.sentiment_error for r in got.values()) == {None: 25, "boom": 25}


def test_the_factory_is_called_once_per_partition_and_rows_scored_once(spark, tmp_path):
    recorder = Recorder(tmp_path, SENTIMENT)
    frame = texts(spark, [(f"k{n}", f"t{n}") for n in range(90)]).repartition(3)
    result = score(frame, SENTIMENT, recorder)
    # A filter on the answer must not make Spark ask a second time.
    assert result.filter("sentiment_label is not null and sentiment_score > 0").count() == 90
    assert recorder.made == 3
    assert sum(map(len, recorder.requests)) == 90


def test_only_key_and_text_go_to_python_and_no_shuffle_is_added(spark):
    frame = spark.range(4).selectExpr(
        "id", "string(id) url_hash", "'t' text_for_inference", "repeat('x', 100) text"
    )
    one_by_one = score(score(frame, SENTIMENT, replying(sentiment("1"))), CATEGORY, replying())
    at_once = score_all(frame, {SENTIMENT: replying(sentiment("1")), CATEGORY: replying()})
    for result, calls in ((one_by_one, 2), (at_once, 1)):
        assert result.columns[:4] == frame.columns and len(result.columns) == 12
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [answer(url_hash") == calls
        assert "Exchange" not in plan and "Join" not in plan


def test_scorers_are_waited_for_at_the_same_time(spark, tmp_path):
    class Meeting:
        """Answers only if the other scorer is being asked too."""

        def __init__(self, mine, other):
            self.mine, self.other = tmp_path / mine, tmp_path / other

        def __call__(self):
            return self.answer

        def answer(self, items):
            self.mine.touch()
            deadline = time.monotonic() + 20
            while not self.other.exists():
                if time.monotonic() > deadline:
                    raise TimeoutError("alone")
                time.sleep(0.01)
            return []

    rows = texts(spark, [(str(n), "t") for n in range(5)])
    scorers = {SENTIMENT: Meeting("s", "c"), CATEGORY: Meeting("c", "s")}
    errors = score_all(rows, scorers).select("sentiment_error", "category_error").distinct()
    assert [tuple(r) for r in errors.collect()] == [
        ("missing sentiment result", "missing classification result")
    ]


def test_several_scorers_answer_as_each_alone(spark, tmp_path):
    rows = [(f"k{n}", f"t{n}" if n % 4 else " ") for n in range(130)]
    recorders = {}
    for spec in (SENTIMENT, CATEGORY):
        folder = tmp_path / spec.prefix
        folder.mkdir()
        recorders[spec] = Recorder(folder, spec, fail_on="t30" if spec is CATEGORY else None)
    frame = texts(spark, rows).repartition(2).persist()
    both = score_all(frame, recorders, chunk_size=10, max_in_flight=2, clock=clock)
    alone = score(frame, SENTIMENT, recorders[SENTIMENT], chunk_size=10, clock=clock)
    alone = score(alone, CATEGORY, recorders[CATEGORY], chunk_size=10, clock=clock)
    assert both.columns == alone.columns
    assert Counter(both.collect()) == Counter(alone.collect())
    frame.unpersist()


def test_result_table(spark):
    for spec, schema in ((SENTIMENT, SENTIMENT_SCHEMA), (CATEGORY, CATEGORY_SCHEMA)):
        table = score_table(texts(spark, [("a", "x")]), spec, replying())
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in schema
        ]


def test_sizes_are_checked(spark):
    for bad in ({"chunk_size": 0}, {"max_in_flight": 0}):
        with pytest.raises(ValueError):
            score(texts(spark, [("a", "x")]), SENTIMENT, replying(), **bad)


rows = st.lists(
    st.tuples(st.sampled_from("abcdef"), st.sampled_from([None, "", " ", "x", "yy", "bad"])),
    max_size=40,
)


@settings(max_examples=200, deadline=None)
@given(rows=rows, silent=st.sets(st.sampled_from("abcdef")), chunk=st.integers(1, 9))
def test_every_row_gets_exactly_one_answer(rows, silent, chunk):
    def scorer(items):
        assert len(items) <= chunk and all(i["text"].strip() for i in items)
        if any(i["text"] == "bad" for i in items):
            raise RuntimeError("boom")
        return [sentiment(i["url_hash"]) for i in items if i["url_hash"] not in silent]

    for at in range(0, len(rows), chunk):
        part = rows[at : at + chunk]
        answers = answer_chunk(part, scorer, SENTIMENT, clock)
        failed = any(text == "bad" for _, text in part)
        assert len(answers) == len(part)
        for (key, text), answer in zip(part, answers):
            if not (text and text.strip()):
                assert answer.error == EMPTY_TEXT
            elif failed:
                assert answer.error == "boom"
            elif key in silent:
                assert answer.error == "missing sentiment result"
            else:
                assert answer.error is None and math.isclose(answer.score, 0.9)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    texts_given=st.lists(st.sampled_from([None, "", " ", "x", "yy", "bad"]), max_size=60),
    partitions=st.integers(1, 5),
    chunk=st.integers(1, 30),
    in_flight=st.integers(1, 3),
)
def test_rows_keep_their_columns_and_number(spark, texts_given, partitions, chunk, in_flight):
    def scorer(items):
        assert 0 < len(items) <= chunk
        return [sentiment(i["url_hash"], i["text"]) for i in items if i["text"] != "bad"]

    rows = [(str(n), text) for n, text in enumerate(texts_given)]
    frame = texts(spark, [*rows, ("last", "z")]).repartition(partitions)
    scored_rows = score(
        frame, SENTIMENT, lambda: scorer, chunk_size=chunk, max_in_flight=in_flight, clock=clock
    ).collect()
    assert sorted((r.url_hash, r.text_for_inference or "") for r in scored_rows) == sorted(
        (key, text or "") for key, text in [*rows, ("last", "z")]
    )
    for row in scored_rows:
        text = row.text_for_inference
        if not (text and text.strip()):
            assert row.sentiment_error == EMPTY_TEXT
        elif text == "bad":
            assert row.sentiment_error == "missing sentiment result"
        else:
            assert (row.sentiment_label, row.sentiment_error) == (text, None)


def test_requests_keep_to_rows_and_bytes(spark, tmp_path):
    """Against packing one text after the other."""
    import random

    random.seed(5)
    words = [random.choice(["", " ", None, "ä" * random.randint(1, 30), "x" * 100]) for _ in range(200)]
    rows = [(f"k{n}", word) for n, word in enumerate(words)]
    recorder = Recorder(tmp_path, SENTIMENT)
    got = scored(spark, rows, recorder, chunk_size=7, chunk_bytes=64)
    expected, chunk, held = [], [], 0
    for key, word in rows:
        size = len(word.encode()) if word and word.strip() else 0
        if len(chunk) == 7 or (held and size and held + size > 64):
            expected.append(chunk)
            chunk, held = [], 0
        chunk.append((key, size))
        held += size
    expected.append(chunk)
    sent = [[key for key, size in chunk if size] for chunk in expected]
    asked = [[item["url_hash"] for item in request] for request in recorder.requests]
    assert sorted(asked) == sorted(keys for keys in sent if keys)
    assert len(got) == 200 and any(len(c) < 7 for c in expected[:-1])
    assert any(size > 64 for chunk in expected for _, size in chunk)


def test_a_request_has_25_rows_unless_told_otherwise(spark, tmp_path):
    recorder = Recorder(tmp_path, SENTIMENT)
    scored(spark, [(f"k{n}", "x" * 10_000) for n in range(60)], recorder)
    assert sorted(map(len, recorder.requests)) == [10, 25, 25]


def test_scorers_and_requests_are_counted(spark):
    from presswork.operators import Tally

    tally = Tally(spark)
    rows = [(str(n), "" if n % 10 == 9 else "x") for n in range(40)]
    frame = texts(spark, rows).repartition(1)
    factory = replying(sentiment("1"))
    options = {"chunk_size": 5, "clock": clock, "tally": tally}
    answered = score_all(frame, {SENTIMENT: factory, CATEGORY: factory}, **options).collect()
    assert len(answered) == 40
    # One thread for each of the two scorers.
    assert (tally.scorers.value, tally.requests.value) == (2, 16)


def test_a_scorer_that_cannot_be_made_fails_the_task(spark):
    from pyspark.errors import PythonException

    def factory():
        raise OSError("no model")

    for options in ({}, {"max_in_flight": 2}):
        with pytest.raises(PythonException, match="no model"):
            scored(spark, [("a", "x")], factory, **options)


def test_budgets_are_checked(spark):
    for wrong in ({"chunk_bytes": 0}, {"chunk_size": 0}, {"max_in_flight": 0}):
        with pytest.raises(ValueError):
            score(texts(spark, [("a", "x")]), SENTIMENT, replying(), **wrong)
