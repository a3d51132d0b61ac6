import pickle
from functools import partial
from unittest.mock import Mock

import pytest
from helpers import STAMP, clock

from presswork.operators import EMPTY_TEXT, SENTIMENT, HttpReady, HttpScorer
from presswork.operators.scoring import answer_chunk


def session(content=None, failure=None):
    reply = Mock()
    reply.json.return_value = content
    reply.raise_for_status.side_effect = failure
    fake = Mock()
    fake.post.return_value = reply
    return fake


def test_what_is_posted_and_what_is_read():
    answers = [
        {"url_hash": key, "sentiment_label": label, "sentiment_score": value}
        for key, label, value in (("k9", "negative", 0.125), ("k7", "positive", 1))
    ]
    fake = session({"took_ms": 3, "results": answers})
    scorer = HttpScorer("https://scores.test/v2", 4.5, fake)
    rows = [("k7", "a long day"), ("k8", "\n"), ("k9", "no rain"), ("k10", "unknown")]
    first, blank, second, unknown = answer_chunk(rows, scorer, SENTIMENT, clock)
    assert (first, second) == (("positive", 1.0, STAMP, None), ("negative", 0.125, STAMP, None))
    assert [blank.error, unknown.error] == [EMPTY_TEXT, SENTIMENT.missing_error]
    (call,) = fake.post.call_args_list
    assert call.args == ("https://scores.test/v2",) and call.kwargs["timeout"] == 4.5
    items = call.kwargs["json"]["items"]
    assert [tuple(i.values()) for i in items] == [("k7", "a long day"), ("k9", "no rain"), ("k10", "unknown")]
    assert all(list(i) == ["url_hash", "text"] for i in items)


@pytest.mark.parametrize("content", [[], "text", None, {}, {"other": 1}])
def test_reply_without_results_answers_nothing(content):
    assert HttpScorer("http://example.test", session=session(content))([]) == []


def test_error_status_fails_the_request():
    scorer = HttpScorer("http://example.test", session=session(failure=OSError("503")))
    (answer,) = answer_chunk([("a", "x")], scorer, SENTIMENT, clock)
    assert answer.error == "503"


def test_the_session_is_kept_between_requests():
    fake = session({"results": []})
    scorer = HttpScorer("http://example.test", session=fake)
    scorer([]), scorer([])
    assert fake.post.call_count == 2


def test_factory_can_be_sent_to_executors():
    pytest.importorskip("requests")
    factory = pickle.loads(pickle.dumps(partial(HttpScorer, "http://example.test", 7)))
    scorer = factory()
    assert (scorer.endpoint, scorer.timeout_s) == ("http://example.test", 7)


@pytest.mark.parametrize(("status", "ready"), [(200, True), (204, True), (500, False)])
def test_ready_by_status(status, ready):
    fake = Mock()
    fake.get.return_value.status_code = status
    assert HttpReady("http://example.test", session=fake)() is ready
    fake.get.assert_called_once_with("http://example.test", timeout=2)


def test_not_ready_when_unreachable():
    fake = Mock()
    fake.get.side_effect = ConnectionError("boom")
    assert HttpReady("http://example.test", session=fake)() is False
