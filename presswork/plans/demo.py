"""Articles over the ``documents`` table, and scorers with known answers.

Both are rules on the row itself, so that the registered queries cover every branch
(null and empty fields, copies, shared keys, blank texts, unanswered items) on any
number of documents, and SQL can say what they must give.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.wire import to_wire
from presswork.schemas import ARTICLE_FIELDS

_START = 1704067200  # 2024-01-01 00:00:00 UTC
_YEAR_MINUTES = 525600


def document_articles(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the ten article fields for each document. A few have a title or a
    summary, made from ``source`` and ``doc_id``; all others are scored on their text. Most
    texts have an address of their own, one in twenty stands at the same one."""
    doc, body = F.col("doc_id"), F.col("text")
    digest = F.md5(body)
    place = F.when(doc % 20 == 0, F.lit("front")).otherwise(F.substring(digest, 1, 8))
    url = F.concat(F.lit("https://news.example/"), place)
    minutes = doc % _YEAR_MINUTES
    fields = {
        "title": F.when(doc % 25 == 3, F.concat(F.lit("Title of "), "source", F.lit(" "), doc)),
        "author": F.concat(F.lit("author"), doc % 50),
        "text": body,
        "summary": F.when(doc % 33 == 0, F.lit("")).when(
            doc % 25 == 4, F.concat(F.lit("Summary  by\n"), "source", F.lit(" of "), doc)
        ),
        "url": url,
        "source": F.col("source"),
        "published_at": F.timestamp_seconds(F.lit(_START) + minutes * 60),
        "scraped_at": F.timestamp_seconds(F.lit(_START) + (minutes + 5) * 60),
        "url_hash": F.when(doc % 97 != 0, F.md5(url)),
        "fingerprint": digest,
    }
    return documents.select("doc_id", *[fields[name].alias(name) for name in ARTICLE_FIELDS])


def document_wire(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the article as the bytes a topic would hold."""
    articles = document_articles(documents)
    return articles.select("doc_id", to_wire(ARTICLE_FIELDS).cast("binary").alias("value"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_articles(read_documents(spark, sf_dir))


@dataclass(frozen=True)
class LengthScorer:
    """Answers from the length of the text, so by position; it leaves every text out
    whose length is a multiple of ``silent_every``, and fails if there is one whose length
    is a multiple of ``refuse_every``. An instance is its own factory."""

    silent_every: int | None = None
    refuse_every: int | None = None
    positional = True

    def __call__(self, items=None):
        if items is None:
            return self
        sizes = [len(item["text"]) for item in items]
        refused = [n for n in sizes if self.refuse_every and n % self.refuse_every == 0]
        if refused:
            raise ValueError(f"refused a text of {refused[0]}")
        return [self._answer(n) for n in sizes]

    def _answer(self, n: int):
        if self.silent_every and n % self.silent_every == 0:
            return None
        return self.answer(n)


class LengthSentiment(LengthScorer):
    def answer(self, n: int) -> dict:
        label = ("positive", "negative", "neutral")[n % 3]
        return {"sentiment_label": label, "sentiment_score": n % 101 / 100.0}


class LengthTopic(LengthScorer):
    def answer(self, n: int) -> dict:
        return {"topic_label": f"topic{n % 5}", "topic_score": n % 97 / 96.0}


def fixed_clock() -> str:
    return "2031-05-17T08:30:00Z"


class RequestLog:
    """Answers each text with the number of its request in the partition, and with the
    texts and bytes that came along. Made anew for each partition, as its own factory."""

    positional = True

    def __init__(self) -> None:
        self.requests = 0

    def __call__(self, items):
        self.requests += 1
        size = sum(len(item["text"].encode()) for item in items)
        label = f"request {self.requests}: {len(items)} texts"
        return [{"sentiment_label": label, "sentiment_score": size}] * len(items)


class CountingClock:
    """Tells how often it was asked. Each task has a copy of its own, which starts at 0."""

    def __init__(self) -> None:
        self.asked = 0

    def __call__(self) -> str:
        self.asked += 1
        return str(self.asked)


class Unavailable:
    """A factory that makes no scorer."""

    def __call__(self):
        raise ConnectionError("no scorer to be had")
