"""Small inputs and recording scorers."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

STAMP = "2031-05-17T08:30:00Z"

ARTICLE = {
    "title": "Title",
    "author": "Author",
    "text": "Body of the article",
    "summary": None,
    "url": "https://news.example/1",
    "source": "news.example",
    "published_at": "2029-11-03T06:15:42",
    "scraped_at": "2029-11-03T06:21:07",
    "url_hash": "h1",
    "fingerprint": "f1",
}


def clock():
    return STAMP


def wire(spark, *records):
    """A ``value`` column from dicts (as JSON), strings and None."""
    values = [(json.dumps(r) if isinstance(r, dict) else r,) for r in records]
    return spark.createDataFrame(values, "value string")


def article(**fields):
    return {**ARTICLE, **fields}


def texts(spark, rows, partitions=1):
    """Scoring input from ``(url_hash, text_for_inference)`` pairs, in order."""
    frame = spark.createDataFrame(rows, "url_hash string, text_for_inference string")
    return frame.coalesce(partitions)


def base_row(url_hash, text="some text", fingerprint="f", **fields):
    return {
        "url_hash": url_hash,
        "text_prepped": text,
        "text": text,
        "fingerprint": fingerprint,
        "text_for_inference": text,
        **fields,
    }


BASE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("url_hash", "text_prepped", "text", "fingerprint", "text_for_inference")
    ]
)


class Recorder:
    """A factory and scorer that answers everything and leaves a trace in files, so
    that calls made in Python workers can be counted from the test."""

    def __init__(self, folder, spec, fail_on=None):
        self.folder = Path(folder)
        self.spec = spec
        self.fail_on = fail_on

    def __call__(self):
        import uuid

        (self.folder / f"made-{uuid.uuid4().hex}").touch()
        return self.answer

    def answer(self, items):
        import uuid

        if self.fail_on is not None and any(i["text"] == self.fail_on for i in items):
            raise RuntimeError("boom")
        (self.folder / f"call-{uuid.uuid4().hex}").write_text(json.dumps(items))
        return [
            {
                "url_hash": item["url_hash"],
                self.spec.label_key: f"label of {item['text']}",
                self.spec.score_key: 0.5,
            }
            for item in items
        ]

    @property
    def made(self):
        return len(list(self.folder.glob("made-*")))

    @property
    def requests(self):
        return [json.loads(path.read_text()) for path in self.folder.glob("call-*")]
