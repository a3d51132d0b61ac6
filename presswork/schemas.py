"""Fixed schemas and field orders of the article dataflow."""

from __future__ import annotations

from pyspark.sql import types as T

# The names, types and orders below are the wire and result
# contracts, so that existing topics, files and consumers keep working.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("url_hash", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)

ARTICLE_FIELDS = ARTICLE_SCHEMA.fieldNames()

#: Two rows are copies of each other when they agree on these.
IDENTITY = ["url_hash", "fingerprint"]

#: Columns of a prepared article, in order.
BASE_FIELDS = [
    "url_hash",
    "text_prepped",
    "title",
    "author",
    "text",
    "summary",
    "url",
    "source",
    "published_at",
    "scraped_at",
    "fingerprint",
    "text_for_inference",
]

#: Members of the JSON object written per enriched article, in order.
KAFKA_FIELDS = ARTICLE_FIELDS + [
    "sentiment_label",
    "sentiment_score",
    "sentiment_inferred_at",
    "sentiment_error",
    "category_label",
    "category_score",
    "category_inferred_at",
    "category_error",
]

#: Columns shown on the console.
CONSOLE_FIELDS = [
    "title",
    "sentiment_label",
    "sentiment_score",
    "category_label",
    "category_score",
    "sentiment_error",
    "category_error",
]


def answer_schema(prefix: str) -> T.StructType:
    """The four columns a scorer adds to a row."""
    return T.StructType(
        [
            T.StructField(f"{prefix}_label", T.StringType()),
            T.StructField(f"{prefix}_score", T.DoubleType()),
            T.StructField(f"{prefix}_inferred_at", T.StringType()),
            T.StructField(f"{prefix}_error", T.StringType()),
        ]
    )


def result_schema(prefix: str) -> T.StructType:
    """A stand-alone result table: the article key and the four answer columns."""
    key = T.StructField("url_hash", T.StringType(), nullable=False)
    return T.StructType([key, *answer_schema(prefix).fields])


SENTIMENT_SCHEMA = result_schema("sentiment")
CATEGORY_SCHEMA = result_schema("category")
