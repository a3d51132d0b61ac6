"""JSON in and out: the wire form of raw and enriched articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.text import normalize_text
from presswork.schemas import ARTICLE_SCHEMA, KAFKA_FIELDS

# The zone is stated per call so that results do not depend on the session's.
_PARSE_OPTIONS = {"timeZone": "UTC", "mode": "PERMISSIVE"}
_WRITE_OPTIONS = {"timeZone": "UTC", "ignoreNullFields": "true"}


def parse_fields(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row of ``value`` (bytes or string) to the ten article fields.

    The struct is flattened with ``inline`` over a one-element array: a generator's
    output is computed once per row, whereas the fields of a plain ``s.*`` get
    inlined into every later filter, which would parse each record several times.
    """
    record = F.from_json(F.col(value).cast("string"), ARTICLE_SCHEMA, _PARSE_OPTIONS)
    return df.select(*keep, F.inline(F.array(record)))


def parse_articles(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The ten article fields and the normalised body, ``text_prepped``."""
    return parse_fields(df, value, keep).withColumn("text_prepped", normalize_text("text"))


def to_wire(fields: Sequence[str] = KAFKA_FIELDS) -> Column:
    """One JSON object of ``fields``, in order and without the null ones."""
    return F.to_json(F.struct(*fields), _WRITE_OPTIONS)
