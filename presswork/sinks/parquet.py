"""Enriched articles to date-partitioned Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY_SECONDS = 86400


def utc_date(timestamp: Column | str) -> Column:
    """The date of an instant in UTC, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(timestamp) / F.lit(_DAY_SECONDS))
    return F.date_from_unix_date(days.cast("int"))


@dataclass(frozen=True)
class ParquetSink:
    """Appends to ``output_dir`` under ``ingest_date=…``, compressed with zstd: an article
    holds its text up to three times.

    With ``per_batch`` each batch has a folder ``stream_id=…/batch_id=…`` above the dates,
    which a replay overwrites instead of appending to; both are then columns on reading.
    The stream's id is the one Spark keeps in its checkpoint, so streams that share
    ``output_dir``, or one that starts anew, do not overwrite each other's batches. Outside
    a stream ``stream_id`` must be given.

    ``ingest_date`` sets another date than today's, for backfills. Where it differs from
    row to row, rows are first brought together by date, or each task would leave a file
    per date: Spark splits the dates with many rows and merges those with few.
    ``one_date`` saves that shuffle where the given date is the same for all rows.
    """

    output_dir: str
    per_batch: bool = False
    ingest_date: Column | None = None
    one_date: bool = False
    stream_id: str | None = None

    single_pass = True

    def write(self, enriched: DataFrame, batch_id: int) -> None:
        if self.ingest_date is None:
            dated = enriched.withColumn("ingest_date", utc_date(F.current_timestamp()))
        else:
            dated = enriched.withColumn("ingest_date", self.ingest_date)
            if not self.one_date:
                dated = dated.hint("rebalance", "ingest_date")
        writer = dated.write.partitionBy("ingest_date").option("compression", "zstd")
        if self.per_batch:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.parquet(self._folder(enriched, batch_id))
        else:
            writer.mode("append").parquet(self.output_dir)

    def written(self, enriched: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch that ``write`` has put into its own folder."""
        read = enriched.sparkSession.read.schema(enriched.schema)
        return read.parquet(self._folder(enriched, batch_id)).select(*enriched.columns)

    def _folder(self, enriched: DataFrame, batch_id: int) -> str:
        context = enriched.sparkSession.sparkContext
        stream = self.stream_id or context.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise ValueError("per_batch needs a stream_id outside a stream")
        return f"{self.output_dir.rstrip('/')}/stream_id={stream}/batch_id={batch_id}"
