"""The first rows of a batch on standard output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from presswork.schemas import CONSOLE_FIELDS


@dataclass(frozen=True)
class ConsoleSink:
    """Shows at most ``rows`` rows, in no order; nothing beyond them is computed."""

    rows: int = 50
    truncate: bool = False

    def write(self, enriched: DataFrame, batch_id: int) -> None:
        enriched.select(*CONSOLE_FIELDS).show(n=self.rows, truncate=self.truncate)
