"""The Korean fan-in as a job of its own (see ``jobs.start_fan_in``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..functions.rules import KR_FAN_IN, Rule
from ..tables import LinkTable, as_table
from .jobs import StreamLayout, start_fan_in


def run_fan_in(spark: SparkSession, layout: StreamLayout, sink: LinkTable | str, checkpoint: str,
               rules: Sequence[Rule] = KR_FAN_IN, max_files: int | str | None = None) -> None:
    start_fan_in(spark, layout, as_table(sink, layout.fmt), checkpoint, rules, max_files).awaitTermination()
