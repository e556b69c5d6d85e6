"""Stateless checks and bounded duplicate removal on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.operators.dedup import fingerprint
from nasij.operators.formats import record_findings


def findings(lines: DataFrame, required: list[str], line: str = "value") -> DataFrame:
    """Schema findings of arriving JSON lines, each with its fingerprint."""
    return record_findings(lines.withColumn("line_sha", F.sha2(line, 256)), "line_sha", line, required)


def first_seen(rows: DataFrame, text: str, time: str, within: str = "1 hour") -> DataFrame:
    """Rows whose text was not seen within the time; the state is bounded by
    the watermark."""
    return rows.withColumn("text_sha", fingerprint(F.col(text))).withWatermark(time, within).dropDuplicatesWithinWatermark(["text_sha"])
