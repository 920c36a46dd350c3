"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexiloom.operators.reports import report_lines


def write_report(report: DataFrame, path: str, title: str) -> None:
    """Write a report as one text file of some tens of lines."""
    report_lines(report, title).coalesce(1).write.mode("overwrite").text(path)
