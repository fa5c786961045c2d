"""Nested quality reports as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed names and nesting of a stored report.
REPORT_SCHEMA = """
    timestamp string,
    layers array<struct<
        layer: string, passed: bigint, failed_critical: bigint, failed_warning: bigint,
        checks: array<struct<
            name: string, description: string, severity: string,
            value: double, passed: boolean, status: string, error: string>>>>,
    summary struct<
        total_checks: bigint, total_passed: bigint, total_critical_failures: bigint,
        total_warnings: bigint, pipeline_healthy: boolean>
"""


def write_report(report: DataFrame, path: str) -> None:
    """Add a report to those at ``path``, one file each."""
    report.coalesce(1).write.mode("append").json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Reports under ``path``, also pretty-printed ones of one document per file."""
    return spark.read.schema(REPORT_SCHEMA).json(path, multiLine=True)
