"""Roll-ups of check results, and the nested report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.checks import CRITICAL, WARNING

# Fixed value: the format of the one-line summary.
SUMMARY_FORMAT = (
    "Ran %d quality checks: %d passed, %d critical failures, %d warnings. Pipeline healthy: %s"
)

_CHECK_FIELDS = ("name", "description", "severity", "value", "passed", "status", "error")


def _counts() -> list[Column]:
    failed = ~F.col("passed")
    return [
        F.count_if("passed").alias("passed"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("failed_critical"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("failed_warning"),
    ]


def layer_summary(results: DataFrame) -> DataFrame:
    """``(layer, passed, failed_critical, failed_warning)``. An error is a failure."""
    return results.groupBy("layer").agg(*_counts()).orderBy("layer")


def overall_summary(results: DataFrame) -> DataFrame:
    """One row; the data is healthy unless a critical check failed."""
    return (
        results.agg(F.count(F.lit(1)).alias("total_checks"), *_counts())
        .select(
            "total_checks",
            F.col("passed").alias("total_passed"),
            F.col("failed_critical").alias("total_critical_failures"),
            F.col("failed_warning").alias("total_warnings"),
        )
        .withColumn("pipeline_healthy", F.col("total_critical_failures") == 0)
    )


def summary_line() -> Column:
    """The columns of an overall summary as one sentence."""
    return F.format_string(
        SUMMARY_FORMAT,
        "total_checks",
        "total_passed",
        "total_critical_failures",
        "total_warnings",
        F.when(F.col("pipeline_healthy"), "True").otherwise("False"),
    )


def labelled(results: DataFrame) -> DataFrame:
    """Adds ``label``: ``pass``, or for a failure ``warning`` or ``critical``."""
    label = F.when(F.col("passed"), "pass").when(F.col("severity") == WARNING, "warning").otherwise("critical")
    return results.withColumn("label", label)


def nested_report(results: DataFrame, timestamp: str) -> DataFrame:
    """One row ``(timestamp, layers, summary)``, layers and checks in their given order."""
    check = F.struct("position", *_CHECK_FIELDS)
    in_order = F.array_sort(F.collect_list(check))
    layers = results.groupBy("layer").agg(
        F.min("position").alias("position"), *_counts(), in_order.alias("checks")
    )
    layer = F.struct(
        "position",
        "layer",
        "passed",
        "failed_critical",
        "failed_warning",
        F.transform("checks", lambda c: F.struct(*[c[f].alias(f) for f in _CHECK_FIELDS])).alias("checks"),
    )
    layer_fields = ("layer", "passed", "failed_critical", "failed_warning", "checks")
    nested = layers.agg(
        F.transform(
            F.array_sort(F.collect_list(layer)), lambda one: F.struct(*[one[f].alias(f) for f in layer_fields])
        ).alias("layers")
    )

    def over_layers(field: str) -> Column:
        return F.aggregate("layers", F.lit(0).cast("long"), lambda total, one: total + one[field])

    n_checks = F.aggregate("layers", F.lit(0).cast("long"), lambda total, one: total + F.size(one["checks"]))
    summary = F.struct(
        n_checks.alias("total_checks"),
        over_layers("passed").alias("total_passed"),
        over_layers("failed_critical").alias("total_critical_failures"),
        over_layers("failed_warning").alias("total_warnings"),
        (over_layers("failed_critical") == 0).alias("pipeline_healthy"),
    )
    return nested.select(F.lit(timestamp).alias("timestamp"), "layers", summary.alias("summary"))


def flatten_report(reports: DataFrame) -> DataFrame:
    """One row per check of each report: timestamp, layer, the check, and its label."""
    per_layer = reports.select("timestamp", F.inline("layers"))
    return labelled(per_layer.select("timestamp", "layer", F.inline("checks")))


def report_summary(reports: DataFrame) -> DataFrame:
    return reports.select("timestamp", "summary.*")
