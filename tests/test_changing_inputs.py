"""What is staged or measured belongs to its input files: a table that is replaced in the session is seen."""

import shutil

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import lookups
from sedimenta.plans.queries import QUERIES
from sedimenta.sources.staging import fingerprint

TABLES = ("lineitem", "orders", "customer", "nation", "supplier", "part")


@pytest.fixture
def folder(tmp_path):
    for name in TABLES:
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_a_replaced_table_changes_the_report(spark, folder):
    def value():
        return {r["name"]: r["value"] for r in QUERIES["dq_report"](spark, folder).collect()}["balance_positive"]

    before = value()
    assert before > 0 and value() == before
    kept = spark.read.parquet(f"{folder}/customer.parquet").filter("c_acctbal > 0").toPandas()
    kept.to_parquet(f"{folder}/customer.parquet")
    assert value() == 0
    summary = QUERIES["dq_layer_summary"](spark, folder).collect()
    assert sum(r["failed_critical"] for r in summary) >= 1 and len(summary) == 3


def test_fingerprint(spark, folder):
    paths = [f"{folder}/{name}.parquet" for name in TABLES]
    first = fingerprint(spark, paths)
    assert fingerprint(spark, paths[::-1]) == first != fingerprint(spark, paths[1:])
    assert fingerprint(spark, []) == 0
    spark.range(3).write.parquet(f"{folder}/more")
    more = fingerprint(spark, [*paths, f"{folder}/more"])
    spark.range(3).write.mode("overwrite").parquet(f"{folder}/more")
    assert fingerprint(spark, [*paths, f"{folder}/more"]) != more != first


def test_a_lookup_that_has_grown_is_measured_anew(spark, tmp_path):
    path = str(tmp_path / "lookup")
    spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    facts = spark.range(100).select((F.col("id") % 10).alias("k"))

    def is_small():
        lookup = spark.read.parquet(path)
        assert lookups.attach(facts, lookup, "k", broadcast_bytes=10_000).count() == 100
        return lookups.size_within(lookup, 10_000)

    assert is_small()
    spark.range(9000).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v")).write.mode("overwrite").parquet(path)
    assert not is_small()
