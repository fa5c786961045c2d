"""Every registered query against its SQL in DuckDB.

Once on the given tables, and once on skewed copies of them with every join shuffled.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from sedimenta.operators import lookups
from sedimenta.plans.oracle import ORACLE_SQL
from sedimenta.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def views(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            path = os.path.join(folder, name)
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return connection


@pytest.fixture(scope="module")
def db():
    return views(FOLDER)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines and orders share their keys, a tenth have keys that are not
    known anywhere, and some rows are exact copies."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    hot = {"l_orderkey": 3, "l_suppkey": 4, "l_partkey": 5, "o_custkey": 6}
    unknown = 10**9
    for name in os.listdir(FOLDER):
        df = spark.read.parquet(f"{FOLDER}/{name}")
        for column, value in hot.items():
            if column in df.columns:
                chosen = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
                lost = F.pmod(F.xxhash64(F.lit(column), *df.columns), F.lit(10)) == 0
                key = F.when(lost, F.lit(unknown)).when(chosen, F.lit(value)).otherwise(F.col(column))
                df = df.withColumn(column, key.cast("bigint"))
        if name == "lineitem.parquet":
            df = df.unionByName(df.filter("l_orderkey = 3").limit(500))
        if name == "customer.parquet":
            df = df.unionByName(df.limit(5)).withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3)))
        if name == "orders.parquet":
            df = df.unionByName(df.limit(50).withColumn("o_orderkey", F.lit(None).cast("bigint")))
        df.write.parquet(f"{folder}/{name}")
    return folder


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(df, result):
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert as_rows(df.columns, df.collect()) == as_rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, db, name):
    compare(QUERIES[name](spark, FOLDER), db.execute(ORACLE_SQL[name]))


JOINED = [name for name in sorted(QUERIES) if name.startswith(("silver", "gold", "dq"))]


@pytest.mark.parametrize("name", [name for name in JOINED if name not in ("dq_layer_summary", "dq_summary")])
def test_same_rows_as_sql_under_skew(spark, skewed, name, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compare(QUERIES[name](spark, skewed), views(skewed).execute(ORACLE_SQL[name]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_check_has_one_value(spark, skewed):
    """The same in a query of its own and in the report."""
    report = {r["name"]: r["value"] for r in QUERIES["dq_report"](spark, skewed).collect()}
    for name in ("dq_range", "dq_date_order", "dq_null_pct", "dq_reconcile"):
        (row,) = QUERIES[name](spark, skewed).collect()
        assert report[row["name"]] == row["value"]


def test_order_of_a_summary(spark, db):
    ours = [row["state"] for row in QUERIES["gold_state_risk"](spark, FOLDER).collect()]
    assert ours == [row[0] for row in db.execute(ORACLE_SQL["gold_state_risk"]).fetchall()]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    assert entry(spark).count() > 0
