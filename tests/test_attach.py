import pytest
from pyspark.sql import functions as F

from sedimenta.operators.lookups import SALTS_PER_SHARE, attach, hot_keys, size_within

SHUFFLED = {"broadcast_bytes": 0}


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows with one key, a third without any, and the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    return spark.range(30_000).select(F.col("id").alias("row"), key.alias("k")).repartition(5)


@pytest.fixture(scope="module")
def lookup(spark):
    """Key 7 twice, key 8 twice, even keys from 100 once, and a null key."""
    rows = [(7, "a"), (7, "b"), (8, "x"), (8, "x"), (None, "never")] + [(i, f"n{i}") for i in range(100, 5000, 2)]
    return spark.createDataFrame(rows, "code int, label string")


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_equals_broadcast_equals_plain_join(facts, lookup, how):
    broadcast = attach(facts, lookup, "k", "code", how)
    shuffled = attach(facts, lookup, "k", "code", how, **SHUFFLED)
    plain = facts.join(lookup, facts.k == lookup.code, how).drop("code")
    assert broadcast.columns == shuffled.columns == ["row", "k", "label"]
    expected = sorted(plain.collect(), key=repr)
    assert sorted(broadcast.collect(), key=repr) == expected
    assert sorted(shuffled.collect(), key=repr) == expected
    # the hot key matches two lookup rows
    assert shuffled.filter("k = 7").count() == 2 * facts.filter("k = 7").count()


def test_small_lookup_is_broadcast_and_large_one_is_not(facts, lookup):
    assert "BroadcastHashJoin" in plan(attach(facts, lookup, "k", "code"))
    shuffled = plan(attach(facts, lookup, "k", "code", **SHUFFLED))
    assert "_salt" in shuffled


def test_hot_and_null_rows_are_spread(spark, facts, lookup):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(facts, lookup, "k", "code", **SHUFFLED)
        sizes = joined.groupBy(F.spark_partition_id(), F.col("k").isNull(), F.col("k") == 7).count().collect()
        plain = facts.join(lookup, facts.k == lookup.code, "left")
        before_sizes = plain.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    nulls = [row["count"] for row in sizes if row[1]]
    hot = [row["count"] for row in sizes if row[2]]
    assert max(nulls) <= 0.5 * sum(nulls)
    assert max(hot) <= 0.5 * sum(hot)
    assert max(row["count"] for row in before_sizes) >= 20_000


def test_hot_keys(facts):
    assert [key for key, _ in hot_keys(facts, "k")] == [7]
    assert hot_keys(facts.filter("k <> 7"), "k") == []
    assert hot_keys(facts.filter("false"), "k") == []


def test_hot_keys_have_no_least_share(spark):
    """With many partitions a small share is several partitions' worth of rows."""
    key = F.when(F.col("id") < 180, -1).when(F.col("id") < 400, F.lit(-2)).otherwise(F.col("id"))
    df = spark.range(200_000).select(key.alias("k"))
    hot = dict(hot_keys(df, "k", partitions=20_000))
    assert sorted(hot) == [-2, -1]  # 0.09% and 0.11% of the rows, 18 and 22 partitions
    assert hot[-1] == SALTS_PER_SHARE * 18 and hot[-2] == SALTS_PER_SHARE * 22
    assert sum(hot.values()) <= SALTS_PER_SHARE * 20_000 + len(hot)


def test_size_counts_texts(spark):
    df = spark.createDataFrame([("x" * 1000,), (None,)], "t string")
    assert size_within(df, 1032)
    assert not size_within(df, 1031)
    assert not size_within(df, 1032, screen=spark.range(100))
    assert size_within(spark.range(10), 160) and not size_within(spark.range(10), 159)
    assert not size_within(df.select(F.array("t").alias("a")), 10**9)


def test_no_shuffle_of_unneeded_columns(spark, tmp_path, facts, lookup):
    path = str(tmp_path / "facts")
    facts.withColumn("wide", F.lit("w")).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = attach(stored, lookup, "k", "code", spread_on=["row"], **SHUFFLED).groupBy("label").count()
    assert "wide" not in plan(counts)


def test_no_salt_without_hot_or_null_keys(facts, lookup):
    even = facts.filter("k <> 7")
    assert "_salt" not in plan(attach(even, lookup, "k", "code", "inner", **SHUFFLED))
    assert attach(even, lookup, "k", "code", "inner", **SHUFFLED).count() == attach(
        even, lookup, "k", "code", "inner"
    ).count()


def test_spread_by_position_in_the_file(spark, tmp_path, lookup):
    """Exact copies of one row end up in several partitions."""
    path = str(tmp_path / "copies")
    spark.range(5000).select(F.lit(7).alias("k")).coalesce(1).write.parquet(path)
    copies = spark.read.parquet(path)
    options = {"spread_on": [F.col("_metadata.row_index")], **SHUFFLED}
    joined = attach(copies, lookup, "k", "code", **options)
    assert joined.columns == ["k", "label"] and joined.count() == 10_000
    assert "row_index" in plan(joined)


def test_rejects_other_joins(facts, lookup):
    with pytest.raises(ValueError):
        attach(facts, lookup, "k", "code", "full")
