import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import profiling
from sedimenta.operators.quantiles import exact_quantiles

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def numbers(kind, n=4000):
    rng = random.Random(5)
    return {
        "spread": [rng.uniform(-1e6, 1e6) for _ in range(n)],
        "one value on a third": [3.25 if i % 3 == 0 else rng.gauss(0, 1) for i in range(n)],
        "all equal": [2.0] * n,
        "two values": [float(i % 2) for i in range(n)],
        "far apart": [math.copysign(10 ** rng.uniform(-300, 300), rng.uniform(-1, 1)) for _ in range(n)],
        "whole": [float(rng.randrange(50)) for _ in range(n)],
    }[kind]


KINDS = ["spread", "one value on a third", "all equal", "two values", "far apart", "whole"]


@pytest.mark.parametrize("band_values", [10, 1_000_000])
def test_quantiles(spark, band_values):
    columns = [numbers(kind) for kind in KINDS]
    rows = [*zip(*columns), [None] * len(KINDS)]
    schema = ", ".join(f"c{i} double" for i in range(len(KINDS))) + ", none double"
    df = spark.createDataFrame([(*row, None) for row in rows], schema).repartition(3)
    found = exact_quantiles(df, df.columns, PROBABILITIES, band_values)
    for values, quantiles in zip(columns, found):
        assert quantiles == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12)
    assert found[-1] == [None] * len(PROBABILITIES)


@pytest.mark.parametrize("band_values", [10, 1_000_000])
def test_describe_equals_pandas(spark, band_values):
    frame = pd.DataFrame({"a": numbers("spread"), "b": numbers("whole")})
    df = spark.createDataFrame(frame).unionByName(spark.createDataFrame([(float("nan"), None)], "a double, b double"))
    found = {row["column"]: row.asDict() for row in profiling.describe(df, ["a", "b"], band_values).collect()}
    for column, expected in frame.describe().round(2).items():
        ours = [found[column][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert ours == pytest.approx(list(expected), abs=0.0101)


def test_describe_infinite_values_and_ties(spark):
    rows = [(1.0,), (2.0,), (math.inf,), (math.inf,), (math.inf,)]
    for band_values in (1, 1_000_000):
        (row,) = profiling.describe(spark.createDataFrame(rows, "v double"), ["v"], band_values).collect()
        assert (row["q25"], row["q50"], row["q75"], row["max"]) == (2.0, math.inf, math.inf, math.inf)


def test_describe_mean_is_exact(spark):
    df = spark.range(30_000).select((F.col("id") * 0.01 + 0.1).alias("v"))
    means = {profiling.describe(df.repartition(n), ["v"]).first()["mean"] for n in (1, 3, 7)}
    assert means == {150.1}


def test_describe_without_rows(spark):
    df = spark.createDataFrame([], "a double")
    (row,) = profiling.describe(df, ["a"]).collect()
    assert row["count"] == 0 and row["mean"] is None and row["q50"] is None


LONG = "word " * 100


def mixed(spark):
    rows = [
        (1, "a", 1.0), (1, "a", 1.0), (1, None, 1.0), (1, None, 1.0), (None, None, None), (None, None, None),
        (2, LONG, float("nan")), (2, LONG, float("nan")), (2, LONG + ".", float("nan")), (3, "", 0.0),
    ]
    return spark.createDataFrame(rows, "i int, s string, x double")


def test_duplicates_equal_pandas(spark):
    df = mixed(spark)
    assert profiling.duplicates(df).first()["duplicate_rows"] == df.toPandas().duplicated().sum() == 4
    assert profiling.duplicates(df.filter("false")).first()["duplicate_rows"] == 0


def test_a_digest_is_not_taken_for_a_text(spark):
    df = spark.createDataFrame([(LONG,)], "s string")
    digest = df.select(F.concat(F.lit("sha256:"), F.sha2("s", 256)).alias("s"))
    assert profiling.duplicates(df.unionByName(digest)).first()["duplicate_rows"] == 0


def test_shape_columns_and_nulls(spark):
    df = mixed(spark)
    assert tuple(profiling.shape(df).first()) == (10, 3)
    assert [tuple(row) for row in profiling.columns(df).collect()] == [
        (0, "i", "int", 8),
        (1, "s", "string", 6),
        (2, "x", "double", 5),
    ]
    # not-a-number is missing, the empty text is not
    assert [tuple(row) for row in profiling.nulls(df).collect()] == [("x", 5, 50.0), ("s", 4, 40.0), ("i", 2, 20.0)]
    assert profiling.nulls(df.filter("i = 3")).collect() == []
    assert profiling.nulls(df.filter("false")).collect() == []


def test_value_counts(spark):
    found = [tuple(row) for row in profiling.value_counts(mixed(spark), ["i", "s"]).collect()]
    assert found == [
        ("i", "1", 4),
        ("i", "2", 3),
        ("i", "3", 1),
        ("s", "a", 2),
        ("s", LONG, 2),
        ("s", "", 1),
        ("s", LONG + ".", 1),
    ]


def test_head_and_row_counts(spark):
    df = mixed(spark)
    assert [row["i"] for row in profiling.head(df, 3, by=["i", "s"]).collect()] == [1, 1, 1]
    counts = profiling.table_row_counts({"all": df, "none": df.filter("false")})
    assert [tuple(row) for row in counts.collect()] == [("all", 10), ("none", 0)]


def test_profile_tables(spark):
    df = mixed(spark)
    found = profiling.profile_tables({"all": df, "none": df.filter("false")}).collect()
    assert [tuple(row) for row in found] == [("all", 10, 3, 4), ("none", 0, 3, 0)]


def test_quantiles_of_many_columns(spark, tmp_path):
    """Of any distribution, at once."""
    rng = np.random.default_rng(5)
    n = 60_000
    columns = {
        "even": rng.random(n), "long": rng.pareto(0.5, n), "ties": rng.integers(0, 50, n) / 7.0,
        "one": np.full(n, 2.5), "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
    }
    spark.createDataFrame(pd.DataFrame(columns)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    df = df.select(*[F.nanvl(name, F.lit(None)).alias(name) for name in df.columns])
    for band_values in (100_000, 40):
        found = exact_quantiles(df, df.columns, PROBABILITIES, band_values)
        for values, quantiles in zip(columns.values(), found):
            assert quantiles == pytest.approx(list(np.quantile(values[~np.isnan(values)], PROBABILITIES)), rel=1e-12)


def test_quantiles_close_to_each_other(spark):
    df = spark.range(100_000).select((F.col("id") % 99_991).cast("double").alias("v"))
    wanted = [0.0, 0.00005, 0.0001, 0.5, 0.5001, 0.99999, 1.0]
    (found,) = exact_quantiles(df, ["v"], wanted)
    assert found == pytest.approx(list(np.quantile(np.arange(100_000) % 99_991, wanted)), rel=1e-12)
