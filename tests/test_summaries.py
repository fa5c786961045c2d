import itertools

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import CleanSpec, Summary, attach, clean, grouped, grouped_before_attach, ordered, summarise
from sedimenta.operators.summaries import largest, mean_money, mean_whole, rows, rows_where, share_where, total

def measures():
    return {
        "n": rows(),
        "amount": total("x"),
        "mean": mean_money("x"),
        "mean_days": mean_whole("days"),
        "most": largest("x"),
        "late": rows_where(F.col("days") > 7),
        "late_pct": share_where(F.col("days") > 7),
    }


def frame(spark):
    rows_ = [("a", 1.005, 7), ("a", 2.0, 8), ("b", None, None), ("b", 0.1, -3), (None, 5.5, 8), (None, 0.0, 8)]
    return spark.createDataFrame(rows_, "k string, x double, days int")


def test_measures(spark):
    spec = Summary({"k": F.col("k")}, measures(), order=("-amount",))
    found = [tuple(row) for row in summarise(frame(spark), spec).collect()]
    assert found == [
        (None, 2, 5.5, 2.75, 8.0, 5.5, 2, 100.0),
        ("a", 2, 3.005, 1.5, 7.5, 2.0, 1, 50.0),
        ("b", 2, 0.1, 0.1, -3.0, 0.1, 0, 0.0),
    ]


def test_group_without_values(spark):
    spec = Summary({"k": F.col("k")}, measures())
    empty = spark.createDataFrame([("z", None, None)], "k string, x double, days int")
    assert [tuple(row) for row in summarise(empty, spec).collect()] == [("z", 1, None, None, None, None, 0, 0.0)]
    assert summarise(empty.filter("false"), spec).collect() == []


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, n int")
    spec = Summary({"k": F.col("k")}, {"n": rows()}, order=("-n",))
    assert [row["k"] for row in ordered(df, spec).collect()] == [None, "a", "b"]
    by_key = Summary({"k": F.col("k")}, {}, order=("k",))
    assert [row["k"] for row in ordered(df, by_key).collect()] == ["a", "b", None]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_grouping_before_the_join_changes_nothing(spark, options):
    """Also with an agent listed three times, twice under the same name."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("agent"),
        (F.col("id") * 0.37).alias("x"),
        (F.col("id") % 15).cast("int").alias("days"),
    )
    names = spark.createDataFrame(
        [(1, "Ann", "A"), (1, "Ann", "A"), (1, "Bob", "B"), (2, "Cy", None)] + [(i, f"n{i}", "C") for i in range(5, 30)],
        "agent int, name string, state string",
    )
    spec = Summary({c: F.col(c) for c in ("agent", "name", "state")}, measures(), required=("agent",))
    after = grouped(attach(df, names, "agent"), spec)
    before = grouped_before_attach(df, spec, names, "agent", **options)
    assert after.columns == before.columns
    assert sorted(before.collect(), key=repr) == sorted(after.collect(), key=repr)


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") * 0.01 + 0.1).alias("x"),
                                    (F.col("id") % 30).cast("int").alias("days"))
    spec = Summary({"k": F.col("k")}, measures(), order=("k",))
    results = [summarise(df.repartition(n), spec).collect() for n in (1, 3, 8)]
    assert all(a == b for a, b in itertools.pairwise(results))


def test_small_amounts_are_not_rounded_away(spark):
    spec = Summary({"k": F.col("k")}, {"amount": total("x"), "mean": mean_money("x")})
    df = spark.range(1000).select(F.lit("a").alias("k"), F.lit(0.004).alias("x"))
    assert [tuple(r) for r in summarise(df, spec).collect()] == [("a", 4.0, 0.0)]


@pytest.mark.parametrize("amount", [1e25, 1e-20, 1 / 300, float("inf")])
def test_no_amount_fails(spark, amount):
    df = spark.createDataFrame([("a", amount)], "k string, x double")
    assert summarise(df, Summary({"k": F.col("k")}, {"amount": total("x")})).collect() == [("a", amount)]


def test_totals_add_up(spark):
    df = frame(spark)
    spec = Summary({"k": F.col("k")}, {"n": rows(), "amount": total("x")})
    summary = summarise(df, spec).agg(F.sum("n"), F.sum("amount")).first()
    assert summary[0] == df.count() and summary[1] == pytest.approx(8.605, abs=1e-12)


RAW = [("c1", 10, "2020-01-01"), ("c1", 10, "2020-01-01"), (None, 10, "2020-01-01"), ("c2", 0, "x"), ("c3", -1, "x"),
       ("c4", None, "x"), ("c5", 5, None)]


def test_clean_filters_raw_columns_then_derives(spark):
    df = spark.createDataFrame(RAW, "city string, amount int, day string")
    spec = CleanSpec(
        select=[F.coalesce("city", F.lit("Unknown")).alias("city"), "amount", F.col("day").cast("date").alias("day")],
        required=("city",),
        positive=("amount",),
        derived={"next": F.date_add("day", 1)},
    )
    cleaned = clean(df, spec)
    assert cleaned.columns == ["city", "amount", "day", "next"]
    assert sorted((row["city"], row["amount"]) for row in cleaned.collect()) == [("c1", 10), ("c5", 5)]


def test_distinct_is_idempotent(spark):
    df = spark.createDataFrame(RAW, "city string, amount int, day string")
    spec = CleanSpec(select=["city", "amount", "day"])
    once = clean(df, spec)
    assert once.count() == 6
    assert sorted(clean(once, spec).collect(), key=repr) == sorted(once.collect(), key=repr)
