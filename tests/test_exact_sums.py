import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import exact_sums
from sedimenta.operators.summaries import Summary, grouped, mean_money, rows, total

RNG = random.Random(17)
TINY = 5e-324
GROUPS = {
    "thirds of cents": [n / 300 for n in range(1, 400)],
    "mixture": [1 / 300, 1e-20, 1e25, 0.1, 0.2, -1e25, 7e9],
    "cancels": [1e300, 1.0, -1e300, 1e-300, -1.0],
    "negative": [-0.1] * 10 + [-1e-30, -3e40],
    "least": [TINY, TINY, -3 * TINY, 2.5e-310],
    "largest": [1.7e308, -1.7e308, 1.5e308],
    "too large": [1.7e308, 1.7e308],
    "ties": [2.0**53, 1.0, 2.0**-1074],
    "ties down": [2.0**53, 1.0, -(2.0**-1074)],
    "even": [2.0**53, 1.0],
    "many large": [2.0**41 - 0.5] * 3000 + [2.0**-60],
    "zero": [0.0, -0.0], "nulls": [None, None], "some": [None, 2.5],
    "infinite": [1.0, math.inf], "both": [math.inf, -math.inf, 1.0], "nan": [math.nan, 1.0, 1e300], "one": [-123.456],
    "tenths": [0.1, 0.2], "micro": [1e-6, 2.000001, -3e-6], "tenths and less": [0.1, 0.2, 1e-7],
    "amounts": [round(RNG.uniform(-1e5, 1e5), 2) for _ in range(2000)],
    "wide": [RNG.uniform(-1, 1) * 2.0 ** RNG.randint(-1060, 1000) for _ in range(3000)],
    "near the edges": [s * 2.0**e * (1 + RNG.random()) for e in (-12, -11, -10, -9, 40, 41, 42, 43) for s in (1, -1, 1)],
}


def plain(values):
    values = [x for x in values if x is not None]
    if not values:
        return None
    if all(abs(x) < 2**33 and round(x * 1e6) / 1e6 == x for x in values):
        return float(sum(Decimal(round(x * 1e6)) for x in values) / 1_000_000)
    if any(math.isnan(x) for x in values) or {math.inf, -math.inf} <= set(values):
        return math.nan
    try:
        return math.fsum(values)
    except OverflowError:
        return math.inf


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_equal_to_fsum_in_any_partitioning(spark, partitions):
    data = [(name, x, k) for name, values in GROUPS.items() for k, x in enumerate(values)]
    random.Random(partitions).shuffle(data)
    df = spark.createDataFrame(data, "name string, amount double, k int").repartition(partitions, "k")
    spec = Summary(keys={"name": F.col("name")}, measures={"n": rows(), "total": total("amount"), "mean": mean_money("amount")})
    found = {r["name"]: r for r in grouped(df, spec).collect()}
    assert set(found) == set(GROUPS)
    for name, values in GROUPS.items():
        assert same(found[name]["total"], plain(values)), name
        assert found[name]["n"] == len(values)


def test_single_aggregate(spark):
    for values in GROUPS.values():
        df = exact_sums.with_digits(spark.createDataFrame([(x,) for x in values], "x double"), {"t": F.col("x")})
        sums = df.groupBy(exact_sums.band("t")).agg(*exact_sums.sums("t"))
        assert same(sums.agg(exact_sums.total_of("t").alias("t")).first()["t"], plain(values))


def test_powers_of_two_are_exact(spark):
    found = spark.range(-640, 641).select("id", F.pow(F.lit(2.0), F.col("id")).alias("p")).collect()
    assert all(r.p == 2.0**r.id for r in found)


def test_two_columns_and_no_rows(spark):
    df = spark.createDataFrame([("a", 0.1, 1e-30), ("a", 0.2, 1e30), ("b", 1e18, None)], "k string, x double, y double")
    spec = Summary(keys={"k": F.col("k")}, measures={"x": total("x"), "y": total("y"), "n": rows()})
    assert {tuple(r) for r in grouped(df, spec).collect()} == {("a", 0.3, 1e30, 2), ("b", 1e18, None, 1)}
    assert grouped(df.limit(0), spec).collect() == []
