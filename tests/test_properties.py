"""Properties that hold for any data."""

import statistics
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.operators import Summary, attach, check_rows, grouped
from sedimenta.operators import checks as dq
from sedimenta.operators.profiling import describe, duplicates
from sedimenta.operators.quantiles import exact_quantiles
from sedimenta.operators.summaries import rows, total

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 5))
cents = st.integers(-(10**9), 10**9).map(lambda n: n / 100)
facts = st.lists(st.tuples(keys, cents), min_size=1, max_size=60)
lookups = st.lists(st.tuples(keys, st.sampled_from("xyz")), max_size=12)


@few
@given(facts, lookups, st.sampled_from(["left", "inner"]))
def test_shuffled_join_equals_nested_loops(spark, left, right, how):
    df = spark.createDataFrame(left, "k int, amount double")
    found = attach(df, spark.createDataFrame(right, "code int, name string"), "k", "code", how, broadcast_bytes=0)
    expected = []
    for k, amount in left:
        names = [name for code, name in right if code == k and k is not None]
        expected += [(k, amount, name) for name in names or ([None] if how == "left" else [])]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


@few
@given(facts)
def test_summary_totals_reconcile(spark, given_rows):
    df = spark.createDataFrame(given_rows, "k int, amount double")
    summary = grouped(df, Summary({"k": F.col("k")}, {"n": rows(), "amount": total("amount")}))
    check = dq.totals_reconcile("gold", "same", ("summary", "amount"), ("facts", "amount"), tolerance=0.005)
    (result,) = check_rows({"summary": summary, "facts": df}, [check]).collect()
    assert result["status"] == "PASS"
    exact = sum(Decimal(str(amount)) for _, amount in given_rows)
    assert grouped(df, Summary({}, {"amount": total("amount")})).first()["amount"] == float(exact)


@few
@given(st.lists(keys, max_size=60), st.lists(keys, max_size=8))
def test_key_checks_equal_counting(spark, children, parents):
    tables = {
        "child": spark.createDataFrame([(k,) for k in children], "k int"),
        "parent": spark.createDataFrame([(k,) for k in parents], "k int"),
    }
    checks = [dq.unique("l", "unique", "child", "k"), dq.references("l", "known", "child", "k", "parent")]
    values = {row["name"]: row["value"] for row in check_rows(tables, checks).collect()}
    assert values["unique"] == len(children) - len(set(children) - {None})
    assert values["known"] == sum(k is not None and k not in parents for k in children)
    assert duplicates(tables["child"]).first()[0] == len(children) - len(set(children))


@few
@given(st.lists(st.floats(-1e9, 1e9), min_size=2, max_size=200))
def test_quartiles_and_deviation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (found,) = exact_quantiles(df, ["v"], (0.25, 0.5, 0.75), band_values=5)
    assert found == pytest.approx(list(np.quantile(values, (0.25, 0.5, 0.75))), rel=1e-9, abs=1e-9)
    row = describe(df, ["v"], band_values=5).first()
    assert row["std"] == pytest.approx(statistics.stdev(values), rel=1e-6, abs=0.01)
