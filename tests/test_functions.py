import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sedimenta.functions import NULL_TOKENS, as_date, null_tokens_to_null, percentage, round2


def values(spark, kind, rows, expr):
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], f"i int, v {kind}")
    return [row["r"] for row in df.orderBy("i").select(expr(F.col("v")).alias("r")).collect()]


def test_null_tokens(spark):
    assert len(NULL_TOKENS) == len(set(NULL_TOKENS)) == 19
    assert values(spark, "string", list(NULL_TOKENS), null_tokens_to_null) == [None] * 19
    kept = ["none", " NA", "NA ", "Null", "0", "-"]
    assert values(spark, "string", [*kept, None], null_tokens_to_null) == [*kept, None]


JUNE = datetime.date(2020, 6, 1)


@pytest.mark.parametrize(
    "text",
    ["2020-06-01", "2020-06-01 00:00:00", "2020/06/01", "2020/06/01 10:11", "2020-6-1", " 2020-06-01 ", "2020-06-01T23:59:59.5"],
)
def test_dates(spark, text):
    assert values(spark, "string", [text, None], as_date) == [JUNE, None]


@pytest.mark.parametrize(
    "text", ["2020", "2020-06", "01-06-2020", "", "bad", "2020-06-01 xyz", "2020-13-01", "2020-06/01", "2020-06-01 25:00",
             "12-4-06-01", "2020-06/01 00:00:00", "2020-6-01x", "abcd-06-01", "2020-06-0x", "2020-06", "1234567-01"]
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_not_dates(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            values(spark, "string", [text], as_date)
        assert values(spark, "string", [text], lambda c: as_date(c, strict=False)) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_round2(spark):
    given = [1.005, 2.675, 1.015, 0.125, -0.125, 2.5, None]
    assert values(spark, "double", given, round2) == [1.0, 2.68, 1.01, 0.13, -0.13, 2.5, None]


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a bigint, b bigint")
    rows = df.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()
    assert rows[0]["p"] == pytest.approx(100 / 3) and rows[1]["p"] is None
