import datetime
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sedimenta.functions import NULL_TOKENS
from sedimenta.operators.drift import header_drift, missing_sources, schema_drift, source_status
from sedimenta.sources import Warehouse, csv_columns, read_csv, source_files, staged
from sedimenta.sources.staging import clear_staged, staging_folder


def write(folder, text, name="data.csv"):
    path = folder / name
    path.write_text(text)
    return str(path)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_declared_types_and_null_tokens(spark, tmp_path):
    text = "id,n,amount,day,extra\n" + "1,12,3.50,2020-06-01,007\n" + "2,13.0,,2020-06-02,NA\n"
    df = read_csv(spark, write(tmp_path, text), {"id": "string", "n": "int", "amount": "decimal(18,2)", "day": "date"})
    assert df.dtypes == [
        ("id", "string"), ("n", "int"), ("amount", "decimal(18,2)"), ("day", "date"), ("extra", "string"),
    ]
    assert rows_of(df) == [
        ("1", 12, decimal.Decimal("3.50"), datetime.date(2020, 6, 1), "007"),
        ("2", 13, None, datetime.date(2020, 6, 2), None),
    ]


def test_every_null_token(spark, tmp_path):
    text = "i,v\n" + "".join(f'{i},"{token}"\n' for i, token in enumerate(NULL_TOKENS)) + "99, NA\n"
    df = read_csv(spark, write(tmp_path, text))
    assert df.filter("v is null").count() == len(NULL_TOKENS)
    assert rows_of(df.filter("v is not null")) == [("99", " NA")]


def test_dialect(spark, tmp_path):
    text = 'a,b,c\n"line one\nline two","say ""hi"", ok",  padded\nshort,1\n\nlast,2,3\n'
    assert rows_of(read_csv(spark, write(tmp_path, text))) == [
        ("last", "2", "3"),
        ("line one\nline two", 'say "hi", ok', "  padded"),
        ("short", "1", None),
    ]


@pytest.mark.parametrize("multi_line", [True, False])
def test_extra_fields(spark, tmp_path, multi_line):
    text = 'a,b\n1,2\n1,2,3\n"x,y",2\n"x,y",2,\nshort\n"q""q,",2,3,4\n'
    path = write(tmp_path, text)
    flagged = read_csv(spark, path, multi_line=multi_line, extra_fields="flag")
    assert rows_of(flagged) == [
        ("1", "2", False),
        ("1", "2", True),
        ('q"q,', "2", True),
        ("short", None, False),
        ("x,y", "2", False),
        ("x,y", "2", True),
    ]
    assert flagged.filter("extra_fields").count() == 3
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_csv(spark, path, multi_line=multi_line).collect()
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_csv(spark, path, multi_line=multi_line).count()


def test_a_break_inside_quotes_needs_multi_line(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"one\ntwo"\n2,x\n')
    assert read_csv(spark, path).count() == 2
    with pytest.raises(PySparkException, match="line break inside quotes"):
        read_csv(spark, path, multi_line=False).collect()


def test_bad_value_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        read_csv(spark, write(tmp_path, "n\nten\n"), {"n": "int"}).collect()


def test_missing_column_is_named(spark, tmp_path):
    with pytest.raises(ValueError, match="amount"):
        read_csv(spark, write(tmp_path, "a,b\n1,2\n"), {"a": "int", "amount": "int"})


def test_files_with_different_headers_fail(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "one.csv")
    write(tmp_path, "b,a\n1,2\n", "two.csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path)).collect()


def test_listing_and_headers(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "one.csv")
    write(tmp_path, "x", "other.txt")
    files = source_files(spark, str(tmp_path), "*.csv")
    assert [(row["file_name"], row["n_bytes"]) for row in files.collect()] == [("one.csv", 8)]
    assert source_files(spark, str(tmp_path / "absent"), "*.csv").count() == 0
    assert csv_columns(spark, str(tmp_path / "one.csv")) == ["a", "b"]


def test_drift(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, c string")
    drift = schema_drift({"t": ["a", "b"], "gone": ["z"]}, {"t": df})
    assert rows_of(drift) == [
        ("gone", "z", "missing", None),
        ("t", "a", "ok", None),
        ("t", "b", "missing", None),
        ("t", "c", "unexpected", 0),
    ]
    headers = header_drift(spark, {"t": ["a", "b"]}, {"t": ["a", "c"]})
    assert rows_of(headers) == [("t", "a", "ok"), ("t", "b", "missing"), ("t", "c", "unexpected")]


def test_missing_sources(spark, tmp_path):
    write(tmp_path, "a\n", "a.csv")
    (tmp_path / "c.csv").mkdir()
    write(tmp_path / "c.csv", "a\n", "part-0.csv")
    expected = {"one": "a.csv", "two": "b.csv", "three": "c.csv"}
    assert rows_of(missing_sources(spark, str(tmp_path), expected)) == [("two", "b.csv", True)]
    counts = spark.createDataFrame([("a.csv", 0), ("c.csv", 5)], "file_name string, n_rows bigint")
    assert rows_of(source_status(expected, counts)) == [
        ("one", "a.csv", "ok", 0),
        ("three", "c.csv", "ok", 5),
        ("two", "b.csv", "missing", None),
    ]


def test_warehouse_replaces_layers_as_a_whole(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    assert warehouse.tables().count() == 0
    with pytest.raises(LookupError):
        warehouse.read("a")
    empty = spark.range(0)
    assert warehouse.replace("bronze", {"a": spark.range(3), "b": empty}) == {"a": 3, "b": 0}
    old = warehouse.read("a")
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(PySparkException):
        warehouse.replace("bronze", {"a": spark.range(9), "b": broken})
    assert warehouse.read("a").count() == 3
    # a table can be rebuilt from its own last version
    warehouse.replace("bronze", {"a": old.unionByName(spark.range(1)), "b": lambda run: warehouse.staged(run, "a")})
    assert old.count() == 3 and warehouse.read("a").count() == 4
    assert rows_of(warehouse.row_counts()) == [("bronze", "a", 4), ("bronze", "b", 4)]


def test_clearing_what_was_staged(spark, tmp_path):
    folder = str(tmp_path / "staged")
    df = staged(spark.range(4), folder)
    assert df.count() == 4 and (tmp_path / "staged").exists()
    clear_staged(spark, folder)
    assert not (tmp_path / "staged").exists()


def test_staging_needs_a_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_folder(Session())


def test_staged_uses_the_checkpoint_folder(spark):
    df = staged(spark.range(4))
    assert df.count() == 4
    assert all("staged-" in path and "checkpoints" in path for path in df.inputFiles())
