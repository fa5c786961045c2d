"""All files of a folder as one plan, against a plan per header."""

import csv
import json

import insurance_data as data
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sedimenta.plans import insurance
from sedimenta.sources.records import csv_fields


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_fields(spark):
    records = ['a,,"b,c"', '"x ""y"", z",1', "", '""', '"line\nbreak",\x01\x02,"\x01,\x02"', ",", '""""', "plain"]
    df = spark.createDataFrame(list(enumerate(records)), "i int, record string")
    found = {row.i: row.fields for row in df.select("i", csv_fields(F.col("record")).alias("fields")).collect()}
    wanted = [next(csv.reader([record])) if record and "\n" not in record else None for record in records]
    wanted[2], wanted[4] = [""], ["line\nbreak", "\x01\x02", "\x01,\x02"]
    assert [found[i] for i in range(len(records))] == wanted


@pytest.fixture
def mixed(tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n1,p,true\n1.0,p,TRUE\n,q,\n"1","p","true"\n')
    (tmp_path / "b.csv").write_text("x,y,z\n2,p,false\n3,p,true\n")
    (tmp_path / "d.csv").write_text("k\nv\n")
    (tmp_path / "e+ %e.csv").write_text('n,m,"two\nlines"\n1.0,-0.0,NA\n1,0,None\n1,0\n')
    (tmp_path / "f.csv").write_text("n,M,t\n" + "x" * 100 + ",1,\n" + "x" * 100 + ",1,\n")
    (tmp_path / "other.txt").write_text("x\n")
    return tmp_path


def test_same_as_a_plan_per_header(spark, mixed):
    one, many = insurance.explore(spark, str(mixed), "split"), insurance.explore(spark, str(mixed))
    assert rows_of(one.tables) == rows_of(many.tables) == [
        ("a.csv", 4, 3, 1), ("b.csv", 2, 3, 0), ("d.csv", 1, 1, 0), ("e+ %e.csv", 3, 3, 2), ("f.csv", 2, 3, 1)
    ]
    assert rows_of(one.columns) == rows_of(many.columns)
    assert rows_of(one.nulls) == rows_of(many.nulls)
    assert sorted(rows_of(one.first_rows)) == sorted(rows_of(many.first_rows))


def test_the_sources(spark, tmp_path):
    data.write_sources(tmp_path)
    one, many = insurance.explore(spark, str(tmp_path), "split"), insurance.explore(spark, str(tmp_path))
    for part in ("tables", "columns", "nulls", "first_rows"):
        assert sorted(rows_of(getattr(one, part))) == sorted(rows_of(getattr(many, part)))


def test_empty_files_and_headers_alone(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV files"):
        insurance.explore(spark, str(tmp_path), "split")
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("p,q\n")
    found = insurance.explore(spark, str(tmp_path), "split")
    # a file without a byte has no header either, and is no table
    assert rows_of(found.tables) == [("b.csv", 0, 2, 0)]
    assert rows_of(found.columns) == [("b.csv", 0, "p", "string", 0), ("b.csv", 1, "q", "string", 0)]
    assert rows_of(found.nulls) == rows_of(found.first_rows) == []


def test_columns_without_a_name_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,N,,z\n1,2,3,4\n5\n")
    found = insurance.explore(spark, str(tmp_path), "split")
    assert [row[2:] for row in rows_of(found.columns)] == [
        ("n0", "bigint", 2), ("N1", "bigint", 1), ("_c2", "bigint", 1), ("z", "bigint", 1)
    ]
    assert json.loads(rows_of(found.first_rows)[1][1]) == {"n0": "5", "N1": None, "_c2": None, "z": None}


def test_too_many_fields_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("p,q\n1,2\n1,2,3\n")
    with pytest.raises(PySparkException, match="more fields than the header in a.csv"):
        insurance.explore(spark, str(tmp_path), "split")


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path):
    plans = []
    for n in (2, 40):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(f"c{i},d\n{i},x\n{i},x\n")
        found = insurance.explore(spark, str(folder), "split", n_first=1)
        assert rows_of(found.tables.agg(F.sum("duplicate_rows"), F.count("*"))) == [(n, n)]
        assert all(json.loads(row) == {f"c{name[:-4]}": name[:-4], "d": "x"} for name, row in rows_of(found.first_rows))
        plans.append([str(df._jdf.queryExecution().optimizedPlan()).count("\n") for df in (found.tables, found.columns)])
    assert plans[0] == plans[1]
