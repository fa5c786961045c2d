"""CSV records read in splits, against the standard library's reader and whole-file reads."""

import csv
import random
from contextlib import contextmanager

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sedimenta.sources import read_csv
from sedimenta.sources.records import csv_records, field_count


@contextmanager
def blocks_of(spark, n_bytes):
    settings = {"spark.sql.files.maxPartitionBytes": n_bytes, "spark.sql.files.openCostInBytes": n_bytes}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, str(value))
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(folder, name, rows, **options):
    with open(folder / name, "w", newline="") as file:
        csv.writer(file, **{"lineterminator": "\n", **options}).writerows(rows)


def written(folder, n_files=3, n_rows=30, seed=1):
    rng = random.Random(seed)
    files = {}
    for i in range(n_files):
        texts = [
            "".join(rng.choice(["x", "y", '"', ",", "\n", "é", "\r\n", " "]) for _ in range(rng.choice([0, 3, 30, 300])))
            for _ in range(2 * n_rows)
        ]
        rows = [["a", "b", "c"], *([str(j), *texts[2 * j : 2 * j + 2]] for j in range(n_rows))]
        write(folder, f"{i}.csv", rows, lineterminator="\r\n" if i == 1 else "\n")
        files[f"{i}.csv"] = rows
    return files


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("n_bytes", [211, 2000, 1 << 20])
def test_records_of_any_blocks(spark, tmp_path, n_bytes, broadcast_bytes):
    files = written(tmp_path)
    with blocks_of(spark, n_bytes):
        records = csv_records(spark, str(tmp_path), broadcast_bytes).withColumn("n", field_count(F.col("record")))
        found = sorted(records.collect())
    for name, rows in files.items():
        mine = [row for row in found if row.path.endswith(name)]
        assert [next(csv.reader([row.record + "\n"], strict=True)) if "\n" not in row.record else None for row in mine] == [
            row if not any("\n" in field for field in row) else None for row in rows
        ]
        assert list(csv.reader("\n".join(row.record for row in mine).splitlines(keepends=True))) == rows
        assert {row.n for row in mine} == {3} and (mine[0].start, mine[0].position) == (0, 0)
    if n_bytes == 211:
        assert len({(row.path, row.start) for row in found}) > 20


def test_split_equals_whole_files(spark, tmp_path):
    written(tmp_path, seed=2)
    types = {"a": "int"}
    whole = read_csv(spark, str(tmp_path), types, file_name="file")
    with blocks_of(spark, 307):
        split = read_csv(spark, str(tmp_path), types, "split", file_name="file")
        assert split.dtypes == whole.dtypes
        # whole files whose lines end in \r\n lose the \r inside quotes too
        same = [F.replace(name, F.lit("\r\n"), F.lit("\n")).alias(name) for name in ("b", "c")]
        mine, theirs = (df.select("a", *same, "file").collect() for df in (split, whole))
        assert sorted(mine, key=repr) == sorted(theirs, key=repr)
        assert split.count() == 90 and split.select("b").filter("a = 7").count() == 3


def test_blank_lines_and_short_and_long_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('\n\na,b\n1,2\n\n1,2,3\n"x,y",2\n"x\n,y",2,\nshort\n"q""q,",2,3,4\n""\n')
    found = read_csv(spark, str(tmp_path), multi_line="split", extra_fields="flag").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [
            ("1", "2", False),
            ("1", "2", True),
            ("x,y", "2", False),
            ("x\n,y", "2", True),
            ("short", None, False),
            ('q"q,', "2", True),
            (None, None, False),
        ],
        key=repr,
    )
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_csv(spark, str(tmp_path), multi_line="split").collect()


@pytest.mark.parametrize("row", ['5" pipe,x', 'a,"open', '"a" ,b', 'x,"a"b'])
def test_quotes_out_of_place_fail(spark, tmp_path, row):
    (tmp_path / "x.csv").write_text(f"a,b\n1,2\n{row}\n3,4\n")
    with pytest.raises(PySparkException, match="a quote inside a field"):
        read_csv(spark, str(tmp_path), multi_line="split").collect()


def test_headers_are_checked(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"a\nb",,c,c\n1,2,3,4\n')
    split = read_csv(spark, str(tmp_path), multi_line="split")
    assert split.columns == ["a\nb", "_c1", "c2", "c3"] and [tuple(row) for row in split.collect()] == [("1", "2", "3", "4")]
    (tmp_path / "y.csv").write_text("a,b,c,d\n1,2,3,4\n")
    with pytest.raises(PySparkException, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path), multi_line="split").collect()


def test_header_only_and_compressed(spark, tmp_path):
    import gzip

    (tmp_path / "x.csv").write_text("a,b")
    assert read_csv(spark, str(tmp_path), multi_line="split").collect() == []
    with gzip.open(tmp_path / "y.csv.gz", "wt") as file:
        file.write('a,b\n"1\n2",3\n')
    assert [tuple(row) for row in read_csv(spark, str(tmp_path), multi_line="split").collect()] == [("1\n2", "3")]
