"""Snapshots of the catalog, builds at once, and reads that open one file."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from sedimenta.sources import ConflictError, Warehouse
from sedimenta.sources.snapshots import create_if_absent, newest, snapshot_path


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_of_two_builds_of_a_table_one_wins_whole(spark, warehouse):
    other = Warehouse(spark, warehouse.root)

    def late(run_id):
        other.replace("bronze", {"a": spark.range(1)})
        return spark.range(2)

    with pytest.raises(ConflictError, match="another build in the meantime: a"):
        warehouse.replace("bronze", {"a": late, "b": spark.range(3)})
    assert [(row["table_name"], row["n_rows"]) for row in warehouse.tables().collect()] == [("a", 1)]
    warehouse.replace("bronze", {"a": spark.range(2), "b": spark.range(3)})
    assert warehouse.read("a").count() == 2 and warehouse.read("b").count() == 3


def test_builds_of_other_tables_at_once_both_count(spark, warehouse):
    def meanwhile(run_id):
        Warehouse(spark, warehouse.root).replace("gold", {"c": spark.range(4)})
        return spark.range(2)

    warehouse.replace("bronze", {"a": meanwhile})
    assert {row["table_name"]: row["n_rows"] for row in warehouse.tables().collect()} == {"a": 2, "c": 4}
    assert warehouse.version() == 2


def test_many_builds_at_once(spark, warehouse):
    def build(i):
        try:
            return i, Warehouse(spark, warehouse.root).replace("bronze", {"shared": spark.range(i), f"own{i}": spark.range(i)})
        except ConflictError:
            return i, None

    with ThreadPoolExecutor(6) as pool:
        won = [i for i, counts in pool.map(build, range(6)) if counts]
    assert won and warehouse.version() == len(won)
    found = {row["table_name"]: row["n_rows"] for row in warehouse.tables().collect()}
    assert set(found) == {"shared", *(f"own{i}" for i in won)} and found["shared"] in won


def test_one_writer_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "folder" / "name")
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda i: create_if_absent(spark, path, str(i).encode()), range(8)))
    assert done.count(True) == 1
    assert (tmp_path / "folder" / "name").read_text() == str(done.index(True))
    assert [x.name for x in (tmp_path / "folder").iterdir() if not x.name.startswith(".")] == ["name"]


def test_a_read_opens_one_file(spark, warehouse):
    for i in range(5):
        warehouse.replace("bronze", {"a": spark.range(i), f"b{i}": spark.range(1)})
    assert newest(spark, f"{warehouse.root}/snapshots") == 5
    assert [path.rsplit("/", 1)[1] for path in warehouse.tables().inputFiles()] == [snapshot_path("x", 5)[2:]]
    assert warehouse.tables().count() == 6
    assert warehouse.read("a").count() == 4 and warehouse.read("a", version=2).count() == 1
    assert warehouse.tables(version=1).count() == 2


def test_a_catalog_of_an_earlier_release(spark, tmp_path, warehouse):
    spark.range(3).write.parquet(str(tmp_path / "old"))
    (tmp_path / "warehouse" / "catalog").mkdir(parents=True)
    rows = [
        {"run_id": run, "layer": "bronze", "table_name": "a", "n_rows": n, "path": str(tmp_path / path)}
        for run, n, path in (("1", 9, "gone"), ("2", 3, "old"))
    ]
    (tmp_path / "warehouse" / "catalog" / "part.json").write_text("".join(json.dumps(row) + "\n" for row in rows))
    assert warehouse.read("a").count() == 3
    warehouse.replace("bronze", {"b": spark.range(1)})
    assert {row["table_name"]: row["n_rows"] for row in warehouse.row_counts().collect()} == {"a": 3, "b": 1}
