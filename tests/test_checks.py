import pytest
from pyspark.sql import functions as F

from sedimenta.operators import checks as dq
from sedimenta.operators import check_rows, run_checks
from sedimenta.operators.reporting import (
    flatten_report,
    labelled,
    layer_summary,
    nested_report,
    overall_summary,
    report_summary,
    summary_line,
)
from sedimenta.sources import read_reports, write_report

SCHEMA = "id string, amount double, age int, loss date, report date, agent string"
ROWS = [
    ("t1", 10.0, 17, "2020-01-02", "2020-01-01", "a1"),
    ("t1", 0.0, 18, "2020-01-01", "2020-01-01", "a9"),
    ("t2", -1.0, 100, "2020-01-01", "2020-01-08", "a9"),
    (None, None, 101, "2020-01-01", None, None),
    (None, 5.0, None, None, "2020-01-01", "a1"),
]


@pytest.fixture(scope="module")
def tables(spark):
    claims = spark.createDataFrame(ROWS, SCHEMA.replace("date", "string"))
    claims = claims.withColumns({name: F.col(name).cast("date") for name in ("loss", "report")})
    agents = spark.createDataFrame([("a1",), ("a1",), (None,)], "agent string")
    return {"claims": claims, "agents": agents, "none": claims.filter("false")}


def one(tables, check):
    (row,) = check_rows(tables, [check]).collect()
    return row["value"], row["passed"], row["status"]


@pytest.mark.parametrize(
    ("check", "expected"),
    [
        (lambda: dq.row_count_at_least("l", "n", "claims", 5), (5.0, True, "PASS")),
        (lambda: dq.row_count_at_least("l", "n", "claims", 6), (5.0, False, "FAIL")),
        (lambda: dq.not_empty("l", "n", "claims"), (5.0, True, "PASS")),
        (lambda: dq.not_empty("l", "n", "none"), (0.0, False, "FAIL")),
        (lambda: dq.unique("l", "n", "claims", "id"), (3.0, False, "FAIL")),
        (lambda: dq.unique("l", "n", "none", "id"), (0.0, True, "PASS")),
        (lambda: dq.positive("l", "n", "claims", "amount"), (2.0, False, "FAIL")),
        (lambda: dq.in_range("l", "n", "claims", "age", 18, 100), (2.0, False, "FAIL")),
        (lambda: dq.in_order("l", "n", "claims", "loss", "report"), (1.0, False, "FAIL")),
        (lambda: dq.references("l", "n", "claims", "agent", "agents"), (2.0, False, "FAIL")),
        (lambda: dq.references("l", "n", "none", "agent", "agents"), (0.0, True, "PASS")),
        (lambda: dq.no_nulls("l", "n", "claims", "amount"), (20.0, False, "FAIL")),
        (lambda: dq.no_nulls("l", "n", "agents", "agent"), (pytest.approx(100 / 3), False, "FAIL")),
        (lambda: dq.no_nulls("l", "n", "none", "amount"), (None, False, "FAIL")),
        (lambda: dq.every_group_has("l", "n", "claims", "age", 18), (1.0, False, "FAIL")),
        (lambda: dq.totals_reconcile("l", "n", ("claims", "amount"), ("claims", "amount")), (0.0, True, "PASS")),
        (lambda: dq.totals_reconcile("l", "n", ("claims", "amount"), ("claims", "age")), (222.0, False, "FAIL")),
        (lambda: dq.totals_reconcile("l", "n", ("claims", "amount"), ("none", "amount")), (None, False, "ERROR")),
        (lambda: dq.totals_reconcile("l", "n", ("none", "amount"), ("none", "amount")), (None, False, "ERROR")),
    ],
)
def test_check_types(tables, check, expected):
    assert one(tables, check()) == expected


def some_checks():
    return [
        dq.row_count_at_least("bronze", "rows", "claims", 1),
        dq.positive("silver", "positive", "claims", "amount", severity=dq.WARNING),
        dq.no_rows_where("silver", "absent_table", "nowhere", F.col("x") > 0),
        dq.no_rows_where("silver", "absent_column", "claims", F.col("nope") > 0, severity=dq.WARNING),
        dq.unique("gold", "unique", "claims", "id"),
    ]


def test_a_check_that_cannot_be_planned_is_an_error(tables):
    rows = {row["name"]: row for row in check_rows(tables, some_checks()).collect()}
    assert {name: row["status"] for name, row in rows.items()} == {
        "rows": "PASS",
        "positive": "FAIL",
        "absent_table": "ERROR",
        "absent_column": "ERROR",
        "unique": "FAIL",
    }
    assert "nope" in rows["absent_column"]["error"] and rows["absent_column"]["value"] is None
    assert rows["rows"]["error"] is None


def test_nothing_can_be_planned(spark):
    rows = check_rows({}, [dq.not_empty("l", "n", "nowhere")], spark).collect()
    assert [row["status"] for row in rows] == ["ERROR"]


def test_a_check_that_fails_at_run_time_leaves_the_others_alone(tables):
    bad = dq.no_rows_where("silver", "bad_cast", "claims", F.col("id").cast("int") > 0)
    good = dq.row_count_at_least("bronze", "rows", "claims", 1)
    rows = run_checks(tables, [bad, good]).collect()
    assert [(row["name"], row["status"]) for row in rows] == [("bad_cast", "ERROR"), ("rows", "PASS")]
    assert "rows have values that the check cannot take" in rows[0]["error"]


def test_values_that_a_predicate_cannot_take_need_no_second_scan(spark, monkeypatch):
    data = [("1", "2020-01-01", 5.0), ("x", "2020-01-02", 7.0), (None, "none", None), ("0", None, 1e25)]
    frame = spark.createDataFrame(data, "amount string, day string, price double")
    checks = [
        dq.positive("l", "amount", "t", "amount"),
        dq.no_rows_where("l", "day", "t", F.col("day").cast("date").isNull(), ["day"]),
        dq.no_rows_where("l", "price", "t", F.col("price") < 0),
        dq.totals_reconcile("l", "total", ("t", "price"), ("t", "price")),
        dq.row_count_at_least("l", "rows", "t", 4),
    ]
    lazy = check_rows({"t": frame}, checks).collect()
    monkeypatch.setattr("sedimenta.operators.checks.DATA_ERRORS", ())  # nothing is tried again
    rows = run_checks({"t": frame}, checks).collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in lazy)
    assert [(r["status"], r["value"]) for r in rows] == [("ERROR", None), ("ERROR", None), ("PASS", 0.0), ("PASS", 0.0), ("PASS", 4.0)]
    assert rows[0]["error"] == '1 rows have values that the check cannot take, such as {"amount":"x"}'
    assert rows[1]["error"] == '1 rows have values that the check cannot take, such as {"day":"none"}'
    nothing = run_checks({"t": frame.limit(0)}, checks).collect()
    assert [r["status"] for r in nothing] == ["PASS", "PASS", "PASS", "ERROR", "FAIL"]


def test_aggregates_of_other_kinds_are_still_isolated(tables):
    part = dq.Part("claims", F.sum(F.col("id").cast("int")))
    bad = dq.Check("silver", "bad_sum", [part], lambda v: v == 0)
    rows = run_checks(tables, [bad, dq.row_count_at_least("bronze", "rows", "claims", 1)]).collect()
    assert [(row["name"], row["status"]) for row in rows] == [("bad_sum", "ERROR"), ("rows", "PASS")]
    assert "CAST_INVALID_INPUT" in rows[0]["error"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_checks_on_one_table_share_a_scan(spark, tables, tmp_path):
    path = str(tmp_path / "claims")
    tables["claims"].write.parquet(path)
    stored = {"claims": spark.read.parquet(path), "agents": tables["agents"]}
    fused = [
        dq.row_count_at_least("l", "a", "claims", 1),
        dq.positive("l", "b", "claims", "amount"),
        dq.in_range("l", "c", "claims", "age", 18, 100),
        dq.no_nulls("l", "d", "claims", "amount"),
        dq.totals_reconcile("l", "e", ("claims", "amount"), ("claims", "amount")),
    ]
    assert plan(check_rows(stored, fused)).count("parquet") == 1
    anti = plan(check_rows(stored, [dq.references("l", "n", "claims", "agent", "agents")]))
    assert "LeftAnti" in anti and "LeftOuter" not in anti


def test_roll_ups(tables):
    results = run_checks(tables, some_checks())
    layers = {row["layer"]: tuple(row)[1:] for row in layer_summary(results).collect()}
    assert layers == {"bronze": (1, 0, 0), "silver": (0, 1, 2), "gold": (0, 1, 0)}
    overall = overall_summary(results)
    assert tuple(overall.first()) == (5, 1, 2, 2, False)
    line = overall.select(summary_line().alias("line")).first()["line"]
    assert line == "Ran 5 quality checks: 1 passed, 2 critical failures, 2 warnings. Pipeline healthy: False"
    labels = {row["name"]: row["label"] for row in labelled(results).collect()}
    assert labels == {
        "rows": "pass",
        "positive": "warning",
        "absent_table": "critical",
        "absent_column": "warning",
        "unique": "critical",
    }
    # the layers add up to the whole
    totals = layer_summary(results).agg(F.sum("passed"), F.sum("failed_critical"), F.sum("failed_warning")).first()
    assert tuple(totals) == tuple(overall.first())[1:4]


def test_a_warning_leaves_the_data_healthy(tables):
    checks = [dq.positive("silver", "p", "claims", "amount", severity=dq.WARNING)]
    assert overall_summary(run_checks(tables, checks)).first()["pipeline_healthy"] is True


def test_report_round_trip(spark, tables, tmp_path):
    path = str(tmp_path / "reports")
    results = run_checks(tables, some_checks())
    for timestamp in ("2026-01-01T00:00:00", "2026-01-02T00:00:00"):
        write_report(nested_report(results, timestamp), path)
    reports = read_reports(spark, path)
    assert reports.count() == 2
    first = reports.orderBy("timestamp").first()
    assert [layer["layer"] for layer in first["layers"]] == ["bronze", "silver", "gold"]
    assert [c["name"] for c in first["layers"][1]["checks"]] == ["positive", "absent_table", "absent_column"]
    flat = flatten_report(reports.filter("timestamp like '2026-01-01%'")).drop("timestamp")
    expected = labelled(results).drop("position").select(flat.columns)
    assert sorted(flat.collect(), key=repr) == sorted(expected.collect(), key=repr)
    summary = report_summary(reports).drop("timestamp").distinct().collect()
    assert [tuple(row) for row in summary] == [tuple(overall_summary(results).first())]


def test_reads_a_pretty_printed_report(spark, tmp_path):
    (tmp_path / "report.json").write_text(
        """{
          "timestamp": "2026-02-03T04:05:06.789",
          "layers": [
            {"layer": "bronze", "passed": 1, "failed_critical": 0, "failed_warning": 0, "checks": [
              {"name": "n1", "description": "d", "severity": "critical", "value": 12, "passed": true, "status": "PASS"}]},
            {"layer": "silver", "passed": 0, "failed_critical": 0, "failed_warning": 1, "checks": [
              {"name": "n2", "description": "d", "severity": "warning", "value": 0.5, "passed": false, "status": "FAIL"}]}
          ],
          "summary": {"total_checks": 2, "total_passed": 1, "total_critical_failures": 0, "total_warnings": 1,
                      "pipeline_healthy": true}
        }"""
    )
    reports = read_reports(spark, str(tmp_path))
    rows = flatten_report(reports).select("layer", "name", "value", "label").collect()
    assert [tuple(row) for row in rows] == [("bronze", "n1", 12.0, "pass"), ("silver", "n2", 0.5, "warning")]
    assert report_summary(reports).first()["pipeline_healthy"] is True
