"""Invented claims from CSV to the quality report."""

from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import insurance_data as data
from sedimenta import __main__ as command_line
from sedimenta.functions import NULL_TOKENS
from sedimenta.operators.reporting import flatten_report, overall_summary
from sedimenta.plans import insurance
from sedimenta.sources import Warehouse, read_reports


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("sources")
    data.write_sources(path)
    return path


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    warehouse = Warehouse(spark, str(root))
    results = insurance.build_all(warehouse, str(folder), str(root / "reports"))
    return warehouse, results


def silver_rows():
    """The claims expected in silver, from the generator's rows."""
    kept = {}
    for row in data.claims():
        amount, city = row["CLAIM_AMOUNT"], row["CITY"]
        if amount not in NULL_TOKENS and Decimal(amount) > 0 and city not in NULL_TOKENS:
            kept[tuple(v for k, v in row.items() if k != "ADDRESS_LINE2" and k not in data.EXTRA)] = row
    return list(kept.values())


def test_row_counts(built):
    warehouse, _ = built
    counts = {row["table_name"]: row["n_rows"] for row in warehouse.row_counts().collect()}
    n_silver = data.N_CLAIMS - data.DROPPED_CLAIMS
    assert len(silver_rows()) == n_silver
    assert counts["bronze_insurance"] == data.N_CLAIMS + data.COPIES
    assert counts["bronze_employees"] == data.N_EMPLOYEES + 1
    assert counts["bronze_vendors"] == data.N_VENDORS
    assert counts["silver_insurance"] == n_silver
    assert counts["silver_employees"] == data.FIRST_WITHOUT_CITY + 1
    assert counts["silver_vendors"] == data.N_VENDORS
    twice = sum(row["AGENT_ID"] == "A0005" for row in silver_rows())
    assert twice and counts["silver_claims_enriched"] == n_silver + twice
    assert len(counts) == 12
    assert all(warehouse.read(name).count() == n for name, n in counts.items())


def test_widths(built):
    warehouse, _ = built
    widths = {name: len(warehouse.read(name).columns) for name in
              ("bronze_insurance", "silver_insurance", "silver_employees", "silver_vendors", "silver_claims_enriched")}
    assert list(widths.values()) == [38, 35, 7, 6, 40]


def test_cleaning(built):
    warehouse, _ = built
    claims = warehouse.read("silver_insurance")
    assert dict(claims.dtypes)["loss_date"] == "date"
    assert "address_line2" not in claims.columns
    authority = {row[0] for row in claims.select("authority_contacted").distinct().collect()}
    assert authority == {"Police", "Ambulance", "None"}
    assert {row[0] for row in claims.select("incident_city").distinct().collect()} == {"Ashby", "Unknown"}
    days = Counter(row[0] for row in claims.select("days_to_report").collect())
    assert set(days) >= {0, 1, 6, 7, 8, 30} and sum(1 for d in days if d < 0) >= 1


def test_shuffled_enrichment_is_the_same(built):
    warehouse, _ = built
    parts = [warehouse.read(f"silver_{name}") for name in ("insurance", "employees", "vendors")]
    shuffled = insurance.silver_claims_enriched(*parts, broadcast_bytes=0)
    stored = warehouse.read("silver_claims_enriched")
    assert shuffled.columns == stored.columns
    assert shuffled.exceptAll(stored).count() == 0 and stored.exceptAll(shuffled).count() == 0


def weight(row):
    return 2 if row["AGENT_ID"] == "A0005" else 1


def test_state_summary(built):
    warehouse, _ = built
    expected = defaultdict(lambda: [0, Decimal(0), 0])
    for row in silver_rows():
        group = expected[row["STATE"]]
        group[0] += weight(row)
        group[1] += weight(row) * Decimal(row["CLAIM_AMOUNT"])
        group[2] += weight(row) * (row["RISK_SEGMENTATION"] == "H")
    found = insurance.read_gold(warehouse, "gold_state_risk_summary").collect()
    assert {row["state"]: [row["total_claims"], row["high_risk_claims"]] for row in found} == {
        state: [n, risky] for state, (n, _, risky) in expected.items()
    }
    for row in found:
        n, amount, risky = expected[row["state"]]
        assert row["total_claim_amount"] == float(amount)
        assert row["avg_claim_amount"] == pytest.approx(float(amount / n), abs=0.0051)
        assert row["high_risk_pct"] == pytest.approx(100 * risky / n, abs=0.0051)
    totals = [row["total_claim_amount"] for row in found]
    assert totals == sorted(totals, reverse=True)


def test_other_summaries(built):
    warehouse, _ = built
    rows = silver_rows()
    agents = {row["agent_id"]: row for row in insurance.read_gold(warehouse, "gold_agent_performance").collect()
              if row["agent_name"] != "Agent five"}
    per_agent = Counter(row["AGENT_ID"] for row in rows if row["AGENT_ID"])
    assert {agent: row["total_claims_processed"] for agent, row in agents.items()} == dict(per_agent)
    orphans = [row for agent, row in agents.items() if int(agent[1:]) >= data.FIRST_WITHOUT_CITY]
    assert orphans and all(row["agent_name"] is None for row in orphans)

    vendors = insurance.read_gold(warehouse, "gold_vendor_statistics").collect()
    per_vendor = Counter()
    for row in rows:
        if row["VENDOR_ID"]:
            per_vendor[row["VENDOR_ID"]] += weight(row)
    assert {row["vendor_id"]: row["total_claims"] for row in vendors} == dict(per_vendor)

    fraud = insurance.read_gold(warehouse, "gold_fraud_indicators").collect()
    assert len(fraud) == 9
    assert sum(row["no_authority_contact"] for row in fraud) == sum(
        weight(row) for row in rows if row["AUTHORITY_CONTACTED"] == "None"
    )
    assert sum(row["no_police_report"] for row in fraud) == sum(
        weight(row) for row in rows if row["POLICE_REPORT_AVAILABLE"] == "0"
    )

    months = insurance.read_gold(warehouse, "gold_monthly_claim_summary").collect()
    keys = [(row["month"], row["insurance_type"]) for row in months]
    assert keys == sorted(sorted(keys, key=lambda k: k[1]), key=lambda k: k[0], reverse=True)
    assert all(month.day == 1 for month, _ in keys)
    assert sum(row["approved_claims"] + row["denied_claims"] for row in months) == sum(weight(row) for row in rows)


def test_checks(built):
    _, results = built
    found = {row["name"]: (row["value"], row["status"]) for row in results.collect()}
    assert found == {
        "bronze_insurance_row_count": (float(data.N_CLAIMS + data.COPIES), "PASS"),
        "bronze_employees_row_count": (float(data.N_EMPLOYEES + 1), "PASS"),
        "bronze_vendors_row_count": (float(data.N_VENDORS), "PASS"),
        "silver_transaction_id_unique": (1.0, "FAIL"),
        "silver_claim_amount_positive": (0.0, "PASS"),
        "silver_age_valid_range": (2.0, "FAIL"),
        "silver_claim_dates_valid": (2.0, "FAIL"),
        "silver_agent_id_referential": (float(data.ORPHANS), "FAIL"),
        "silver_claim_amount_null_pct": (0.0, "PASS"),
        "gold_state_summary_nonempty": (4.0, "PASS"),
        "gold_total_matches_silver": (0.0, "PASS"),
        "gold_agent_performance_valid": (0.0, "PASS"),
    }
    assert tuple(overall_summary(results).first()) == (12, 8, 2, 2, False)


def test_stored_report(spark, built):
    warehouse, results = built
    reports = read_reports(spark, f"{warehouse.root}/reports")
    assert reports.count() == 1
    layers = reports.first()["layers"]
    assert [(layer["layer"], len(layer["checks"])) for layer in layers] == [("bronze", 3), ("silver", 6), ("gold", 3)]
    assert flatten_report(reports).count() == results.count()


def test_checks_without_tables_are_errors(spark, tmp_path):
    results = insurance.check_quality(Warehouse(spark, str(tmp_path)))
    assert {row["status"] for row in results.collect()} == {"ERROR"}
    assert overall_summary(results).first()["pipeline_healthy"] is False


def test_sources(spark, folder, tmp_path):
    assert insurance.absent_sources(spark, str(folder)).count() == 0
    assert insurance.absent_sources(spark, str(tmp_path)).count() == 3
    with pytest.raises(ValueError, match="unknown source"):
        insurance.read_source(spark, str(folder), "payments")
    drift = insurance.source_drift(spark, str(folder)).filter("status <> 'ok'")
    assert [(row["source"], row["column"], row["status"]) for row in drift.collect()] == [
        (source, name, "unexpected")
        for source, names in (("employees", data.EXTRA), ("insurance", data.EXTRA), ("vendors", ["ADDRESS_LINE2"]))
        for name in sorted(names)
    ]


def test_renamed_column_is_drift(spark, tmp_path):
    rows = [{("MANAGER" if k == "AGENT_NAME" else k): v for k, v in row.items()} for row in data.employees()]
    data.write_csv(tmp_path / "employee_data.csv", rows)
    drift = insurance.source_drift(spark, str(tmp_path)).filter("status = 'missing'")
    assert [row["column"] for row in drift.collect()] == ["AGENT_NAME"]
    with pytest.raises(ValueError, match="AGENT_NAME"):
        insurance.read_source(spark, str(tmp_path), "employees")


def test_explore(spark, folder, tmp_path):
    found = insurance.explore(spark, str(folder))
    assert {row["table_name"]: tuple(row)[1:] for row in found.tables.collect()} == {
        "employee_data.csv": (data.N_EMPLOYEES + 1, 10, 0),
        "insurance_data.csv": (data.N_CLAIMS + data.COPIES, 38, data.COPIES),
        "vendor_data.csv": (data.N_VENDORS, 7, 0),
    }
    assert found.columns.count() == 10 + 38 + 7
    shares = {(row["table_name"], row["column"]): row["null_pct"] for row in found.nulls.collect()}
    assert 80 < shares["insurance_data.csv", "ADDRESS_LINE2"] < 90
    assert 28 < shares["insurance_data.csv", "VENDOR_ID"] < 37
    assert shares["vendor_data.csv", "ADDRESS_LINE2"] == 100.0
    types = {(row["table_name"], row["column"]): row["type"] for row in found.columns.collect()}
    assert types["insurance_data.csv", "AGE"] == "bigint" and types["insurance_data.csv", "CLAIM_AMOUNT"] == "double"
    assert types["insurance_data.csv", "LOSS_DT"] == "string" and types["vendor_data.csv", "ADDRESS_LINE2"] == "string"
    first = [row for row in found.first_rows.collect() if row["table_name"] == "insurance_data.csv"]
    assert len(first) == 5 and '"TRANSACTION_ID":"TXN000000"' in first[0]["row"]
    with pytest.raises(ValueError, match="no CSV files"):
        insurance.explore(spark, str(tmp_path))


def test_explore_files_of_one_header(spark, tmp_path):
    """They share a scan, and numbers are compared as such."""
    (tmp_path / "a.csv").write_text("x,y,z\n1,p,true\n1.0,p,TRUE\n,q,\n")
    (tmp_path / "b.csv").write_text("x,y,z\n2,p,false\n3,p,true\n")
    (tmp_path / "c.csv").write_text("x,y,z\n")
    (tmp_path / "d.csv").write_text("k\nv\n")
    found = insurance.explore(spark, str(tmp_path))
    assert [tuple(row) for row in found.tables.collect()] == [
        ("a.csv", 3, 3, 0), ("b.csv", 2, 3, 0), ("c.csv", 0, 3, 0), ("d.csv", 1, 1, 0)
    ]
    types = {(row["table_name"], row["column"]): row["type"] for row in found.columns.collect()}
    assert types["a.csv", "x"] == "double" and types["b.csv", "x"] == "bigint" and types["a.csv", "z"] == "boolean"
    assert found.first_rows.filter("table_name = 'a.csv'").count() == 3


def test_amounts_stay_as_they_are(spark, tmp_path):
    """Also those with more than two decimals, and none is dropped for being small."""
    rows = data.claims()[:5000]
    amounts = ["10.005", "0.004", "1e3", "0", "-0.001"]
    rows[:5] = [row | {"CLAIM_AMOUNT": amount, "CITY": "Ashby"} for row, amount in zip(rows, amounts)]
    data.write_sources(tmp_path)
    data.write_csv(tmp_path / "insurance_data.csv", rows)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    insurance.build_bronze(warehouse, str(tmp_path), {"vendors": False})
    insurance.build_silver(warehouse)
    wanted = [row["TRANSACTION_ID"] for row in rows[:5]]

    def read(table, key, amount):
        found = warehouse.read(table).filter(F.col(key).isin(wanted)).collect()
        return [row[amount] for row in sorted(found, key=lambda row: row[key])]

    assert read("bronze_insurance", "TRANSACTION_ID", "CLAIM_AMOUNT") == [10.005, 0.004, 1000.0, 0.0, -0.001]
    assert read("silver_insurance", "transaction_id", "claim_amount") == [10.005, 0.004, 1000.0]


def test_claim_distributions(built):
    warehouse, _ = built
    claims = warehouse.read("bronze_insurance")
    amounts, values = insurance.claim_distributions(claims)
    assert amounts.first()["count"] == claims.filter("CLAIM_AMOUNT is not null").count()
    counts = Counter(row["CLAIM_STATUS"] for row in [*data.claims()])
    found = {row["value"]: row["n"] for row in values.filter("column = 'CLAIM_STATUS'").collect()}
    assert found == dict(counts)


def test_command_line(spark, folder, tmp_path, capsys):
    arguments = ["--sources", str(folder), "--warehouse", str(tmp_path / "w"), "--reports", str(tmp_path / "r")]
    command_line.main([*arguments, "bronze", "silver"])
    assert "silver_claims_enriched" in capsys.readouterr().out
    command_line.main([*arguments, "gold", "quality"])
    out = capsys.readouterr().out
    assert "gold_vendor_statistics" in out and "12 quality checks: 8 passed" in out
    assert read_reports(spark, str(tmp_path / "r")).count() == 1
    with pytest.raises(SystemExit):
        command_line.main([*arguments, "platinum"])
