"""The insurance claims tables: sources, silver and gold layers, and their checks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import as_date, null_tokens_to_null, or_default, percentage, round2
from sedimenta.operators import CleanSpec, Summary, attach, clean, grouped, ordered, run_checks
from sedimenta.operators import checks as dq
from sedimenta.operators import exploring, profiling
from sedimenta.operators.drift import header_drift, missing_sources
from sedimenta.operators.exploring import Exploration
from sedimenta.operators.reporting import nested_report
from sedimenta.operators.summaries import (
    largest,
    mean_money,
    mean_whole,
    rows,
    rows_where,
    share_where,
    total,
)
from sedimenta.sources import Warehouse, csv_columns, read_csv, source_exists, source_files, staged, write_report
from sedimenta.sources.delimited import SPLIT
from sedimenta.sources.records import csv_fields, csv_records, file_name

# ---- sources ---------------------------------------------------------------------

# Fixed names: source, its file, its raw table.
SOURCE_FILES = {
    "insurance": "insurance_data.csv",
    "employees": "employee_data.csv",
    "vendors": "vendor_data.csv",
}
BRONZE_TABLES = {
    "insurance": "bronze_insurance",
    "employees": "bronze_employees",
    "vendors": "bronze_vendors",
}

# Fixed names: declared columns. Amounts stay as they were read; sums are what is exact. A source may carry others; they are kept as text in bronze.
SOURCE_TYPES = {
    "insurance": {
        "TRANSACTION_ID": "string",
        "CUSTOMER_ID": "string",
        "POLICY_NUMBER": "string",
        "TXN_DATE_TIME": "string",
        "POLICY_EFF_DT": "string",
        "LOSS_DT": "string",
        "REPORT_DT": "string",
        "INSURANCE_TYPE": "string",
        "PREMIUM_AMOUNT": "double",
        "CLAIM_AMOUNT": "double",
        "CUSTOMER_NAME": "string",
        "ADDRESS_LINE1": "string",
        "ADDRESS_LINE2": "string",
        "CITY": "string",
        "STATE": "string",
        "POSTAL_CODE": "string",
        "MARITAL_STATUS": "string",
        "AGE": "int",
        "TENURE": "int",
        "EMPLOYMENT_STATUS": "string",
        "NO_OF_FAMILY_MEMBERS": "int",
        "RISK_SEGMENTATION": "string",
        "HOUSE_TYPE": "string",
        "SOCIAL_CLASS": "string",
        "CUSTOMER_EDUCATION_LEVEL": "string",
        "CLAIM_STATUS": "string",
        "INCIDENT_SEVERITY": "string",
        "AUTHORITY_CONTACTED": "string",
        "ANY_INJURY": "int",
        "POLICE_REPORT_AVAILABLE": "int",
        "INCIDENT_STATE": "string",
        "INCIDENT_CITY": "string",
        "INCIDENT_HOUR_OF_THE_DAY": "int",
        "AGENT_ID": "string",
        "VENDOR_ID": "string",
    },
    "employees": {
        "AGENT_ID": "string",
        "AGENT_NAME": "string",
        "DATE_OF_JOINING": "string",
        "ADDRESS_LINE1": "string",
        "CITY": "string",
        "STATE": "string",
        "POSTAL_CODE": "string",
    },
    "vendors": {
        "VENDOR_ID": "string",
        "VENDOR_NAME": "string",
        "ADDRESS_LINE1": "string",
        "CITY": "string",
        "STATE": "string",
        "POSTAL_CODE": "string",
    },
}


# True, false or "split" for all sources, or by source; line breaks inside quotes are allowed where nothing is said.
MultiLine = bool | str | Mapping[str, bool | str]


def read_source(spark: SparkSession, folder: str, source: str, multi_line: MultiLine = True) -> DataFrame:
    if source not in SOURCE_FILES:
        raise ValueError(f"unknown source {source!r}, expected one of {', '.join(SOURCE_FILES)}")
    breaks = multi_line if isinstance(multi_line, bool | str) else multi_line.get(source, True)
    return read_csv(spark, f"{folder}/{SOURCE_FILES[source]}", SOURCE_TYPES[source], breaks)


def read_sources(spark: SparkSession, folder: str, multi_line: MultiLine = True) -> dict[str, DataFrame]:
    return {source: read_source(spark, folder, source, multi_line) for source in SOURCE_FILES}


def absent_sources(spark: SparkSession, folder: str) -> DataFrame:
    return missing_sources(spark, folder, SOURCE_FILES)


def source_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Declared against observed headers of the sources that are present."""
    paths = {source: f"{folder}/{name}" for source, name in SOURCE_FILES.items()}
    headers = {source: csv_columns(spark, path) for source, path in paths.items() if source_exists(spark, path)}
    return header_drift(spark, {source: list(SOURCE_TYPES[source]) for source in headers}, headers)


def explore(spark: SparkSession, folder: str, multi_line: bool | str = True, n_first: int = 5) -> Exploration:
    """Profiles of every CSV file in a folder, whatever its columns.

    With ``"split"`` the records of all files are stored once in long form and the jobs do not grow with the files; it
    asks what ``csv_records`` asks of quotes. Otherwise files with one header are scanned together: once for what
    their columns hold, and once more, with the types found, for copies. The driver sees names, headers and types.
    """
    if multi_line == SPLIT:
        return _explore_records(spark, folder, n_first)
    files = {r["file_name"]: r["path"] for r in source_files(spark, folder, "*.csv").orderBy("file_name").collect()}
    if not files:
        raise ValueError(f"no CSV files in {folder}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for name, path in files.items():
        by_header.setdefault(tuple(csv_columns(spark, path, multi_line)), []).append(name)

    tables, profiles = [], []
    for header, names in by_header.items():
        paths = [files[name] for name in names]
        texts = read_csv(spark, paths, multi_line=multi_line, file_name="table_name")
        profile = profiling.columns_by_table(texts, "table_name", header)
        profiles.append(staged(profile))
        kinds = {}
        for row in profiles[-1].select("column", "type").distinct().collect():
            kinds.setdefault(row["column"], set()).add(row["type"])
        types = {name: kind for name, (kind, *more) in kinds.items() if not more and kind != "string"}
        typed = read_csv(spark, paths, types, multi_line, file_name="table_name")
        found = spark.createDataFrame([(name,) for name in names], "table_name string")
        tables.append(profiling.copies_by_table(typed, "table_name", found))
    columns = reduce(DataFrame.unionByName, profiles)
    missing = F.col("n_rows") - F.col("non_null")
    nulls = columns.select(
        "table_name", "column", missing.alias("null_count"), round2(percentage(missing, F.col("n_rows"))).alias("null_pct")
    )
    first = [
        read_csv(spark, path, multi_line=multi_line).limit(n_first).select(
            F.lit(name).alias("table_name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")
        )
        for name, path in files.items()
    ]
    return Exploration(
        tables=reduce(DataFrame.unionByName, tables).orderBy("table_name"),
        columns=columns.select("table_name", "position", "column", "type", "non_null").orderBy("table_name", "position"),
        nulls=nulls.filter("null_count > 0").orderBy("table_name", F.desc("null_count"), "column"),
        first_rows=reduce(DataFrame.unionByName, first),
    )


def _explore_records(spark: SparkSession, folder: str, n_first: int) -> Exploration:
    files = source_files(spark, folder, "*.csv").select(F.col("file_name").alias("table_name"))
    if files.isEmpty():
        raise ValueError(f"no CSV files in {folder}")
    records = csv_records(spark, folder, pattern="*.csv").select(
        file_name(F.col("path")).alias("table_name"), "start", "position", csv_fields(F.col("record")).alias("fields")
    )
    records = staged(records)
    is_header = (F.col("start") == 0) & (F.col("position") == 0)
    names = staged(exploring.headers(records.filter(is_header)))
    values = F.transform("fields", null_tokens_to_null).alias("fields")
    rows = records.filter(~is_header).select("table_name", "start", "position", values)
    return exploring.explored(rows, names, files, n_first)


def claim_distributions(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statistics of the claim amount, and value counts of the columns gold groups by."""
    grouped_by = ["CLAIM_STATUS", "INSURANCE_TYPE", "RISK_SEGMENTATION", "INCIDENT_SEVERITY"]
    return profiling.describe(claims, ["CLAIM_AMOUNT"]), profiling.value_counts(claims, grouped_by)


# ---- silver ----------------------------------------------------------------------


# Defaults for optional texts.
FILLED = {
    "CITY": "Unknown",
    "CUSTOMER_EDUCATION_LEVEL": "Unknown",
    "AUTHORITY_CONTACTED": "None",
    "INCIDENT_CITY": "Unknown",
}

# Raw date texts and the names of the dates.
DATES = {
    "TXN_DATE_TIME": "txn_date",
    "POLICY_EFF_DT": "policy_start_date",
    "LOSS_DT": "loss_date",
    "REPORT_DT": "report_date",
    "DATE_OF_JOINING": "date_of_joining",
}


def silver_columns(source: str, dropped: tuple[str, ...] = ()) -> list[Column]:
    """The declared columns of a source: dates parsed, defaults filled, names in lower case."""
    result = []
    for name in SOURCE_TYPES[source]:
        if name in DATES:
            result.append(as_date(F.col(name)).alias(DATES[name]))
        elif name in FILLED:
            result.append(or_default(F.col(name), FILLED[name]).alias(name.lower()))
        elif name not in dropped:
            result.append(F.col(name).alias(name.lower()))
    return result


def claims_spec() -> CleanSpec:
    """``ADDRESS_LINE2`` is mostly null and is dropped."""
    return CleanSpec(
        select=silver_columns("insurance", dropped=("ADDRESS_LINE2",)),
        required=("CITY", "CLAIM_AMOUNT"),
        positive=("CLAIM_AMOUNT",),
        derived={"days_to_report": F.datediff("report_date", "loss_date")},
    )


def party_spec(source: str) -> CleanSpec:
    """Cleaning of the employees or the vendors."""
    return CleanSpec(select=silver_columns(source), required=("CITY",))


def silver_insurance(bronze: DataFrame) -> DataFrame:
    return clean(bronze, claims_spec())


def silver_employees(bronze: DataFrame) -> DataFrame:
    return clean(bronze, party_spec("employees"))


def silver_vendors(bronze: DataFrame) -> DataFrame:
    return clean(bronze, party_spec("vendors"))


def silver_claims_enriched(claims: DataFrame, employees: DataFrame, vendors: DataFrame, **join_options) -> DataFrame:
    """Claims with the agent's and the vendor's details, claims without either kept.

    An agent or vendor listed twice with different details multiplies its claims.
    """
    agents = employees.select(
        "agent_id",
        "agent_name",
        F.col("date_of_joining").alias("agent_joining_date"),
        F.col("state").alias("agent_state"),
    )
    shops = vendors.select("vendor_id", "vendor_name", F.col("state").alias("vendor_state"))
    with_agent = attach(claims, agents, "agent_id", **join_options)
    return attach(with_agent, shops, "vendor_id", keys_in=claims, **join_options)


# ---- gold ------------------------------------------------------------------------


def monthly_summary_spec(denied: str = "D") -> Summary:
    return Summary(
        keys={"month": F.trunc("txn_date", "month"), "insurance_type": F.col("insurance_type")},
        measures={
            "total_claims": rows(),
            "total_claim_amount": total("claim_amount"),
            "avg_claim_amount": mean_money("claim_amount"),
            "max_claim_amount": largest("claim_amount"),
            "approved_claims": rows_where(F.col("claim_status") == "A"),
            "denied_claims": rows_where(F.col("claim_status") == denied),
        },
        order=("-month", "insurance_type"),
    )


def state_risk_spec(high_risk: str = "H") -> Summary:
    risky = F.col("risk_segmentation") == high_risk
    return Summary(
        keys={"state": F.col("state")},
        measures={
            "total_claims": rows(),
            "total_claim_amount": total("claim_amount"),
            "avg_claim_amount": mean_money("claim_amount"),
            "high_risk_claims": rows_where(risky),
            "claims_with_injury": rows_where(F.col("any_injury") == 1),
            "high_risk_pct": share_where(risky),
        },
        order=("-total_claim_amount",),
    )


def agent_performance_spec() -> Summary:
    return Summary(
        keys={name: F.col(name) for name in ("agent_id", "agent_name", "agent_state")},
        measures={
            "total_claims_processed": rows(),
            "total_claim_value": total("claim_amount"),
            "avg_claim_value": mean_money("claim_amount"),
            "avg_days_to_report": mean_whole("days_to_report"),
            "approved_claims": rows_where(F.col("claim_status") == "A"),
        },
        order=("-total_claims_processed",),
        required=("agent_id",),
    )


def vendor_statistics_spec(total_loss: str = "Total Loss") -> Summary:
    return Summary(
        keys={name: F.col(name) for name in ("vendor_id", "vendor_name", "vendor_state")},
        measures={
            "total_claims": rows(),
            "total_claim_amount": total("claim_amount"),
            "avg_claim_amount": mean_money("claim_amount"),
            "total_loss_claims": rows_where(F.col("incident_severity") == total_loss),
        },
        order=("-total_claim_amount",),
        required=("vendor_id",),
    )


def fraud_indicators_spec() -> Summary:
    return Summary(
        keys={"risk_segment": F.col("risk_segmentation"), "incident_severity": F.col("incident_severity")},
        measures={
            "claim_count": rows(),
            "avg_claim_amount": mean_money("claim_amount"),
            "no_police_report": rows_where(F.col("police_report_available") == 0),
            "late_reports": rows_where(F.col("days_to_report") > 7),
            "no_authority_contact": rows_where(F.col("authority_contacted") == "None"),
        },
        order=("-claim_count",),
    )


# Fixed names: the gold tables.
GOLD_SPECS = {
    "gold_monthly_claim_summary": monthly_summary_spec,
    "gold_state_risk_summary": state_risk_spec,
    "gold_agent_performance": agent_performance_spec,
    "gold_vendor_statistics": vendor_statistics_spec,
    "gold_fraud_indicators": fraud_indicators_spec,
}


# ---- checks ----------------------------------------------------------------------


def insurance_checks() -> list[dq.Check]:
    """Their names are fixed."""
    claims = "silver_insurance"
    return [
        dq.row_count_at_least(
            "bronze", "bronze_insurance_row_count", "bronze_insurance", 5000, description="enough raw claims"
        ),
        dq.row_count_at_least(
            "bronze", "bronze_employees_row_count", "bronze_employees", 500, description="enough raw employees"
        ),
        dq.row_count_at_least(
            "bronze", "bronze_vendors_row_count", "bronze_vendors", 100, description="enough raw vendors"
        ),
        dq.unique(
            "silver", "silver_transaction_id_unique", claims, "transaction_id", description="no repeated transaction"
        ),
        dq.positive(
            "silver", "silver_claim_amount_positive", claims, "claim_amount", description="claim amounts above zero"
        ),
        dq.in_range(
            "silver",
            "silver_age_valid_range",
            claims,
            "age",
            18,
            100,
            severity=dq.WARNING,
            description="ages from 18 to 100",
        ),
        dq.in_order(
            "silver",
            "silver_claim_dates_valid",
            claims,
            "loss_date",
            "report_date",
            description="no loss reported before it happened",
        ),
        dq.references(
            "silver",
            "silver_agent_id_referential",
            claims,
            "agent_id",
            "silver_employees",
            severity=dq.WARNING,
            description="agents of claims are known employees",
        ),
        dq.no_nulls(
            "silver", "silver_claim_amount_null_pct", claims, "claim_amount", description="no claim without an amount"
        ),
        dq.not_empty(
            "gold", "gold_state_summary_nonempty", "gold_state_risk_summary", description="state summary has rows"
        ),
        dq.totals_reconcile(
            "gold",
            "gold_total_matches_silver",
            ("gold_state_risk_summary", "total_claim_amount"),
            ("silver_claims_enriched", "claim_amount"),
            description="state totals add up to the claims",
        ),
        dq.every_group_has(
            "gold",
            "gold_agent_performance_valid",
            "gold_agent_performance",
            "total_claims_processed",
            severity=dq.WARNING,
            description="every listed agent has a claim",
        ),
    ]


CHECKED_TABLES = (
    "bronze_insurance",
    "bronze_employees",
    "bronze_vendors",
    "silver_insurance",
    "silver_employees",
    "silver_claims_enriched",
    "gold_state_risk_summary",
    "gold_agent_performance",
)


# ---- building --------------------------------------------------------------------


def build_bronze(warehouse: Warehouse, folder: str, multi_line: MultiLine = True) -> dict[str, int]:
    sources = read_sources(warehouse.spark, folder, multi_line)
    return warehouse.replace("bronze", {BRONZE_TABLES[source]: df for source, df in sources.items()})


def build_silver(warehouse: Warehouse, **join_options) -> dict[str, int]:
    def enriched(run_id: str) -> DataFrame:
        parts = [warehouse.staged(run_id, f"silver_{name}") for name in ("insurance", "employees", "vendors")]
        return silver_claims_enriched(*parts, **join_options)

    return warehouse.replace(
        "silver",
        {
            "silver_insurance": silver_insurance(warehouse.read("bronze_insurance")),
            "silver_employees": silver_employees(warehouse.read("bronze_employees")),
            "silver_vendors": silver_vendors(warehouse.read("bronze_vendors")),
            "silver_claims_enriched": enriched,
        },
    )


def build_gold(warehouse: Warehouse) -> dict[str, int]:
    """All summaries read the stored enriched claims, each only the columns it needs."""
    enriched = warehouse.read("silver_claims_enriched")
    return warehouse.replace("gold", {name: grouped(enriched, spec()) for name, spec in GOLD_SPECS.items()})


def read_gold(warehouse: Warehouse, name: str) -> DataFrame:
    """A stored summary in its order."""
    return ordered(warehouse.read(name), GOLD_SPECS[name]())


def check_quality(warehouse: Warehouse, report_path: str | None = None) -> DataFrame:
    """Results of all checks; with a path, the nested report is added there as well.

    A table that was never built turns its checks into errors.
    """
    tables = stored(warehouse, CHECKED_TABLES)
    results = run_checks(tables, insurance_checks(), warehouse.spark)
    if report_path:
        write_report(nested_report(results, datetime.now().isoformat()), report_path)
    return results


def stored(warehouse: Warehouse, names: tuple[str, ...]) -> Mapping[str, DataFrame]:
    paths = {row["table_name"]: row["path"] for row in warehouse.tables().collect()}
    return {name: warehouse.spark.read.parquet(paths[name]) for name in names if name in paths}


def build_all(warehouse: Warehouse, folder: str, report_path: str | None = None) -> DataFrame:
    build_bronze(warehouse, folder)
    build_silver(warehouse)
    build_gold(warehouse)
    return check_quality(warehouse, report_path)
