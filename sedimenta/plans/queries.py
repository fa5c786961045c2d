"""The registered queries: each takes a session and the folder of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import as_date, null_tokens_to_null
from sedimenta.operators import (
    Check,
    Summary,
    check_rows,
    grouped,
    grouped_before_attach,
    ordered,
    run_checks,
    summarise,
)
from sedimenta.operators import checks as dq
from sedimenta.operators import profiling
from sedimenta.operators.drift import missing_sources, schema_drift, source_status
from sedimenta.operators.reporting import (
    flatten_report,
    labelled,
    layer_summary,
    nested_report,
    overall_summary,
    summary_line,
)
from sedimenta.operators.summaries import largest, mean_money, rows, smallest, total
from sedimenta.plans import conformed, insurance
from sedimenta.plans.conformed import table
from sedimenta.sources import read_csv, read_reports, source_exists, staged, write_report
from sedimenta.sources.delimited import SPLIT
from sedimenta.sources.staging import once_for_inputs, staging_folder

Query = Callable[[SparkSession, str], DataFrame]

COUNTED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The statuses and codes that play the claim codes in the order schema.
DENIED, HIGH_RISK, TOTAL_LOSS = "R", "F", "F"


# ---- silver and gold -------------------------------------------------------------


def na_normalise(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    written = (
        F.when(segment == "BUILDING", "NA")
        .when(segment == "MACHINERY", "None")
        .when(segment == "FURNITURE", "")
        .when(segment == "HOUSEHOLD", "#N/A N/A")
        .otherwise(segment)
    )
    return table(spark, folder, "customer").select("c_custkey", null_tokens_to_null(written).alias("segment"))


# What the summaries read of the claims.
MONTHLY_COLUMNS = ("txn_date", "insurance_type", "claim_amount", "claim_status")
STATE_COLUMNS = ("state", "claim_amount", "risk_segmentation", "any_injury")
AGENT_COLUMNS = ("agent_id", "claim_amount", "days_to_report", "claim_status")
VENDOR_COLUMNS = ("vendor_id", "claim_amount", "incident_severity")
FRAUD_COLUMNS = (
    "risk_segmentation",
    "incident_severity",
    "claim_amount",
    "police_report_available",
    "days_to_report",
    "authority_contacted",
)


def gold_monthly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarise(conformed.claims(spark, folder, *MONTHLY_COLUMNS), insurance.monthly_summary_spec(DENIED))


def state_risk_of(claims: DataFrame) -> DataFrame:
    return grouped(claims, insurance.state_risk_spec(HIGH_RISK))


def gold_state_risk(spark: SparkSession, folder: str) -> DataFrame:
    claims = conformed.claims(spark, folder, *STATE_COLUMNS)
    return ordered(state_risk_of(claims), insurance.state_risk_spec(HIGH_RISK))


def agent_performance_of(spark: SparkSession, folder: str, claims: DataFrame) -> DataFrame:
    agents = conformed.agents(spark, folder)
    return grouped_before_attach(claims, insurance.agent_performance_spec(), agents, "agent_id")


def gold_agent_performance(spark: SparkSession, folder: str) -> DataFrame:
    performance = agent_performance_of(spark, folder, conformed.claims(spark, folder, *AGENT_COLUMNS))
    return ordered(performance, insurance.agent_performance_spec())


def gold_vendor_statistics(spark: SparkSession, folder: str) -> DataFrame:
    spec = insurance.vendor_statistics_spec(TOTAL_LOSS)
    claims, vendors = conformed.claims(spark, folder, *VENDOR_COLUMNS), conformed.vendors(spark, folder)
    return ordered(grouped_before_attach(claims, spec, vendors, "vendor_id"), spec)


def gold_fraud_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return summarise(conformed.claims(spark, folder, *FRAUD_COLUMNS), insurance.fraud_indicators_spec())


def gold_tax_by_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts with three decimals, as doubles: none is rounded, the totals are exact."""
    price, rate = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_tax").cast("decimal(4,2)")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("claim_status"), F.round(price * rate, 3).cast("double").alias("tax")
    )
    spec = Summary(
        keys={"claim_status": F.col("claim_status")},
        measures={
            "total_claims": rows(),
            "total_tax": total("tax"),
            "avg_tax": mean_money("tax"),
            "least_tax": smallest(F.when(F.col("tax") > 0, F.col("tax"))),
        },
        order=("claim_status",),
    )
    return summarise(lines, spec)


def gold_fee_by_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts in thirds of cents, which no decimal holds: the totals are exact sums of the doubles."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("claim_status"), (F.col("l_extendedprice") / 300).alias("fee")
    )
    spec = Summary(
        keys={"claim_status": F.col("claim_status")},
        measures={"total_claims": rows(), "total_fee": total("fee"), "avg_fee": mean_money("fee"), "max_fee": largest("fee")},
        order=("claim_status",),
    )
    return summarise(lines, spec)


# ---- checks ----------------------------------------------------------------------


def volume_checks() -> list[Check]:
    return [
        dq.row_count_at_least("bronze", "claims_row_count", "lineitem", 5000),
        dq.row_count_at_least("bronze", "agents_row_count", "supplier", 500),
        dq.row_count_at_least("bronze", "vendors_row_count", "part", 100),
    ]


def uniqueness_checks() -> list[Check]:
    return [
        dq.unique("silver", "order_id_unique", "orders", "o_orderkey"),
        dq.unique("silver", "line_order_unique", "lineitem", "l_orderkey"),
    ]


def positive_check() -> Check:
    return dq.positive("silver", "balance_positive", "customer", "c_acctbal")


def range_check() -> Check:
    return dq.in_range("silver", "quantity_in_range", "claims", "quantity", 5, 45, severity=dq.WARNING)


def date_order_check() -> Check:
    return dq.in_order("silver", "dates_in_order", "claims", "loss_date", "report_date")


def references_check() -> Check:
    return dq.references(
        "silver", "customer_known", "orders", "o_custkey", "solvent_customer", "c_custkey", severity=dq.WARNING
    )


def null_check() -> Check:
    return dq.no_nulls("silver", "vendor_null_pct", "claims", "vendor_id")


def nonempty_check() -> Check:
    return dq.not_empty("gold", "state_summary_nonempty", "state_summary")


def reconcile_check() -> Check:
    return dq.totals_reconcile(
        "gold", "state_total_matches_claims", ("state_summary", "total_claim_amount"), ("claims", "claim_amount")
    )


def group_check() -> Check:
    return dq.every_group_has(
        "gold", "agents_have_claims", "agent_performance", "total_claims_processed", severity=dq.WARNING
    )


def all_checks() -> list[Check]:
    """Checks over three layers: one on a total over no rows, and three that cannot give a
    value, for a missing table, a missing column, and texts that are no dates."""
    return [
        *volume_checks(),
        *uniqueness_checks(),
        positive_check(),
        range_check(),
        date_order_check(),
        references_check(),
        null_check(),
        nonempty_check(),
        reconcile_check(),
        group_check(),
        dq.totals_reconcile(
            "gold",
            "bankrupt_total_matches",
            ("bankrupt_customer", "c_acctbal"),
            ("customer", "c_acctbal"),
            severity=dq.WARNING,
        ),
        dq.row_count_at_least("bronze", "payments_row_count", "payments", 1),
        dq.positive("silver", "discount_positive", "customer", "c_discount", severity=dq.WARNING),
        dq.no_rows_where(
            "silver", "names_are_dates", "customer", as_date(F.col("c_name")).isNull(), ["c_name"], severity=dq.WARNING
        ),
    ]


CHECKED_COLUMNS = tuple(
    dict.fromkeys((*STATE_COLUMNS, *AGENT_COLUMNS, "claim_amount", "quantity", "loss_date", "report_date", "vendor_id"))
)


@once_for_inputs("lineitem", "orders", "customer", "nation")
def checked_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The claims as the checks read them, written once."""
    return staged(conformed.claims(spark, folder, *CHECKED_COLUMNS))


def checked_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Base tables and, written once for all checks that read them, the claims."""
    claims = checked_claims(spark, folder)
    customer = table(spark, folder, "customer")
    return {
        **{name: table(spark, folder, name) for name in ("lineitem", "supplier", "part", "orders")},
        "customer": customer,
        "solvent_customer": customer.filter(F.col("c_acctbal") > 0),
        "claims": claims,
        "bankrupt_customer": customer.filter(F.col("c_acctbal") < -100_000),
        "state_summary": state_risk_of(claims),
        "agent_performance": agent_performance_of(spark, folder, claims),
    }


def outcome(tables: dict[str, DataFrame], *checks: Check) -> DataFrame:
    return check_rows(tables, checks).select("name", "value", "passed", "status")


def dq_volume(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({name: table(spark, folder, name) for name in ("lineitem", "supplier", "part")}, *volume_checks())


def dq_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({name: table(spark, folder, name) for name in ("orders", "lineitem")}, *uniqueness_checks())


def dq_positive(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({"customer": table(spark, folder, "customer")}, positive_check())


def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({"claims": conformed.claims(spark, folder, "quantity")}, range_check())


def dq_date_order(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({"claims": conformed.claims(spark, folder, "loss_date", "report_date")}, date_order_check())


def dq_referential(spark: SparkSession, folder: str) -> DataFrame:
    solvent = table(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    return outcome({"orders": table(spark, folder, "orders"), "solvent_customer": solvent}, references_check())


def dq_null_pct(spark: SparkSession, folder: str) -> DataFrame:
    return outcome({"claims": conformed.claims(spark, folder, "vendor_id")}, null_check())


def dq_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    claims = conformed.claims(spark, folder, *STATE_COLUMNS)
    return outcome({"state_summary": state_risk_of(claims)}, nonempty_check())


def dq_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    claims = checked_claims(spark, folder)
    return outcome({"state_summary": state_risk_of(claims), "claims": claims}, reconcile_check())


def dq_group_min(spark: SparkSession, folder: str) -> DataFrame:
    performance = agent_performance_of(spark, folder, conformed.claims(spark, folder, *AGENT_COLUMNS))
    return outcome({"agent_performance": performance}, group_check())


@once_for_inputs("lineitem", "orders", "customer", "nation", "supplier", "part")
def results(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all checks, stored: what is rolled up or reported starts from them."""
    return staged(run_checks(checked_tables(spark, folder), all_checks(), spark))


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return labelled(results(spark, folder)).select("layer", "name", "severity", "value", "passed", "status", "label")


def dq_layer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return layer_summary(results(spark, folder))


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return overall_summary(results(spark, folder)).withColumn("line", summary_line())


def report_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Back from the stored report, which is written and read as JSON."""
    path = f"{staging_folder(spark)}/report-{uuid.uuid4().hex}"
    write_report(nested_report(results(spark, folder), "run"), path)
    return flatten_report(read_reports(spark, path)).select("layer", "name", "severity", "value", "passed", "status", "label")


# ---- files -----------------------------------------------------------------------


def csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, with their line breaks and quotes, written as CSV and read back in splits."""
    path = f"{staging_folder(spark)}/csv-{uuid.uuid4().hex}"
    texts = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    texts.write.options(header="true", quoteAll="true", escape='"', **options).csv(path)
    found = read_csv(spark, path, {"doc_id": "bigint"}, SPLIT)
    return found.select("doc_id", "lang", "source", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


# ---- profiles and drift ----------------------------------------------------------


def counted(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.table_row_counts({name: table(spark, folder, name) for name in COUNTED_TABLES})


def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.shape(table(spark, folder, "orders"))


def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.columns(table(spark, folder, "orders"))


def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("vendor_id"),
        F.nullif("l_linestatus", F.lit("O")).alias("authority"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("amount"),
        F.col("l_quantity").alias("quantity"),
    )
    return profiling.nulls(lines)


def profile_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.duplicates(table(spark, folder, "documents").select("text"))


def profile_describe(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.describe(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])


def profile_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.value_counts(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


def profile_head(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.head(table(spark, folder, "orders"), 3, by=["o_orderkey"])


EXPECTED_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_phone", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
}


def drift(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift(EXPECTED_COLUMNS, {name: table(spark, folder, name) for name in EXPECTED_COLUMNS})


EXPECTED_SOURCES = {
    "claims": "lineitem.parquet",
    "agents": "supplier.parquet",
    "vendors": "part.parquet",
    "payments": "payment.parquet",
}


def missing(spark: SparkSession, folder: str) -> DataFrame:
    """Every expected source with its number of rows, none where it is absent."""
    paths = {name: f"{folder}/{name}" for name in EXPECTED_SOURCES.values()}
    present = {name: spark.read.parquet(path) for name, path in paths.items() if source_exists(spark, path)}
    counts = profiling.table_row_counts(present).withColumnRenamed("table_name", "file_name")
    critical = missing_sources(spark, folder, EXPECTED_SOURCES).select("source", "critical")
    status = source_status(EXPECTED_SOURCES, counts).join(critical, "source", "left")
    return status.withColumn("critical", F.coalesce("critical", F.lit(False))).orderBy("source")


QUERIES: dict[str, Query] = {
    "na_normalise": na_normalise,
    "table_row_counts": counted,
    "silver_claims": conformed.silver_claims,
    "silver_dim_agent": conformed.silver_dim_agent,
    "silver_dim_vendor": conformed.silver_dim_vendor,
    "silver_enriched": conformed.silver_enriched,
    "gold_monthly_summary": gold_monthly_summary,
    "gold_state_risk": gold_state_risk,
    "gold_agent_performance": gold_agent_performance,
    "gold_vendor_statistics": gold_vendor_statistics,
    "gold_fraud_indicators": gold_fraud_indicators,
    "gold_tax_by_flag": gold_tax_by_flag,
    "gold_fee_by_flag": gold_fee_by_flag,
    "dq_volume": dq_volume,
    "dq_nonempty": dq_nonempty,
    "dq_uniqueness": dq_uniqueness,
    "dq_positive": dq_positive,
    "dq_range": dq_range,
    "dq_date_order": dq_date_order,
    "dq_referential": dq_referential,
    "dq_null_pct": dq_null_pct,
    "dq_reconcile": dq_reconcile,
    "dq_group_min": dq_group_min,
    "dq_report": dq_report,
    "dq_layer_summary": dq_layer_summary,
    "dq_summary": dq_summary,
    "report_flatten": report_flatten,
    "csv_split": csv_split,
    "profile_shape": profile_shape,
    "profile_columns": profile_columns,
    "profile_nulls": profile_nulls,
    "profile_duplicates": profile_duplicates,
    "profile_describe": profile_describe,
    "profile_value_counts": profile_value_counts,
    "profile_head": profile_head,
    "schema_drift": drift,
    "missing_sources": missing,
}
