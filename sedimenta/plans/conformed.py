"""The claims model laid over an order-and-lineitem schema.

A line of an order plays a claim, its supplier the agent, its part the vendor, and
the nation of the order's customer the state. Missing vendors, and other defects the
checks look for, are derived from the data with plain expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import as_date, or_default
from sedimenta.operators import CleanSpec, attach, clean


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nations(spark: SparkSession, folder: str, key: str, name: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


# Claim columns that come from the order, and the column they come from.
FROM_ORDERS = {
    "txn_date": "o_orderdate",
    "loss_date": "o_orderdate",
    "days_to_report": "o_orderdate",
    "insurance_type": "o_orderpriority",
    "risk_segmentation": "o_orderstatus",
    "state": "state",
}


def claim_lines(spark: SparkSession, folder: str, *of_orders: str) -> DataFrame:
    """Lines joined to the given columns of their orders; a line without order is no claim.

    ``state`` is the nation of the order's customer, null where either is unknown, so it
    adds and drops no row. It is found for the orders, before they meet the more numerous
    lines.
    """
    lines = table(spark, folder, "lineitem")
    # A line's position in its file spreads lines evenly, exact copies included, and
    # is the same whenever the file is read again.
    spread = [F.col("_metadata.row_index")]
    own = [name for name in of_orders if name != "state"]
    orders = table(spark, folder, "orders")
    if "state" not in of_orders:
        return attach(lines, orders.select("o_orderkey", *own), "l_orderkey", "o_orderkey", "inner", spread_on=spread)
    orders = orders.select("o_orderkey", "o_custkey", *own)
    states = customer_states(spark, folder)
    placed = attach(orders, states, "o_custkey", "c_custkey", spread_on=["o_orderkey"]).drop("o_custkey")
    return attach(lines, placed, "l_orderkey", "o_orderkey", "inner", screen=orders, spread_on=spread)


def customer_states(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``(c_custkey, state)`` per customer, the first state where a key repeats."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = attach(customers, nations(spark, folder, "n_key", "state"), "c_nationkey", "n_key")
    return placed.groupBy("c_custkey").agg(F.min("state").alias("state"))


def claims(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """Claims as the silver layer would hold them.

    The rows are the same whichever columns are named: lines joined to their orders.
    Without names, all columns but ``state``.
    """
    loss, report = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    columns = {
        "order_id": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber"),
        "txn_date": loss,
        "loss_date": loss,
        "report_date": report,
        "days_to_report": F.datediff(report, loss),
        "insurance_type": F.col("o_orderpriority"),
        "claim_amount": F.col("l_extendedprice"),
        "quantity": F.col("l_quantity"),
        "claim_status": F.col("l_returnflag"),
        "risk_segmentation": F.col("o_orderstatus"),
        "incident_severity": F.col("l_linestatus"),
        "any_injury": (F.col("l_discount") > 0.05).cast("int"),
        "police_report_available": (F.col("l_tax") > 0.04).cast("int"),
        "authority_contacted": or_default(F.nullif("l_linestatus", F.lit("O")), "None"),
        **party_keys(),
        "state": F.col("state"),
    }
    wanted = names or tuple(name for name in columns if name != "state")
    of_orders = dict.fromkeys(FROM_ORDERS[name] for name in wanted if name in FROM_ORDERS)
    return claim_lines(spark, folder, *of_orders).select(*[columns[name].alias(name) for name in wanted])


def party_keys() -> dict[str, Column]:
    """Agent and vendor of a line; a third of the lines has no vendor."""
    return {
        "agent_id": F.col("l_suppkey"),
        "vendor_id": F.when(F.col("l_returnflag") != "N", F.col("l_partkey")),
    }


def agents(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("agent_id"), F.col("s_name").alias("agent_name"), "s_nationkey"
    )
    states = nations(spark, folder, "n_key", "agent_state")
    return attach(suppliers, states, "s_nationkey", "n_key").drop("s_nationkey")


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("vendor_id"),
        F.col("p_name").alias("vendor_name"),
        F.col("p_brand").alias("vendor_state"),
    )


def raw_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims before cleaning: dates as text, optional fields with gaps, bad amounts."""
    amount = F.when(F.col("l_tax") == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return claim_lines(spark, folder, "o_orderdate", "o_orderpriority").select(
        "l_orderkey",
        "l_suppkey",
        F.replace(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lit("/")).alias("loss_dt"),
        F.col("l_shipdate").cast("string").alias("report_dt"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("city"),
        F.nullif("l_linestatus", F.lit("O")).alias("authority"),
        F.nullif("l_returnflag", F.lit("N")).alias("education"),
        F.when(F.col("l_discount") > 0, amount).alias("amount"),
    )


def silver_claims(spark: SparkSession, folder: str) -> DataFrame:
    spec = CleanSpec(
        select=[
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("agent_id"),
            as_date(F.col("loss_dt")).alias("loss_date"),
            as_date(F.col("report_dt")).alias("report_date"),
            or_default(F.col("city"), "Unknown").alias("city"),
            or_default(F.col("authority"), "None").alias("authority_contacted"),
            or_default(F.col("education"), "Unknown").alias("education_level"),
            F.col("amount").alias("claim_amount"),
        ],
        required=("city", "amount"),
        positive=("amount",),
        derived={"days_to_report": F.datediff("report_date", "loss_date")},
    )
    return clean(raw_claims(spark, folder), spec)


def silver_dim_agent(spark: SparkSession, folder: str) -> DataFrame:
    raw = agents(spark, folder).withColumn("city", F.nullif("agent_state", F.lit("NATION_3")))
    spec = CleanSpec(
        select=[
            F.col("agent_id"),
            F.col("agent_name"),
            or_default(F.col("city"), "Unknown").alias("city"),
            F.col("agent_state").alias("state"),
        ],
        required=("city",),
    )
    return clean(raw, spec)


def silver_dim_vendor(spark: SparkSession, folder: str) -> DataFrame:
    """Without the part key many rows are exact copies."""
    raw = table(spark, folder, "part").select(
        "p_name",
        F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"),
    )
    spec = CleanSpec(
        select=[
            F.col("p_name").alias("vendor_name"),
            or_default(F.col("p_brand"), "Unknown").alias("city"),
            or_default(F.col("p_type"), "Unknown").alias("state"),
        ],
        required=("p_brand",),
    )
    return clean(raw, spec)


def silver_enriched(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "lineitem").select(
        *[key.alias(name) for name, key in party_keys().items()]
    )
    with_agent = attach(claims(spark, folder), agents(spark, folder), "agent_id", keys_in=keys)
    return attach(with_agent, vendors(spark, folder), "vendor_id", keys_in=keys)
