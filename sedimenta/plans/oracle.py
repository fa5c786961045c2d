"""The registered queries as SQL, for comparison with another engine."""

from __future__ import annotations

_CLAIMS = """
claims AS (
  SELECT l_orderkey AS order_id,
         l_linenumber AS line_number,
         CAST(o_orderdate AS DATE) AS txn_date,
         CAST(o_orderdate AS DATE) AS loss_date,
         CAST(l_shipdate AS DATE) AS report_date,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_report,
         o_orderpriority AS insurance_type,
         l_extendedprice AS claim_amount,
         l_quantity AS quantity,
         l_returnflag AS claim_status,
         o_orderstatus AS risk_segmentation,
         l_linestatus AS incident_severity,
         CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS any_injury,
         CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS police_report_available,
         COALESCE(NULLIF(l_linestatus, 'O'), 'None') AS authority_contacted,
         l_suppkey AS agent_id,
         CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS vendor_id,
         n_name AS state
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN (
    SELECT c_custkey, MIN(n_name) AS n_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY c_custkey
  ) ON o_custkey = c_custkey
)"""

_AGENTS = """
agents AS (
  SELECT s_suppkey AS agent_id, s_name AS agent_name, n_name AS agent_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
)"""

_VENDORS = """
vendors AS (
  SELECT p_partkey AS vendor_id, p_name AS vendor_name, p_brand AS vendor_state FROM part
)"""

_TOTAL = "CAST(SUM(CAST(claim_amount AS DECIMAL(28,6))) AS DOUBLE)"
_MEAN = f"ROUND({_TOTAL} / COUNT(claim_amount), 2)"

_STATE_RISK = f"""
state_summary AS (
  SELECT state,
         COUNT(*) AS total_claims,
         {_TOTAL} AS total_claim_amount,
         {_MEAN} AS avg_claim_amount,
         COUNT(*) FILTER (WHERE risk_segmentation = 'F') AS high_risk_claims,
         COUNT(*) FILTER (WHERE any_injury = 1) AS claims_with_injury,
         ROUND(100.0 * COUNT(*) FILTER (WHERE risk_segmentation = 'F') / COUNT(*), 2) AS high_risk_pct
  FROM claims GROUP BY state
)"""

_AGENT_PERFORMANCE = f"""
agent_performance AS (
  SELECT agent_id, agent_name, agent_state,
         COUNT(*) AS total_claims_processed,
         {_TOTAL} AS total_claim_value,
         {_MEAN} AS avg_claim_value,
         ROUND(AVG(days_to_report), 2) AS avg_days_to_report,
         COUNT(*) FILTER (WHERE claim_status = 'A') AS approved_claims
  FROM claims LEFT JOIN agents USING (agent_id)
  WHERE agent_id IS NOT NULL
  GROUP BY agent_id, agent_name, agent_state
)"""

# Values of the checks: name -> a query of one column.
_VALUES = {
    "claims_row_count": "SELECT COUNT(*) FROM lineitem",
    "agents_row_count": "SELECT COUNT(*) FROM supplier",
    "vendors_row_count": "SELECT COUNT(*) FROM part",
    "order_id_unique": "SELECT COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders",
    "line_order_unique": "SELECT COUNT(*) - COUNT(DISTINCT l_orderkey) FROM lineitem",
    "balance_positive": "SELECT COUNT(*) FROM customer WHERE c_acctbal <= 0",
    "quantity_in_range": "SELECT COUNT(*) FROM claims WHERE quantity < 5 OR quantity > 45",
    "dates_in_order": "SELECT COUNT(*) FROM claims WHERE loss_date > report_date",
    "customer_known": """SELECT COUNT(*) FROM orders
        LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
        WHERE o_custkey IS NOT NULL AND c_custkey IS NULL""",
    "vendor_null_pct": "SELECT 100.0 * COUNT(*) FILTER (WHERE vendor_id IS NULL) / COUNT(*) FROM claims",
    "state_summary_nonempty": "SELECT COUNT(*) FROM state_summary",
    "state_total_matches_claims": """SELECT ABS(
        (SELECT SUM(CAST(total_claim_amount AS DECIMAL(28,6))) FROM state_summary)
        - (SELECT SUM(CAST(claim_amount AS DECIMAL(28,6))) FROM claims))""",
    "agents_have_claims": "SELECT COUNT(*) FROM agent_performance WHERE total_claims_processed < 1",
    "bankrupt_total_matches": """SELECT ABS(
        (SELECT SUM(c_acctbal) FROM customer WHERE c_acctbal < -100000) - (SELECT SUM(c_acctbal) FROM customer))""",
    # no such table, no such column, and a text that is no date
    "payments_row_count": "SELECT NULL",
    "discount_positive": "SELECT NULL",
    "names_are_dates": "SELECT NULL",
}

# Layer, severity, and the condition to pass of every check.
_RULES = {
    "claims_row_count": ("bronze", "critical", ">= 5000"),
    "agents_row_count": ("bronze", "critical", ">= 500"),
    "vendors_row_count": ("bronze", "critical", ">= 100"),
    "order_id_unique": ("silver", "critical", "= 0"),
    "line_order_unique": ("silver", "critical", "= 0"),
    "balance_positive": ("silver", "critical", "= 0"),
    "quantity_in_range": ("silver", "warning", "= 0"),
    "dates_in_order": ("silver", "critical", "= 0"),
    "customer_known": ("silver", "warning", "= 0"),
    "vendor_null_pct": ("silver", "critical", "= 0"),
    "state_summary_nonempty": ("gold", "critical", "> 0"),
    "state_total_matches_claims": ("gold", "critical", "< 1"),
    "agents_have_claims": ("gold", "warning", "= 0"),
    "bankrupt_total_matches": ("gold", "warning", "< 1"),
    "payments_row_count": ("bronze", "critical", ">= 1"),
    "discount_positive": ("silver", "warning", "= 0"),
    "names_are_dates": ("silver", "warning", "= 0"),
}
_BROKEN = ("payments_row_count", "discount_positive", "names_are_dates")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _results(*names: str) -> str:
    """A CTE ``results`` with one row per check."""
    branches = []
    for name in names:
        layer, severity, rule = _RULES[name]
        on_null = "FAIL" if rule == "= 0" and name not in _BROKEN else "ERROR"
        branches.append(
            f"""SELECT '{layer}' AS layer, '{name}' AS name, '{severity}' AS severity,
            CAST(v AS DOUBLE) AS value, COALESCE(v {rule}, FALSE) AS passed,
            CASE WHEN v IS NULL THEN '{on_null}' WHEN v {rule} THEN 'PASS' ELSE 'FAIL' END AS status
            FROM (SELECT ({_VALUES[name]}) AS v)"""
        )
    return _with(_CLAIMS, _AGENTS, _STATE_RISK, _AGENT_PERFORMANCE, "results AS (" + "\nUNION ALL\n".join(branches) + ")")


def _outcome(*names: str) -> str:
    return _results(*names) + " SELECT name, value, passed, status FROM results"


_LABELLED = """ SELECT *, CASE WHEN passed THEN 'pass' WHEN severity = 'warning' THEN 'warning' ELSE 'critical' END AS label
FROM results"""

_FAILED = {
    kind: f"COUNT(*) FILTER (WHERE NOT passed AND severity = '{kind}')" for kind in ("critical", "warning")
}


def _described(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", COUNT({column}) AS count, ROUND(AVG({column}), 2) AS mean,
       ROUND(STDDEV_SAMP({column}), 2) AS std, ROUND(MIN({column}), 2) AS min,
       ROUND(QUANTILE_CONT({column}, 0.25), 2) AS q25, ROUND(QUANTILE_CONT({column}, 0.5), 2) AS q50,
       ROUND(QUANTILE_CONT({column}, 0.75), 2) AS q75, ROUND(MAX({column}), 2) AS max
FROM lineitem"""


def _non_null(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{column}' AS "column", COUNT({column}) AS non_null FROM {table}"""
        for i, column in enumerate(columns)
    )


# The engines' names of the same types.
_TYPE = """CASE typeof({0}) WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
           ELSE lower(typeof({0})) END"""


def _typed(table: str, columns: list[str]) -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT {i} AS position, (SELECT {_TYPE.format(column)} FROM {table} LIMIT 1) AS type"""
        for i, column in enumerate(columns)
    )
    return f"""SELECT position, "column", type, non_null FROM ({_non_null(table, columns)}) JOIN ({kinds}) USING (position)"""


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]

_NULLABLE = {
    "order_id": "l_orderkey",
    "vendor_id": "CASE WHEN l_returnflag <> 'N' THEN l_partkey END",
    "authority": "NULLIF(l_linestatus, 'O')",
    "amount": "CASE WHEN l_discount > 0 THEN l_extendedprice END",
    "quantity": "l_quantity",
}

ORACLE_SQL: dict[str, str] = {
    "na_normalise": """
        SELECT c_custkey,
               CASE WHEN written IN ('', 'NA', 'None', '#N/A N/A') THEN NULL ELSE written END AS segment
        FROM (SELECT c_custkey,
                     CASE c_mktsegment WHEN 'BUILDING' THEN 'NA' WHEN 'MACHINERY' THEN 'None'
                          WHEN 'FURNITURE' THEN '' WHEN 'HOUSEHOLD' THEN '#N/A N/A' ELSE c_mktsegment END AS written
              FROM customer)""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    ),
    "silver_claims": """
        SELECT DISTINCT l_orderkey AS order_id, l_suppkey AS agent_id,
               CAST(o_orderdate AS DATE) AS loss_date, CAST(l_shipdate AS DATE) AS report_date,
               CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_report,
               o_orderpriority AS city,
               COALESCE(NULLIF(l_linestatus, 'O'), 'None') AS authority_contacted,
               COALESCE(NULLIF(l_returnflag, 'N'), 'Unknown') AS education_level,
               l_extendedprice AS claim_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderpriority <> '5-LOW' AND l_discount > 0 AND l_tax <> 0 AND l_extendedprice > 0""",
    "silver_dim_agent": _with(_AGENTS)
    + """ SELECT DISTINCT agent_id, agent_name, agent_state AS city, agent_state AS state
          FROM agents WHERE NULLIF(agent_state, 'NATION_3') IS NOT NULL""",
    "silver_dim_vendor": """
        SELECT DISTINCT p_name AS vendor_name, p_brand AS city,
               COALESCE(NULLIF(p_type, 'ECONOMY'), 'Unknown') AS state
        FROM part WHERE NULLIF(p_brand, 'Brand#7') IS NOT NULL""",
    "silver_enriched": _with(_CLAIMS, _AGENTS, _VENDORS)
    + """ SELECT c.* EXCLUDE (state), agent_name, agent_state, vendor_name, vendor_state
          FROM claims AS c LEFT JOIN agents AS a ON c.agent_id = a.agent_id
          LEFT JOIN vendors AS v ON c.vendor_id = v.vendor_id""",
    "gold_monthly_summary": _with(_CLAIMS)
    + f""" SELECT CAST(date_trunc('month', txn_date) AS DATE) AS month, insurance_type,
                  COUNT(*) AS total_claims, {_TOTAL} AS total_claim_amount, {_MEAN} AS avg_claim_amount,
                  MAX(claim_amount) AS max_claim_amount,
                  COUNT(*) FILTER (WHERE claim_status = 'A') AS approved_claims,
                  COUNT(*) FILTER (WHERE claim_status = 'R') AS denied_claims
           FROM claims GROUP BY 1, 2 ORDER BY month DESC, insurance_type""",
    "gold_state_risk": _with(_CLAIMS, _STATE_RISK) + " SELECT * FROM state_summary ORDER BY total_claim_amount DESC",
    "gold_agent_performance": _with(_CLAIMS, _AGENTS, _AGENT_PERFORMANCE)
    + " SELECT * FROM agent_performance ORDER BY total_claims_processed DESC",
    "gold_vendor_statistics": _with(_CLAIMS, _VENDORS)
    + f""" SELECT vendor_id, vendor_name, vendor_state, COUNT(*) AS total_claims,
                  {_TOTAL} AS total_claim_amount, {_MEAN} AS avg_claim_amount,
                  COUNT(*) FILTER (WHERE incident_severity = 'F') AS total_loss_claims
           FROM claims LEFT JOIN vendors USING (vendor_id) WHERE vendor_id IS NOT NULL
           GROUP BY vendor_id, vendor_name, vendor_state ORDER BY total_claim_amount DESC""",
    "gold_fraud_indicators": _with(_CLAIMS)
    + f""" SELECT risk_segmentation AS risk_segment, incident_severity, COUNT(*) AS claim_count,
                  {_MEAN} AS avg_claim_amount,
                  COUNT(*) FILTER (WHERE police_report_available = 0) AS no_police_report,
                  COUNT(*) FILTER (WHERE days_to_report > 7) AS late_reports,
                  COUNT(*) FILTER (WHERE authority_contacted = 'None') AS no_authority_contact
           FROM claims GROUP BY 1, 2 ORDER BY claim_count DESC""",
    "gold_tax_by_flag": """
        SELECT l_returnflag AS claim_status, COUNT(*) AS total_claims, CAST(SUM(tax) AS DOUBLE) AS total_tax,
               ROUND(CAST(SUM(tax) AS DOUBLE) / COUNT(tax), 2) AS avg_tax,
               CAST(MIN(tax) FILTER (WHERE tax > 0) AS DOUBLE) AS least_tax
        FROM (SELECT l_returnflag,
                     ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 3) AS tax
              FROM lineitem)
        GROUP BY 1 ORDER BY 1""",
    # exact sums of binary numbers, as integers of 2**-63
    "gold_fee_by_flag": """
        SELECT l_returnflag AS claim_status, COUNT(*) AS total_claims, total / 9223372036854775808.0 AS total_fee,
               ROUND(total / 9223372036854775808.0 / COUNT(fee), 2) AS avg_fee, MAX(fee) AS max_fee
        FROM (SELECT l_returnflag, fee,
                     CAST(SUM(CAST(fee * 9223372036854775808.0 AS HUGEINT)) OVER (PARTITION BY l_returnflag) AS DOUBLE) AS total
              FROM (SELECT l_returnflag, l_extendedprice / 300 AS fee FROM lineitem))
        GROUP BY l_returnflag, total ORDER BY 1""",
    "dq_volume": _outcome("claims_row_count", "agents_row_count", "vendors_row_count"),
    "dq_nonempty": _outcome("state_summary_nonempty"),
    "dq_uniqueness": _outcome("order_id_unique", "line_order_unique"),
    "dq_positive": _outcome("balance_positive"),
    "dq_range": _outcome("quantity_in_range"),
    "dq_date_order": _outcome("dates_in_order"),
    "dq_referential": _outcome("customer_known"),
    "dq_null_pct": _outcome("vendor_null_pct"),
    "dq_reconcile": _outcome("state_total_matches_claims"),
    "dq_group_min": _outcome("agents_have_claims"),
    "dq_report": _results(*_RULES) + _LABELLED,
    "dq_layer_summary": _results(*_RULES)
    + f""" SELECT layer, COUNT(*) FILTER (WHERE passed) AS passed, {_FAILED["critical"]} AS failed_critical,
                  {_FAILED["warning"]} AS failed_warning FROM results GROUP BY layer ORDER BY layer""",
    "dq_summary": _results(*_RULES)
    + f""" SELECT *, total_critical_failures = 0 AS pipeline_healthy,
                  'Ran ' || total_checks || ' quality checks: ' || total_passed || ' passed, '
                  || total_critical_failures || ' critical failures, ' || total_warnings || ' warnings. Pipeline healthy: '
                  || CASE WHEN total_critical_failures = 0 THEN 'True' ELSE 'False' END AS line
           FROM (SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS total_passed,
                        {_FAILED["critical"]} AS total_critical_failures, {_FAILED["warning"]} AS total_warnings
                 FROM results)""",
    "report_flatten": _results(*_RULES) + _LABELLED,
    "csv_split": """
        SELECT doc_id, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source,
               CAST(LENGTH(NULLIF(text, '')) AS INTEGER) AS n_chars, MD5(NULLIF(text, '')) AS text_md5
        FROM documents""",
    "profile_shape": "SELECT COUNT(*) AS n_rows, 6 AS n_columns FROM orders",
    "profile_columns": _typed("orders", _ORDER_COLUMNS),
    "profile_nulls": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", COUNT(*) - COUNT({value}) AS null_count,
            ROUND(100.0 * (COUNT(*) - COUNT({value})) / COUNT(*), 2) AS null_pct FROM lineitem"""
        for name, value in _NULLABLE.items()
    )
    + """) WHERE null_count > 0 ORDER BY null_count DESC, "column" """,
    "profile_duplicates": """SELECT (SELECT COUNT(*) FROM documents)
        - (SELECT COUNT(*) FROM (SELECT DISTINCT text FROM documents)) AS duplicate_rows""",
    "profile_describe": f"{_described('l_extendedprice')} UNION ALL {_described('l_quantity')}",
    "profile_value_counts": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", {name} AS value, COUNT(*) AS n FROM orders
            WHERE {name} IS NOT NULL GROUP BY {name}"""
        for name in ("o_orderstatus", "o_orderpriority")
    ),
    "profile_head": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3",
    "schema_drift": f"""
        WITH expected(source, "column") AS (VALUES
            ('customer', 'c_custkey'), ('customer', 'c_name'), ('customer', 'c_nationkey'), ('customer', 'c_phone'),
            ('customer', 'c_mktsegment'), ('part', 'p_partkey'), ('part', 'p_name'), ('part', 'p_brand'),
            ('part', 'p_type'), ('part', 'p_size'), ('part', 'p_retailprice')),
        observed AS (
            SELECT 'customer' AS source, "column", non_null FROM ({_non_null("customer", _CUSTOMER_COLUMNS)})
            UNION ALL
            SELECT 'part' AS source, "column", non_null FROM ({_non_null("part", _PART_COLUMNS)}))
        SELECT COALESCE(e.source, o.source) AS source, COALESCE(e."column", o."column") AS "column",
               CASE WHEN o.source IS NULL THEN 'missing' WHEN e.source IS NULL THEN 'unexpected' ELSE 'ok' END AS status,
               CASE WHEN e.source IS NULL THEN non_null END AS non_null
        FROM expected AS e FULL JOIN observed AS o ON e.source = o.source AND e."column" = o."column"
        ORDER BY 1, 2""",
    "missing_sources": """
        SELECT source, file_name, CASE WHEN n_rows IS NULL THEN 'missing' ELSE 'ok' END AS status, n_rows,
               n_rows IS NULL AS critical
        FROM (VALUES ('claims', 'lineitem.parquet', (SELECT COUNT(*) FROM lineitem)),
                     ('agents', 'supplier.parquet', (SELECT COUNT(*) FROM supplier)),
                     ('vendors', 'part.parquet', (SELECT COUNT(*) FROM part)),
                     ('payments', 'payment.parquet', NULL)) AS t(source, file_name, n_rows)
        ORDER BY source""",
}
