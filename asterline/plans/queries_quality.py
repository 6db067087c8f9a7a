"""Contract checks, evidence, verdicts, ledgers and lineage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import OLAP, OLTP, ORDER_STATUSES, Contract, Field, Rule
from asterline.functions.scalars import canonical_json
from asterline.operators import evidence as V
from asterline.operators import ledger as L
from asterline.operators import lineage as G
from asterline.operators import quality as Q
from asterline.operators import scd2
from asterline.operators.asof import asof_join
from asterline.operators.timeline import with_neighbour
from asterline.plans import model as M
from asterline.plans import star as S
from asterline.plans.catalog import MODEL, query
from asterline.plans.queries_star import _lines_with_time, ntz
from asterline.plans.steps import recorded
from asterline.plans.warehouse import STEPS, build_recorded, star
from asterline.session import scratch, stored, table

# --- the same checks as SQL, written from the contracts ------------------------------


def _row_sql(contract: Contract, source: str, where: str = "", extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{r.id}' AS rule_id, '{r.reason_code}' AS reason_code, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE NOT COALESCE({r.predicate}, false)) AS failures FROM {source} {where}"
        for r in contract.row_rules()
    )


def _key_sql(contract: Contract, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule_id, '{'DUPLICATE_GRAIN' if rule.endswith('.grain') else 'DUPLICATE_KEY'}' "
        f"AS reason_code, COALESCE(CAST(sum(n) AS BIGINT), 0) AS n_rows, COALESCE(CAST(sum(n - 1) AS BIGINT), 0) AS failures "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(columns)})"
        for rule, columns in contract.unique_sets().items()
    )


def _metrics_sql(contract: Contract) -> str:
    source = f"m_{contract.name}"
    return " UNION ALL ".join(p for p in (_row_sql(contract, source), _key_sql(contract, source)) if p)


ALL_METRICS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS contract, * FROM ({_metrics_sql(contract)})" for name, contract in OLTP.items()
)
MODEL["m_metrics"] = ALL_METRICS_SQL


def _all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    result = None
    for name, contract in OLTP.items():
        part = Q.contract_metrics(getattr(M, name)(spark, sf), contract).select(
            F.lit(name).alias("contract"), "*"
        )
        result = part if result is None else result.unionByName(part)
    return result


# --- data quality --------------------------------------------------------------------

# What is stored, with the defects the report is for.
STORED_SQL = {
    "category": "SELECT category_id, category_name FROM m_category",
    "customer": "SELECT customer_id, full_name, email_domain, registered_at, full_name AS email_address FROM m_customer",
    "product": "SELECT CAST(product_id AS INTEGER) AS product_id, product_name, category_id FROM m_product",
    "order": None,
    "order_line": "SELECT *, 1 AS loyalty_tier FROM m_order_line",
    "fact_order_line": "SELECT order_id, line_number, quantity, unit_price, 'x' AS product_name FROM m_order_line",
}
REPORTED = {**OLTP, "fact_order_line": OLAP["fact_order_line"]}
_STORED_COLUMNS = {
    "category": [("category_id", "bigint"), ("category_name", "string")],
    "customer": [("customer_id", "bigint"), ("full_name", "string"), ("email_domain", "string"),
                 ("registered_at", "timestamp_ntz"), ("email_address", "string")],
    "product": [("product_id", "int"), ("product_name", "string"), ("category_id", "bigint")],
    "order_line": [("order_id", "bigint"), ("line_number", "bigint"), ("product_id", "bigint"),
                   ("quantity", "bigint"), ("unit_price", "double"), ("loyalty_tier", "int")],
    "fact_order_line": [("order_id", "bigint"), ("line_number", "bigint"), ("quantity", "bigint"),
                        ("unit_price", "double"), ("product_name", "string")],
}
_DECLARED_VALUES = ", ".join(
    f"('{name}', '{f.name}', '{f.spark_type.simpleString()}')"
    for name, contract in REPORTED.items()
    for f in contract.fields
)
_STORED_SELECT = " UNION ALL ".join(
    f"SELECT '{name}' AS t, '{c}' AS c, '{kind}' AS stored, count(*) AS n_rows, count(*) - count({c}) AS n_nulls "
    f"FROM ({STORED_SQL[name]})"
    for name, columns in _STORED_COLUMNS.items()
    for c, kind in columns
)


@query(
    "dq_schema_report",
    f"""SELECT COALESCE(d.t, s.t) AS table_name, COALESCE(d.c, s.c) AS column_name,
               COALESCE(d.declared, '-') AS declared, COALESCE(s.stored, '-') AS stored,
               CASE WHEN COALESCE(d.t, s.t) = 'order' THEN 'missing_table'
                    WHEN s.stored IS NULL THEN 'missing_column'
                    WHEN s.c = 'email_address' THEN 'personal_name'
                    WHEN d.declared IS NULL AND s.t LIKE 'fact_%' AND s.stored = 'string' THEN 'descriptive_on_fact'
                    WHEN d.declared IS NULL THEN 'undeclared'
                    WHEN d.declared <> s.stored THEN 'retyped' ELSE 'match' END AS status,
               COALESCE(n_rows, 0) AS n_rows, COALESCE(n_nulls, 0) AS n_nulls
        FROM (VALUES {_DECLARED_VALUES}) d(t, c, declared)
        FULL JOIN ({_STORED_SELECT}) s ON d.t = s.t AND d.c = s.c""",
)
def dq_schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """Stored tables with an undeclared, a missing, a retyped and a personal column,
    a descriptive attribute on a fact, and one table that is not there."""
    customer, line = M.customer(spark, sf), M.order_line(spark, sf)
    tables = {
        "category": M.category(spark, sf),
        "customer": customer.withColumn("email_address", F.col("full_name")),
        "product": M.product(spark, sf)
        .drop("list_price")
        .withColumn("product_id", F.col("product_id").cast("int")),
        "order": None,
        "order_line": line.withColumn("loyalty_tier", F.lit(1)),
        "fact_order_line": line.drop("product_id").withColumn("product_name", F.lit("x")),
    }
    return Q.schema_report(tables, REPORTED)


@query(
    "dq_coerce",
    """SELECT 'product_id' AS column_name, count(*) AS n_rows, 0 AS failures FROM part
       UNION ALL SELECT 'p_size', count(*), count(*) FILTER (WHERE p_size % 10 = 0) FROM part
       UNION ALL SELECT 'p_brand', count(*), count(*) FROM part""",
)
def dq_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """Text read as the declared type; what cannot be read is counted per column."""
    contract = Contract(
        "raw_part",
        (Field("product_id", "int64"), Field("p_size", "int64"), Field("p_brand", "float64")),
    )
    size = F.col("p_size").cast("string")
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_size") % 10 == 0, F.concat(size, F.lit(" cm"))).otherwise(size).alias("p_size"),
        "p_brand",
    )
    return Q.uncoercible(raw, contract)


@query(
    "dq_not_null",
    """SELECT 'product_source.category.not_null' AS rule_id, 'NULL_VALUE' AS reason_code, count(*) AS n_rows,
              count(*) FILTER (WHERE c.category_name IS NULL) AS failures
       FROM m_product LEFT JOIN m_category c USING (category_id)
       UNION ALL SELECT 'product_source.name.not_null', 'NULL_VALUE', count(*), 0 FROM m_product""",
)
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    looked_up = M.product(spark, sf).join(M.category(spark, sf), "category_id", "left")
    rules = [
        Rule("product_source.category.not_null", "category_name IS NOT NULL", "NULL_VALUE"),
        Rule("product_source.name.not_null", "product_name IS NOT NULL", "NULL_VALUE"),
    ]
    return Q.rule_metrics(looked_up, rules)


@query(
    "dq_unique",
    "SELECT p_name AS product_name, count(*) AS copies FROM part GROUP BY p_name HAVING count(*) > 1",
)
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicates(M.product(spark, sf), ["product_name"])


@query(
    "dq_grain",
    "SELECT order_id, line_number, count(*) AS copies FROM m_order_line GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_grain(spark: SparkSession, sf: str) -> DataFrame:
    return Q.duplicates(M.order_line(spark, sf), OLTP["order_line"].grain)


@query("dq_range", "SELECT * FROM m_metrics WHERE reason_code = 'OUT_OF_RANGE'")
def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    result = None
    for name, contract in OLTP.items():
        rules = [r for r in contract.row_rules() if r.reason_code == "OUT_OF_RANGE"]
        part = Q.rule_metrics(getattr(M, name)(spark, sf), rules).select(
            F.lit(name).alias("contract"), "*"
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "dq_isin",
    """SELECT o_orderstatus AS status, count(*) AS n_rows FROM orders
       WHERE o_orderstatus NOT IN ('O', 'F') OR o_orderstatus IS NULL GROUP BY 1""",
)
def dq_isin(spark: SparkSession, sf: str) -> DataFrame:
    """Values outside a closed set, here one that forgot a status."""
    field = Field("status", "string", isin=("O", "F"))
    coded = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"))
    return Q.quarantine(coded, field.row_rules("order")).groupBy("status").agg(
        F.count("*").alias("n_rows")
    )


MODEL["m_read_fact_order_line"] = "SELECT * FROM m_fact"
MODEL["m_read_dim_date"] = "SELECT * FROM m_dim_date"
for _name, _unknown in (
    ("dim_product", "SELECT -1, -1, 'Unknown', 'Unknown', 0.0"),
    ("dim_customer", "SELECT -1, -1, 'Unknown', 'Unknown'"),
):
    MODEL[f"m_read_{_name}"] = f"""
    SELECT * EXCLUDE (updated_at, "__START_AT", "__END_AT"), "__START_AT" AS valid_from, "__END_AT" AS valid_to,
           "__END_AT" IS NULL AS is_current FROM m_{_name}
    UNION ALL {_unknown}, TIMESTAMP '1900-01-01 00:00:00', NULL, true"""


@query(
    "dq_star_contracts",
    " UNION ALL ".join(
        p
        for name, contract in OLAP.items()
        for p in (_row_sql(contract, f"m_read_{name}"), _key_sql(contract, f"m_read_{name}"))
        if p
    ),
)
def dq_star_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of every star table, on the star as its readers see it."""
    s = star(spark, sf)
    read = {
        "dim_product": S.with_unknown(scd2.reader_view(s.dim_product)),
        "dim_customer": S.with_unknown(scd2.reader_view(s.dim_customer)),
        "dim_date": s.dim_date,
        "fact_order_line": s.fact_order_line,
    }
    result = None
    for name, contract in OLAP.items():
        part = Q.contract_metrics(read[name], contract)
        result = part if result is None else result.unionByName(part)
    return result


LINE_RULES = (
    Rule("order_positive", "order_id > 0"),
    Rule("small_order", "quantity <= 45"),
    Rule("fair_price", "unit_price < 2000 AND unit_price > 0"),
)
_LINE_PASS = "order_id > 0 AND quantity <= 45 AND unit_price < 2000 AND unit_price > 0"


@query("dq_expect_or_drop", f"SELECT * FROM m_order_line WHERE {_LINE_PASS}")
def dq_expect_or_drop(spark: SparkSession, sf: str) -> DataFrame:
    return Q.keep(M.order_line(spark, sf), LINE_RULES)


@query(
    "dq_quarantine",
    f"""SELECT *, concat_ws(',', CASE WHEN NOT order_id > 0 THEN 'order_positive' END,
              CASE WHEN NOT quantity <= 45 THEN 'small_order' END,
              CASE WHEN NOT (unit_price < 2000 AND unit_price > 0) THEN 'fair_price' END) AS failed
        FROM m_order_line WHERE NOT ({_LINE_PASS})""",
)
def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = Q.quarantine(M.order_line(spark, sf), LINE_RULES)
    return bad.withColumn("failed", F.array_join(Q.FAILED, ",")).drop(Q.FAILED)


@query(
    "dq_expect_metrics",
    """SELECT 'order_positive' AS rule_id, count(*) AS n_rows, count(*) FILTER (WHERE NOT order_id > 0) AS failures FROM m_order_line
       UNION ALL SELECT 'small_order', count(*), count(*) FILTER (WHERE NOT quantity <= 45) FROM m_order_line
       UNION ALL SELECT 'fair_price', count(*), count(*) FILTER (WHERE NOT (unit_price < 2000 AND unit_price > 0)) FROM m_order_line""",
)
def dq_expect_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return Q.rule_metrics(M.order_line(spark, sf), LINE_RULES).drop("reason_code")


@query("dq_all_failures", "SELECT * FROM m_metrics WHERE failures > 0")
def dq_all_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of every contract that fails, not the first."""
    return _all_metrics(spark, sf).filter("failures > 0")


@query(
    "dq_price_in_force",
    """SELECT l.product_id, count(*) AS lines,
              count(*) FILTER (WHERE v.product_key IS NULL) AS unresolved,
              count(*) FILTER (WHERE abs(v.list_price - l.unit_price) > 0.005) AS other_price
       FROM m_order_line l JOIN m_order o USING (order_id)
       LEFT JOIN m_dim_product v ON v.product_id = l.product_id AND o.ordered_at >= v."__START_AT"
            AND (v."__END_AT" IS NULL OR o.ordered_at < v."__END_AT")
       GROUP BY l.product_id""",
)
def dq_price_in_force(spark: SparkSession, sf: str) -> DataFrame:
    """The price charged against the version in force when the order was placed."""
    priced = asof_join(
        _lines_with_time(spark, sf), star(spark, sf).dim_product, "product_id", "ordered_at",
        ["product_key", "list_price"],
    )
    return priced.groupBy("product_id").agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("product_key").isNull()).alias("unresolved"),
        F.count_if(F.abs(F.col("list_price") - F.col("unit_price")) > 0.005).alias("other_price"),
    )


# --- evidence, verdicts, decisions -----------------------------------------------------

OBSERVED_AT = "2026-03-01 00:00:00"
_MESSAGE = "failures || ' of ' || n_rows || ' rows'"
MODEL["m_verdict"] = f"""
    SELECT contract, count(*) AS rules, count(*) FILTER (WHERE n_rows > 0) AS rules_run,
           CASE WHEN count(*) FILTER (WHERE failures > 0) > 0 THEN 'fail'
                WHEN count(*) FILTER (WHERE n_rows > 0) < count(*) THEN 'unknown' ELSE 'pass' END AS outcome,
           COALESCE(string_agg('  ' || rule_id || ' ' || reason_code || ': ' || {_MESSAGE}, chr(10) ORDER BY rule_id)
                    FILTER (WHERE failures > 0), '') AS broken
    FROM m_metrics GROUP BY contract"""
_REASON = """CASE outcome WHEN 'fail' THEN 'POLICY_VIOLATIONS' WHEN 'pass' THEN 'POLICY_SATISFIED'
             ELSE CASE WHEN rules_run = 0 THEN 'POLICY_ENGINE_UNAVAILABLE' ELSE 'POLICY_QUERY_UNDEFINED' END END"""


def _verdicts(spark: SparkSession, sf: str) -> DataFrame:
    rules = V.rule_table(spark, OLTP.values()).select("contract", "rule_id", "reason_code")
    return V.verdicts(rules, _all_metrics(spark, sf), ["contract"])


@query(
    "ev_evidence",
    f"""SELECT contract, rule_id, '{{"failures":' || failures || ',"rows":' || n_rows || '}}' AS observed,
               'oltp.' || contract AS source, TIMESTAMP '{OBSERVED_AT}' AS observed_at FROM m_metrics""",
)
def ev_evidence(spark: SparkSession, sf: str) -> DataFrame:
    source = F.concat(F.lit("oltp."), F.col("contract"))
    return V.evidence(_all_metrics(spark, sf), source, ntz(OBSERVED_AT)).drop("n_rows", "failures")


@query(
    "ev_verdict",
    f"""SELECT contract, outcome, reason_code, rules, rules_run,
               contract || ': ' || outcome || ' (' || reason_code || ')' ||
               CASE WHEN broken = '' THEN '' ELSE chr(10) || broken END AS explanation
        FROM (SELECT *, {_REASON} AS reason_code FROM m_verdict)""",
)
def ev_verdict(spark: SparkSession, sf: str) -> DataFrame:
    verdict = _verdicts(spark, sf)
    return verdict.withColumn("explanation", V.explain(verdict, F.col("contract"))).drop("violations")


@query(
    "ev_violations",
    f"SELECT contract, rule_id AS id, reason_code, {_MESSAGE} AS message FROM m_metrics WHERE failures > 0",
)
def ev_violations(spark: SparkSession, sf: str) -> DataFrame:
    return V.violations(_verdicts(spark, sf), ["contract"])


@query(
    "ev_decision",
    """SELECT contract, outcome,
              CASE WHEN outcome = 'fail' AND contract = 'order_line' THEN 'quarantine'
                   WHEN outcome = 'pass' THEN 'publish' ELSE 'halt' END AS action,
              CASE WHEN outcome = 'fail' AND contract = 'order_line' THEN 'GRAIN_KNOWN_BROKEN'
                   WHEN outcome = 'pass' THEN 'POLICY_SATISFIED' WHEN outcome = 'fail' THEN 'POLICY_VIOLATIONS'
                   ELSE 'POLICY_NOT_EVALUATED' END AS decision_reason
       FROM m_verdict""",
)
def ev_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Each verdict's response; the known grain fault is quarantined, not waved through."""
    overrides = spark.createDataFrame(
        [("order_line", "quarantine", "GRAIN_KNOWN_BROKEN")],
        "contract string, override string, override_reason string",
    )
    return V.decisions(_verdicts(spark, sf), overrides).select(
        "contract", "outcome", "action", "decision_reason"
    )


@query(
    "ev_fail_closed",
    """SELECT s.status, CASE WHEN count(o.order_id) = 0 THEN 'unknown'
              WHEN count(*) FILTER (WHERE NOT o.order_id > 0) > 0 THEN 'fail' ELSE 'pass' END AS outcome,
              CASE WHEN count(o.order_id) = 0 THEN 'POLICY_ENGINE_UNAVAILABLE'
              WHEN count(*) FILTER (WHERE NOT o.order_id > 0) > 0 THEN 'POLICY_VIOLATIONS' ELSE 'POLICY_SATISFIED' END AS reason_code,
              CASE WHEN count(o.order_id) > 0 AND count(*) FILTER (WHERE NOT o.order_id > 0) = 0 THEN 'publish' ELSE 'halt' END AS action
       FROM (VALUES ('placed'), ('shipped'), ('delivered'), ('cancelled')) s(status)
       LEFT JOIN m_order o USING (status) GROUP BY s.status
       UNION ALL SELECT 'returned', 'unknown', 'POLICY_ENGINE_UNAVAILABLE', 'halt'""",
)
def ev_fail_closed(spark: SparkSession, sf: str) -> DataFrame:
    """One verdict per listed status; a status without orders was not judged."""
    rule = Rule("order.order_id.gt", "order_id > 0", "OUT_OF_RANGE")
    metrics = Q.rule_metrics(M.order(spark, sf), [rule], by=["status"])
    expected = spark.createDataFrame(
        [(s, rule.id, rule.reason_code) for s in ORDER_STATUSES],
        "status string, rule_id string, reason_code string",
    )
    # A status that is listed but has no rule at all must not vanish.
    listed = spark.createDataFrame([(s,) for s in (*ORDER_STATUSES, "returned")], "status string")
    verdict = V.verdicts(expected, metrics, ["status"], listed)
    return V.decisions(verdict).select("status", "outcome", "reason_code", "action")


_RULE_VALUES = ", ".join(
    "('{}', '{}', '{}')".format(c, i, p.replace("'", "''"))
    for c, i, p in [
        (contract.name, r.id, r.predicate) for contract in OLTP.values() for r in contract.row_rules()
    ]
    + [
        (contract.name, rule, f"UNIQUE ({', '.join(columns)})")
        for contract in OLTP.values()
        for rule, columns in contract.unique_sets().items()
    ]
)


@query(
    "ev_policy_revision",
    f"""SELECT contract, sha256(string_agg(r || ' ' || p, chr(10) ORDER BY r || ' ' || p)) AS policy_revision,
               count(*) AS rules, max(n_rows) AS rows_judged
        FROM (VALUES {_RULE_VALUES}) v(contract, r, p)
        JOIN (SELECT contract, max(n_rows) AS n_rows FROM m_metrics GROUP BY contract) USING (contract)
        GROUP BY contract""",
)
def ev_policy_revision(spark: SparkSession, sf: str) -> DataFrame:
    """What was checked, named by its digest, beside how many rows it was checked on."""
    revision = V.policy_revision(V.rule_table(spark, OLTP.values()), ["contract"])
    judged = _all_metrics(spark, sf).groupBy("contract").agg(F.max("n_rows").alias("rows_judged"))
    return revision.join(judged, "contract")


@query(
    "ev_history",
    """SELECT outcome, month, count(*) AS verdicts FROM (
         SELECT customer_id % 10 AS shard, date_trunc('month', ordered_at) AS month,
                CASE WHEN count(*) FILTER (WHERE NOT order_id > 0 OR status = 'shipped' AND customer_id % 100 = 7) > 0
                     THEN 'fail' ELSE 'pass' END AS outcome
         FROM m_order GROUP BY 1, 2) GROUP BY outcome, month""",
)
def ev_history(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts per shard and month of order, counted over time."""
    rules = [
        Rule("order.order_id.gt", "order_id > 0", "OUT_OF_RANGE"),
        Rule("order.blocked", "NOT (status = 'shipped' AND customer_id % 100 = 7)", "BLOCKED_CUSTOMER"),
    ]
    orders = M.order(spark, sf).select(
        "*",
        (F.col("customer_id") % 10).alias("shard"),
        F.date_trunc("month", "ordered_at").cast("timestamp_ntz").alias("month"),
    )
    by = ["shard", "month"]
    metrics = stored(Q.rule_metrics(orders, rules, by=by), "metrics")
    verdict = V.verdicts(metrics.select(*by, "rule_id", "reason_code"), metrics, by)
    return V.decisions(verdict).groupBy("outcome", "month").agg(F.count("*").alias("verdicts"))


# --- ledgers ---------------------------------------------------------------------------

MODEL["m_entry"] = """
    SELECT CAST(o_custkey AS VARCHAR) AS chain_id, 'node-' || (o_orderkey % 4) AS machine,
           '{"order_id":' || o_orderkey || ',"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}' AS payload,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS sequence
    FROM orders"""
_MATERIAL = """sha256('{"machine":"' || e.machine || '","payload":' || e.payload || ',"previous_hash":"' ||
               PREVIOUS || '","sequence":' || e.sequence || '}')"""
_LINK = "c.entry_hash"
_CHAIN_SQL = f"""WITH RECURSIVE chained AS (
    SELECT e.chain_id, e.sequence, repeat('0', 64) AS previous_hash,
           {_MATERIAL.replace("PREVIOUS", "repeat('0', 64)")} AS entry_hash, e.machine, e.payload
    FROM m_entry e WHERE e.sequence = 0
    UNION ALL
    SELECT e.chain_id, e.sequence, {_LINK}, {_MATERIAL.replace("PREVIOUS", _LINK)}, e.machine, e.payload
    FROM chained c JOIN m_entry e ON e.chain_id = c.chain_id AND e.sequence = c.sequence + 1)"""


def _entries(spark: SparkSession, sf: str, chain: str = "o_custkey") -> DataFrame:
    """One audit entry per order, chained per customer or another column."""
    payload = canonical_json(
        order_id=F.col("o_orderkey"), status=F.col("o_orderstatus"), priority=F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select(
        F.col(chain).cast("string").alias("chain_id"),
        "o_orderkey",
        F.concat(F.lit("node-"), F.col("o_orderkey") % 4).alias("machine"),
        payload.alias("payload"),
    )


@query("ledger_build", f"{_CHAIN_SQL} SELECT * FROM chained")
def ledger_build(spark: SparkSession, sf: str) -> DataFrame:
    return L.build(_entries(spark, sf), "o_orderkey")


@query(
    "ledger_verify",
    """SELECT CAST(c_custkey AS VARCHAR) AS chain_id, count(o_orderkey) AS entries, true AS intact, -1 AS broken_at,
              CASE WHEN count(o_orderkey) = 0 THEN 'empty ledger' ELSE 'chain verifies' END AS detail
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def ledger_verify(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's chain walked; customers without orders have an empty one."""
    ledger = stored(L.build(_entries(spark, sf), "o_orderkey"), "ledger")
    chains = table(spark, sf, "customer").select(F.col("c_custkey").alias("chain_id"))
    return L.verify(ledger.withColumn("line", F.col("sequence")), "line", chains)


@query(
    "ledger_long_chain",
    """SELECT o_orderstatus AS chain_id, count(*) AS entries, true AS intact, -1 AS broken_at, 'chain verifies' AS detail
       FROM orders GROUP BY o_orderstatus""",
)
def ledger_long_chain(spark: SparkSession, sf: str) -> DataFrame:
    """One chain for each order status: thousands of entries, the same format as a short one."""
    entries = _entries(spark, sf, "o_orderstatus")
    ledger = stored(L.build(entries, "o_orderkey"), "ledger")
    return L.verify(ledger.withColumn("line", F.col("sequence")), "line")


@query("ledger_append", f"{_CHAIN_SQL} SELECT * FROM chained")
def ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, the second after the tails of the first, are the chains of one load."""
    entries = _entries(spark, sf)
    half = entries.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0] or 0
    first = stored(L.build(entries.where(F.col("o_orderkey") <= half), "o_orderkey"), "ledger")
    return first.unionByName(L.build(entries.where(F.col("o_orderkey") > half), "o_orderkey", first))


@query(
    "ledger_erased_fields",
    """WITH n AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
       SELECT CAST(k AS VARCHAR) AS chain_id, n AS entries, false AS intact, n - 1 AS broken_at,
              CASE k % 4 WHEN 0 THEN 'sequence none found at position ' || (n - 1)
                   WHEN 1 THEN 'previous_hash does not match the preceding record'
                   ELSE 'the record''s contents do not match its hash' END AS detail
       FROM n""",
)
def ledger_erased_fields(spark: SparkSession, sf: str) -> DataFrame:
    """One field of each chain's last entry is erased; nothing after it could show that."""
    ledger = stored(L.build(_entries(spark, sf), "o_orderkey"), "ledger")
    last = ledger.groupBy("chain_id").agg(F.max("sequence").alias("_last"))
    log = ledger.join(last, "chain_id").withColumn("line", F.col("sequence"))
    kind, at = F.col("chain_id").cast("long") % 4, F.col("line") == F.col("_last")
    for n, field in enumerate(("sequence", "previous_hash", "payload", "entry_hash")):
        log = log.withColumn(field, F.when(~(at & (kind == n)), F.col(field)))
    return L.verify(log, "line")


CASES = ("intact", "edited", "swapped", "deleted", "truncated", "unlinked")


def tampered(ledger: DataFrame) -> DataFrame:
    """Each chain damaged in one of six ways, by its number; `line` is the log order."""
    n, seq = F.col("chain_id").cast("long") % 6, F.col("sequence")
    case = F.element_at(F.array(*[F.lit(c) for c in CASES]), (n + 1).cast("int"))
    length = ledger.groupBy("chain_id").agg(F.count("*").alias("_length"))
    log = ledger.join(length, "chain_id").withColumn("case", case)
    line = F.when((F.col("case") == "swapped") & (seq < 2) & (F.col("_length") > 1), 1 - seq).otherwise(seq)
    payload = F.when(
        (F.col("case") == "edited") & (seq == 1), F.replace("payload", F.lit('"status"'), F.lit('"state"'))
    ).otherwise(F.col("payload"))
    previous = F.when((F.col("case") == "unlinked") & (seq == 2), F.repeat(F.lit("f"), F.lit(64))).otherwise(
        F.col("previous_hash")
    )
    gone = ((F.col("case") == "deleted") & (seq == 1)) | (
        (F.col("case") == "truncated") & (seq >= F.col("_length") - 2)
    )
    return log.withColumns({"line": line, "payload": payload, "previous_hash": previous}).filter(~gone)


@query(
    "ledger_tamper_cases",
    """WITH n AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
       d AS (SELECT CAST(k AS VARCHAR) AS chain_id, k % 6 AS c, n,
              CASE WHEN k % 6 = 3 AND n > 1 THEN n - 1 WHEN k % 6 = 4 THEN greatest(n - 2, 0) ELSE n END AS entries,
              CASE WHEN k % 6 = 1 AND n > 1 THEN 1 WHEN k % 6 = 2 AND n > 1 THEN 0
                   WHEN k % 6 = 3 AND n > 2 THEN 1 WHEN k % 6 = 5 AND n > 2 THEN 2 ELSE -1 END AS broken_at FROM n)
       SELECT chain_id, entries, broken_at = -1 AS intact, broken_at,
              CASE WHEN entries = 0 THEN 'empty ledger' WHEN broken_at = -1 THEN 'chain verifies'
                   WHEN c = 1 THEN 'the record''s contents do not match its hash'
                   WHEN c = 2 THEN 'sequence 1 found at position 0' WHEN c = 3 THEN 'sequence 2 found at position 1'
                   ELSE 'previous_hash does not match the preceding record' END AS detail
       FROM d""",
)
def ledger_tamper_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Edits, swaps, deletions and false links are found; a cut-off tail is not, by design."""
    ledger = stored(L.build(_entries(spark, sf), "o_orderkey"), "ledger")
    return L.verify(tampered(ledger), "line", ledger.select("chain_id"))


_HISTORY_RULES = [
    Rule("order.order_id.gt", "order_id > 0", "OUT_OF_RANGE"),
    Rule("order.blocked", "NOT (status = 'shipped' AND customer_id % 100 = 7)", "BLOCKED_CUSTOMER"),
]
_HISTORY_REVISION = "\n".join(sorted(f"{r.id} {r.predicate}" for r in _HISTORY_RULES)).replace("'", "''")
MODEL["m_decision"] = f"""
    SELECT 'order/' || shard AS chain_id, 'policy' AS machine, row_number() OVER (PARTITION BY shard ORDER BY month) - 1 AS sequence,
           '{{"action":"' || CASE WHEN broken = '' THEN 'publish' ELSE 'halt' END || '","contract":"order/' || shard ||
           '","evaluated_at":"' || strftime(month, '%Y-%m-%d') || '","outcome":"' || CASE WHEN broken = '' THEN 'pass' ELSE 'fail' END ||
           '","policy_revision":"' || sha256('{_HISTORY_REVISION}') || '","reason_code":"' ||
           CASE WHEN broken = '' THEN 'POLICY_SATISFIED' ELSE 'POLICY_VIOLATIONS' END || '","violations":[' || broken || ']}}' AS payload
    FROM (SELECT shard, month, array_to_string(list_filter([
             CASE WHEN b > 0 THEN '{{"id":"order.blocked","message":"' || b || ' of ' || n || ' rows","reason_code":"BLOCKED_CUSTOMER"}}' END,
             CASE WHEN o > 0 THEN '{{"id":"order.order_id.gt","message":"' || o || ' of ' || n || ' rows","reason_code":"OUT_OF_RANGE"}}' END],
             lambda x: x IS NOT NULL), ',') AS broken
          FROM (SELECT customer_id % 10 AS shard, date_trunc('month', ordered_at) AS month, count(*) AS n,
                       count(*) FILTER (WHERE status = 'shipped' AND customer_id % 100 = 7) AS b,
                       count(*) FILTER (WHERE NOT order_id > 0) AS o FROM m_order GROUP BY 1, 2))"""


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    """One decision for each shard of orders and month, as ledger entries."""
    by = ["shard", "month"]
    month = F.date_trunc("month", "ordered_at").cast("date").alias("month")
    orders = M.order(spark, sf).select("*", (F.col("customer_id") % 10).alias("shard"), month)
    metrics = stored(Q.rule_metrics(orders, _HISTORY_RULES, by=by), "metrics")
    decided = V.decisions(V.verdicts(metrics.select(*by, "rule_id", "reason_code"), metrics, by))
    rules = spark.createDataFrame([("order", r.id, r.predicate) for r in _HISTORY_RULES], "contract string, rule_id string, predicate string")
    revision = V.policy_revision(rules, ["contract"]).first().policy_revision
    return V.decision_entries(decided, F.concat(F.lit("order/"), "shard"), F.lit(revision), F.col("month"), "policy")


@query("decision_ledger", f"{_CHAIN_SQL.replace('m_entry', 'm_decision')} SELECT * FROM chained")
def decision_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Every decision with its contract, outcome, action, revision, violations and time, chained; the later half is a load of its own."""
    entries = stored(_decisions(spark, sf), "decisions")
    half = F.col("at") < F.lit("1995-06-01").cast("date")
    first = stored(L.build(entries.where(half), "at"), "ledger")
    return L.appended(first, stored(L.build(entries.where(~half), "at", first), "ledger"))


# --- lineage ---------------------------------------------------------------------------

_CASES_SOURCE = " ".join(f"WHEN {i} THEN '{s}'" for i, (s, _) in enumerate(M.STAR_EDGES))
_CASES_TARGET = " ".join(f"WHEN {i} THEN '{t}'" for i, (_, t) in enumerate(M.STAR_EDGES))
MODEL["m_log"] = f"""
    SELECT CASE event_type WHEN 'click' THEN CASE event_id % {len(M.STAR_EDGES)} {_CASES_SOURCE} END
                WHEN 'view' THEN 'olap.fact_order_line' WHEN 'purchase' THEN 'mart.user_' || user_id
                WHEN 'error' THEN CASE WHEN event_id % 7 = 0 THEN 'olap.fact_order_line' ELSE 'stage.batch_' || user_id END
           END AS source,
           CASE event_type WHEN 'click' THEN CASE event_id % {len(M.STAR_EDGES)} {_CASES_TARGET} END
                WHEN 'view' THEN 'mart.user_' || user_id WHEN 'purchase' THEN 'mart.user_' || (user_id // 2)
                WHEN 'error' THEN CASE WHEN event_id % 7 = 0 THEN
                     (['oltp.category','oltp.customer','oltp.order','oltp.order_line','oltp.product'])[user_id % 5 + 1]
                     ELSE 'olap.dim_product' END
                ELSE 'mart.user_' || user_id END AS target, ts AS at
    FROM events"""
MODEL["m_edge"] = "SELECT DISTINCT source, target FROM m_log WHERE source IS NOT NULL"


def _names(spark: SparkSession, names) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "name string")


@query("distinct_edges", "SELECT source, target FROM m_edge")
def distinct_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.edges(M.lineage_log(spark, sf))


@query("lineage_upstream", "SELECT source FROM m_edge WHERE target = 'olap.fact_order_line'")
def lineage_upstream(spark: SparkSession, sf: str) -> DataFrame:
    return G.upstream_of(M.lineage_log(spark, sf), "olap.fact_order_line")


@query(
    "lineage_untraced",
    """SELECT name FROM (SELECT 'olap.dim_product' AS name UNION ALL SELECT 'olap.dim_customer'
         UNION ALL SELECT 'olap.fact_order_line' UNION ALL SELECT 'olap.dim_date'
         UNION ALL SELECT DISTINCT 'mart.user_' || c_custkey FROM customer)
       WHERE name NOT IN (SELECT target FROM m_edge)""",
)
def lineage_untraced(spark: SparkSession, sf: str) -> DataFrame:
    """Published tables with no upstream: the calendar, and reports nobody wrote."""
    reports = table(spark, sf, "customer").select(
        F.concat(F.lit("mart.user_"), F.col("c_custkey")).alias("name")
    )
    return G.untraced(
        _names(spark, [f"olap.{n}" for n in OLAP]).unionByName(reports), M.lineage_log(spark, sf)
    )


@query(
    "lineage_required_edges",
    """SELECT source, target FROM (
         SELECT 'olap.dim_product' AS source, 'olap.fact_order_line' AS target
         UNION ALL SELECT 'olap.dim_customer', 'olap.fact_order_line'
         UNION ALL SELECT 'oltp.category', 'olap.dim_product'
         UNION ALL SELECT 'olap.dim_date', 'olap.fact_order_line') r
       WHERE NOT EXISTS (SELECT 1 FROM m_edge e WHERE e.source = r.source AND e.target = r.target)""",
)
def lineage_required_edges(spark: SparkSession, sf: str) -> DataFrame:
    required = [
        ("olap.dim_product", "olap.fact_order_line"),
        ("olap.dim_customer", "olap.fact_order_line"),
        ("oltp.category", "olap.dim_product"),
        ("olap.dim_date", "olap.fact_order_line"),
    ]
    frame = spark.createDataFrame(required, "source string, target string")
    return G.missing_edges(frame, M.lineage_log(spark, sf))


@query(
    "lineage_foreign_edges",
    """SELECT source, target FROM m_edge WHERE target LIKE 'olap.%' AND source NOT LIKE 'olap.%'
         AND source NOT LIKE 'oltp.%'""",
)
def lineage_foreign_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.foreign_edges(M.lineage_log(spark, sf), "olap", ["olap", "oltp"])


@query(
    "lineage_source_cycle",
    "SELECT source, target FROM m_edge WHERE source LIKE 'olap.%' AND target LIKE 'oltp.%'",
)
def lineage_source_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return G.into_sources(M.lineage_log(spark, sf), _names(spark, M.SOURCES), "olap")


@query(
    "lineage_impact",
    """WITH RECURSIVE reach AS (
         SELECT DISTINCT source AS root, source AS affected FROM m_edge WHERE source LIKE 'oltp.%'
         UNION SELECT r.root, e.target FROM reach r JOIN m_edge e ON e.source = r.affected)
       SELECT root, affected FROM reach WHERE root <> affected""",
)
def lineage_impact(spark: SparkSession, sf: str) -> DataFrame:
    """If a source table changes: everything downstream, however far."""
    reached = G.impact(M.lineage_log(spark, sf), _names(spark, M.SOURCES))
    return reached.select("root", "affected")


@query(
    "lineage_impact_chain",
    """SELECT 'event_' || min(event_id) OVER (PARTITION BY user_id) AS root, 'event_' || event_id AS affected,
              CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS depth
       FROM events QUALIFY depth > 0""",
)
def lineage_impact_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events as a chain of any length: how far each is from the first."""
    events = table(spark, sf, "events").select("user_id", "event_id")
    name = lambda column: F.concat(F.lit("event_"), F.col(column))
    following = with_neighbour(events, ["user_id"], "event_id", "event_id", "next_id").where("next_id IS NOT NULL")
    log = following.select(name("event_id").alias("source"), name("next_id").alias("target"))
    first = events.groupBy("user_id").agg(F.min("event_id").alias("first")).select(name("first").alias("name"))
    return G.impact(log, first)


_READ = ", ".join(f"('{source}', '{step.target}')" for step in STEPS for source in step.reads)


@query(
    "lineage_recorded",
    f"""SELECT source, target, n_rows FROM (VALUES {_READ}) e(source, target) JOIN (
         SELECT 'olap.dim_product' AS target, count(*) AS n_rows FROM m_dim_product
         UNION ALL SELECT 'olap.dim_customer', count(*) FROM m_dim_customer
         UNION ALL SELECT 'olap.dim_date', count(*) FROM m_dim_date
         UNION ALL SELECT 'olap.fact_order_line', count(*) FROM m_fact) USING (target)""",
)
def lineage_recorded(spark: SparkSession, sf: str) -> DataFrame:
    """What a build of the star really read: its log's edges, with the rows of each table written."""
    log = scratch(spark, "lineage-log")
    built = build_recorded(spark, sf, log)
    counts = None
    for step in STEPS:
        one = built[step.target].agg(F.count("*").alias("n_rows")).select(F.lit(step.target).alias("target"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return G.edges(recorded(spark, log)).join(counts, "target").select("source", "target", "n_rows")
