"""Contracts, row rules, evidence, verdicts and decisions."""

from __future__ import annotations

import pytest
from conftest import day
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterline.contracts import (
    OLAP, OLTP, Contract, ContractBroken, Field, Rule, UnmappedTypeError, create_statement, generated_keys,
)
from asterline.operators import evidence as V
from asterline.operators import lookup, quality
from asterline.plans import star as S
from asterline.sources import sinks, tables


def broken_rules(df, contract):
    return {r.rule_id for r in quality.all_failures(df, contract).collect()}


def test_seed_passes_every_contract(seed):
    for name in OLTP:
        assert broken_rules(getattr(seed, name), OLTP[name]) == set()
        quality.validated(getattr(seed, name), OLTP[name])


CHANGES = [
    ("customer", {"customer_id": "1L"}, "customer.customer_id.unique"),
    ("customer", {"full_name": "CAST(NULL AS STRING)"}, "customer.full_name.not_null"),
    ("customer", {"email_domain": "'ada@example.test'"}, "customer.email_domain.forbid"),
    ("order_line", {"quantity": "-3L"}, "order_line.quantity.gt"),
    ("product", {"list_price": "-1.0D"}, "product.list_price.gt"),
    ("order", {"status": "'plcaed'"}, "order.status.isin"),
    ("order_line", {"order_id": "1L", "line_number": "1L"}, "order_line.grain"),
]


@pytest.mark.parametrize("name,change,rule", CHANGES)
def test_one_change_is_refused(seed, name, change, rule):
    changed = getattr(seed, name).withColumns({c: F.expr(text) for c, text in change.items()})
    assert broken_rules(changed, OLTP[name]) == {rule}
    with pytest.raises(ContractBroken, match=rule):
        quality.validated(changed, OLTP[name])


def star_rows(spark):
    line = (1, 1, -1, 5, 20260101, 2, 1.0, 2.0)
    fact = spark.createDataFrame([line], OLAP["fact_order_line"].schema)
    product = (1, 7, "Hammer", "Tools", 9.0, day("2026-01-01"), None, True)
    dim = spark.createDataFrame([product, (-1, -1, "Unknown", "Unknown", 0.0, day("1900-01-01"), None, True)],
                                OLAP["dim_product"].schema)
    return fact, dim


def test_star_contracts(spark):
    fact, dim = star_rows(spark)
    f, d = OLAP["fact_order_line"], OLAP["dim_product"]
    assert broken_rules(fact, f) == set() and broken_rules(dim, d) == set()
    assert broken_rules(fact.union(fact), f) == {"fact_order_line.grain"}
    assert broken_rules(dim.withColumn("product_key", F.lit(3).cast("long")), d) == {"dim_product.product_key.unique"}
    assert "dim_product.product_key.ge" in broken_rules(dim.withColumn("product_key", F.lit(-2).cast("long")), d)
    assert broken_rules(fact.withColumn("line_revenue", F.lit(-1.0)), f) == {
        "fact_order_line.line_revenue.ge", "fact_order_line.line_revenue.product",
    }
    assert broken_rules(fact.withColumn("unit_price", F.lit(3.0)), f) == {"fact_order_line.line_revenue.product"}
    assert broken_rules(fact.withColumn("date_key", F.lit(999).cast("long")), f) == {"fact_order_line.date_key.ge"}


def test_built_tables_keep_their_contracts(seed):
    from test_history import customer_feed, product_feed

    products = S.dim_product(product_feed(seed))
    customers = S.dim_customer(customer_feed(seed))
    from asterline.operators.scd2 import reader_view

    assert broken_rules(S.with_unknown(reader_view(products)), OLAP["dim_product"]) == set()
    assert broken_rules(S.with_unknown(reader_view(customers)), OLAP["dim_customer"]) == set()
    assert broken_rules(S.calendar_of(seed.order, "ordered_at"), OLAP["dim_date"]) == set()
    fact = S.fact_order_line(seed.order_line, seed.order, products, customers)
    assert broken_rules(fact, OLAP["fact_order_line"]) == set()


def test_undeclared_column_is_refused_before_reading(seed):
    with pytest.raises(ContractBroken, match="loyalty_tier: undeclared"):
        quality.validated(seed.customer.withColumn("loyalty_tier", F.lit(1)), OLTP["customer"])


def test_values_are_coerced(seed):
    text = seed.category.withColumn("category_id", F.col("category_id").cast("string"))
    assert quality.validated(text, OLTP["category"]).schema["category_id"].dataType == T.LongType()
    with pytest.raises(ContractBroken, match="category_id: 3 values"):
        quality.validated(text.withColumn("category_id", F.lit("ten")), OLTP["category"])


def test_unmapped_type_names_column_and_remedy():
    contract = Contract("t", (Field("paid", "decimal"),))
    with pytest.raises(UnmappedTypeError, match="ERR_UNMAPPED_DTYPE.*paid.*declare"):
        _ = contract.schema


def test_stored_schemas():
    assert OLAP["dim_product"].stored_schema().names == [
        "product_key", "product_id", "product_name", "category_name", "list_price",
        "updated_at", "__START_AT", "__END_AT",
    ]
    assert generated_keys(OLAP["dim_product"]) == ["product_key"]
    assert generated_keys(OLAP["fact_order_line"]) == []
    assert "`updated_at` timestamp_ntz NOT NULL" in create_statement(OLTP["order"], "x.`order`")


def test_null_rule_counts_as_broken(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, v long")
    rule = Rule("v_positive", "v > 0")
    assert quality.keep(df, [rule]).count() == 1
    bad = quality.quarantine(df, [rule]).collect()
    assert [(r.id, r.failed_rules) for r in bad] == [(1, ["v_positive"])]
    (m,) = quality.rule_metrics(df, [rule]).collect()
    assert (m.n_rows, m.failures) == (2, 1)


def test_row_rules_reach_the_scan(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "quantity").write.parquet(str(tmp_path / "t"))
    kept = quality.keep(spark.read.parquet(str(tmp_path / "t")), [Rule("q", "quantity > 5")])
    assert "PushedFilters: [IsNotNull(quantity), GreaterThan(quantity,5)]" in (
        kept._jdf.queryExecution().executedPlan().toString()
    )


def test_schema_report(seed):
    report = quality.schema_report(
        {"customer": seed.customer.withColumn("phone", F.lit("x")), "order": None},
        {"customer": OLTP["customer"], "order": OLTP["order"]},
    )
    status = {(r.table_name, r.column_name): r.status for r in report.collect()}
    assert status["customer", "phone"] == "personal_name"
    assert status["customer", "full_name"] == "match"
    assert status["order", "status"] == "missing_table"


def test_references(seed):
    assert lookup.dangling(seed.order_line, seed.product, "product_id", "product_id").count() == 1
    unused = lookup.unused(seed.category, seed.product, "category_id", "category_id").collect()
    assert [r.category_id for r in unused] == [30]


RULES = "contract string, rule_id string, reason_code string"
SEEN = "contract string, rule_id string, n_rows long, failures long"


def test_verdicts_are_three_valued(spark):
    rules = spark.createDataFrame(
        [("a", "r2", "X"), ("a", "r1", "Y"), ("b", "r1", "X"), ("c", "r1", "X"), ("d", "r1", "X"), ("d", "r2", "X")],
        RULES,
    )
    seen = spark.createDataFrame(
        [("a", "r1", 9, 2), ("a", "r2", 9, 1), ("b", "r1", 9, 0), ("c", "r1", 0, 0), ("d", "r1", 9, 0)], SEEN
    )
    verdict = V.verdicts(rules, seen, ["contract"])
    rows = {r.contract: r for r in verdict.collect()}
    assert {c: r.outcome for c, r in rows.items()} == {"a": "fail", "b": "pass", "c": "unknown", "d": "unknown"}
    assert rows["c"].reason_code == "POLICY_ENGINE_UNAVAILABLE"
    assert rows["d"].reason_code == "POLICY_QUERY_UNDEFINED"
    assert [v.id for v in rows["a"].violations] == ["r1", "r2"]
    text = verdict.select("contract", V.explain(verdict, F.col("contract")).alias("e")).collect()
    assert {r.contract: r.e for r in text}["a"] == (
        "a: fail (POLICY_VIOLATIONS)\n  r1 Y: 2 of 9 rows\n  r2 X: 1 of 9 rows"
    )
    done = {r.contract: (r.action, r.decision_reason) for r in V.decisions(verdict).collect()}
    assert done == {
        "a": ("halt", "POLICY_VIOLATIONS"), "b": ("publish", "POLICY_SATISFIED"),
        "c": ("halt", "POLICY_NOT_EVALUATED"), "d": ("halt", "POLICY_NOT_EVALUATED"),
    }


def test_outcome_without_response_stops(spark):
    verdict = spark.createDataFrame([("a", "maybe")], "contract string, outcome string")
    with pytest.raises(Exception, match="outcome without a response: maybe"):
        V.decisions(verdict).collect()


def test_waiver_applies_to_failures_only(spark):
    verdict = spark.createDataFrame([("a", "fail"), ("b", "pass")], "contract string, outcome string")
    waived = spark.createDataFrame(
        [("a", "waive", "KNOWN"), ("b", "waive", "KNOWN")], "contract string, override string, override_reason string"
    )
    done = {r.contract: r.action for r in V.decisions(verdict, waived).collect()}
    assert done == {"a": "waive", "b": "publish"}


def test_policy_revision_ignores_order_and_sees_edits(spark):
    rules = V.rule_table(spark, OLTP.values())
    first = {r.contract: r.policy_revision for r in V.policy_revision(rules, ["contract"]).collect()}
    again = V.policy_revision(rules.orderBy(F.rand(3)).repartition(3), ["contract"]).collect()
    assert first == {r.contract: r.policy_revision for r in again}
    edited = rules.withColumn("predicate", F.replace("predicate", F.lit("> 0"), F.lit(">= 0")))
    assert {r.policy_revision for r in V.policy_revision(edited, ["contract"]).collect()}.isdisjoint(first.values())
    assert all(len(v) == 64 for v in first.values())


def test_columnar_document(spark):
    contract = OLTP["order"]
    text = '{"order_id":[1,2],"customer_id":[5,6],"ordered_at":["2026-02-01","never"],"status":["placed","lost"]}'
    documents = spark.createDataFrame([(text,)], "doc string")
    rows = tables.columnar_document(documents, "doc", contract, ("ordered_at",)).orderBy("order_id").collect()
    assert [(r.order_id, r.ordered_at) for r in rows] == [(1, day("2026-02-01")), (2, None)]


def test_sql_takes_tables_and_values_as_arguments(spark, seed):
    hostile = "placed' OR '1'='1"
    found = tables.sql(spark, "SELECT * FROM IDENTIFIER(:t) WHERE status = :s", {"t": seed.order}, s=hostile)
    assert found.count() == 0
    with pytest.raises(Exception):
        tables.sql(spark, "SELECT * FROM IDENTIFIER(:t) WHERE status = :s", {}, s="placed").count()


def test_load_is_all_or_nothing(spark, seed, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(ContractBroken):
        sinks.load_validated(seed.product.withColumn("list_price", F.lit(0.0)), OLTP["product"], path, sinks.INITIAL_AT)
    assert not (tmp_path / "p").exists()
    sinks.load_validated(seed.product, OLTP["product"], path, sinks.INITIAL_AT)
    assert spark.read.parquet(path).select("updated_at").distinct().collect() == [(day("2026-01-01"),)]
