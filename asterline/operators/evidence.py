"""Evidence, verdicts and decisions as tables.

Evidence is what was observed, a verdict is what rules conclude from it, a
decision is what is done about it. A rule that did not run is `unknown`: never
a pass, never a failure.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import Contract
from asterline.functions.scalars import canonical_json

OUTCOMES = ("pass", "fail", "unknown")
ACTIONS = ("publish", "quarantine", "halt", "waive")

# What is done about each outcome. Total over the outcomes.
RESPONSES = {
    "pass": ("publish", "POLICY_SATISFIED"),
    "fail": ("halt", "POLICY_VIOLATIONS"),
    "unknown": ("halt", "POLICY_NOT_EVALUATED"),
}


def rule_table(spark: SparkSession, contracts: Iterable[Contract]) -> DataFrame:
    """Every declared rule; a few rows per contract, the contracts' own size."""
    rows = []
    for contract in contracts:
        rows += [
            (contract.name, r.id, r.predicate, r.reason_code) for r in contract.row_rules()
        ]
        for rule_id, columns in contract.unique_sets().items():
            reason = "DUPLICATE_GRAIN" if rule_id.endswith(".grain") else "DUPLICATE_KEY"
            rows.append((contract.name, rule_id, f"UNIQUE ({', '.join(columns)})", reason))
    return spark.createDataFrame(
        rows, "contract string, rule_id string, predicate string, reason_code string"
    )


def evidence(metrics: DataFrame, source: Column, observed_at: Column) -> DataFrame:
    """One observation per rule: counts, no judgement."""
    kept = [c for c in metrics.columns if c not in {"n_rows", "failures", "reason_code"}]
    return metrics.select(
        *kept,
        canonical_json(failures=F.col("failures"), rows=F.col("n_rows")).alias("observed"),
        source.alias("source"),
        observed_at.alias("observed_at"),
        "n_rows",
        "failures",
    )


def verdicts(rules: DataFrame, observed: DataFrame, by: list[str], groups: DataFrame | None = None) -> DataFrame:
    """One verdict per group of `by`; rules without evidence over any row are unknown.

    `rules` holds one row per group and rule that should have run. The lists are
    as long as a contract has rules. A group of `groups` without any rule is unknown too.
    """
    ran = observed.select(*by, "rule_id", "n_rows", "failures")
    judged = rules.join(ran, [*by, "rule_id"], "left").select(
        *by,
        "rule_id",
        "reason_code",
        (F.coalesce("n_rows", F.lit(0)) > 0).alias("ran"),
        (F.coalesce("failures", F.lit(0)) > 0).alias("violated"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
    violation = F.when(
        F.col("violated"),
        F.struct(
            F.col("rule_id").alias("id"),
            "reason_code",
            F.concat_ws(" ", "failures", F.lit("of"), "n_rows", F.lit("rows")).alias("message"),
        ),
    )
    grouped = judged.groupBy(*by).agg(
        F.count("rule_id").alias("rules"),
        F.count_if("ran").alias("rules_run"),
        F.array_sort(F.collect_list(violation)).alias("violations"),
    )
    if groups is not None:
        listed = groups.select(*by).distinct().join(grouped, by, "left")
        grouped = listed.withColumns(
            {
                "rules": F.coalesce("rules", F.lit(0)),
                "rules_run": F.coalesce("rules_run", F.lit(0)),
                "violations": F.coalesce("violations", F.array().cast(grouped.schema["violations"].dataType)),
            }
        )
    outcome = (
        F.when(F.size("violations") > 0, "fail")
        .when((F.col("rules") == 0) | (F.col("rules_run") < F.col("rules")), "unknown")
        .otherwise("pass")
    )
    reason = (
        F.when(F.col("outcome") == "fail", "POLICY_VIOLATIONS")
        .when(F.col("outcome") == "pass", "POLICY_SATISFIED")
        .when(F.col("rules_run") == 0, "POLICY_ENGINE_UNAVAILABLE")
        .otherwise("POLICY_QUERY_UNDEFINED")
    )
    return grouped.withColumn("outcome", outcome).withColumn("reason_code", reason)


def explain(verdict: DataFrame, contract: Column) -> Column:
    """The verdict in words, made of its own fields only."""
    header = F.concat(contract, F.lit(": "), F.col("outcome"), F.lit(" ("), F.col("reason_code"), F.lit(")"))
    lines = F.transform(
        "violations",
        lambda v: F.concat(F.lit("  "), v["id"], F.lit(" "), v["reason_code"], F.lit(": "), v["message"]),
    )
    return F.array_join(F.concat(F.array(header), lines), "\n")


def violations(verdict: DataFrame, by: list[str]) -> DataFrame:
    return verdict.select(*by, F.inline("violations"))


def decisions(verdict: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The response to each verdict; an override may waive or quarantine a failure.

    An outcome outside the three has no response and stops the query.
    """
    pairs = [F.lit(x) for outcome, (action, reason) in RESPONSES.items() for x in (outcome, action)]
    reasons = [F.lit(x) for outcome, (action, reason) in RESPONSES.items() for x in (outcome, reason)]
    action = F.element_at(F.create_map(*pairs), F.col("outcome"))
    decided = verdict.withColumn(
        "action",
        F.when(F.col("outcome").isin(*OUTCOMES), action).otherwise(
            F.raise_error(F.concat(F.lit("outcome without a response: "), F.col("outcome")))
        ),
    ).withColumn("decision_reason", F.element_at(F.create_map(*reasons), F.col("outcome")))
    if overrides is None:
        return decided
    # overrides: contract, override ("waive" or "quarantine"), override_reason
    joined = decided.join(overrides, "contract", "left")
    use = F.col("override").isNotNull() & (F.col("outcome") == "fail")
    return joined.select(
        *verdict.columns,
        F.when(use, F.col("override")).otherwise(F.col("action")).alias("action"),
        F.when(use, F.col("override_reason")).otherwise(F.col("decision_reason")).alias("decision_reason"),
    )


def policy_revision(rules: DataFrame, by: list[str]) -> DataFrame:
    """SHA-256 over the sorted rules: derived from what was checked, never declared."""
    line = F.concat_ws(" ", "rule_id", "predicate")
    return rules.groupBy(*by).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("policy_revision"),
        F.count("*").alias("rules"),
    )


def decision_entries(decided: DataFrame, contract: Column, revision: Column, evaluated_at: Column, machine: str) -> DataFrame:
    """Decisions as ledger entries (chain_id, at, machine, payload): one chain for each contract, in the order they were taken.

    The payload says what was decided, on which contract and revision of its rules, when, and what was violated: the whole decision
    can be read from the ledger alone. Names are in order at every depth.
    """
    found = F.transform(
        "violations", lambda v: F.struct(v["id"].alias("id"), v["message"].alias("message"), v["reason_code"].alias("reason_code"))
    )
    payload = canonical_json(
        action=F.col("action"), contract=contract, evaluated_at=evaluated_at.cast("string"), outcome=F.col("outcome"),
        policy_revision=revision, reason_code=F.col("decision_reason"), violations=found,
    )
    return decided.select(contract.alias("chain_id"), evaluated_at.alias("at"), F.lit(machine).alias("machine"), payload.alias("payload"))
