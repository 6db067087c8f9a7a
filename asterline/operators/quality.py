"""Row rules, uniqueness and schema checks, all failures at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterline.contracts import Contract, ContractBroken, Rule

FAILED = "failed_rules"


def holds(rule: Rule) -> Column:
    """A rule that evaluates to NULL is not satisfied."""
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row with the names of the rules it breaks: one narrow pass."""
    broken = F.array(*[F.when(~holds(rule), F.lit(rule.id)) for rule in rules])
    return df.withColumn(FAILED, F.array_compact(broken))


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every rule, as plain filters that reach the scan."""
    for rule in rules:
        df = df.filter(rule.predicate)
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break any rule, with the list of the rules they break."""
    return judge(df, rules).filter(F.size(FAILED) > 0)


def rule_columns(rules: Sequence[Rule]) -> list[Column]:
    """One aggregate per rule, for agg() or observe()."""
    return [
        F.count("*").alias("rows"),
        *[F.count_if(~holds(rule)).alias(f"r{i}") for i, rule in enumerate(rules)],
    ]


def rule_metrics(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """(rule_id, n_rows, failures) from one aggregation, one row per rule."""
    counted = df.groupBy(*by).agg(*rule_columns(rules))
    cells = F.array(
        *[
            F.struct(
                F.lit(rule.id).alias("rule_id"),
                F.lit(rule.reason_code).alias("reason_code"),
                F.col(f"r{i}").alias("failures"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counted.select(*by, F.col("rows").alias("n_rows"), F.inline(cells)).select(
        *by, "rule_id", "reason_code", "n_rows", "failures"
    )


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with how often."""
    return (
        df.groupBy(*columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    )


def uniqueness_metrics(df: DataFrame, contract: Contract) -> DataFrame | None:
    """Rows in excess of one per key, for each declared key."""
    parts = []
    for rule_id, columns in contract.unique_sets().items():
        kind = "DUPLICATE_GRAIN" if rule_id.endswith(".grain") else "DUPLICATE_KEY"
        groups = df.groupBy(*columns).agg(F.count("*").alias("copies"))
        parts.append(
            groups.agg(
                F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("failures"),
            ).select(
                F.lit(rule_id).alias("rule_id"),
                F.lit(kind).alias("reason_code"),
                "n_rows",
                "failures",
            )
        )
    result = None
    for part in parts:
        result = part if result is None else result.unionByName(part)
    return result


def contract_metrics(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row rule and every key rule of a contract in one table."""
    rows = rule_metrics(df, contract.row_rules())
    keys = uniqueness_metrics(df, contract)
    return rows if keys is None else rows.unionByName(keys)


def all_failures(df: DataFrame, contract: Contract) -> DataFrame:
    return contract_metrics(df, contract).filter(F.col("failures") > 0)


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared types by try_cast; what cannot be read becomes null."""
    return df.select(
        *[F.col(f.name).try_cast(f.spark_type).alias(f.name) for f in contract.fields]
    )


def uncoercible(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, n_rows, failures): values present before the cast and null after it."""
    fields = contract.fields
    lost = [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.spark_type).isNull())
        for f in fields
    ]
    counted = df.agg(F.count("*").alias("n_rows"), *[c.alias(f"c{i}") for i, c in enumerate(lost)])
    cells = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.col(f"c{i}").alias("failures"))
            for i, f in enumerate(fields)
        ]
    )
    return counted.select("n_rows", F.inline(cells)).select("column_name", "n_rows", "failures")


# Column names that would hold a person's own data; a domain is allowed.
PERSONAL_NAMES = ("email", "email_address", "phone", "ssn", "birth_date", "street_address")


def schema_report(stored: dict[str, DataFrame | None], contracts: dict[str, Contract]) -> DataFrame:
    """Stored columns against declared ones, with the fill of each stored column.

    Schemas are metadata, a few rows per table; the fill comes from one
    aggregation per table. A table that is not there is reported, never skipped.
    """
    spark = next(df for df in stored.values() if df is not None).sparkSession
    declared_rows = [
        (name, f.name, f.spark_type.simpleString(), name.startswith("fact_"))
        for name, contract in contracts.items()
        for f in contract.fields
    ]
    declared = spark.createDataFrame(
        declared_rows, "table_name string, column_name string, declared string, fact boolean"
    )
    found = None
    for name, df in stored.items():
        if df is None:
            continue
        counted = df.agg(
            F.count("*").alias("n_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
        )
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(df.schema[c].dataType.simpleString()).alias("stored"),
                    F.col(f"n{i}").alias("n_nulls"),
                )
                for i, c in enumerate(df.columns)
            ]
        )
        rows = counted.select(F.lit(name).alias("table_name"), "n_rows", F.inline(cells))
        found = rows if found is None else found.unionByName(rows)
    missing_tables = [name for name, df in stored.items() if df is None]
    status = (
        F.when(F.col("table_name").isin(missing_tables), "missing_table")
        .when(F.col("stored").isNull(), "missing_column")
        .when(F.col("column_name").isin(*PERSONAL_NAMES), "personal_name")
        .when(
            F.col("declared").isNull()
            & F.col("table_name").startswith("fact_")
            & (F.col("stored") == "string"),
            "descriptive_on_fact",
        )
        .when(F.col("declared").isNull(), "undeclared")
        .when(F.col("declared") != F.col("stored"), "retyped")
        .otherwise("match")
    )
    return (
        declared.drop("fact")
        .join(found, ["table_name", "column_name"], "full")
        .select(
            "table_name",
            "column_name",
            F.coalesce("declared", F.lit("-")).alias("declared"),
            F.coalesce("stored", F.lit("-")).alias("stored"),
            status.alias("status"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("n_nulls", F.lit(0)).alias("n_nulls"),
        )
    )


def schema_drift(df: DataFrame, contract: Contract, sequence: bool = False) -> list[str]:
    """Strict schema check on metadata alone: what differs from the contract."""
    expected = {f.name: f.spark_type for f in contract.fields}
    extra = {"updated_at"} if sequence else set()
    actual = {f.name: f.dataType for f in df.schema.fields if f.name not in extra}
    return (
        [f"{name}: undeclared column" for name in actual if name not in expected]
        + [f"{name}: missing column" for name in expected if name not in actual]
        + [
            f"{name}: {actual[name].simpleString()} instead of {kind.simpleString()}"
            for name, kind in expected.items()
            if name in actual and actual[name] != kind
        ]
    )


def validated(df: DataFrame, contract: Contract) -> DataFrame:
    """The coerced data, or ContractBroken naming every failure.

    Only the failing rule ids and counts reach the driver: at most one row per
    declared rule.
    """
    names = [f for f in schema_drift(df, contract) if " instead of " not in f]
    if names:
        raise ContractBroken(contract.name, names)
    typed = coerce(df, contract)
    broken = [
        f"{row.column_name}: {row.failures} values not of the declared type"
        for row in uncoercible(df, contract).filter("failures > 0").collect()
    ] + [
        f"{row.rule_id}: {row.failures} of {row.n_rows} rows"
        for row in all_failures(typed, contract).collect()
    ]
    if broken:
        raise ContractBroken(contract.name, sorted(broken))
    return typed
