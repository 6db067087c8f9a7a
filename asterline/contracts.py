"""Table contracts as data: fields, keys, ranges, closed sets.

One declaration yields the Spark schema, the stored DDL, the row rules and the
uniqueness rules, so no two of them can disagree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

UNKNOWN_KEY = -1
UNKNOWN_NAME = "Unknown"
SEQUENCE = "updated_at"
START, END = "__START_AT", "__END_AT"
VALIDITY = ("valid_from", "valid_to", "is_current")
KEY_SUFFIX = "_key"
ORDER_STATUSES = ("placed", "shipped", "delivered", "cancelled")
MIN_DATE_KEY, MAX_DATE_KEY = 19000101, 99991231

# The five value types a contract may use. Anything else is refused.
SPARK_TYPES: dict[str, T.DataType] = {
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "datetime64[ns]": T.TimestampNTZType(),
}


class UnmappedTypeError(ValueError):
    """A contract type without a Spark type: code, column and remedy."""

    code = "ERR_UNMAPPED_DTYPE"

    def __init__(self, column: str, dtype: str) -> None:
        self.column, self.dtype = column, dtype
        self.remedy = f"declare {column} as one of {sorted(SPARK_TYPES)}"
        super().__init__(f"{self.code}: {column} has type {dtype!r}; {self.remedy}")


class ContractBroken(ValueError):
    """Data that was refused at a write boundary, with every failure named."""

    def __init__(self, contract: str, failures: list[str]) -> None:
        self.contract, self.failures = contract, failures
        super().__init__(f"{contract}: " + "; ".join(failures))


@dataclass(frozen=True)
class Rule:
    """A named predicate over one row. NULL counts as not satisfied."""

    id: str
    predicate: str
    reason_code: str = "ROW_RULE"


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    nullable: bool = False
    gt: float | None = None
    ge: float | None = None
    le: float | None = None
    isin: tuple[str, ...] = ()
    forbid: str = ""
    unique: bool = False

    @property
    def spark_type(self) -> T.DataType:
        if self.dtype not in SPARK_TYPES:
            raise UnmappedTypeError(self.name, self.dtype)
        return SPARK_TYPES[self.dtype]

    def row_rules(self, table: str) -> list[Rule]:
        rules = []

        def add(kind: str, predicate: str, reason: str) -> None:
            # A nullable field may be absent; only present values are judged.
            text = f"{self.name} IS NULL OR {predicate}" if self.nullable else predicate
            rules.append(Rule(f"{table}.{self.name}.{kind}", text, reason))

        if not self.nullable:
            rules.append(
                Rule(f"{table}.{self.name}.not_null", f"{self.name} IS NOT NULL", "NULL_VALUE")
            )
        if self.gt is not None:
            add("gt", f"{self.name} > {self.gt}", "OUT_OF_RANGE")
        if self.ge is not None:
            add("ge", f"{self.name} >= {self.ge}", "OUT_OF_RANGE")
        if self.le is not None:
            add("le", f"{self.name} <= {self.le}", "OUT_OF_RANGE")
        if self.isin:
            values = ", ".join(f"'{value}'" for value in self.isin)
            add("isin", f"{self.name} IN ({values})", "NOT_IN_SET")
        if self.forbid:
            add("forbid", f"{self.name} NOT LIKE '%{self.forbid}%'", "FORBIDDEN_TEXT")
        return rules


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    grain: tuple[str, ...] = ()
    versioned: bool = False
    rules: tuple[Rule, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    def row_rules(self) -> list[Rule]:
        return [rule for f in self.fields for rule in f.row_rules(self.name)] + list(self.rules)

    def unique_sets(self) -> dict[str, tuple[str, ...]]:
        sets = {f"{self.name}.{f.name}.unique": (f.name,) for f in self.fields if f.unique}
        if self.grain:
            sets[f"{self.name}.grain"] = self.grain
        return sets

    def stored_schema(self) -> T.StructType:
        """The schema of the table on disk.

        Operational tables add the sequence. A versioned dimension drops the
        reader's validity columns and carries the sequence and the interval.
        """
        if self.versioned:
            kept = [f for f in self.fields if f.name not in VALIDITY]
            tail = [(SEQUENCE, False), (START, False), (END, True)]
        else:
            kept, tail = list(self.fields), [(SEQUENCE, False)]
        clock = SPARK_TYPES["datetime64[ns]"]
        return T.StructType(
            [T.StructField(f.name, f.spark_type, f.nullable) for f in kept]
            + [T.StructField(name, clock, nullable) for name, nullable in tail]
        )


def create_statement(contract: Contract, target: str) -> str:
    """Idempotent DDL; never drops."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in contract.stored_schema().fields
    )
    return f"CREATE TABLE IF NOT EXISTS {target} ({columns}) USING parquet"


def generated_keys(contract: Contract) -> list[str]:
    """The warehouse-made columns of a versioned dimension, known by suffix."""
    return [f.name for f in contract.fields if contract.versioned and f.name.endswith(KEY_SUFFIX)]


def _id(name: str, **checks) -> Field:
    return Field(name, "int64", gt=0, **checks)


def _validity() -> tuple[Field, ...]:
    return (
        Field("valid_from", "datetime64[ns]"),
        Field("valid_to", "datetime64[ns]", nullable=True),
        Field("is_current", "bool"),
    )


OLTP: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "category",
            (_id("category_id", unique=True), Field("category_name", "string")),
        ),
        Contract(
            "customer",
            (
                _id("customer_id", unique=True),
                Field("full_name", "string"),
                Field("email_domain", "string", forbid="@"),
                Field("registered_at", "datetime64[ns]"),
            ),
        ),
        Contract(
            "product",
            (
                _id("product_id", unique=True),
                Field("product_name", "string"),
                _id("category_id"),
                Field("list_price", "float64", gt=0),
            ),
        ),
        Contract(
            "order",
            (
                _id("order_id", unique=True),
                _id("customer_id"),
                Field("ordered_at", "datetime64[ns]"),
                Field("status", "string", isin=ORDER_STATUSES),
            ),
        ),
        Contract(
            "order_line",
            (
                _id("order_id"),
                _id("line_number"),
                _id("product_id"),
                Field("quantity", "int64", gt=0),
                Field("unit_price", "float64", gt=0),
            ),
            grain=("order_id", "line_number"),
        ),
    )
}

OLAP: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "dim_product",
            (
                Field("product_key", "int64", ge=UNKNOWN_KEY, unique=True),
                Field("product_id", "int64", ge=UNKNOWN_KEY),
                Field("product_name", "string"),
                Field("category_name", "string"),
                Field("list_price", "float64", ge=0),
                *_validity(),
            ),
            versioned=True,
        ),
        Contract(
            "dim_customer",
            (
                Field("customer_key", "int64", ge=UNKNOWN_KEY, unique=True),
                Field("customer_id", "int64", ge=UNKNOWN_KEY),
                Field("full_name", "string"),
                Field("email_domain", "string"),
                *_validity(),
            ),
            versioned=True,
        ),
        Contract(
            "dim_date",
            (
                Field("date_key", "int64", ge=MIN_DATE_KEY, le=MAX_DATE_KEY, unique=True),
                Field("calendar_date", "datetime64[ns]"),
                Field("year", "int64", ge=1900, le=9999),
                Field("quarter", "int64", ge=1, le=4),
                Field("month", "int64", ge=1, le=12),
                Field("day_of_month", "int64", ge=1, le=31),
                Field("is_weekend", "bool"),
            ),
        ),
        Contract(
            "fact_order_line",
            (
                _id("order_id"),
                _id("line_number"),
                Field("customer_key", "int64", ge=UNKNOWN_KEY),
                Field("product_key", "int64", ge=UNKNOWN_KEY),
                Field("date_key", "int64", ge=MIN_DATE_KEY, le=MAX_DATE_KEY),
                Field("quantity", "int64", gt=0),
                Field("unit_price", "float64", ge=0),
                Field("line_revenue", "float64", ge=0),
            ),
            grain=("order_id", "line_number"),
            rules=(
                Rule(
                    "fact_order_line.line_revenue.product",
                    "abs(line_revenue - quantity * unit_price) <= 0.005",
                    "INCONSISTENT_MEASURE",
                ),
            ),
        ),
    )
}

# Rules the dataflow applies at its own table boundaries.
FLOW_RULES: dict[str, tuple[Rule, ...]] = {
    "dim_product": (
        Rule("product_id_present", "product_id IS NOT NULL"),
        Rule("price_non_negative", "list_price >= 0"),
    ),
    "dim_customer": (
        Rule("customer_id_present", "customer_id IS NOT NULL"),
        Rule("no_personal_address", "email_domain NOT LIKE '%@%'"),
    ),
    "fact_order_line": (
        Rule("keys_present", "order_id IS NOT NULL AND line_number IS NOT NULL"),
        Rule("measures_non_negative", "quantity > 0 AND line_revenue >= 0"),
        Rule("dimensions_resolved", "product_key IS NOT NULL AND customer_key IS NOT NULL"),
    ),
}
