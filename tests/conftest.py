from __future__ import annotations

import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from asterline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("asterline-tests", "8", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


class Seed:
    """The seed batch: a price that changes, orders on both sides of the change,
    a line whose product does not exist, a category without products."""

    initial, change = day("2026-01-01"), day("2026-03-01")

    def __init__(self, spark):
        make = spark.createDataFrame
        self.category = make(
            [(10, "Tools"), (20, "Books"), (30, "Unstocked")], "category_id long, category_name string"
        )
        self.customer = make(
            [(1, "Ada Lovelace", "example.test", day("2026-01-01")),
             (2, "Alan Turing", "example.test", day("2026-01-02"))],
            "customer_id long, full_name string, email_domain string, registered_at timestamp_ntz",
        )
        columns = "product_id long, product_name string, category_id long, list_price double"
        self.product = make([(100, "Hammer", 10, 9.99), (200, "SICP", 20, 55.0)], columns)
        self.changed = make([(100, "Hammer", 10, 11.99)], columns)
        self.order = make(
            [(1000, 1, day("2026-02-01"), "delivered"), (1001, 2, day("2026-04-01"), "shipped")],
            "order_id long, customer_id long, ordered_at timestamp_ntz, status string",
        )
        self.order_line = make(
            [(1000, 1, 100, 2, 9.99), (1000, 2, 200, 1, 55.0), (1001, 1, 100, 3, 11.99), (1001, 2, 999, 1, 1.0)],
            "order_id long, line_number long, product_id long, quantity long, unit_price double",
        )


@pytest.fixture(scope="session")
def seed(spark):
    return Seed(spark)
