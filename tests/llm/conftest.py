from __future__ import annotations

import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, slot int"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs) -> dict[int, str | None]:
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns that clash with results."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    a = "The quick brown fox jumps over the lazy dog near the old river bank today and every day after that one " * 2
    rows = [
        (1, a, "en", "s1", 5, 1, "k", 1),
        (1, a, "en", "s1", 5, 1, "k", 1),
        (2, a, "en", "s2", 5, None, None, None),
        (2, a + " Once more.", None, "s2", 5, 1, "k", 1),
        (3, None, "en", "s1", None, 1, "k", 1),
        (4, "", "en", None, 0, 1, "k", 1),
        (None, a.upper(), "en", None, 0, 1, "k", 1),
        (None, None, None, None, None, None, None, None),
        (5, " \t\n\x0b ", "en", "s3", 0, 1, "k", 1),
        (6, long, "en", "s3", 0, 1, "k", 1),
        (7, "one two", "en", "s3", 0, 1, "k", 1),
        (8, "ONE\ttwo ", "en", "s3", 0, 1, "k", 1),
        (9, "z" * 5000, "en", "s3", 0, 1, "k", 1),
        (10, "é" * 300 + " <|endoftext|> ΣΑΣ don't", "en", "s3", 0, 1, "k", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
