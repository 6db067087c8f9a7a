"""Personal data by content."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from asterline.functions import scalars
from asterline.operators import personal as P


def found(spark, text):
    corpus = spark.createDataFrame([("d", "s", text)], "document string, source string, text string")
    return sorted((r.line_no, r.entity, r.score) for r in P.findings(corpus).collect())


def base58(payload: bytes) -> str:
    raw = payload + hashlib.sha256(hashlib.sha256(payload).digest()).digest()[:4]
    number, out = int.from_bytes(raw, "big"), ""
    while number:
        number, digit = divmod(number, 58)
        out = scalars.BASE58[digit] + out
    return "1" * (len(raw) - len(raw.lstrip(b"\0"))) + out


ADDRESS = base58(b"\0" + bytes(range(1, 21)))
CARD = "4" + "1" * 15

CASES = [
    ("write to\nsome.one@mail.example.org today", [(2, "EMAIL_ADDRESS", 1.0)]),
    ("see logo@2x.png, x@y.zzzz and icon@3x.JPEG", []),
    ("at a@b.de or c@d.co.uk", [(1, "EMAIL_ADDRESS", 1.0), (1, "EMAIL_ADDRESS", 1.0)]),
    ("some.one@example.invalid", []),
    (f"card {CARD} on file", [(1, "CREDIT_CARD", 1.0)]),
    ("card 4111 1111 1111 1111 4111-1111-1111-1111", [(1, "CREDIT_CARD", 1.0)] * 2),
    (f"card {CARD}1", []),
    ("card 4111111111111112", []),
    ("ssn 123-45-6789", [(1, "US_SSN", 0.85)]),
    ("ssn 000-45-6789 ssn 666-45-6789 ssn 123-00-6789 ssn 912-34-5678", []),
    ("ref 123-45-6789", []),
    ("passport C12345678", [(1, "US_PASSPORT", 0.85)]),
    ("C12345678", []),
    ("driver license D1234567890", [(1, "US_DRIVER_LICENSE", 0.85)]),
    ("IBAN DE89370400440532013000", [(1, "IBAN_CODE", 1.0)]),
    ("IBAN DE89 3704 0044 0532 0130 00", [(1, "IBAN_CODE", 1.0)]),
    ("IBAN GB82 WEST 1234 5698 7654 32", [(1, "IBAN_CODE", 1.0)]),
    ("IBAN DE88370400440532013000", []),
    ("phone +1 (555) 010-1234", [(1, "PHONE_NUMBER", 0.85)]),
    ("+1 (555) 010-1234", []),
    ("dea AB1234563", [(1, "MEDICAL_LICENSE", 1.0)]),
    ("dea AB1234564", []),
    (f"pay {ADDRESS} now", [(1, "CRYPTO", 1.0)]),
    ("pay 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", [(1, "CRYPTO", 1.0)]),
    ("pay 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb", []),
    ("import Darwin\nresult: dict[str, Any] = ruff.check(ci_yml)\n", []),
    ("Ada Lovelace lives in London", []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_cases(spark, text, want):
    assert found(spark, text) == want


def test_the_text_is_not_in_a_finding(spark):
    corpus = spark.createDataFrame([("d", "s", f"card {CARD}")], "document string, source string, text string")
    assert P.findings(corpus).columns == ["document", "source", "line_no", "entity", "score"]


def test_end_of_a_long_text_is_read(spark):
    text = "\n".join(["nothing 1"] * 30_000 + ["mail a@b.example.com"])
    assert found(spark, text) == [(30_001, "EMAIL_ADDRESS", 1.0)]


def test_source_without_text_is_unknown(spark):
    corpus = spark.createDataFrame(
        [("a", "clean", "hello"), ("b", "dirty", "a@b.example.com"), ("c", "empty", None)],
        "document string, source string, text string",
    )
    assert {r.source: (r.documents, r.findings, r.outcome) for r in P.summary(corpus).collect()} == {
        "clean": (1, 0, "pass"), "dirty": (1, 1, "fail"), "empty": (0, 0, "unknown"),
    }


def test_skipped_files(spark):
    files = spark.createDataFrame([("a/x.PNG",), ("uv.lock",), ("a/flake.lock",), ("a/b.py",)], "path string")
    assert [r.path for r in P.scannable(files).collect()] == ["a/b.py"]


def test_base58_checksums(spark):
    """Valid ones of both kinds, with leading zeros and at the ends of the range; each with a digit changed, one less, one more."""
    digits = scalars.BASE58
    payloads = [b"\0" * 21, b"\0" * 5 + bytes(range(16)), b"\x05" + b"\xff" * 20, b"\xff" * 21, *(bytes((i * 37 + k * 11) % 256 for k in range(21)) for i in range(20))]
    good = [base58(p) for p in payloads]
    bad = [g[:-1] + digits[(digits.index(g[-1]) + 1) % 58] for g in good] + ["1" + g for g in good] + [g[:-1] for g in good]
    bad += ["z" * 34, "z" * 40, "1" * 25, "2"]
    rows = spark.createDataFrame([(t, i < len(good)) for i, t in enumerate(good + bad)], "t string, valid boolean")
    found = rows.select("t", "valid", scalars.base58_valid(F.col("t")).alias("got")).collect()
    assert [r.t for r in found if r.got != r.valid] == []
