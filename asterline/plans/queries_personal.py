"""Personal data in documents, pages and record cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.operators import personal as P
from asterline.plans import model as M
from asterline.plans.catalog import MODEL, query

_D = lambda i: f"((k // {10**i}) % 10)"

MODEL["m_corpus"] = """
    SELECT 'doc-' || doc_id AS document, source, text FROM documents
    UNION ALL SELECT 'page-' || page_id, 'pages', html FROM pages"""
MODEL["m_card"] = f"""
    SELECT 'card-' || k AS document, 'cards' AS source, concat_ws(chr(10), c_name,
      CASE WHEN k % 3 <> 0 THEN 'SSN' ELSE 'ref' END || ' ' || right('00' || (k % 1000), 3) || '-' || right('0' || (k % 100), 2)
        || '-' || left(lpad(CAST(k AS VARCHAR), 4, '0'), 4),
      CASE WHEN k % 3 <> 0 THEN 'passport' ELSE 'ref' END || ' no C' || lpad(CAST(k AS VARCHAR), 8, '0'),
      CASE WHEN k % 3 <> 0 THEN 'driver license' ELSE 'ref' END || ' D' || lpad(CAST(k AS VARCHAR), 10, '0'),
      'dea AB' || lpad(CAST(k AS VARCHAR), 6, '0') ||
        (({_D(5)} + {_D(3)} + {_D(1)} + 2 * ({_D(4)} + {_D(2)} + {_D(0)}) + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END) % 10),
      'account DE' || lpad(CAST(CASE WHEN k % 2 = 0 THEN r WHEN r < 97 THEN r + 1 ELSE r - 1 END AS VARCHAR), 2, '0')
        || lpad(CAST(k AS VARCHAR), 18, '0'),
      CASE WHEN k % 3 <> 0 THEN 'phone' ELSE 'ref' END || ' +1 (555) 010-' || lpad(CAST(k AS VARCHAR), 4, '0'),
      'wallet {M.WALLET[:-1]}' || CASE WHEN k % 5 = 0 THEN 'a' ELSE 'b' END) AS text
    FROM (SELECT c_custkey AS k, c_name, 98 - ((c_custkey % 97) * 27 + 131400) % 97 AS r FROM customer)"""
MODEL["m_all_text"] = "SELECT * FROM m_corpus UNION ALL SELECT * FROM m_card"
MODEL["m_line"] = r"""
    SELECT document, source, n AS line_no, regexp_replace(raw, '[^\x00-\x7F]', ' ', 'g') AS line
    FROM (SELECT document, source, unnest(parts) AS raw, unnest(range(1, len(parts) + 1)) AS n
          FROM (SELECT document, source, string_split(text, chr(10)) AS parts FROM m_all_text))
    WHERE regexp_matches(raw, '[@0-9]')"""


def _sql_valid(entity: str) -> tuple[str, float]:
    """The validity of match m on its line, and the score it earns."""
    context = f"regexp_matches(line, '{P.CONTEXT[entity]}')" if entity in P.CONTEXT else ""
    if entity == "EMAIL_ADDRESS":
        known = ", ".join(f"'{s}'" for s in P.GENERIC_SUFFIXES if s not in P.RESERVED_SUFFIXES)
        suffix = "lower(regexp_extract(m, '[^.]*$'))"
        return f"(length({suffix}) = 2 OR {suffix} IN ({known}))", 1.0
    if entity == "CREDIT_CARD":
        digits = "regexp_replace(m, '[ -]', '', 'g')"
        digit = f"CAST(substr(reverse({digits}), i, 1) AS INTEGER)"
        doubled = f"({digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END)"
        return (
            f"list_sum([CASE WHEN i % 2 = 1 THEN {digit} ELSE {doubled} END for i in range(1, 17)]) % 10 = 0",
            1.0,
        )
    if entity == "IBAN_CODE":
        code = "replace(m, ' ', '')"
        moved = f"(substr({code}, 5) || substr({code}, 1, 4))"
        step = (
            "lambda a, c: CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END"
        )
        codes = f"[CAST(0 AS BIGINT)] || [CAST(ascii(substr({moved}, i, 1)) AS BIGINT) for i in range(1, length({moved}) + 1)]"
        return f"list_reduce({codes}, {step}) = 1", 1.0
    if entity == "MEDICAL_LICENSE":
        d = [f"CAST(substr(m, {i + 2}, 1) AS INTEGER)" for i in range(8)]
        return f"({d[1]} + {d[3]} + {d[5]} + 2 * ({d[2]} + {d[4]} + {d[6]})) % 10 = {d[7]}", 1.0
    if entity == "CRYPTO":
        # Every address in the given tables is a card's; this one alone is valid.
        return f"m = '{M.WALLET}'", 1.0
    if entity == "US_SSN":
        issued = (
            "substr(m, 1, 3) NOT IN ('000', '666') AND substr(m, 1, 3) < '900' "
            "AND substr(m, 5, 2) <> '00' AND substr(m, 8, 4) <> '0000'"
        )
        return f"{context} AND {issued}", P.IN_CONTEXT
    return context, P.IN_CONTEXT


def _findings_sql(*entities: str) -> str:
    parts = []
    for entity in entities:
        valid, score = _sql_valid(entity)
        parts.append(
            f"SELECT document, source, line_no, '{entity}' AS entity, CAST({score} AS DOUBLE) AS score FROM "
            f"(SELECT *, unnest(regexp_extract_all(line, '{P.PATTERNS[entity]}')) AS m FROM m_line) WHERE {valid}"
        )
    return " UNION ALL ".join(parts)


MODEL["m_finding"] = _findings_sql(*P.ENTITIES)


def _text(spark: SparkSession, sf: str) -> DataFrame:
    return M.corpus(spark, sf).unionByName(M.record_cards(spark, sf))


@query("pii_findings", "SELECT * FROM m_finding")
def pii_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Document, line, entity and score of everything found; never the text."""
    return P.findings(_text(spark, sf))


@query("pii_email", _findings_sql("EMAIL_ADDRESS"))
def pii_email(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf), ("EMAIL_ADDRESS",))


@query("pii_card", _findings_sql("CREDIT_CARD"))
def pii_card(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf), ("CREDIT_CARD",))


US = ("US_SSN", "US_PASSPORT", "US_DRIVER_LICENSE", "MEDICAL_LICENSE")


@query("pii_us_ids", _findings_sql(*US))
def pii_us_ids(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf), US)


@query("pii_iban", _findings_sql("IBAN_CODE"))
def pii_iban(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf), ("IBAN_CODE",))


@query("pii_phone", _findings_sql("PHONE_NUMBER"))
def pii_phone(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf), ("PHONE_NUMBER",))


@query(
    "pii_crypto",
    f"""SELECT source, m = '{M.WALLET}' AS valid, count(*) AS candidates
        FROM (SELECT source, unnest(regexp_extract_all(line, '{P.PATTERNS["CRYPTO"]}')) AS m FROM m_line)
        GROUP BY 1, 2""",
)
def pii_crypto(spark: SparkSession, sf: str) -> DataFrame:
    """Address shapes per source and whether their base58 checksum holds."""
    return (
        P.candidates(_text(spark, sf), ("CRYPTO",))
        .groupBy("source", (F.col("score") >= P.THRESHOLD).alias("valid"))
        .agg(F.count("*").alias("candidates"))
    )


@query(
    "pii_summary",
    """SELECT source, documents, COALESCE(findings, 0) AS findings,
              CASE WHEN documents = 0 THEN 'unknown' WHEN findings > 0 THEN 'fail' ELSE 'pass' END AS outcome
       FROM (SELECT source, count(text) AS documents FROM m_all_text GROUP BY source)
       LEFT JOIN (SELECT source, count(*) AS findings FROM m_finding GROUP BY source) USING (source)""",
)
def pii_summary(spark: SparkSession, sf: str) -> DataFrame:
    return P.summary(_text(spark, sf))


@query("pii_by_entity", "SELECT entity, source, count(*) AS findings FROM m_finding GROUP BY entity, source")
def pii_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    return P.findings(_text(spark, sf)).groupBy("entity", "source").agg(F.count("*").alias("findings"))
