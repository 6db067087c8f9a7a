"""Personal data found by content: pattern, checksum, context. Never the text itself.

Scores: a checksum or suffix that is valid counts 1.0, a format with a context
word on its line 0.85, a format alone 0.5. Findings start at 0.8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterline.functions.scalars import (
    base58_valid,
    iban_valid,
    luhn_valid,
    medical_license_valid,
    ssn_plausible,
)

THRESHOLD = 0.8
VALID, IN_CONTEXT, FORMAT_ONLY = 1.0, 0.85, 0.5

# The kinds of personal data that are looked for.
ENTITIES = (
    "EMAIL_ADDRESS",
    "US_SSN",
    "CREDIT_CARD",
    "IBAN_CODE",
    "US_PASSPORT",
    "US_DRIVER_LICENSE",
    "PHONE_NUMBER",
    "MEDICAL_LICENSE",
    "CRYPTO",
)

# File names and suffixes that hold no text a person wrote.
SKIP_SUFFIXES = (".png", ".jpg", ".jpeg", ".gif", ".ico", ".woff", ".woff2")
SKIP_NAMES = ("uv.lock", "flake.lock")

# Suffixes reserved for tests and examples, in which no address is real.
RESERVED_SUFFIXES = ("test", "example", "invalid", "localhost", "local", "internal", "onion", "arpa")

# Suffixes of the public root zone that are not two letters of a country. Anything else after the last dot, such as that of
# a file, makes no address.
GENERIC_SUFFIXES = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "aero", "asia", "cat", "coop", "jobs", "mobi",
    "museum", "post", "tel", "travel", "app", "art", "bank", "blog", "business", "cafe", "center", "chat", "city", "cloud", "club",
    "company", "consulting", "design", "dev", "digital", "email", "energy", "expert", "finance", "fun", "global", "group", "guru",
    "health", "host", "inc", "institute", "international", "law", "legal", "life", "link", "live", "ltd", "media", "money", "network",
    "news", "one", "online", "page", "photo", "press", "school", "science", "services", "shop", "site", "social", "software",
    "solutions", "space", "store", "studio", "support", "systems", "team", "tech", "technology", "tips", "today", "tools", "top",
    "university", "ventures", "video", "website", "wiki", "work", "works", "world", "xyz", "zone",
)

PATTERNS = {
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\b",
    "CREDIT_CARD": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "US_SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "US_PASSPORT": r"\b[A-Z]?[0-9]{8,9}\b",
    "US_DRIVER_LICENSE": r"\b[A-Z][0-9]{7,12}\b",
    "MEDICAL_LICENSE": r"\b[A-HJ-MPR-UX][A-Z9][0-9]{7}\b",
    "IBAN_CODE": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "PHONE_NUMBER": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|\b[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b",
    "CRYPTO": r"\b[13][1-9A-HJ-NP-Za-km-z]{25,34}\b",
}

CONTEXT = {
    "US_SSN": r"(?i)\b(?:ssn|ssns|social security)\b",
    "US_PASSPORT": r"(?i)\bpassport\b",
    "US_DRIVER_LICENSE": r"(?i)\b(?:driver|drivers|driving) (?:license|licence|permit)\b",
    "PHONE_NUMBER": r"(?i)\b(?:phone|telephone|tel|call|mobile|fax)\b",
}

def lines(corpus: DataFrame) -> DataFrame:
    """(document, source, line_no, line): whole texts, only lines that can hold a finding.

    Letters outside ASCII become blanks, so a word boundary means the same in
    every regular expression engine.
    """
    split = corpus.select("document", "source", F.posexplode(F.split("text", "\n")).alias("_n", "raw"))
    return split.filter(F.col("raw").rlike("[@0-9]")).select(
        "document",
        "source",
        (F.col("_n").cast("long") + 1).alias("line_no"),
        F.regexp_replace("raw", r"[^\x00-\x7F]", " ").alias("line"),
    )


def matches(entity: str) -> Column:
    return F.regexp_extract_all("line", F.lit(PATTERNS[entity]), F.lit(0))


def suffix_real(address: Column) -> Column:
    """Two letters or a known generic suffix; reserved ones and those of files are neither."""
    suffix = F.lower(F.element_at(F.split(address, "\\."), -1))
    return ((F.length(suffix) == 2) | suffix.isin(*GENERIC_SUFFIXES)) & ~suffix.isin(*RESERVED_SUFFIXES)


def _score(entity: str, match: Column) -> Column:
    valid = F.lit(VALID)
    if entity == "EMAIL_ADDRESS":
        checked = suffix_real(match)
    elif entity == "CREDIT_CARD":
        checked = luhn_valid(F.regexp_replace(match, "[ -]", ""))
    elif entity == "IBAN_CODE":
        checked = iban_valid(F.replace(match, F.lit(" "), F.lit("")))
    elif entity == "CRYPTO":
        checked = base58_valid(match)
    elif entity == "MEDICAL_LICENSE":
        checked = medical_license_valid(match)
    else:
        checked = F.col("line").rlike(CONTEXT[entity])
        if entity == "US_SSN":
            checked = checked & ssn_plausible(match)
        valid = F.lit(IN_CONTEXT)
    return F.when(checked, valid).otherwise(F.lit(FORMAT_ONLY))


def scored(entity: str) -> Column:
    """An array of (entity, score), one element per match on the line."""
    return F.transform(
        matches(entity),
        lambda m: F.struct(F.lit(entity).alias("entity"), _score(entity, m).alias("score")),
    )


def candidates(corpus: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """Every match with its score: one pass over the lines, narrow, no shuffle."""
    found = [scored(e) for e in entities]
    return lines(corpus).select("document", "source", "line_no", F.inline(F.concat(*found) if len(found) > 1 else found[0]))


def findings(corpus: DataFrame, entities: tuple[str, ...] = ENTITIES) -> DataFrame:
    return candidates(corpus, entities).filter(F.col("score") >= THRESHOLD)


def summary(corpus: DataFrame, entities: tuple[str, ...] = ENTITIES) -> DataFrame:
    """(source, documents, findings, outcome): a source without text is unknown, never clean.

    Texts are counted apart from findings; both are pre-aggregated.
    """
    scanned = corpus.groupBy("source").agg(F.count("text").alias("documents"))
    found = findings(corpus, entities).groupBy("source").agg(F.count("*").alias("findings"))
    joined = scanned.join(found, "source", "left").withColumn(
        "findings", F.coalesce("findings", F.lit(0))
    )
    outcome = (
        F.when(F.col("documents") == 0, "unknown").when(F.col("findings") > 0, "fail").otherwise("pass")
    )
    return joined.withColumn("outcome", outcome)


def scannable(files: DataFrame, path: str = "path") -> DataFrame:
    """Files worth reading as text, by name and suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    wanted = ~name.isin(*SKIP_NAMES)
    for suffix in SKIP_SUFFIXES:
        wanted = wanted & ~F.lower(name).endswith(suffix)
    return files.filter(wanted)
