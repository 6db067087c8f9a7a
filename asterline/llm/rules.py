"""Quality rules as a short-circuit cascade.

Each rule rejects a document on its text. Cost and selectivity of every rule are estimated on a bounded sample of
documents; rules then run in the order of rejections per cost, and a document meets no rule after the first that
rejects it. The order changes the time taken, never the verdict.

Everything is a Spark SQL expression on one row: no shuffle, no Python. Words are runs of characters other than
space and \\t \\n \\v \\f \\r. Null text counts as empty: no words, so the rule on words rejects it. Empty tables give
empty results, rows with equal ids are judged one by one, extra columns stay.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterline.session import stored

#: Documents in the sample on which cost and selectivity are estimated.
SAMPLE = 256
SPACE = r"[\\x20\\x09-\\x0D]"

_WORDS = rf"array_remove(split(coalesce(`{{0}}`, ''), '{SPACE}+'), '')"
_LINES = rf"transform(filter(split(coalesce(`{{0}}`, ''), '\\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]'), l -> xxhash64(l))"
# A window is its whole hash and its place, so that one sort brings equal windows together. Places of windows that have an
# equal neighbour, in order, cover up to 3 words each.
_REPEATED = """transform(array({words}), w -> if(size(w) < 4, 0L,
  transform(array(sort_array(transform(sequence(0, size(w) - 3),
      i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, CAST(i AS BIGINT) AS p)))), v ->
    aggregate(sort_array(transform(filter(sequence(0, size(v) - 1), i ->
          (i > 0 AND v[i].h = v[i - 1].h) OR (i < size(v) - 1 AND v[i].h = v[i + 1].h)),
        i -> v[i].p)),
      named_struct('at', -3L, 'n', 0L),
      (s, p) -> named_struct('at', p, 'n', s.n + least(3L, p - s.at)), s -> s.n))[0]))[0]"""
_NO_SPACE = "translate(coalesce(`{0}`, ''), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), '')"

#: SQL of each measure of a text column {0}.
MEASURES: dict[str, str] = {
    "n_words": rf"CAST(regexp_count(coalesce(`{{0}}`, ''), '[^\\x20\\x09-\\x0D]+') AS BIGINT)",
    "word_chars": f"CAST(char_length({_NO_SPACE}) AS BIGINT)",
    "n_symbols": "CAST(char_length(coalesce(`{0}`, '')) - char_length(translate(coalesce(`{0}`, ''), '#*$%&|<>', '')) AS BIGINT)",
    "n_dup_lines": f"transform(array({_LINES}), l -> CAST(size(l) - size(array_distinct(l)) AS BIGINT))[0]",
    "n_repeat_words": _REPEATED.format(words=_WORDS),
    "n_lines": f"CAST(size({_LINES}) AS BIGINT)",
}


@dataclass(frozen=True)
class Rule:
    """Rejects where `rejects` holds; it names measures as {n_words}."""

    name: str
    rejects: str

    def condition(self, text: str | None) -> Column:
        """Over a text column, or over columns that hold the measures already."""
        how = {k: v.format(text) if text else f"`{k}`" for k, v in MEASURES.items()}
        return F.expr(self.rejects.format(**how))


BASE = (
    Rule("few_words", "{n_words} < 50"),
    Rule("repeated_words", "100 * {n_repeat_words} > 50 * {n_words}"),
)
RULES = (
    *BASE,
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("word_length", "{word_chars} < 2 * {n_words} OR {word_chars} > 12 * {n_words}"),
    Rule("repeated_lines", "{n_dup_lines} > 0 AND 100 * {n_dup_lines} > 30 * {n_lines}"),
)


def measured(docs: DataFrame, text: str = "text", names: tuple[str, ...] = tuple(MEASURES)) -> DataFrame:
    return docs.select("*", *[F.expr(MEASURES[n].format(text)).alias(n) for n in names])


def sample(docs: DataFrame, text: str = "text", rows: int = SAMPLE) -> DataFrame:
    """At most `rows` texts for estimates, spread over the table by hash."""
    return stored(docs.select(F.col(text).alias("text")).orderBy(F.xxhash64(text)).limit(rows), "rules-sample")


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second, as estimated on a sample; the first run of each only warms up."""
    few = sample(docs, text, rows)
    rate = {}
    for rule in rules:
        counted = few.agg(F.count(F.when(rule.condition("text"), 1)).alias("n"))
        counted.first()
        start = time.perf_counter()
        rejected = counted.first().n
        rate[rule.name] = rejected / max(time.perf_counter() - start, 1e-6)
    return sorted(rules, key=lambda r: (-rate[r.name], r.name))


def verdict(rules: list[Rule], text: str | None = "text") -> Column:
    """The name of the first rule that rejects, or null: later rules are not evaluated."""
    out: Column | None = None
    for rule in rules:
        condition = F.coalesce(rule.condition(text), F.lit(True))
        out = F.when(condition, rule.name) if out is None else out.when(condition, rule.name)
    return F.lit(None).cast("string") if out is None else out


def kept(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    return docs.where(verdict(ordered(docs, rules, text), text).isNull())


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All rows with every measure, the rule that rejects, and whether it is kept."""
    order = ordered(docs, rules, text)
    rows = measured(docs, text)
    base = F.coalesce(BASE[0].condition(None), F.lit(True)) | F.coalesce(BASE[1].condition(None), F.lit(True))
    return rows.withColumn("rejected_by", verdict(order, None)).withColumn("base_failed", base).withColumn(
        "kept", F.col("rejected_by").isNull()
    )
