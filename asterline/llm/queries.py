"""One registered query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.llm import bisectors, bpe, fingerprints, jaccard, mixing, packing, periodic, repeats, rules, scoring, sharding, toxicity, warc
from asterline.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def tokenizer_file(spark: SparkSession, name: str) -> str:
    """Where tasks find a public vocabulary: the folder named in asterline.tokenizers, or the installed package."""
    folder = spark.conf.get("asterline.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_minimax_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes; equal texts share a shard."""
    return (
        sharding.sharded(table(spark, sf_dir, "documents"), SHARDS)
        .withColumn("law", F.lit("bytes"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
    )


@register("op2_budget_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 % of all words, by weights 3, 1, 2 in the order of sources."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


@register("op7_rule_cascade", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
    q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM p),
    r AS (SELECT doc_id, least(3, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -2)) AS n FROM q WHERE c >= 2),
    s AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM r GROUP BY 1),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
          FROM d),
    a AS (SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines FROM m LEFT JOIN s USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
                OR (n_dup_lines > 0 AND 100 * n_dup_lines > 30 * n_lines)) AS kept
    FROM b""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether the cascade of rules keeps it."""
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register("op5_warc")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived and read back."""
    return warc.archived(table(spark, sf_dir, "pages")).drop("url")


@register("op10_packed_ids")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token ids, read back from the files."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file(spark, "byte_bpe_50k.json"), end_id=2)


@register("op8_bottom_k")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are."""
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


@register("op9_prefix_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back."""
    rows = bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_file(spark, "word_bpe_49k.json"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op4_signature_tree_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over distinct 5-word shingles at a Jaccard similarity of 0.75."""
    return jaccard.joined(table(spark, sf_dir, "documents")).drop("tie", "component")


@register("op3_suffix_arrays")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text when bytes of strings of 100 bytes met before are removed."""
    return repeats.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("repeat_bytes").alias("n_bytes"),
        F.expr("CAST(aggregate(repeat_spans, 0L, (n, r) -> n + r.stop - r.start) AS BIGINT)").alias("n_removed"),
        F.size("repeat_spans").cast("long").alias("n_spans"),
        F.sha2("repeat_kept", 256).alias("kept_sha256"),
    )


@register("op6_entropy_difference")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored between the model of good documents and that of all."""
    return scoring.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id ends in 0, words from one on repeat a part of the text over and over."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w, n = F.col("w"), F.size("w").cast("long")
    words = F.when(F.pmod(crc, F.lit(10)) == 0, F.regexp_extract_all("text", F.lit(mixing.WORDS), F.lit(0)))
    rows = docs.select("doc_id", "text", words.alias("w"), F.floor(crc / 10).alias("g"))
    rows = rows.withColumn("a", F.when(n > 0, F.pmod("g", n)))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.pmod("g", F.lit(8)))))
    copies = F.array_repeat(F.slice(w, (F.col("a") + 1).cast("int"), F.col("p").cast("int")), F.ceil((n - F.col("a")) / F.col("p")).cast("int"))
    again = F.slice(F.flatten(copies), 1, (n - F.col("a")).cast("int"))
    text = F.array_join(F.concat(F.slice(w, 1, F.col("a").cast("int")), again), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@register("op13_grammar_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text, after those of chosen ids were made to repeat, and what is left without the copies."""
    rows = periodic.collapsed(_repeating(table(spark, sf_dir, "documents")))
    none = "CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)"
    # Runs come by start and period, so that the first of equal exponents stays.
    best = f"aggregate(runs, {none}, (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    lines = r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr(best).alias("best"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.*", F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")


def _rounds_sql(rounds: int = 10, k: int = 8, size: int = 64) -> str:
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS MATERIALIZED (SELECT list(x ORDER BY h, x) AS cs
        FROM (SELECT x, sha256('3:' || vec_id) AS h FROM v ORDER BY h, x LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, x, list_min(d) AS distance, list_position(d, list_min(d)) - 1 AS cluster
        FROM (SELECT vec_id, x, list_transform(cs, lambda c: list_sum(
              list_transform(range(1, {size + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))) AS d FROM v, c{r}))""")
    for r in range(rounds):
        # The centroids of the next round: an exact floor of the mean, or the old ones where a cluster is empty.
        parts.insert(2 + 3 * r + 1, f"""n{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS c
        FROM (SELECT cluster, i, sum(x[i]) AS s, count(*) AS n
              FROM (SELECT cluster, x, unnest(range(1, {size + 1})) AS i FROM a{r}) GROUP BY ALL) GROUP BY 1)""")
        parts.insert(2 + 3 * r + 2, f"""c{r + 1} AS MATERIALIZED (SELECT list(coalesce(n.c, o.c) ORDER BY o.k) AS cs
        FROM (SELECT unnest(range(0, len(cs))) AS k, unnest(cs) AS c FROM c{r}) o LEFT JOIN n{r} n ON n.cluster = o.k)""")
    return "WITH " + ", ".join(parts) + f"""
        SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cs[cluster + 1], ',')) AS centroid_sha256
        FROM a{rounds}, c{rounds}"""


@register("op11_bisector_clusters", _rounds_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    rows = bisectors.clustered(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                       F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


@register("op12_compression_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.7).cast("int").alias("predicted"))
