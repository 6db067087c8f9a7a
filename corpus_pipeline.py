"""A corpus pipeline: each stage applies one operator to all that the one before it kept.

All stages but the last return the columns of documents; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.llm import bpe, jaccard, mixing, repeats, rules
from asterline.llm.queries import tokenizer_file
from asterline.session import stored, table

SEED = 17
SHARE = 1.5
MOST = 2.0
VOCABULARY = "word_bpe_49k.json"

#: Whether the byte at a place, from 0, goes on with a character that began before it.
_INSIDE = "hex(substring(CAST(text AS BINARY), CAST({0} + 1 AS INT), 1)) BETWEEN '80' AND 'BF'"
_BACK = "CASE WHEN NOT coalesce({0}, false) THEN r.start WHEN NOT {1} THEN r.start - 1 WHEN NOT {2} THEN r.start - 2 ELSE r.start - 3 END".format(
    *(_INSIDE.format(f"(r.start - {i})") for i in range(3)))
_ON = "CASE WHEN NOT {0} THEN r.stop WHEN NOT {1} THEN r.stop + 1 WHEN NOT {2} THEN r.stop + 2 ELSE r.stop + 3 END".format(
    *(_INSIDE.format(f"(r.stop + {i})") for i in range(3)))
#: The whole characters outside of repeat_spans.
WHOLE = f"""CAST(aggregate(
    concat(transform(repeat_spans, r -> struct({_BACK} AS start, {_ON} AS stop)), array(struct(repeat_bytes AS start, repeat_bytes AS stop))),
    struct(0L AS at, CAST('' AS BINARY) AS data),
    (s, r) -> struct(greatest(s.at, r.stop) AS at,
                     concat(s.data, substring(CAST(text AS BINARY), CAST(s.at + 1 AS INT), CAST(greatest(0L, r.start - s.at) AS INT))) AS data),
    s -> s.data) AS STRING)"""


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the least id; of rows with one id, one text.

    Documents without words are in no component and stay.
    """
    found = stored(jaccard.joined(docs), "pipeline-classes")
    kept = found.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct("doc_id", "tie")).alias("k"))
    kept = kept.select("k.*").unionByName(found.where("n_shingles = 0").select("doc_id", "tie").distinct())
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_tie"))
    out = docs.join(kept, same, "left_semi")
    # Only rows repeated with id and text are left to tell apart; without any, texts need no second shuffle.
    repeated = found.groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1")
    return out if repeated.isEmpty() else out.dropDuplicates(["doc_id", "text"])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings met before; a document of which nothing is left goes, one without text stays."""
    found = repeats.deduplicated(docs)
    # A cut may fall inside a character: what is left of it goes, by moving the cut to the character's edge.
    text = F.when(F.size("repeat_spans") == 0, F.col("text")).otherwise(F.expr(WHOLE))
    out = found.where("repeat_bytes = 0 OR octet_length(repeat_kept) > 0").withColumn("text", text)
    out = out.withColumn("n_chars", F.when(F.size("repeat_spans") == 0, F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document that the mix takes twice is there twice, one it does not take is not."""
    return mixing.taken(docs, seed=SEED, share=SHARE, most=MOST)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, for training; decoded from the ids they give the text back in the vocabulary's form."""
    return bpe.encoded(docs, tokenizer_file(spark, VOCABULARY), keep=("source",))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mix),
    ("BPE encoding", encode),
]

#: Suffix arrays, seeded choice and BPE are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
