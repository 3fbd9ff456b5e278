"""From documents to token ids: quality rules, line dedup, near-duplicate join, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes to the
shared folder and reads again for the next stage. All stages but the last return the columns
of `documents` (doc_id, text, lang, source, n_chars).

Cases: NULL and empty texts go in the first stage, as documents of too few words; NULL ids,
languages and sources stay as they are; columns beyond those of `documents` are dropped;
repeated rows are near duplicates of each other, of which one stays; rows that share an id or
have none, but not their text, are compared by their texts; rows without id and words all stay;
documents that line dedup leaves without a word go; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from tallystream.llm.queries import BYTE_RANKS
from tallystream.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, whole."""
    return quality_rules.keep(quality_rules.apply_rules(docs.select(*COLUMNS))).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that an earlier one holds; n_chars follows the text. Those that
    lose lines and have no word left go: all they said stands in earlier documents."""
    kept = line_dedup.drop_repeated_lines(docs.select(*COLUMNS), scratch_path(spark, "pipeline-lines"))
    kept = kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^ \t-\r]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the smallest id, one without an id only if none has
    one, and of one id the smallest hash. Rows without words are like no other."""
    docs = docs.select(*COLUMNS)
    groups = jaccard_join.row_groups(docs.select("doc_id", "text"), scratch_path(spark, "pipeline-groups"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = groups.where("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.row_key").alias("_row"))
    alone = groups.where("component is null and doc_id is not null").select(F.col("row_key").alias("_row")).distinct()
    nameless = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    # Rows of one id and text are one, the smallest of them.
    once = docs.where(~nameless).groupBy(jaccard_join.row_key().alias("_row")).agg(
        F.min(F.struct("text", "lang", "source", "n_chars", "doc_id")).alias("_least"))
    kept = once.join(first.unionByName(alone), "_row", "left_semi").select("_least.*").select(*COLUMNS)
    return kept.unionByName(docs.where(nameless))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    mixed = mixing.mix(docs.select(*COLUMNS), scratch_path(spark, "pipeline-mix"))
    times = F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("epoch")
    return mixed.where("epochs > 0").select(*COLUMNS, times).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return bpe.encode(docs.select(*COLUMNS), BYTE_RANKS)


STAGES = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("mixing", mix),
    ("byte_bpe", tokens),
]

# BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
