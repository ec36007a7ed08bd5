"""A corpus from documents to mixed token ids, one operator after the other.

Each stage is given all that the one before it kept and returns rows with the columns of
``documents``; the last one returns token ids. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.llm import bpe, lines, minhash, mixing, toxicity
from matrixq.llm.common import table, written
from matrixq.llm.queries import WORD_TOKENIZER, toxicity_model

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Similarity of near duplicates in hundredths, on shingles of five words.
SIMILAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is learned from the labelled ones."""
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir), out="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur, or nearly occur, earlier.

    Documents that had lines and lost them all go. Others that lost lines get their new length.
    """
    left = lines.dedup(docs.withColumn("__no_text", F.col("text").isNull()))
    left = left.where((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    text = F.when(~F.col("__no_text"), F.col("text"))  # a null text stays one
    return left.withColumn("n_chars", n_chars).withColumn("text", text).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    found = minhash.near_duplicates(docs.withColumn("__kept_text", F.col("text")), SIMILAR)
    return found.where("first").withColumnRenamed("__kept_text", "text").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = mixing.mix(
        mixing.sized(docs, size="size"), order=F.xxhash64("doc_id", "text")
    ).where("copies > 0")
    repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    done = bpe.encode(docs, WORD_TOKENIZER, decoded="decoded")
    return done.select(
        "doc_id", "source", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic), ("line dedup", dedup_lines), ("near-duplicate documents", dedup_documents),
    ("mixing sources", mix_sources), ("bpe", tokenize),
]

#: Character models, hashes that choose copies and merges of tokens have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
