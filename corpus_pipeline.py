"""The corpus pipeline. A driver writes what a stage returns and rereads it as the next docs.

Every stage but the last returns the columns of ``documents``; rows that a stage drops are
dropped by its operator's own decision.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortwise.llm import exact, packing, quality, secrets, simhash
from cohortwise.llm.common import (
    addressed, discard, documents, own_columns, place, quoted, stored, unused,
)

#: Fixed value: a document goes if its score is below this.
LEAST_QUALITY = 0.5


def without(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` without the rows that a decision per row drops; ``tie`` names a row's place.

    The dropped places, one number each, are the build side, so the texts are not sorted.
    """
    docs = addressed(docs)
    tie = unused(docs, "tie")
    dropped = decide(docs).where(~F.col("kept")).select(F.col("tie").alias(tie))
    rows = docs.select("*", place(docs).alias(tie))
    return rows.join(dropped.hint("shuffle_hash"), tie, "left_anti").select(*own_columns(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier rejects. It learns from the labels of the documents at hand."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), LEAST_QUALITY)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest id of equal texts."""
    return without(docs, exact.exact_dedup)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies: fingerprints of 4-word shingles that
    4 or fewer differing bits connect."""
    return without(docs, lambda rows: simhash.near_dedup(rows, radius=4, shingle=4))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blank out secrets, with ``n_chars`` to match; documents without any pass unchanged."""
    found = unused(docs, "found")
    clean = secrets.blanked(F.col("text"), F.col(found), secrets.MARK)
    rows = secrets.find_secrets(docs, "text", found).withColumn(found, F.struct(
        clean.alias("text"), (F.size(found) > 0).alias("changed"),
    ))
    size = F.when(F.col(found)["changed"], F.length(F.col(found)["text"])).otherwise(F.col("n_chars"))
    new = {"text": F.col(found)["text"], "n_chars": size.cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(quoted(c)) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: Learnt scores and fingerprints have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it stored."""
    docs, path = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        before = path
        docs, path = stored(stage(spark, docs, sf_dir))
        if before:
            discard(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
