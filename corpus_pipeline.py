"""From raw documents to packed training sequences: five stages, each one operator over all its predecessor kept.

Every stage takes (spark, docs, folder of the input tables) and returns a DataFrame; it is written as Parquet and read
again as the documents of the next stage. All but the last return the columns of ``documents``.

Null texts fail the first stage, as empty ones do. A null id is an id like any other, last in order, and never trusted.
Ties go to the smallest id and line; repeated rows stay repeated until near-duplicates are grouped. Extra columns pass
through whatever their names; an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import line_dedup, packing, quality, secret_scan, simhash
from lakegate.session import materialised

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the rules or look unlike trusted text go; the labels say what is trusted."""
    return quality.keep(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines equal to an earlier one, or of 20 characters and one edit away, leave the texts; every document stays."""
    return _recounted(line_dedup.dedup(docs))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group stays: 3-word shingles, two bits at most."""
    return simhash.first_of_each(docs, shingle=3, max_bits=2)


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _recounted(secret_scan.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The texts as sequences of tokens, packed into bins of several permitted lengths."""
    return packing.pack(docs).withColumn("doc_ids", F.transform("pieces", lambda p: p["doc_id"]))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", one_of_near_duplicates),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: Hashed n-grams, edit distances, fingerprints, token ratios and packing have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if number < len(STAGES) - 1:
            docs = materialised(docs, f"stage-{number}")
    return docs
