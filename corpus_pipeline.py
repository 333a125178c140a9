"""From raw documents to packed training sequences in five stages.

Every stage takes the documents that the one before kept, written as Parquet and read
again, and returns documents; the last returns packed pieces.

Defined cases, the same in every stage: a null text counts as empty, which the quality rules
reject, and stays null where a stage keeps it; a null language has no reference and is judged by the
base rules; a null id is kept like any other.  Rows equal in id and text count once after
``near_dedup``; of ties the smallest id stays.  Very long texts are read whole.  An empty table
gives an empty one.  Columns beside ``doc_id``, ``text`` and ``lang`` may have any name and stay as they
are, but ``n_chars`` follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import quality, queries, secrets, shingles, substrings
from millrace.session import materialise, read_table


def _counted() -> Column:
    """``n_chars`` after a change of the text; a null text keeps its count."""
    return F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")).alias("n_chars")


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.select(*(_counted() if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles stays: the one with the smallest id.

    Candidates come from the Golay keys of ``simhash`` and, for copies further apart than its two bits, from min-hashes.
    """
    return shingles.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur anywhere else go; the documents stay."""
    return _with_length(substrings.without_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return _with_length(secrets.redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    return queries.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# SQL can express neither the fingerprints nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``: one row for each packed piece (see ``packing.pack``)."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
