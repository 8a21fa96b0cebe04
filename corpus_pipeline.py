"""The corpus pipeline: bad documents go, one of each group of near copies stays, personal data is redacted, sources are
mixed to their targets, and what is left is packed into sequences.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. What a stage does with nulls, ties and repeated rows is what its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusloom.llm import line_crf, mixing, ngram_join, packing, pii
from locusloom.llm.common import table
from locusloom.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier doesn't reject."""
    return line_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents that five-word shingles link at 80 percent."""
    return ngram_join.keep_one(docs, width=5, like=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix in the order of the curriculum; those that the mix takes twice come twice."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mixture),
    ("best-fit packing", packed),
]

# The classifier and the boosted trees can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on the table documents; each result is written to shared storage before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
