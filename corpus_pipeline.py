"""Documents to training sequences, in stages that are stored one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake.llm import line_dedup, packing, pii, quality, simhash
from meterlake.llm.common import documents, stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(line_dedup.shortened(docs), docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recounted(pii.with_surrogates(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


def recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with `n_chars` of the changed text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", one_of_near_copies),
    ("pii surrogates", surrogates),
    ("best-fit packing", packed),
]

# Learned scores, fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
