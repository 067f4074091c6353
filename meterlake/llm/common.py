"""Small helpers shared by the operators on documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for inner columns that no column of the table has, whatever its case."""
    taken, found = {name.lower() for name in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def row_key() -> Column:
    """128 bits that rows share if they share doc_id and text; null counts as no id, no text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    # The text is hashed where it stands; joining it to the id would copy it.
    return F.unhex(F.md5(F.concat_ws(":", doc_id, F.md5(text_of()))))
