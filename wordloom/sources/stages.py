"""Stage tables: the cleaned texts and their features, written once and read many times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PREPARED = "doc_id long, text string, label int, split string"


def write_prepared(df: DataFrame, path: str) -> DataFrame:
    """Store cleaned reviews by split; later reads prune to the splits they ask for."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return read_prepared(df.sparkSession, path, schema=df.schema)


def read_prepared(
    spark: SparkSession,
    path: str,
    split: str | None = None,
    schema: StructType | str = PREPARED,
) -> DataFrame:
    """A stored table, also one without any row: nothing is inferred from its files."""
    table = spark.read.schema(schema).parquet(path)
    return table if split is None else table.filter(table.split == split)


def write_features(df: DataFrame, path: str) -> DataFrame:
    """Store feature rows (vectors or the relational form) and read them back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
