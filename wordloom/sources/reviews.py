"""Review tables: (doc_id, text, label) from delimited files, stage tables or table folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.cleaning import classic_clean, with_clean_text
from wordloom.session import new_folder
from wordloom.sources.split_csv import read_split_csv
from wordloom.sources.stages import write_prepared

RAW_COLUMNS = ("text", "label")


def read_csv(
    spark: SparkSession, path: str, header: bool = True, multi_line: bool = True, split: bool = True
) -> DataFrame:
    """A delimited file as strings; quoted fields may hold doubled quotes and line breaks.

    With a header, columns go by their names in the file; without one the first two columns
    are the text and the label. Large files are read by many tasks. That takes two passes over
    the text where fields may have line breaks; `split=False` reads such a file in one pass and
    one task, in the order of its rows, and `multi_line=False` is for files without any.
    """
    if multi_line and split:
        return read_split_csv(spark, path, header, None if header else RAW_COLUMNS)
    reader = (
        spark.read.option("header", header)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
    )
    if header:
        return reader.csv(path)
    return reader.csv(path).toDF(*RAW_COLUMNS)


def typed_reviews(df: DataFrame, *ids: str) -> DataFrame:
    """Text as string, label as int; a label that is no number becomes null."""
    return df.select(
        *ids,
        F.col("text").cast("string").alias("text"),
        F.col("label").cast("string").try_cast("int").alias("label"),
    )


def rejects(df: DataFrame) -> DataFrame:
    """One row: how many typed rows have no usable label."""
    return df.agg(F.count_if(F.col("label").isNull()).alias("rejected"))


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isNotNull())


def load_splits(
    spark: SparkSession,
    folder: str,
    clean=classic_clean,
    header: bool = True,
    multi_line: bool = True,
    **paths: str,
) -> DataFrame:
    """Delimited files, one per split, as one stored table (doc_id, text, label, split).

    The files hold no ids, so rows get theirs here, once, and keep them in the stored table.
    Everything after reads that table.
    """
    parts = [
        typed_reviews(read_csv(spark, path, header, multi_line)).withColumn("split", F.lit(split))
        for split, path in paths.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    numbered = rows.select(F.monotonically_increasing_id().alias("doc_id"), "*")
    return write_prepared(with_clean_text(numbered, clean), folder)


def load_reviews(
    spark: SparkSession,
    path: str,
    split: str,
    clean=classic_clean,
    header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """One delimited review file, stored below the shared folder."""
    folder = new_folder(spark, "reviews")
    return load_splits(spark, folder, clean, header, multi_line, **{split: path})


def literal_text(spark: SparkSession, *texts: str) -> DataFrame:
    """Given texts as a table, numbered in order."""
    rows = list(enumerate(texts))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """All texts of a table folder as (doc_id, text)."""
    return read_table(spark, folder, "documents").select("doc_id", "text")


def reviews(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """The labelled texts of a table folder as (doc_id, text, label)."""
    labels = read_table(spark, folder, "labels").select("doc_id", F.col(label).alias("label"))
    texts = documents(spark, folder).filter(F.col("text").isNotNull())
    return typed_reviews(texts.join(labels, "doc_id"), "doc_id")


def clean_reviews(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    return with_clean_text(reviews(spark, folder, label))
