"""From raw documents to token ids of a training mixture: stages over the documents table.

Each stage is (name, function); a function takes the session, the documents that the stage before
has kept and the folder of the tables. All but the last return the columns they were given. `run`
writes each stage's result as Parquet in the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.line_duplicates import deduplicated
from wordloom.llm.mixing import mixed
from wordloom.llm.near_duplicates import one_of_each
from wordloom.llm.quality import good_texts
from wordloom.llm.queries import piece_model
from wordloom.llm.sentence_pieces import encode
from wordloom.session import new_folder


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier takes for good; empty texts are judged like others."""
    return good_texts(docs, spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines that match an earlier line; what loses all its words goes.

    Every line with a word takes part, however short. n_chars, where there, follows the text. A document that lost no line stays as it is.
    """
    rest = deduplicated(docs, least_words=1)
    gone = (F.col("lines_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rest = rest.filter(~gone)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("lines_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        rest = rest.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return rest.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return one_of_each(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as a mixture by source weights takes them; null texts never."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_tokens, ids): token ids with begin and end, one row per row."""
    ids = encode(docs, piece_model())
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality-classifier", quality),
    ("line-dedup", lines),
    ("near-duplicates", near_duplicates),
    ("source-mixing", mixing),
    ("sentence-pieces", tokens),
]

#: The fitted classifier, the iterated components and the encoding have no SQL form; tests compare
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
