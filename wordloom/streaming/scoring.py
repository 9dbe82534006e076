"""Scoring texts as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wordloom.plans.pipeline import cleans_unicode
from wordloom.plans.scoring import presented, score_table, usable


def arriving_texts(
    spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files that appear in a folder, as a stream."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(folder)


def scored_stream(model: PipelineModel, texts: DataFrame, *keep: str) -> DataFrame:
    """Stateless: rows without a word are left out, the others get the presented prediction."""
    columns = ("prediction", "probability_negative", "probability_positive")
    texts = usable(texts, cleans_unicode(model))
    return presented(score_table(model, texts, *keep), *keep, *columns)


def start_scoring(
    model: PipelineModel,
    texts: DataFrame,
    output: str,
    checkpoint: str,
    *keep: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Append scored rows to Parquet files, each input file exactly once across restarts."""
    writer = (
        scored_stream(model, texts, *keep)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
