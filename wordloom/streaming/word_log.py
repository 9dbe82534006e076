"""Running word counts of texts as they arrive, late ones counted apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordloom.functions.cleaning import with_clean_text
from wordloom.operators import vocabulary_log
from wordloom.options import Options

MARK = "batch long, latest timestamp"


def start_counting(
    texts: DataFrame,
    log: str,
    checkpoint: str,
    event_time: str,
    delay: str,
    options: Options = Options(),
    available_now: bool = False,
) -> StreamingQuery:
    """Add each micro-batch of a stream with `text` and `event_time` to word count logs.

    A row is late if its event time is more than `delay` (as "1 hour") before the latest one of
    all earlier batches; a row without a time never is. Counts of the others go to
    `on_time_log(log)`, those of late rows to `late_log(log)`, and both together equal a count of
    all files at once. The state is in the logs, on disk and spread over tasks, so it may
    outgrow any executor. A batch that is run again after a failure, in part or in whole, changes
    nothing: it is known by its number, and its mark depends on its rows alone.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            mark = watermark(spark, log, delay, number)
            late = F.coalesce(F.col(event_time).cast("timestamp") < F.lit(mark), F.lit(False))
            for folder, part in ((on_time_log(log), ~late), (late_log(log), late)):
                split = f"batch-{number}"
                if split not in vocabulary_log.members(spark, folder):
                    docs = with_clean_text(batch.filter(part).select("text"))
                    vocabulary_log.add_split(spark, folder, split, docs, options)
            latest = batch.agg(
                F.lit(number).cast("long").alias("batch"),
                F.max(F.col(event_time).cast("timestamp")).alias("latest"),
            )
            latest.coalesce(1).write.mode("overwrite").parquet(f"{_marks(log)}/number={number}")
        finally:
            batch.unpersist()

    writer = texts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def on_time_log(log: str) -> str:
    return f"{log.rstrip('/')}/on-time"


def late_log(log: str) -> str:
    return f"{log.rstrip('/')}/late"


def watermark(spark: SparkSession, log: str, delay: str, before: int):
    """The latest event time of the batches before a number, less `delay`; None without any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_marks(log))
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    marks = spark.read.schema(MARK).parquet(_marks(log)).filter(F.col("batch") < before)
    return marks.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("mark")).first().mark


def _marks(log: str) -> str:
    return f"{log.rstrip('/')}/marks"
