"""Tables made on the way, as Parquet in the shared folder, and joins with small ones."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import new_folder

MOST_BROADCAST_BYTES = 32 << 20
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Tables made inside hand whole texts to Python in batches of at most `rows`, so that a worker
    and its task hold a few megabytes of them at once. A smaller setting of the session stays."""
    before = spark.conf.get(BATCH_SETTING)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once, in columns, and read back; lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes, most: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """A stored table for broadcasting if its rows come to at most `most` bytes, else as it is,
    to be joined by shuffles."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= most else df
