"""Ranks and running totals over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.session import cut

ROW_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id


def in_chunks(df: DataFrame, key: str) -> DataFrame:
    """`df` range-partitioned by a unique key, with its `chunk` and its 0-based `pos` in there.

    The chunk limits come from a sample, so the result is stored: a second run over the same
    rows might draw other limits, and offsets taken from one would not fit the other.
    """
    ordered = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    return cut(
        ordered.select(
            "*",
            F.spark_partition_id().alias("chunk"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION)).alias("pos"),
        )
    )


def chunk_offsets(chunks: DataFrame, total) -> DataFrame:
    """(chunk, before): what all earlier chunks add up to. One row per partition."""
    totals = chunks.groupBy("chunk").agg(total.alias("total"))
    # One row per partition of the table, so a window without a key is small here.
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast("bigint")
    return totals.select("chunk", before.alias("before"))


def with_rank(df: DataFrame, key: str, name: str = "rank") -> DataFrame:
    """Add the 0-based position of each row in the order of a unique key."""
    chunks = in_chunks(df, key)
    offsets = chunk_offsets(chunks, F.count("*"))
    ranked = chunks.join(F.broadcast(offsets), "chunk")
    return ranked.select(*df.columns, (F.col("before") + F.col("pos")).alias(name))


def with_total_before(df: DataFrame, key: str, value: str, name: str = "before") -> DataFrame:
    """Add the sum of `value` over all rows whose unique key is lower."""
    chunks = in_chunks(df, key)
    offsets = chunk_offsets(chunks, F.sum(value))
    earlier = (
        Window.partitionBy("chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    running = chunks.withColumn("_inside", inside).join(F.broadcast(offsets), "chunk")
    return running.select(*df.columns, (F.col("before") + F.col("_inside")).alias(name))
