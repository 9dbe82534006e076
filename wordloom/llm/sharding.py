"""Shards of near equal size by a minimax contiguous partition.

Rows with equal texts form an atomic group. Groups stand in the order of their least id, with the
running total of their sizes; a shard is a range of that order. The smallest capacity that lets
greedy filling get by with the given number of shards is found by a search that tries several
capacities at once: each step of the greedy filling asks the stored totals for the last group end
within reach, one aggregate for all tries, and reads only the ranges where such an end can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.ordering import with_rank, with_total_before
from wordloom.session import new_folder

TRIES = 31


def greedy_ends(ends: DataFrame, capacities: list[int], shards: int, largest: int):
    """For each capacity the end of each shard, filled one after the other."""
    reached = [[0] for _ in capacities]
    for _ in range(shards):
        reach = [r[-1] + c for r, c in zip(reached, capacities)]
        # A fuller shard would take another group, so an end lies within `largest` of its reach.
        near = ends.filter(F.col("end").between(min(reach) - largest, max(reach)))
        best = near.agg(
            *[F.max(F.when(F.col("end") <= x, F.col("end"))).alias(f"e{k}") for k, x in enumerate(reach)]
        ).first()
        for r, end in zip(reached, best):
            r.append(r[-1] if end is None else max(end, r[-1]))
    return [r[1:] for r in reached]


def smallest_capacity(ends: DataFrame, total: int, largest: int, shards: int):
    """The least capacity with which greedy filling needs at most `shards`, and its shard ends."""
    low = max(-(-total // shards), largest)
    high = -(-total // shards) + largest  # enough: every shard but the last passes total / shards
    found = greedy_ends(ends, [high], shards, largest)[0]
    while low < high:
        width = high - low
        tries = sorted({low + width * k // TRIES for k in range(TRIES)})
        filled = greedy_ends(ends, tries, shards, largest)
        fits = [k for k, e in enumerate(filled) if e[-1] == total]
        if fits:
            high, found = tries[fits[0]], filled[fits[0]]
            low = tries[fits[0] - 1] + 1 if fits[0] else high
        else:
            low = tries[-1] + 1
    return high, found


def shards(docs: DataFrame, count: int = 8) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 bytes of the text plus 1; a null text has none. Equal texts (by SHA-256)
    stay together, a group is never split, and the largest shard is as small as any contiguous
    partition allows. slot counts the rows of a shard from 0, by group and doc_id; nulls stand
    first, and rows that repeat one another take the next slots. An empty table gives no rows.
    With fewer groups than shards the last shards stay empty. Extra columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("content"),
    )
    groups = rows.groupBy("content").agg(
        F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes")
    )
    groups = groups.withColumn("key", F.struct("first_id", "content"))
    path = new_folder(spark, "groups")
    placed = with_total_before(groups, "key", "bytes", "before")
    placed.withColumn("end", F.col("before") + F.col("bytes")).write.parquet(path)
    placed = spark.read.parquet(path)
    total, largest = placed.agg(F.max("end"), F.max("bytes")).first()
    cuts = []
    if total:
        cuts = smallest_capacity(placed.select("end"), total, largest, count)[1][:-1]
    shard = F.lit(0)
    for end in cuts:
        shard = shard + (F.col("before") >= end).cast("int")
    where = placed.select("content", "first_id", shard.alias("shard"))
    # A group may hold a third of the rows: adaptive execution splits that side of the join.
    dealt = rows.join(where, "content")
    dealt = dealt.withColumn("key", F.struct("shard", "first_id", "content", "doc_id"))
    ranked = with_rank(dealt.drop("first_id", "content"), "key")
    # One row per shard.
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
