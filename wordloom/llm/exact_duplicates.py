"""Exact duplicates by a content sort.

A bounded sample of keys gives splitters, which cut the key range into chunks of about equal
bytes; within a chunk an external sort puts equal texts next to each other, and each row is
compared in full with the row before it where head and digest agree. The key is the first characters of the text, its digest
and the id, so it is short whatever the text is, and copies of one text spread over as many
chunks as they fill. Runs that touch a chunk's edge are joined by a full comparison at the end.
The text itself is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.places import place
from wordloom.session import cut

HEAD = 32
OVERSAMPLING = 8
#: What a row weighs beside its text.
ROW_BYTES = 128
#: Bounds what every task gets: so many splitters of at most HEAD characters, digest and id.
MOST_CHUNKS = 4096


def splitters(rows: DataFrame, chunks: int) -> DataFrame:
    """One row with the sorted array of at most chunks - 1 keys that part rows into equal bytes.

    The sample is drawn by a hash of the row, so that a second run draws the same. It has a few
    keys a chunk, each weighing what its row has to carry.
    """
    wanted = chunks * OVERSAMPLING / max(1, rows.count())
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 24)) < F.lit(int(wanted * (1 << 24)))
    weight = (F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("weight")
    sample = rows.filter(drawn).select("key", weight)
    order = Window.orderBy("key")
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("weight").over(Window.partitionBy())
    placed = sample.select("key", F.floor(upto * F.lit(chunks) / (whole + 1)).alias("part"))
    first = placed.groupBy("part").agg(F.min("key").alias("key")).filter("part > 0")
    return first.agg(F.array_sort(F.collect_list("key")).alias("splitters"))


def exact_duplicates(
    docs: DataFrame, keep: str = "smallest", normalise=None, chunks: int | None = None
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same after `normalise`, a function from column to column
    (default: no change); null counts as empty. Of a group the row with the smallest or largest
    doc_id stays; of rows that repeat that id too, one. A null doc_id stays only in a group
    without any id, whose keep_id is null. Extra columns are ignored. `chunks` is the number of
    key ranges, by default two for each shuffle partition, at most 4096.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    best = F.min if keep == "smallest" else F.max
    spark = docs.sparkSession
    if chunks is None:
        chunks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = min(chunks, MOST_CHUNKS)
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (normalise(text) if normalise else text).alias("text"))
    rows = rows.withColumn("text_sha256", F.sha2("text", 256))
    key = F.struct(F.substring("text", 1, HEAD).alias("head"), "text_sha256", "doc_id")
    rows = rows.withColumn("key", key)
    limits = splitters(rows, chunks)
    rows = rows.withColumn("limits", limits.scalar())
    rows = rows.withColumn("chunk", place(F.col("key"), F.col("limits"), chunks))
    digest = F.col("text_sha256")
    beside = [F.get("limits", F.col("chunk") + k)["text_sha256"] == digest for k in (-1, 0)]
    at_edge = F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))
    head = F.col("key")["head"].alias("head")
    rows = rows.select("doc_id", "text", "text_sha256", head, "chunk", at_edge.alias("at_edge"))
    # Chunks stay whole; what is compared are rows of one head and digest. So no more than those
    # are held at a time, and the text ends here.
    rows = rows.repartition("chunk")
    alike = ("chunk", "head", "text_sha256")
    order = Window.partitionBy(*alike).orderBy("text", "doc_id")
    same = F.coalesce(F.lag("text").over(order) == F.col("text"), F.lit(False))
    compared = rows.select(
        *alike,
        "doc_id",
        "text",
        "at_edge",
        F.row_number().over(order).alias("pos"),
        same.alias("same"),
        F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id")).alias("same_id"),
    ).select(
        *alike,
        "doc_id",
        "pos",
        (~F.col("same")).cast("long").alias("new"),
        (F.col("same") & F.col("same_id")).alias("again"),
        F.when(F.col("at_edge") & ~F.col("same"), F.col("text")).alias("edge_text"),
    )
    numbered = compared.withColumn("run", F.sum("new").over(Window.partitionBy(*alike).orderBy("pos")))
    run = Window.partitionBy(*alike, "run")
    found = cut(
        numbered.select(
            *alike,
            "doc_id",
            "run",
            "again",
            "edge_text",
            best("doc_id").over(run).alias("best"),
            F.count("*").over(run).alias("size"),
        )
    )
    # At most two runs of a chunk touch its edges.
    whole = Window.partitionBy("edge_text")
    edges = found.filter("edge_text IS NOT NULL").select(
        *alike,
        "run",
        best("best").over(whole).alias("whole_best"),
        F.sum("size").over(whole).alias("whole_size"),
    )
    both = found.join(F.broadcast(edges), [*alike, "run"], "left")
    touched = F.col("whole_size").isNotNull()
    both = both.select(
        "doc_id",
        F.when(touched, F.col("whole_best")).otherwise(F.col("best")).alias("keep_id"),
        F.coalesce("whole_size", "size").alias("group_size"),
        "again",
        "text_sha256",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("again")
    return both.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
