"""WARC records and a Merkle audit of their replicas.

Records are laid out one after the other in files, so each has a place (file, offset, length). The
digests of the records are the leaves of a tree; a node covers a range of consecutive offsets and
is the digest of its children's digests, up to one root of the whole archive. Two replicas are
compared from the roots down, and only children of nodes that differ are looked at, so sound
replicas cost one comparison and damage costs a path for each damaged record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.operators.ordering import with_rank
from wordloom.session import cut

FANOUT = 16
RECORDS_IN_FILE = FANOUT**3
ROWS_IN_FILE = 50_000
MOST_COALESCED = 32  # beyond, a table keeps the partitions of its shuffle
MANIFEST = ("page_id", "place", "file", "offset", "length", "record_sha256")
DATE = "2025-01-01T00:00:00Z"


def record(url: Column, name: Column, payload: Column) -> Column:
    """The bytes of a resource record: header, payload and the two line breaks after it."""
    body = F.coalesce(payload.cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(name.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def laid_out(pages: DataFrame, records_in_file: int = RECORDS_IN_FILE) -> DataFrame:
    """The manifest of the archive of pages (page_id, url, html): page_id, place, file, offset,
    length, record_sha256.

    place numbers all records from 0 in the order of page_id (null first), ties in the order of
    url and content; a file holds `records_in_file` of them. Nulls count as empty fields. Repeated
    rows are records of their own. Extra columns are ignored. The bytes never leave their scan.
    """
    whole = record(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select(
        F.struct("page_id", "url", F.sha2(whole, 256).alias("record_sha256")).alias("key"),
        F.octet_length(whole).cast("long").alias("length"),
    )
    rows = with_rank(rows, "key", "place").select(
        "key.page_id", "place", F.expr(f"place div {records_in_file}").alias("file"), "length", "key.record_sha256"
    )
    # A file has a bounded number of records.
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return rows.withColumn("offset", offset).select(*MANIFEST)


def write_archive(pages: DataFrame, path: str, records_in_file: int = RECORDS_IN_FILE) -> DataFrame:
    """Write the records as WARC files below `path`, one folder a file; returns the manifest.

    The two line breaks after a record are the line separator of the text sink.
    """
    manifest = cut(laid_out(pages, records_in_file))
    whole = record(F.col("url"), F.col("page_id"), F.col("html"))
    texts = pages.select(F.col("page_id").alias("id"), F.sha2(whole, 256).alias("sha"), whole.alias("value"))
    # Equal records may stand for one another.
    texts = texts.dropDuplicates(["id", "sha"])
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("record_sha256") == F.col("sha"))
    rows = manifest.join(texts, same).withColumn("value", F.expr("substring(value, 1, length(value) - 4)"))
    rows = rows.repartition("file").sortWithinPartitions("file", "place")
    rows.select("file", "value").write.partitionBy("file").option("lineSep", "\r\n\r\n").text(path)
    return manifest


def read_archive(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """The manifest as the files below `path` have it: digests of the bytes at its ranges.

    Ranges of a file that is not there, or beyond its end, are not in the result.
    """
    ranges = manifest.groupBy("file").agg(
        F.collect_list(F.struct("page_id", "place", "offset", "length")).alias("ranges")
    )
    files = spark.read.format("binaryFile").load(path).select("file", "content")
    rows = files.join(ranges, "file").select("file", "content", F.explode("ranges").alias("r"))
    part = F.substring(F.col("content"), (F.col("r.offset") + 1).cast("int"), F.col("r.length").cast("int"))
    rows = rows.filter(F.octet_length("content") > F.col("r.offset"))
    return rows.select("r.page_id", "r.place", "file", "r.offset", "r.length", F.sha2(part, 256).alias("record_sha256")).select(*MANIFEST)


def leaves(manifest: DataFrame) -> DataFrame:
    """The manifest with the leaves' digests: they cover the range as well as the bytes."""
    where = F.concat_ws(":", "file", "offset", F.coalesce("record_sha256", F.lit("")))
    return manifest.withColumn("digest", F.sha2(where, 256))


def stored(rows: DataFrame, most: int) -> DataFrame:
    """Checkpoint a table of at most `most` rows, in no more files than they need."""
    files = max(1, -(-most // ROWS_IN_FILE))
    return cut(rows.coalesce(files) if files < MOST_COALESCED else rows)


def tree(leaf_rows: DataFrame, height: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The nodes (node, digest) of each level; level 0 are the leaves, `height` the root.

    A node is the SHA-256 of its children's digests in the order of their places; a missing child
    leaves its number out. Each level is an aggregation of at most `fanout` rows a group.
    """
    level = leaf_rows.select(F.col("place").alias("node"), "digest")
    nodes = [level]
    for k in range(1, height + 1):
        child = F.struct("node", "digest")
        grown = level.groupBy(F.expr(f"node div {fanout}").alias("parent")).agg(
            F.array_sort(F.collect_list(child)).alias("children")
        )
        text = F.array_join(
            F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"])), ","
        )
        grown = grown.select(F.col("parent").alias("node"), F.sha2(text, 256).alias("digest"))
        level = stored(grown, fanout ** (height - k))
        nodes.append(level)
    return nodes


def height_for(count: int, fanout: int = FANOUT) -> int:
    height = 0
    while fanout**height < count:
        height += 1
    return height


def damaged(ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(place, in_ours, in_theirs) of the leaves that differ, found from the root down.

    `ours` and `theirs` are trees of the same height. Each step keeps the children of nodes that
    differ and compares those alone.
    """
    spark, height = ours[0].sparkSession, len(ours) - 1
    open_nodes = spark.createDataFrame([(0,)], "node long")
    for level in range(height, -1, -1):
        sides = [
            t[level].join(open_nodes, "node", "left_semi").select("node", F.col("digest").alias(name))
            for t, name in ((ours, "a"), (theirs, "b"))
        ]
        differ = sides[0].join(sides[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        if level:
            children = F.sequence(F.col("node") * fanout, F.col("node") * fanout + fanout - 1)
            open_nodes = differ.select(F.explode(children).alias("node"))
            open_nodes = stored(open_nodes, fanout ** (height - level + 1))
            if open_nodes.isEmpty():
                break
        else:
            return cut(
                differ.select(
                    F.col("node").alias("place"),
                    F.col("a").isNotNull().alias("in_ours"),
                    F.col("b").isNotNull().alias("in_theirs"),
                )
            )
    return spark.createDataFrame([], "place long, in_ours boolean, in_theirs boolean")


def fixity_audit(manifest: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per record of the archive, or of its replica alone: the manifest's columns, the
    digest and status.

    Both are manifests (page_id, place, file, offset, length, record_sha256). status is `sound`,
    `corrupt` (bytes or range differ), `missing` (not in the replica) or `extra` (only there). A
    null digest counts as empty. Two empty archives give no rows. Extra columns are ignored.
    """
    ours, theirs = (cut(leaves(m.select(*MANIFEST))) for m in (manifest, replica))
    both = ours.select("place").union(theirs.select("place"))
    last = both.agg(F.max("place")).first()[0]
    height = height_for(1 if last is None else last + 1, fanout)
    marks = damaged(tree(ours, height, fanout), tree(theirs, height, fanout), fanout)
    status = (
        F.when(F.col("in_ours").isNull(), "sound")
        .when(~F.col("in_theirs"), "missing")
        .otherwise("corrupt")
    )
    found = ours.join(marks, "place", "left").withColumn("status", status)
    extra = theirs.join(marks.filter("NOT in_ours"), "place").withColumn("status", F.lit("extra"))
    columns = [*MANIFEST, "digest", "status"]
    return found.select(*columns).union(extra.select(*columns))
