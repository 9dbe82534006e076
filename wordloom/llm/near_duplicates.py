"""Near duplicates by one-permutation MinHash with optimal densification.

Every text becomes the set of its distinct word shingles. Texts with equal sets form a class that
goes on as one, so thousands of copies cost as much as one. The hash range is cut into bins, each
bin keeps its least shingle, and an empty bin takes over from a bin that a fixed random order
names. Bands of bins are bucket keys; a bucket ties its members to its least member, a star, so
its edges grow with its size and not with the square. Links count only after the full sets are
compared. Members that a star leaves unconnected are then paired across components, at most once
per pair, and only where an exact bound on the overlap allows a link; so the star loses none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.bytewise import U64, lean, lists, mix, seeded, sums_by
from wordloom.llm.components import components
from wordloom.llm.names import unused
from wordloom.llm.shingles import shingle_sets
from wordloom.llm.tables import small_batches
from wordloom.session import cut

BANDS = 32
MOST_ROWS = 8
MISSES = 1e-4
PARITY_WORDS = 8  # 64-bit words of the parity bitmap


def rows_for(percent: int, bands: int) -> int:
    """The most rows a band with which a pair of just that similarity is missed with odds of at
    most `MISSES`."""
    fit = [r for r in range(1, MOST_ROWS + 1) if (1 - (percent / 100) ** r) ** bands <= MISSES]
    return max(fit, default=1)


def bin_minima(values, owner, sizes, bins: int) -> np.ndarray:
    """Least value per owner and bin of the hash range, empty bins densified.

    An empty bin takes the value of the first filled bin in a random order of its own, which is
    the same for all texts, so two texts agree in a bin with a chance equal to their Jaccard
    similarity. Owners without values get rows that mean nothing.
    """
    table = np.zeros((len(sizes), bins), U64)
    place = ((values >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    least = np.ones(len(values), bool)
    least[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    filled = np.zeros((len(sizes), bins), bool)
    table[owner[least], place[least]] = values[least]
    filled[owner[least], place[least]] = True
    orders = np.argsort(seeded(bins * bins, 23).reshape(bins, bins), axis=1)
    row, gap = np.nonzero(~filled & (sizes > 0)[:, None])
    for k in range(bins):
        if not len(row):
            break
        source = orders[gap, k]
        found = filled[row, source]
        table[row[found], gap[found]] = table[row[found], source[found]]
        row, gap = row[~found], gap[~found]
    return table


def band_keys(table: np.ndarray, bands: int) -> np.ndarray:
    rows = table.shape[1] // bands
    odd = seeded(rows, 31)
    with np.errstate(over="ignore"):
        parts = (table.reshape(len(table), bands, rows) * odd).sum(axis=2, dtype=U64)
        return mix(parts + seeded(bands, 37))


def parity_bitmap(values, owner, sizes) -> np.ndarray:
    """A bit per hash of a set, added without carry: the bits in which two bitmaps differ are at
    most as many as the values that only one of the sets has."""
    out = np.zeros((len(sizes), PARITY_WORDS), U64)
    word = ((values >> U64(8)) % U64(PARITY_WORDS)).astype(np.int64)
    np.bitwise_xor.at(out, (owner, word), U64(1) << (values & U64(63)))
    return out


SIGNED = "doc_id long, text_key long, n long, d1 long, d2 long, bands array<long>, parity array<long>"


def _signatures(width: int, bands: int, rows: int):
    def of(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, values, owner, sizes in shingle_sets(batch.column("text"), width):
                with np.errstate(over="ignore"):
                    d1 = sums_by(owner, mix(values ^ U64(0xA5A5A5A5)), sizes)
                    d2 = sums_by(owner, mix(values ^ U64(0x5A5A5A5A00)), sizes)
                keys = band_keys(bin_minima(values, owner, sizes, bands * rows), bands)
                each = np.where(sizes > 0, bands, 0)
                parity = parity_bitmap(values, owner, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        batch.column("text_key").slice(i, j - i),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(d1.view(np.int64)),
                        pa.array(d2.view(np.int64)),
                        lists(keys[sizes > 0].ravel().view(np.int64), each),
                        lists(parity.ravel().view(np.int64), np.full(j - i, PARITY_WORDS)),
                    ],
                    ["doc_id", "text_key", "n", "d1", "d2", "bands", "parity"],
                )

    return of


def _sets(width: int):
    def of(batches):
        for batch in batches:
            for i, j, values, _, sizes in shingle_sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), lists(values.view(np.int64), sizes)],
                    ["doc_id", "shingles"],
                )

    return of


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    asked = texts.join(wanted, "doc_id", "left_semi")
    with small_batches(texts.sparkSession):
        sets = cut(asked.mapInArrow(lean(_sets(width)), "doc_id long, shingles array<long>"))
    first = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(first, "a").join(second, "b")
    both = both.select("a", "b", (F.size("x") + F.size("y")).alias("n"), shared.alias("shared"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("n") - F.col("shared"))).select(
        "a", "b"
    )


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    width: int = 5,
    bands: int = BANDS,
    rows: int | None = None,
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept, text_key.

    Two texts are linked if 100 * shared >= percent * union over their distinct shingles of
    `width` lower-cased words; a shorter text is one shingle, a text without words none and never
    linked. component_id is the least doc_id reachable over links, text_key xxhash64 of the text.
    Pairs that other links join already are not compared again. `rows` of a band are by default so
    many that a pair at the limit is missed with odds below 1 in 10,000; a miss matters only if no
    other links join the two.

    Null texts count as empty. Rows that share a doc_id are one node. A row without doc_id gets
    the component of its copies and no link of its own; alone it keeps component null and stays.
    Identical rows come back as often as they are given. Extra columns are ignored.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows_for(percent, bands) if rows is None else rows
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    with small_batches(docs.sparkSession):
        signed = cut(keyed.mapInArrow(lean(_signatures(width, bands, rows)), SIGNED))
    key = ["n", "d1", "d2"]
    classes = cut(
        signed.filter("n > 0")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("parity").alias("parity"))
        .filter("rep IS NOT NULL")
    )
    spots = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = spots.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("members"))
    hubs = hubs.filter("members > 1").select("bucket", "hub")
    stars = spots.select("bucket", "rep").join(hubs, "bucket").filter("hub < rep")
    stars = cut(stars.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    linked = cut(_confirmed(stars, texts, width, percent))
    label = components(linked)

    # What the stars left apart: members of one bucket in different components.
    labelled = classes.join(label, classes["rep"] == label["node"], "left").select(
        "rep", "n", "bands", "parity", F.coalesce("component", "rep").alias("component")
    )
    labelled = cut(labelled)
    spots = labelled.select("rep", "component", F.posexplode("bands").alias("band", "bucket"))
    split = spots.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    split = split.filter("lo < hi").select("bucket")
    open_spots = spots.select("rep", "band", "bucket").join(split, "bucket", "left_semi")
    open_spots = cut(open_spots.join(labelled, "rep"))
    left = open_spots.select(*[F.col(c).alias(f"{c}_a") for c in open_spots.columns])
    right = open_spots.select(*[F.col(c).alias(f"{c}_b") for c in open_spots.columns])
    # Equal places of the two signatures before this band: the pair is met there already.
    earlier = F.exists(
        F.slice(F.arrays_zip("bands_a", "bands_b"), F.lit(1), F.col("band_a")),
        lambda two: two["bands_a"] == two["bands_b"],
    )
    apart = sum(
        F.bit_count(F.get("parity_a", F.lit(k)).bitwiseXOR(F.get("parity_b", F.lit(k))))
        for k in range(PARITY_WORDS)
    )
    total = F.col("n_a") + F.col("n_b")
    possible = (
        (F.col("rep_a") < F.col("rep_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        & ((100 + percent) * (total - apart) >= 2 * percent * total)
        & ~earlier
    )
    pairs = left.join(right, (F.col("bucket_a") == F.col("bucket_b")) & possible)
    pairs = pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    # Where a bucket's hub is one of the two, the star has tested the pair.
    pairs = cut(pairs.join(stars, ["a", "b"], "left_anti"))
    more = cut(_confirmed(pairs, texts, width, percent))
    links = linked.union(more)
    label = cut(components(links))
    named = (
        classes.select(*key, "rep")
        .join(label, F.col("rep") == label["node"], "left")
        .select(*key, F.coalesce("component", "rep").alias("component"))
    )
    # Many rows may share one class: adaptive execution splits that side of the join.
    rows_out = signed.select("doc_id", "text_key", *key).join(named, key, "left")
    component = F.coalesce("component", "doc_id")
    return rows_out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("component").isNull()).alias("kept"),
        "text_key",
    )


def one_of_each(docs: DataFrame, percent: int = 80, **settings) -> DataFrame:
    """The rows of docs whose document stays, with all columns as they are.

    One row stays of each component; of rows that repeat its id, the one with the least hashes of
    text, then of the whole row. Rows without words are linked with nothing and stay.
    """
    found = near_duplicates(docs, percent, **settings).filter("kept")
    # One text for each id; null ids go by their texts.
    own, key, place = unused(docs, "own_id", "own_key", "place")
    one = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("text_key"))
    lone = found.filter("doc_id IS NULL").select("doc_id", "text_key").distinct()
    one = one.union(lone).toDF(own, key)
    text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (text_key == F.col(key))
    rows = docs.join(one, same)
    first = Window.partitionBy(own, key).orderBy(F.xxhash64(*docs.columns))
    rows = rows.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
    return rows.select(*docs.columns)
