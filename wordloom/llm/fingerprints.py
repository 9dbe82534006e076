"""Document fingerprints: I-Match over several randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band. A document's distinct
lexicon terms are sorted and hashed, once for the whole lexicon and once for each of a family of
random subsets of it, from an eighth of the terms down to a two-thousandth. Equal texts agree in all
hashes; the small subsets still agree where only part of a text changed, so the share of equal
hashes is a likeness. Terms are known by their 64-bit hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.places import place
from wordloom.session import cut

SPACE = r"[\x20\x09-\x0D]+"
IDF_BAND = (3.0, 7.0)
CHAINS = 12
LEVELS = 5
#: Stands for no term; gives every text a row, whatever its terms are.
NO_TERM = 0
MOST_BROADCAST_TERMS = 2_000_000
MOST_CHUNKS = 4096


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """(term) for rows (text): the terms whose ln(documents / document frequency) is in the band.

    Its size is bounded by the mean number of distinct terms of a text times e to the upper limit.
    """
    n = docs.count()
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    low, high = (n / math.exp(x) for x in (band[1], band[0]))
    return cut(counts.filter(F.col("count").between(low, high)).select("term"))


def drawn(chain: int, level: int):
    """Of all terms an eighth, of a drawn subset a quarter, by bits of their hashes."""
    first = 4 * chain
    if level == 0:
        return lambda t: F.shiftright(t, first).bitwiseAND(F.lit(7)) == 0
    return lambda t: F.shiftright(t, first + 1 + 2 * level).bitwiseAND(F.lit(3)) == 0


def subset_hashes(found: DataFrame, name: str) -> DataFrame:
    """Replace the array of sorted terms `name` by its hashes: whole lexicon, then subsets.

    Chain c draws on bits of the term's hash from 4 * c on; each level keeps a quarter of the one
    above, so the work is little more than that of the first level. An empty subset has no hash.
    """
    hashes = ["_whole"]
    found = found.withColumn("_whole", F.when(F.size(name) > 0, F.hash(name)))
    for level in range(LEVELS):
        names = [name if level == 0 else f"_part{c}" for c in range(CHAINS)]
        picked = {}
        for c in range(CHAINS):
            picked[f"_part{c}"] = F.filter(names[c], drawn(c, level))
        found = found.withColumns(picked)
        made = {
            f"_hash{level}_{c}": F.when(F.size(f"_part{c}") > 0, F.hash(f"_part{c}"))
            for c in range(CHAINS)
        }
        found = found.withColumns(made)
        hashes += list(made)
    kept = [c for c in found.columns if not c.startswith("_") and c != name]
    return found.select(*kept, F.array(*hashes).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Equal hashes among those that either has; null if neither has any."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda s: s))
    both = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda s: s))
    return F.when(both > 0, same / both)


def shown(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit("-"))), " ")


def in_reading_order(docs: DataFrame, chunks: int | None = None) -> DataFrame:
    """Rows (doc_id, text) dealt out by ranges of descending doc_id: adds chunk, pos, ghost, next.

    `next` is the text of the row that follows, after the last row that of the first. The first
    row of each chunk also stands, as a ghost, at the end of the chunk before it, so every row
    finds its follower in its own chunk and the texts are shuffled once. Null ids come last;
    ties are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    if chunks is None:
        chunks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2, min(chunks, MOST_CHUNKS))
    shares = [k / chunks for k in range(1, chunks)]
    limits = docs.agg(F.array_distinct(F.percentile_approx("doc_id", shares)).alias("limits"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    rows = rows.withColumn("limits", F.coalesce(limits.scalar(), F.array().cast("array<bigint>")))
    rows = rows.withColumn("chunk", place(F.col("doc_id"), F.col("limits"), chunks)).drop("limits")
    # One row per chunk.
    tops = rows.groupBy("chunk").agg(F.max(F.struct("doc_id", "tie")).alias("top"))
    above = F.lead("chunk").over(Window.orderBy("chunk"))
    tops = tops.select(
        F.col("chunk").alias("top_chunk"),
        "top",
        F.coalesce(above, F.min("chunk").over(Window.partitionBy())).alias("above"),
    )
    rows = rows.join(F.broadcast(tops), F.col("chunk") == F.col("top_chunk"))
    is_top = F.col("top").eqNullSafe(F.struct("doc_id", "tie"))
    own = F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("above").alias("chunk"), F.lit(True).alias("ghost"))
    stands = F.inline(F.when(is_top, F.array(own, ghost)).otherwise(F.array(own)))
    rows = rows.select("doc_id", "text", "tie", stands.alias("chunk", "ghost"))
    order = Window.partitionBy("chunk").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return rows.select(
        "chunk",
        F.row_number().over(order).alias("pos"),
        "ghost",
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next"),
    )


def fingerprints_with_edits(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """One row per row of docs (doc_id, text) with its fingerprint and that of an edited text.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of
    the next document, in descending doc_id; after the last comes the first. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (likeness to
    the edited text and to the next document).

    Null counts as empty. A text without any lexicon term has as its fingerprint a hash of the
    whole text, which is like an equal one alone. Null ids come last in the order, rows that share
    an id are ordered by a hash of the text, and repeated rows follow each other; a row alone
    follows itself. Extra columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = lexicon(texts, band)
    if known.count() <= MOST_BROADCAST_TERMS:
        known = F.broadcast(known.union(known.sparkSession.range(NO_TERM, NO_TERM + 1)))
    else:
        known = known.union(known.sparkSession.range(NO_TERM, NO_TERM + 1))
    rows = in_reading_order(texts)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half)
    )
    rows = rows.withColumn("edited", F.when(~F.col("ghost"), edited).otherwise(""))
    versions = F.inline(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("version")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("version")),
        )
    )
    each = rows.select("chunk", "pos", versions)
    each = each.select(
        "chunk", "pos", "kind",
        F.explode(F.concat(F.array(F.lit(NO_TERM).cast("long")), terms(F.col("version")))).alias("term"),
    )
    # All rows of a chunk are in one place already: neither this nor the window shuffles.
    found = each.join(known, "term").groupBy("chunk", "pos", "kind").agg(F.collect_list("term").alias("hashes"))
    found = found.withColumn(
        "hashes", F.array_sort(F.filter("hashes", lambda t: t != NO_TERM))
    )
    found = subset_hashes(found, "hashes")
    order = Window.partitionBy("chunk").orderBy("pos", "kind")
    found = found.select(
        "chunk", "pos", "kind", "hashes",
        F.lead("hashes", 1).over(order).alias("edited_hashes"),
        F.lead("hashes", 2).over(order).alias("next_hashes"),
    ).filter("kind = 0")
    found = found.select(
        "chunk", "pos",
        F.when(F.get("hashes", F.lit(0)).isNotNull(), shown(F.col("hashes"))).alias("fingerprint"),
        F.when(F.get("edited_hashes", F.lit(0)).isNotNull(), shown(F.col("edited_hashes"))).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )

    def whole(name):
        return F.concat(F.lit("="), F.lower(F.hex(F.xxhash64(name))))

    named = rows.filter(~F.col("ghost")).select(
        "chunk", "pos", "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        whole("text").alias("whole"),
        whole("edited").alias("whole_edited"),
        (F.col("text") == F.col("edited")).cast("double").alias("same_edited"),
        (F.col("text") == F.col("next")).cast("double").alias("same_next"),
    )
    return named.join(found, ["chunk", "pos"]).select(
        "doc_id", "n_chars", "edited_sha256",
        F.coalesce("fingerprint", "whole").alias("fingerprint"),
        F.coalesce("edited_fingerprint", "whole_edited").alias("edited_fingerprint"),
        F.coalesce("near_edited", "same_edited").alias("near_edited"),
        F.coalesce("near_next", "same_next").alias("near_next"),
    )
