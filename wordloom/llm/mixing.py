"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of equal token counts are dealt to the sources: slot i is the golden-ratio point i * phi
mod 1, looked up in the cumulative target shares, so every stretch of the mixture holds each
source about as often as its share says. Each source's documents stand in a shuffled order, read
as one stream of words that starts over at its end; the k-th slot of a source takes the k-th block
of its stream. Slots are ranked and words counted by running totals over range partitions, so no
source, however large, meets in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.names import unused
from wordloom.llm.places import constants, place
from wordloom.operators.ordering import with_rank, with_total_before
from wordloom.session import cut

SPACE = r"[\x20\x09-\x0D]+"
PHI = 0.6180339887498949
MOST_REPEATS = 3
MOST_SOURCES = 10_000
BLOCK_WORDS = 2048
SEED = "mix"


def word_count(text):
    """Number of words between ASCII white space; null has none."""
    parts = F.size(F.split(text, SPACE))
    ends = text.rlike(r"^[\x20\x09-\x0D]").cast("int") + text.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(parts - ends).cast("long")


def cyclic_weights(sources: list) -> list[float]:
    return [1.0 + k % 3 for k in range(len(sources))]


def targets(sizes: list[int], weights: list[float], most_repeats: int = MOST_REPEATS) -> list[float]:
    """Shares of all words by weight; what lies above `most_repeats` times a source's size goes
    to the others by their weights, until nothing lies above."""
    total, free = float(sum(sizes)), float(sum(weights))
    out = [0.0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (sizes[k] / weights[k], k)):
        level = total / free
        out[k] = min(float(most_repeats * sizes[k]), level * weights[k])
        total -= out[k]
        free -= weights[k]
        if free <= 0:
            break
    return out


class Sources:
    """Sizes, targets and quotas of all sources, in code point order, null last.

    One row per source reaches the driver; more than `MOST_SOURCES` are refused.
    """

    def __init__(self, rows: DataFrame, weights: Callable[[list], list[float]]):
        found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1)
        found = [(r["source"], r["size"]) for r in found.collect()]
        if len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources: mix by a coarser column")
        found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
        self.names = [name for name, _ in found]
        self.sizes = [size for _, size in found]
        self.targets = targets(self.sizes, weights(self.names)) if found else []
        self.quotas = [
            min(MOST_REPEATS * size, int(t + 0.5)) for size, t in zip(self.sizes, self.targets)
        ]
        self.starts = [sum(self.sizes[:k]) for k in range(len(found))]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (k, *r) for k, r in enumerate(zip(self.names, self.sizes, self.targets, self.quotas, self.starts))
        ]
        kinds = "s int, source string, source_size long, target double, quota long, start long"
        return spark.createDataFrame(rows, kinds)


def slots(spark: SparkSession, sources: Sources, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, s, turn, turns): which source each slot takes from, and for which time."""
    total = sum(sources.quotas)
    n = -(-total // block)
    limits, at = [], 0
    for quota in sources.quotas[:-1]:
        at += quota
        limits.append(at / max(total, 1))
    dealt = spark.range(n).select(
        F.col("id").alias("slot"),
        place((F.col("id") * F.lit(PHI)) % 1.0, constants(limits, "double"), len(limits)).alias("s"),
    )
    # Small sources that no point met get a slot at the end.
    met = {r["s"]: r["n"] for r in dealt.groupBy("s").agg(F.count("*").alias("n")).collect()}
    missed = [(n + k, k) for k, q in enumerate(sources.quotas) if q and k not in met]
    dealt = dealt.union(spark.createDataFrame(missed, "slot long, s int"))
    turns = {**met, **{k: 1 for _, k in missed}}
    firsts, before = [], 0
    for k in range(len(sources.quotas)):
        firsts.append((k, before, turns.get(k, 0)))
        before += turns.get(k, 0)
    ranked = with_rank(dealt.withColumn("key", F.struct("s", "slot")), "key")
    firsts = F.broadcast(spark.createDataFrame(firsts, "s int, first long, turns long"))
    return ranked.join(firsts, "s").select(
        "slot", "s", (F.col("rank") - F.col("first")).alias("turn"), "turns"
    )


def streams(docs: DataFrame, sources: Sources, seed: str) -> DataFrame:
    """docs with s, their source's numbers, and `begin`, the place of their first word in the
    shuffled stream of their source."""
    table = F.broadcast(sources.table(docs.sparkSession))
    rows = docs.join(table.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    shuffled = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    rows = rows.withColumn("key", F.struct("s", shuffled.alias("shuffled"), "doc_id", "size", "text_key"))
    running = with_total_before(rows, "key", "size", "running")
    return running.withColumn("begin", F.col("running") - F.col("start")).drop("key", "running", "name")


def schedule(placed: DataFrame, sources: Sources, block: int = BLOCK_WORDS) -> DataFrame:
    """The mixture in pieces: (slot, s, begin, pass, first_word, words).

    Words first_word to first_word + words of the document that begins at `begin` of its source's
    stream stand in `slot`; a slot holds its pieces in the order of the stream.
    """
    ranked = slots(placed.sparkSession, sources, block)
    passes = F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))).alias("pass")
    pieces = placed.filter("size > 0").select("s", "begin", "size", "source_size", "quota", passes)
    start = F.col("pass") * F.col("source_size") + F.col("begin")
    pieces = pieces.withColumn("p", start)
    pieces = pieces.withColumn("q", F.least(F.col("p") + F.col("size"), "quota")).filter("p < q")
    counts = ranked.groupBy("s").agg(F.first("turns").alias("n"))
    # One row per source.
    pieces = pieces.join(F.broadcast(counts), "s")
    each = F.expr("(quota + n - 1) div n")
    pieces = pieces.withColumn("each", each)
    pieces = pieces.withColumn("turn", F.explode(F.expr("sequence(p div each, (q - 1) div each)")))
    low = F.greatest("p", F.col("turn") * F.col("each"))
    high = F.least("q", (F.col("turn") + 1) * F.col("each"))
    pieces = pieces.select(
        "s", "turn", "begin", "pass", (low - F.col("p")).alias("first_word"), (high - low).alias("words")
    )
    return pieces.join(ranked.select("s", "turn", "slot"), ["s", "turn"]).select(
        "slot", "s", "begin", "pass", "first_word", "words"
    )


def sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("text_key"),
    )


def _planned(docs: DataFrame, weights, block: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The rows of docs in the streams of their sources, and the schedule."""
    rows = cut(sized(docs))
    sources = Sources(rows, weights)
    placed = cut(streams(rows, sources, seed))
    return placed, schedule(placed, sources, block)


def mix(
    docs: DataFrame,
    weights: Callable[[list], list[float]] = cyclic_weights,
    block: int = BLOCK_WORDS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text, source) with what the mixture takes of each, and the schedule.

    First table, one row per row of docs: doc_id, text_key, size (words), source, source_size,
    target, quota, begin, taken (words, repeats counted). A source's quota is its target rounded to whole
    words; its stream gives out exactly that many, no word more than three times. Null texts have
    size 0 and are never taken; a null source is a source; null ids are shuffled as one id and
    stand by size. Rows that repeat one another take their own places. An empty table gives empty
    tables. Extra columns are ignored. The same rows give the same mixture.
    """
    placed, plan = _planned(docs, weights, block, seed)
    taken = plan.groupBy("s", "begin").agg(F.sum("words").alias("words"))
    # An empty document begins where the next one does.
    both = placed.withColumn("some", F.col("size") > 0).join(
        taken.withColumn("some", F.lit(True)), ["s", "begin", "some"], "left"
    )
    table = both.select(
        "doc_id", "text_key", "size", "source", "source_size", "target", "quota", "begin",
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
    )
    return table, plan


def copies(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """(s, begin, times): for each document that the schedule takes whole, the (slot, pass) in which
    its copies begin.

    A pass takes a document if it takes at least half of its words. The first document of a stream
    is taken once at least, so no source with a quota goes without.
    """
    each = plan.groupBy("s", "begin", "pass").agg(
        F.sum("words").alias("words"), F.min(F.when(F.col("first_word") == 0, F.col("slot"))).alias("slot")
    )
    sizes = placed.filter("size > 0").select("s", "begin", "size")
    whole = (2 * F.col("words") >= F.col("size")) | ((F.col("begin") == 0) & (F.col("pass") == 0))
    found = each.join(sizes, ["s", "begin"]).filter(whole)
    return found.groupBy("s", "begin").agg(F.collect_list(F.struct("slot", "pass")).alias("times"))


def mixed(docs: DataFrame, weights=cyclic_weights, block: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """docs as the mixture takes them, with all columns as they are: each row as often as passes
    over its source's stream take at least half of its words, so never or up to three times, and the
    first of each source with a quota once at least.

    Rows stand in the order of the slots in which they begin, within a slot as in the stream. Rows
    equal in doc_id, text and source each get a place of their own.
    """
    placed, plan = _planned(docs, weights, block, seed)
    same, nth, places, found, row = unused(docs, "same", "nth", "places", "found", "row")
    # Nulls are equal inside of structs.
    wanted = placed.filter("size > 0").join(copies(placed, plan), ["s", "begin"], "left")
    wanted = wanted.groupBy(F.struct("doc_id", "source", "text_key").alias(same)).agg(
        F.sort_array(F.collect_list(F.struct("begin", "s", "times"))).alias(places)
    )
    wanted = wanted.filter(F.exists(places, lambda p: p["times"].isNotNull()))
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    key = F.struct("doc_id", source.alias("source"), F.xxhash64(text).alias("text_key"))
    rows = docs.select(F.struct(*docs.columns).alias(row), key.alias(same)).filter(F.length(text) > 0)
    # One row nearly always: more are rows that repeat one another.
    hashed = [F.col(row)[c] for c, kind in docs.dtypes if not re.search("map<|variant", kind)]
    order = Window.partitionBy(same).orderBy(F.xxhash64(*hashed))
    rows = rows.withColumn(nth, F.row_number().over(order)).join(wanted, same)
    rows = rows.withColumn(found, F.get(places, F.col(nth) - 1))
    rows = rows.select(row, F.col(found)["begin"].alias("begin"), F.explode(F.col(found)["times"]).alias("time"))
    rows = rows.orderBy("time.slot", "time.pass", "begin")
    return rows.select(*[F.col(row)[c].alias(c) for c in docs.columns])
