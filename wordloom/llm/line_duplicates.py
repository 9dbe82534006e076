"""Line de-duplication by an exact set-similarity join.

A line is the set of its distinct lower-cased words. Words are ordered from rare to frequent; two
sets of the wanted Jaccard similarity must share one of their first few words, so only sets that
share such a word are compared, and only where lengths, the place of the word and a bitmap bound on
the overlap allow a match. Equal sets, told by a 64-bit hash and their size, go on as one. A set that
matches one of the first holders of a word is settled by that; only the others are compared with
all earlier holders, so a cluster of like lines costs about as many comparisons as it has lines.
A word that the corpus uses once leads to no other set, so no set is sought by it: a bit map of
bounded size tells such words, and one that it cannot tell only costs time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.bytewise import (
    lean,
    U64,
    WordHasher,
    byte_view,
    lists,
    lowered,
    mix,
    runs,
    sums_by,
    word_limits,
)
from wordloom.llm.collocations import _has as in_bit_map
from wordloom.llm.collocations import bit_map
from wordloom.llm.names import unused
from wordloom.llm.tables import broadcast_if_small, stored

HEAD_WORDS = 1 << 16
LEAST_WORDS = 1
COUNT_RUN_BYTES = 4 << 20
MOST_COUNTS = 1_500_000
HUBS = (1, 2, 4, 8)
SPOT_BYTES = 80
NO_ID = 2**63 - 1


def _line_offsets(part: np.ndarray, offsets: np.ndarray):
    """First byte of each line of texts given as bytes, and each line's text and number."""
    breaks = np.flatnonzero(part == 10) + 1
    starts = np.unique(np.concatenate([offsets[:-1], breaks[breaks < len(part)]]))
    starts = starts[starts < len(part)]
    text = np.searchsorted(offsets, starts, "right") - 1
    number = np.searchsorted(breaks, starts, "right") - np.searchsorted(breaks, offsets[text], "right")
    return np.append(starts, len(part)), text, number


def _counted(batches):
    """Words of a partition with their uses, merged in memory up to `MOST_COUNTS` at a time."""
    hasher, held, size = WordHasher(), [], 0

    def merged():
        words, which = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(which, np.concatenate([n for _, n in held])).astype(np.int64)

    def rows(words, uses):
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(uses)], ["word", "uses"]
        )

    for batch in batches:
        data, offsets = byte_view(batch.column("text"))
        for i, j in runs(offsets, COUNT_RUN_BYTES):
            part = lowered(data[offsets[i] : offsets[j]])
            starts, ends, _ = word_limits(part, offsets[i : j + 1] - offsets[i])
            held.append(np.unique(hasher(part, starts, ends), return_counts=True))
            size += len(held[-1][0])
            if size > MOST_COUNTS:
                held = [merged()]
                size = len(held[0][0])
                if size > MOST_COUNTS // 2:
                    yield rows(*held[0])
                    held, size = [], 0
    if held:
        yield rows(*merged())


def repeated_words(texts: DataFrame) -> DataFrame:
    """(word, uses) of the hashes of all words used more than once, stored."""
    counts = texts.select("text").mapInArrow(lean(_counted), "word long, uses long")
    counts = counts.groupBy("word").agg(F.sum("uses").alias("uses"))
    return stored(counts.filter("uses > 1"), "uses")


def frequent_words(counts: DataFrame, head_words: int = HEAD_WORDS) -> np.ndarray:
    """Hashes of the most frequent words, frequent ones last. All other words count as rarer."""
    top = counts.orderBy(F.desc("uses"), "word").limit(head_words).toArrow()
    order = np.lexsort((top["word"].to_numpy(), top["uses"].to_numpy()))
    return top["word"].to_numpy()[order].view(U64)


class _Ranks:
    """Order of words from rare to frequent, as 64-bit numbers: the hash without its last bit, and
    for frequent words their rank above all of those."""

    def __init__(self, head: np.ndarray):
        self.order = np.argsort(head)
        self.head = head[self.order]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = hashes >> U64(1)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
            there = self.head[at] == hashes
            out[there] = U64(1 << 63) + self.order[at[there]].astype(U64)
        return out


def _line_sets(part, offsets, hasher, ranks, least_words, asked=None):
    """Lines that take part: text and line numbers, sorted distinct words, their owners, sizes.

    `asked`, if given, has the lines wanted as text << 32 | number.
    """
    limits, text, number = _line_offsets(part, offsets)
    part = lowered(part)
    starts, ends, owner = word_limits(part, limits)
    words = np.bincount(owner, minlength=len(text))
    keep = words >= least_words
    if asked is not None:
        keep &= np.isin(text << 32 | number, asked)
    mine = keep[owner]
    place = np.cumsum(keep) - 1
    hashes = hasher(part, starts[mine], ends[mine]) if mine.any() else np.zeros(0, U64)
    # Each different word is looked up once; lines and places of words sort as one number.
    different, which = np.unique(hashes, return_inverse=True)
    order, at = np.unique(ranks(different), return_inverse=True)
    width = len(order).bit_length()
    both = np.sort(place[owner[mine]] << width | at[which])
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    owner = both >> width
    sizes = np.bincount(owner, minlength=int(keep.sum()))
    return text[keep], number[keep], order[both & ((1 << width) - 1)], owner, sizes


def _prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """First words of each set that others are sought by: none where a set of one word more or
    less is too far off already, so that equal sets only match."""
    few = sizes - -(-sizes * percent // 100) + 1
    return np.where(100 * sizes < percent * (sizes + 1), 0, few)


LINES = "doc_id long, text_key long, line int, n int, sid long, bits long, bits2 long, prefix array<int>"


def _set_ids(values, owner, sizes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(sums_by(owner, mix(values + U64(0x51ED27)), sizes) + sizes.astype(U64)).view(np.int64)


def _lines(head: np.ndarray, repeated: np.ndarray, percent: int, least_words: int):
    """Lines with their sets' ids, bitmaps and prefixes. In a prefix, 0 stands for a word used once:
    the others keep their places."""

    def run(batches):
        hasher, ranks = WordHasher(), _Ranks(head)
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            for i, j in runs(offsets):
                part = data[offsets[i] : offsets[j]]
                text, number, values, owner, sizes = _line_sets(
                    part, offsets[i : j + 1] - offsets[i], hasher, ranks, least_words
                )
                with np.errstate(over="ignore"):
                    mixed = mix(values + U64(0x2545F491))
                first = np.cumsum(sizes) - sizes
                bit, half = U64(1) << (mixed & U64(63)), (mixed >> U64(6)) & U64(1)
                bits = [np.zeros(len(sizes), U64)] * 2
                if len(values):
                    bits = [
                        np.bitwise_xor.reduceat(np.where(half == k, bit, U64(0)), first) for k in (0, 1)
                    ]
                few = _prefix_sizes(sizes, percent)
                among = np.arange(len(values)) - first[owner] < few[owner]
                short = np.maximum(mixed[among] >> U64(32), U64(1)).astype(np.uint32).view(np.int32)
                rare = values[among] < U64(1 << 63)
                short[rare & ~in_bit_map(repeated, values[among] << U64(1))] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, j - i).take(pa.array(text)) for c in ("doc_id", "text_key")],
                        pa.array(number.astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(_set_ids(values, owner, sizes)),
                        *[pa.array(b.view(np.int64)) for b in bits],
                        lists(short, few),
                    ],
                    LINES.replace(",", "").split()[::2],
                )

    return run


def _words_of(head: np.ndarray, least_words: int):
    """(sid, words) of the lines asked for in each text."""

    def run(batches):
        hasher, ranks = WordHasher(), _Ranks(head)
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            asked = batch.column("lines")
            lines, ends = asked.flatten().to_numpy(), asked.offsets.to_numpy()
            ends = ends - ends[0]
            for i, j in runs(offsets):
                part = data[offsets[i] : offsets[j]]
                own = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1])) << 32
                _, _, values, owner, sizes = _line_sets(
                    part, offsets[i : j + 1] - offsets[i], hasher, ranks, least_words,
                    own | lines[ends[i] : ends[j]],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_set_ids(values, owner, sizes)),
                        lists(values.view(np.int64), sizes),
                    ],
                    ["sid", "words"],
                )

    return run


#: What a spot, a set at one of its first words, carries.
SPOT = ("doc", "line", "sid", "n", "bits", "bits2", "pos")
PLACE = ("doc", "line", "sid")


def _spots(sets: DataFrame) -> DataFrame:
    """(word, spot): each set at each repeated word of its prefix; `doc` orders null ids last.

    No column can be null, so joins add no filters below the shuffle, and all readers share it.
    """
    doc = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc")
    each = sets.select(F.posexplode("prefix").alias("pos", "word"), doc, "line", "sid", "n", "bits", "bits2")
    each = each.filter("word <> 0")
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("word", "line", "sid", "n", "bits", "bits2")]
    return each.select("doc", "pos", *filled)


def _earlier(own, other) -> Column:
    same_doc, same_line = other("doc") == own("doc"), other("line") == own("line")
    later_line = (other("line") < own("line")) | (same_line & (other("sid") < own("sid")))
    return (other("doc") < own("doc")) | (same_doc & later_line)


def _overlap_possible(own, other, percent: int) -> Column:
    """Length filter, and a bound on the overlap by the bits in which the bitmaps differ."""
    n, total = (own("n"), other("n")), own("n") + other("n")
    apart = F.bit_count(own("bits").bitwiseXOR(other("bits"))) + F.bit_count(
        own("bits2").bitwiseXOR(other("bits2"))
    )
    return (100 * F.least(*n) >= percent * F.greatest(*n)) & (
        (100 + percent) * (total - apart) >= 2 * percent * total
    )


def _position_possible(own, other, percent: int) -> Column:
    """From their first shared word on, both sets must hold enough words. (Of later shared words
    the bound asks too much; the row of the first one remains.)"""
    most = F.least(own("n") - own("pos"), other("n") - other("pos"))
    return (100 + percent) * most >= percent * (own("n") + other("n"))


def _possible(own, other, percent: int) -> Column:
    return (
        _overlap_possible(own, other, percent)
        & _position_possible(own, other, percent)
        & _earlier(own, other)
    )


def _pairs(spots: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """(sid, doc, line, o_sid, o_doc, o_line): sets and earlier ones that they may match."""
    possible = (OWN("word") == OTHER("word")) & _possible(OWN, OTHER, percent)
    both = spots.alias("own").join(others.alias("other"), possible)
    return both.select(*[OWN(c) for c in PAIR[:3]], *[OTHER(c).alias(f"o_{c}") for c in PAIR[:3]])


def OWN(name: str) -> Column:
    return F.col(f"own.{name}")


def OTHER(name: str) -> Column:
    return F.col(f"other.{name}")


PAIR = ("sid", "doc", "line", "o_sid", "o_doc", "o_line")


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs to be compared in full, and whether they stand for others.

    A word's holders stand in order in one place. Each is held against a few of the first ones
    (`HUBS`); where one of them is a possible match, the holder is paired with that alone
    (`hub` true), else with all possible matches before it. The join is an outer one so that the
    holders are read once, and its other side reads the same shuffle.
    """
    spots = _spots(sets).repartition("word")
    order = Window.partitionBy("word").orderBy("doc", "line", "sid")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hubs = [F.nth_value(F.struct(*SPOT), k).over(until).alias(f"hub{k}") for k in HUBS]
    placed = spots.select("*", *hubs)
    near = []
    for k in HUBS:

        def hub(name, k=k):
            return F.col(f"hub{k}")[name]

        fits = _overlap_possible(F.col, hub, percent) & _earlier(F.col, hub)
        near.append(F.when(F.coalesce(fits, F.lit(False)), F.struct(*[hub(c) for c in PAIR[:3]])))
    placed = placed.select("word", *SPOT, F.coalesce(*near).alias("near"))
    alone = OWN("near").isNull()
    possible = (OWN("word") == OTHER("word")) & alone & _possible(OWN, OTHER, percent)
    both = placed.alias("own").join(spots.alias("other"), possible, "left")
    found = [F.coalesce(OWN("near")[c], OTHER(c)).alias(f"o_{c}") for c in PAIR[:3]]
    rows = both.select(*[OWN(c) for c in PAIR[:3]], *found, (~alone).alias("hub"))
    return rows.filter("o_sid IS NOT NULL").distinct()


def _matches(pairs: DataFrame, texts: DataFrame, words_of, percent: int) -> DataFrame:
    """The distinct `sid` of pairs whose full sets reach the similarity."""
    ends = F.array(F.struct("doc", "line"), F.struct(F.col("o_doc").alias("doc"), F.col("o_line").alias("line")))
    asked = pairs.select(F.inline(ends)).groupBy("doc").agg(F.collect_set("line").alias("lines"))
    asked = stored(asked, "asked")
    asked = broadcast_if_small(asked, F.size("lines") * 4 + 64)
    asked_for = texts.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).join(asked, "doc")
    found = stored(
        asked_for.select("text", "lines").mapInArrow(lean(words_of), "sid long, words array<long>"), "words"
    )
    other = found.withColumnsRenamed({"sid": "o_sid", "words": "o_words"})
    both = pairs.select("sid", "o_sid").distinct().join(found, "sid").join(other, "o_sid")
    shared = F.size(F.array_intersect("words", "o_words"))
    total = F.size("words") + F.size("o_words")
    return both.filter((100 + percent) * shared >= percent * total).select("sid").distinct()


def removed_lines(
    docs: DataFrame, percent: int = 80, least_words: int = LEAST_WORDS, head_words: int = HEAD_WORDS
) -> DataFrame:
    """(doc_id, text_key, lines): numbers of the lines of each text that match an earlier line.

    Lines stand in the order of doc_id (null last), then number. Two match if their sets of
    distinct words have a Jaccard similarity of `percent` or more; a line with fewer than
    `least_words` words takes no part (1: every line that has a word does). text_key is xxhash64
    of the text; rows equal in doc_id and text are one text. A text or a line may have any length. Texts without such lines have no row. Null texts have no lines.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    counts = repeated_words(texts)
    head = frequent_words(counts, head_words)
    repeated = bit_map(counts.select(F.col("word").alias("pair")))
    lines = stored(texts.mapInArrow(lean(_lines(head, repeated, percent, least_words)), LINES), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", "text_key")
    sets = stored(
        lines.groupBy("sid", "n")
        .agg(
            F.min(place).alias("first"),
            F.first("bits").alias("bits"),
            F.first("bits2").alias("bits2"),
            F.first("prefix").alias("prefix"),
            (F.count("*") > 1).alias("again"),
        )
        .select("sid", "n", "bits", "bits2", "prefix", "again", "first.*"),
        "sets",
    )
    words_of = _words_of(head, least_words)
    pairs = stored(_candidates(sets, percent), "pairs")
    settled = stored(_matches(pairs, texts, words_of, percent), "settled")
    # Sets that a first holder looked like a match for and that match none: against all holders.
    failed = stored(pairs.filter("hub").select("sid").distinct().join(settled, "sid", "left_anti"), "failed")
    if not failed.isEmpty():
        spots = stored(_spots(sets.join(failed, "sid", "left_semi")), "spots")
        rest = _pairs(broadcast_if_small(spots, F.lit(SPOT_BYTES)), _spots(sets), percent).distinct()
        rest = stored(rest.join(pairs.select("sid", "o_sid"), ["sid", "o_sid"], "left_anti").select(*PAIR), "rest")
        settled = stored(settled.union(_matches(rest, texts, words_of, percent)), "settled")
    first = sets.join(settled, "sid", "left_semi").select("doc_id", "text_key", "line")
    # A line may stand in a third of all texts: adaptive execution splits that side of the join.
    copied = sets.filter("again").select("sid", "n", place.alias("first"))
    copies = lines.join(copied, ["sid", "n"]).filter(~place.eqNullSafe(F.col("first")))
    gone = first.union(copies.select("doc_id", "text_key", "line"))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def deduplicated(docs: DataFrame, percent: int = 80, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs with `text` rid of the lines that match an earlier line, and `lines_removed`, which
    takes the place of a column of that name.

    All rows and other columns stay; a text that loses every line becomes empty, a text that loses
    none is unchanged, null stays null. Rows equal in doc_id and text are judged as one. An empty
    table stays empty.
    """
    own, key, lost = unused(docs, "own_id", "own_key", "lost")
    gone = stored(removed_lines(docs, percent, least_words).toDF(own, key, lost), "gone")
    gone = broadcast_if_small(gone, F.size(lost) * 4 + 64)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(key))
    both = docs.join(gone, same, "left")
    rest = F.filter(
        F.split("text", "\n"), lambda line, k: ~F.array_contains(lost, k.cast("int"))
    )
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    removed = F.coalesce(F.size(lost), F.lit(0)).cast("long")
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    columns = [c for c, name in zip(columns, docs.columns) if name != "lines_removed"]
    return both.select(*columns, removed.alias("lines_removed"))
