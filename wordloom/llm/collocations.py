"""Phrase collocations from a weighted de Bruijn graph of words.

Counts of all phrases up to N words come from one table: at each word, the longest gram that
begins there, N words or as far as the piece goes. Grams of N words are the edges of a graph whose
nodes are N - 1 words long, from their first to their last N - 1 words; shorter grams say how often
pieces end in a node. A node's flow, its edges plus its ends, counts its phrase, and flows of
nodes sum to those of their shorter beginnings in the same way.

Only phrases of `least` uses and more matter, so a first pass counts word pairs by hash and pieces
are taken to end between two words that are a rare pair. That cuts no frequent phrase and, as a cut
is an end like others, leaves the flows of all frequent phrases exact. The frequent pairs go to
the tasks as a bit map of bounded size; pairs that share a bit with one only cost time.

Frequent edges with nothing but one another before and after them, in one chain, are joined to
paths: the phrases inside have the flow of the path and need no counting of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.bytewise import U64, WordHasher, byte_view, lowered, mix, runs, seeded
from wordloom.llm.tables import stored
from wordloom.session import cut

LONGEST = 4
RUN_BYTES = 2 << 20
#: Pairs that a task counts before it hands them on.
MOST_PAIRS = 2 << 20
#: Size limits of the bit map, as powers of two.
LEAST_BITS, MOST_BITS = 16, 27
RANK_PARTS = 64
NO_LANGUAGE = "und"
COUNT = "decimal(20,0)"


class Words:
    """The words of some texts: canonical bytes with one blank after each word, word hashes that
    hold the language, and how many words follow in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray, hasher: WordHasher):
        data = lowered(data)
        breaks = np.zeros(256, bool)
        breaks[[10, 11, 12, 13, *b".,;:!?"]] = True
        gaps = breaks.copy()
        gaps[[9, 32]] = True
        inside = ~gaps[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = starts = np.flatnonzero(inside & ~(before & ~edge[:-1]))
        ends = np.flatnonzero(inside & ~(after & ~edge[1:])) + 1
        owner = np.searchsorted(offsets, starts, "right") - 1
        self.language = languages[owner]
        pieces = np.cumsum(breaks[data])[starts] if len(starts) else starts
        n = len(starts)
        self.same = np.zeros(n, bool)
        if n:
            self.same[:-1] = (pieces[1:] == pieces[:-1]) & (owner[1:] == owner[:-1])
        sizes = ends - starts
        self.first = np.cumsum(sizes + 1) - sizes - 1
        total = int(self.first[-1] + sizes[-1] + 1) if n else 0
        self.bytes = np.full(total, 32, np.uint8)
        place = np.arange(total) - np.repeat(self.first, sizes + 1)
        word = np.repeat(starts, sizes + 1)
        own = place < np.repeat(sizes, sizes + 1)
        self.bytes[own] = data[(word + place)[own]]
        self.ends = self.first + sizes
        with np.errstate(over="ignore"):
            self.hash = mix(hasher(data, starts, ends) + seeded(int(languages.max(initial=0)) + 1, 19)[self.language])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of all pairs in a piece, and the pairs' hashes."""
        at = np.flatnonzero(self.same)
        with np.errstate(over="ignore"):
            return at, mix(self.hash[at] * U64(0x9E3779B97F4A7C15) + self.hash[at + 1] * seeded(1, 23)[0])


def _read(batches, codes: dict[str, int]):
    """Words of each run of texts."""
    hasher = WordHasher()
    for batch in batches:
        data, offsets = byte_view(batch.column("text"))
        names = batch.column("lang").dictionary_encode()
        known = np.array([codes[x] for x in names.dictionary.to_pylist()], np.int64)
        language = known[names.indices.to_numpy()] if len(known) else np.zeros(0, np.int64)
        for i, j in runs(offsets, RUN_BYTES):
            part = data[offsets[i] : offsets[j]]
            yield Words(part, offsets[i : j + 1] - offsets[i], language[i:j], hasher)


def _pair_counts(codes):
    def run(batches):
        held, size = [], 0

        def counted():
            pairs, uses = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.view(np.int64)), pa.array(uses)], ["pair", "uses"]
            )

        for words in _read(batches, codes):
            held.append(words.pairs()[1])
            size += len(held[-1])
            if size >= MOST_PAIRS:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    return run


def bit_map(pairs: DataFrame) -> np.ndarray:
    """Bits of the hashes in `pair`, packed; large enough to be sparse up to a fixed size."""
    n = pairs.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    place = F.shiftrightunsigned("pair", 64 - bits)
    chunks = pairs.select(place.alias("place")).groupBy(
        F.bitmap_bucket_number(F.col("place") + 1).alias("chunk")
    )
    found = chunks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for chunk, part in found.toLocalIterator():
        at = (chunk - 1) * len(part)
        size = min(len(part), len(out) - at)
        out[at : at + size] = np.frombuffer(part, np.uint8)[:size]
    return out


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    width = len(bits).bit_length() + 2
    place = (hashes >> U64(64 - width)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def _grams(codes, names, bits, n):
    def run(batches):
        frequent = np.frombuffer(bits.value, np.uint8)
        odd = seeded(n + 1, 29)
        for words in _read(batches, codes):
            at, pairs = words.pairs()
            linked = np.zeros(len(words.hash), bool)
            linked[at[_has(frequent, pairs)]] = True
            size = np.ones(len(linked), np.int64)
            go = linked.copy()
            key = words.hash * odd[0]
            with np.errstate(over="ignore"):
                for k in range(1, n):
                    there = np.flatnonzero(go)
                    size[there] += 1
                    key[there] += words.hash[there + k] * odd[k]
                    go[there] = linked[there + k]
                key = mix(key + size.astype(U64) * odd[n])
            _, example, uses = np.unique(key, return_index=True, return_counts=True)
            first, size = words.first[example], size[example]
            length = words.ends[example + size - 1] - first
            ends = np.cumsum(length)
            gather = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + length, length)
            offsets = np.zeros(len(ends) + 1, np.int32)
            offsets[1:] = ends
            phrase = pa.StringArray.from_buffers(
                len(ends), pa.py_buffer(offsets), pa.py_buffer(words.bytes[gather])
            )
            language = pa.array([names[c] for c in words.language[example].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [language, phrase, pa.array(size.astype(np.int32)), pa.array(uses)],
                ["lang", "phrase", "m", "uses"],
            )

    return run


def longest_grams(docs: DataFrame, least: int, n: int = LONGEST) -> DataFrame:
    """(lang, phrase, m, uses): the longest grams that begin at each word, of up to `n` words,
    pieces being cut between words that form a pair of fewer than `least` uses."""
    texts = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    names = sorted(r.lang for r in texts.select("lang").distinct().collect())
    codes = {name: i for i, name in enumerate(names)}
    pairs = texts.mapInArrow(_pair_counts(codes), "pair long, uses long").groupBy("pair")
    frequent = stored(pairs.agg(F.sum("uses").alias("uses")).filter(F.col("uses") >= least).select("pair"), "pairs")
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(frequent).tobytes())
    grams = texts.mapInArrow(_grams(codes, names, bits, n), "lang string, phrase string, m int, uses long")
    return grams.groupBy("lang", "phrase", "m").agg(F.sum("uses").alias("uses"))


def first_words(phrase, m):
    return F.substring_index(phrase, " ", m)


def without_first(phrase):
    return F.expr(f"substring({phrase}, instr({phrase}, ' ') + 1)")


def flows(grams: DataFrame, n: int = LONGEST) -> dict[int, DataFrame]:
    """(lang, phrase, uses) of all phrases of 1 to `n` words: edges, then nodes ever shorter, each
    with what flows out of it and the ends in it."""
    at = {n: grams.filter(F.col("m") == n).select("lang", "phrase", "uses")}
    for m in range(n - 1, 0, -1):
        out = at[m + 1].select("lang", first_words("phrase", m).alias("phrase"), "uses")
        ends = grams.filter(F.col("m") == m).select("lang", "phrase", "uses")
        at[m] = out.union(ends).groupBy("lang", "phrase").agg(F.sum("uses").alias("uses"))
    return at


def paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, phrase, uses): chains of edges joined where only one leads on to only one other.

    `nodes` are the flows of the edges' ends. Two edges are joined when they have the flow of the
    node between them: then nothing else leads in or out, and no piece begins or ends there. Such
    chains have ends, as every piece begins somewhere. Each round joins what the last has joined
    in pairs, so their number follows the logarithm of the longest chain.
    """
    last = without_first("phrase")
    inner = (
        edges.select("lang", last.alias("node"), "uses", F.col("phrase").alias("left"))
        .join(nodes.select("lang", F.col("phrase").alias("node"), "uses"), ["lang", "node", "uses"])
        .join(
            edges.select("lang", F.col("phrase").alias("right"), "uses").withColumn(
                "node", F.expr("substring_index(right, ' ', size(split(right, ' ')) - 1)")
            ),
            ["lang", "node", "uses"],
        )
        .select("lang", "left", "right")
    )
    links = cut(inner)
    # Pointer doubling: `far` is the edge that a chain from `head` has reached, null at its end,
    # and `rest` the words that it adds to those of the head.
    heads = edges.select("lang", F.col("phrase").alias("head"), "uses")
    follows = links.select("lang", F.col("left").alias("head"), F.col("right").alias("far"))
    step = cut(
        heads.join(follows, ["lang", "head"], "left").select(
            "lang", "head", "uses", "far", F.substring_index("far", " ", -1).alias("rest")
        )
    )
    while step.filter("far IS NOT NULL").limit(1).count():
        on = step.select("lang", F.col("head").alias("far"), F.col("far").alias("farther"), F.col("rest").alias("more"))
        step = cut(
            step.join(on, ["lang", "far"], "left").select(
                "lang", "head", "uses", F.col("farther").alias("far"),
                F.concat("rest", F.coalesce(F.concat(F.lit(" "), "more"), F.lit(""))).alias("rest"),
            )
        )
    joined = links.select("lang", F.col("right").alias("head"))
    heads = step.join(joined, ["lang", "head"], "left_anti")
    return heads.select("lang", F.concat_ws(" ", "head", "rest").alias("phrase"), "uses")


def windows(table: DataFrame, m: int, inside: bool = False) -> DataFrame:
    """(lang, phrase, uses): every run of `m` words in a path, without those that begin or end it
    if `inside`."""
    words = F.split("phrase", " ")
    skip = 1 if inside else 0
    first = F.explode(F.sequence(F.lit(1 + skip), F.size(words) - m + 1 - skip))
    some = table.filter(F.size(words) - m - 2 * skip >= 0).select("lang", words.alias("words"), "uses", first.alias("i"))
    return some.select("lang", F.array_join(F.slice("words", F.col("i"), m), " ").alias("phrase"), "uses")


def phrase_counts(docs: DataFrame, least: int, n: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, uses) of all phrases of 1 to `n` words with `least` uses and more, words
    with fewer aside, and (lang, n): words in all."""
    grams = stored(longest_grams(docs, least, n), "grams")
    # Every word begins one longest gram.
    totals = grams.groupBy("lang").agg(F.sum("uses").alias("n"))
    at = flows(grams, n)
    often = {m: table.filter(F.col("uses") >= least) for m, table in at.items()}
    nodes = stored(often[n - 1], "nodes")
    chains = stored(paths(stored(often[n], "edges"), nodes), "paths")
    # Nodes inside a path have its flow; the others have their own.
    within = windows(chains, n - 1, inside=True)
    outer = nodes.join(within, ["lang", "phrase"], "left_anti").select("lang", "phrase", "uses")
    tables = [(n, windows(chains, n)), (n - 1, within.union(outer))]
    tables += [(m, often[m]) for m in range(n - 2, 0, -1)]
    counts = None
    for m, table in tables:
        part = table.select("lang", "phrase", F.lit(m).alias("m"), "uses")
        counts = part if counts is None else counts.union(part)
    return stored(counts, "phrases"), totals


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut of least score: l, r and score."""
    parts = counts.select("lang", "phrase", "uses")
    cuts = counts.filter("m >= 2").select(
        "lang", "phrase", F.col("uses").alias("a"), "m", F.explode(F.expr("sequence(1, m - 1)")).alias("k")
    )
    cuts = cuts.select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - m)").alias("tail"),
    )
    head = parts.select("lang", F.col("phrase").alias("head"), F.col("uses").alias("l"))
    tail = parts.select("lang", F.col("phrase").alias("tail"), F.col("uses").alias("r"))
    both = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
    a, l, r = (F.col(c).cast(COUNT) for c in ("a", "l", "r"))
    ratio = both.select(
        "lang", "phrase", "m", "a", "k", "l", "r", a.alias("a_"), (l + r).alias("all_")
    ).withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * a_) div all_"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return ratio.groupBy("lang", "phrase", "m", "a").agg(best).select(
        "lang", "phrase", "m", "a", "best.l", "best.r", "best.score"
    )


def covered(counts: DataFrame, n: int = LONGEST) -> DataFrame:
    """(lang, phrase, longer): the most uses of any longer phrase that holds the phrase."""
    parts = None
    for m in range(3, n + 1):
        long_ = counts.filter(F.col("m") == m).select("lang", "phrase", "uses")
        for size in range(2, m):
            part = windows(long_, size)
            parts = part if parts is None else parts.union(part)
    return parts.groupBy("lang", "phrase").agg(F.max("uses").alias("longer"))


def collocations(
    docs: DataFrame, least: int = 30, most: int = 2000, share: int = 80, n: int = LONGEST
) -> DataFrame:
    """The phrases of 2 to `n` words that stick together most, the first `most` of each language.

    Columns lang, rank, phrase, a (its uses), l and r (uses of the parts at the weakest cut), n (words of
    the language), score: floor(2000000 * a / (l + r)) at the cut where that is least. A phrase
    counts within pieces, which `[.,;:!?]` and line breaks end. Those with fewer than `least` uses
    are left out, and those inside a longer one that has `share` per cent of their uses.

    A null text is empty, a null language is `und`; texts without words give nothing, repeated
    rows count again, ids are not read. Texts of any length are read in runs; a single word may be
    of any length. Equal scores rank by uses, then by the phrase's bytes. An empty table gives no
    rows. Other columns are not read. Languages are few: their names come to the driver.
    """
    if n < 3:
        raise ValueError("the graph needs grams of three words and more")
    counts, totals = phrase_counts(docs, least, n)
    found = scored(counts).join(covered(counts, n), ["lang", "phrase"], "left")
    inside = F.lit(100).cast(COUNT) * F.coalesce("longer", F.lit(0)).cast(COUNT) >= F.lit(share).cast(COUNT) * F.col("a").cast(COUNT)
    rest = found.filter(~inside)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The best of each part first, so that one language does not meet in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    rest = rest.withColumn("part", part)
    rest = rest.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rest = rest.filter(F.col("place") <= most)
    rest = rest.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    rest = rest.filter(F.col("rank") <= most)
    return rest.join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
