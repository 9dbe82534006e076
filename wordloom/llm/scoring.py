"""Language-model scores: marginal probabilities over a sub-word lattice.

A token's probability sums over all ways to write it: as a word of the training texts, with its
count less a discount, or as any sequence of pieces of an existing vocabulary. What the discount
frees weighs the pieces, so the model is a distribution over all words, seen or not. The pieces'
own weights start from the vocabulary's scores and are fitted to the distinct training words.

Counts of all words are gathered by one aggregation. Scores of a bounded number of the most
frequent words are sent to every task, which settles most tokens in place; the rest are joined to
the word table, so a word in every text never meets in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bytewise import WordHasher, byte_view, lists, lowered, runs, word_limits
from wordloom.llm.lattice import Lattice, Units, read_units
from wordloom.llm.quality import held_out
from wordloom.session import cut

HEAD_WORDS = 1 << 18
COUNT_RUN_BYTES = 4 << 20
FIT_ROUNDS = 2
LEAST_USE = 0.01


def _counted(batches):
    hasher = WordHasher()
    for batch in batches:
        data, offsets = byte_view(batch.column("text"))
        learnt = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        for i, j in runs(offsets, COUNT_RUN_BYTES):
            part = lowered(data[offsets[i] : offsets[j]])
            starts, ends, owner = word_limits(part, offsets[i : j + 1] - offsets[i])
            hashes, example, which = np.unique(
                hasher(part, starts, ends), return_index=True, return_inverse=True
            )
            uses = np.bincount(which, learnt[i:j][owner], minlength=len(hashes))
            raw = part.tobytes()
            words = [
                raw[a:b].decode() for a, b in zip(starts[example].tolist(), ends[example].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    pa.array(words, pa.string()),
                    pa.array(uses.astype(np.int64)),
                ],
                ["hash", "word", "uses"],
            )


def word_table(texts: DataFrame) -> DataFrame:
    """(hash, word, c) of rows (text, held_out): every word, with its uses in training texts."""
    parts = texts.select("text", "held_out").mapInArrow(_counted, "hash long, word string, uses long")
    return cut(parts.groupBy("hash", "word").agg(F.sum("uses").alias("c")))


def fit_units(words: DataFrame, units: Units, rounds: int = FIT_ROUNDS) -> Units:
    """Fit the pieces' weights to distinct words: expected uses, summed by Spark, round by round."""
    for _ in range(rounds):

        def run(batches, lattice=Lattice(units)):
            total = np.zeros(len(lattice.units.weights))
            for batch in batches:
                total += lattice.expected_uses(batch.column("word").to_pylist())
            rows = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total[rows])], ["piece", "uses"])

        # As many rows as the vocabulary has pieces.
        found = words.select("word").mapInArrow(run, "piece long, uses double")
        found = found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses = np.full(len(units.weights), LEAST_USE)
        for row in found:
            uses[row["piece"]] += row["uses"]
        units = units.with_weights(np.log(uses / uses.sum()))
    return units


def _settled(head_hash, head_base, head_score, head_known):
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            for i, j in runs(offsets):
                n = j - i
                part = lowered(data[offsets[i] : offsets[j]])
                starts, ends, owner = word_limits(part, offsets[i : j + 1] - offsets[i])
                hashes = hasher(part, starts, ends).view(np.int64)
                distinct, which = np.unique(hashes, return_inverse=True)
                at = np.minimum(np.searchsorted(head_hash, distinct), len(head_hash) - 1)
                there = (head_hash[at] == distinct)[which]
                at = at[which][there]
                own = owner[there]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, n) for c in ("doc_id", "row", "held_out")],
                        pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(own, head_known[at], minlength=n).astype(np.int64)),
                        pa.array(np.bincount(own, head_base[at], minlength=n)),
                        pa.array(np.bincount(own, head_score[at], minlength=n)),
                        lists(hashes[~there], np.bincount(owner[~there], minlength=n)),
                    ],
                    ["doc_id", "row", "held_out", "words", "known", "base", "score", "rest"],
                )

    return run


def language_scores(
    docs: DataFrame, path: str, folds: int = 7, fold: int = 2, head_words: int = HEAD_WORDS
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Tokens are the words of the text, A-Z lower-cased, then one end. Texts whose crc32(doc_id)
    modulo `folds` is `fold` are held out; the others are learnt from. base_score is the log10
    probability with add-one counts, score that of the lattice over the pieces of `path`.

    A null text counts as empty: one token, the end. A null id is held out. Repeated rows are
    learnt from and scored as often as they stand there. With nothing to learn from, all
    weight lies on the pieces. An empty table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
    )
    ends = texts.filter(~F.col("held_out")).count()
    words = word_table(texts)
    total, kinds, once, twice = (
        words.filter("c > 0")
        .agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2))
        .first()
    )
    total, kinds = (total or 0) + ends, kinds + (ends > 0)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    freed = discount * kinds / total if total else 1.0

    units = fit_units(words.filter("c > 0"), read_units(path))
    lattice = Lattice(units)

    def weigh(batches):
        for batch in batches:
            spelt = lattice.log_probabilities(batch.column("word").to_pylist())
            c = batch.column("c").to_numpy()
            own = np.where(c > 0, (c - discount) / max(total, 1), 0.0)
            with np.errstate(divide="ignore"):
                score = np.logaddexp(np.log(own), spelt + math.log(freed)) / math.log(10)
            base = np.log10((c + 1) / (total + kinds + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), batch.column("c"), pa.array(base), pa.array(score)],
                ["hash", "c", "base", "score"],
            )

    weighed = cut(
        words.select("hash", "word", "c").mapInArrow(weigh, "hash long, c long, base double, score double")
    )
    head = weighed.orderBy(F.desc("c"), "hash").limit(head_words).toArrow().sort_by("hash")
    arrays = [head.column(c).to_numpy() for c in ("hash", "base", "score", "c")]
    if not len(arrays[0]):
        arrays = [np.zeros(1, a.dtype) for a in arrays]
    sent = spark.sparkContext.broadcast((*arrays[:3], (arrays[3] > 0).astype(float)))

    def settle(batches):
        yield from _settled(*sent.value)(batches)

    kind = docs.schema["doc_id"].dataType.simpleString()
    settled = cut(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            settle,
            f"doc_id {kind}, row long, held_out boolean, words long, known long, base double, "
            "score double, rest array<long>",
        )
    )
    rest = settled.select("row", F.explode("rest").alias("hash")).groupBy("row", "hash").count()
    joined = rest.join(weighed, "hash").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("count")).otherwise(0)).alias("more_known"),
        F.sum(F.col("count") * F.col("base")).alias("more_base"),
        F.sum(F.col("count") * F.col("score")).alias("more_score"),
    )
    end_base = math.log10((ends + 1) / (total + kinds + 1))
    # The end has no spelling: it is a piece of its own with the least weight.
    spelt = math.exp(float(units.weights.min()))
    end_score = math.log10(max(ends - discount, 0) / max(total, 1) + freed * spelt)
    zero = F.lit(0)
    return settled.drop("rest").join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", zero) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) + F.lit(end_base)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero) + F.lit(end_score)).alias("score"),
    )
