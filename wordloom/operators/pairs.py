"""From texts to words: the map side of the word statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import words as W
from wordloom.operators.batch_grams import Runs, kept_by, slices
from wordloom.options import Options


def tokens(docs: DataFrame, *keys: str) -> DataFrame:
    """One row per word of `text` with its position, empty words left out."""
    return _exploded(docs, keys, F.split(F.lower("text"), r"\s+")).filter(F.col("word") != "")


def without_stopwords(words: DataFrame) -> DataFrame:
    return words.filter(~W.is_stopword(F.col("word")))


def normalised(words: DataFrame, unicode: bool = False) -> DataFrame:
    return words.withColumn("word", W.normalise_word(F.col("word"), unicode))


def of_word_length(words: DataFrame, options: Options = Options()) -> DataFrame:
    return words.filter(W.has_word_length(F.col("word"), options))


def map_phase(
    docs: DataFrame, options: Options = Options(), *keys: str, cleaned: bool = False
) -> DataFrame:
    """(keys, word, 1) for every word that survives stopwords, normalising and the length test.

    Takes any text; words of `cleaned` text hold nothing to normalise and skip that regex. A
    narrow job: one scan, no shuffle, all in generated code.
    """
    keys = keys or ("doc_id", "label")
    words = tokens(docs, *keys)
    if options.remove_stopwords:
        words = without_stopwords(words)
    if not cleaned:
        words = normalised(words, options.unicode)
    return of_word_length(words, options).select(*keys, "word", F.lit(1).alias("count"))


def term_counts(docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, word, tf) for every distinct word of each cleaned text, without a shuffle.

    A text is one row, so its words can be counted inside the row: sort them, find where each
    run of equal words starts, and measure the distance to the next start. Grouping exploded
    words by (doc_id, word) would instead shuffle about as many bytes as the corpus has.
    """
    keys = keys or ("doc_id",)
    words = docs.select(*keys, F.sort_array(W.split_clean_words(F.col("text"))).alias("_words"))
    starts = words.select(
        "*",
        F.expr(
            "filter(sequence(0, size(_words) - 1), i -> i = 0 OR _words[i] != _words[i - 1])"
        ).alias("_starts"),
    )
    runs = F.expr(
        "transform(_starts, (start, i) -> struct(_words[start] AS word, "
        "bigint(coalesce(get(_starts, i + 1), size(_words)) - start) AS tf))"
    )
    # The outer form: the inner one adds a size() test that repeats the whole text chain.
    return starts.select(*keys, F.inline_outer(runs))


# Cleaned text has no empty words, so the empty word can stand for the text itself.
WHOLE_TEXT = ""


def marked_words(docs: DataFrame) -> DataFrame:
    """(word, first): every word of each cleaned text, `first` 1 once per text and word.

    Summing `first` per word gives document frequencies in the pass that counts the words; the
    word WHOLE_TEXT, added once to each text, counts the texts. Sorted words put equal ones
    side by side, so this is a comparison with the neighbour, in generated code.
    """
    words = F.array_append(W.split_clean_words(F.col("text")), WHOLE_TEXT)
    sorted_words = docs.select(F.sort_array(words).alias("_words"))
    placed = sorted_words.select("_words", F.posexplode_outer("_words").alias("pos", "word"))
    new = (F.col("pos") == 0) | (F.get("_words", F.col("pos") - 1) != F.col("word"))
    return placed.select("word", new.cast("bigint").alias("first"))


def kept_term_counts(docs: DataFrame, options: Options = Options(), *keys: str) -> DataFrame:
    return term_counts(docs, *keys).filter(W.keeps_word(F.col("word"), options))


def ngram_pairs(docs: DataFrame, options: Options = Options(), *keys: str) -> DataFrame:
    """(keys, n, gram) for every n-gram of the kept words, for each n of the configured range.

    A word looks up the words that follow it in its text's array; grams that would run past
    the end come out null and are dropped.
    """
    keys = keys or ("doc_id",)
    listed = docs.select(*keys, W.kept_words(F.col("text"), options).alias("_words"))
    placed = listed.select(*keys, "_words", F.posexplode_outer("_words").alias("pos", "word"))
    low, high = options.ngram_range
    grams = [
        F.struct(F.lit(n).alias("n"), _gram_from_here(n).alias("gram"))
        for n in range(low, high + 1)
    ]
    return placed.select(*keys, F.inline_outer(F.array(*grams))).filter(
        F.col("gram").isNotNull()
    )


def ngram_counts(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """(n, gram, total_count) for each n of the configured range: counted by batch, then summed.

    Most grams are rare, so the batches' counts go to the shuffle as they are: a table of all the
    grams of a task would grow out of its memory and be sorted instead.
    """
    low, high = options.ngram_range
    kept = kept_by(options)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for n, grams, times in Runs(part["text"], *kept).counts(low, high):
                    some = np.flatnonzero(times)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), n, np.int32)), grams.take(some), pa.array(times[some])],
                        ["n", "gram", "total_count"],
                    )

    words = docs.select(F.lower("text").alias("text"))
    counts = words.mapInArrow(counted, "n int not null, gram string, total_count long")
    dealt = counts.repartition("n", "gram")
    return dealt.groupBy("n", "gram").agg(F.sum("total_count").alias("total_count"))


def _gram_from_here(n: int):
    parts = [F.col("word")]
    for ahead in range(1, n):
        parts += [F.lit(" "), F.get("_words", F.col("pos") + ahead)]
    return F.concat(*parts)


def _exploded(docs: DataFrame, keys, words) -> DataFrame:
    listed = docs.select(*keys, words.alias("_words"))
    return listed.select(*keys, F.posexplode_outer("_words").alias("pos", "word"))
