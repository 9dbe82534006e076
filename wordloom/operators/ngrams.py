"""N-grams as features: a vocabulary of words and frequent n-grams, and weights for both.

An n-gram can be frequent only if both n-grams of one word less in it are, its first and its last
words. So vocabularies are built level by level, and a gram takes part in a level's count only
if its two parts have passed the level before: what is shuffled is not every pair of neighbours
but those of frequent ones. The upper limit on texts is no such bound; it is applied at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.functions import words as W
from wordloom.operators.batch_grams import Runs, kept_by, slices
from wordloom.operators.wordstats import stored_counts, top_words, with_count_bounds
from wordloom.options import Options
from wordloom.session import cut

MOST_BROADCAST_BYTES = 32 << 20


def is_small(df: DataFrame, row_bytes: Column) -> bool:
    """Whether the rows of a stored table are small enough together to be sent to each worker."""
    return (df.agg(F.sum(row_bytes)).first()[0] or 0) <= MOST_BROADCAST_BYTES


def kept_grams(text: Column, low: int, high: int, options: Options) -> Column:
    """Runs of `low` to `high` kept words of cleaned text.

    The words are bound to a variable of one step of `transform`: named twice, or inside another
    function's variable, they would be split and filtered once more for each gram.
    """

    def grams(kept):
        return F.concat(*[W.ngrams(kept, n) for n in range(low, high + 1)])

    return F.get(F.transform(F.array(W.kept_words(text, options)), grams), F.lit(0))


def marked_grams(docs: DataFrame, n: int, options: Options) -> DataFrame:
    """(gram, first): every run of n kept words of each cleaned text, `first` 1 once per text and
    gram; sorted inside the row, so counting texts takes no shuffle by text."""
    listed = docs.select(F.sort_array(kept_grams(F.col("text"), n, n, options)).alias("_grams"))
    placed = listed.select("_grams", F.posexplode("_grams").alias("pos", "gram"))
    new = (F.col("pos") == 0) | (F.get("_grams", F.col("pos") - 1) != F.col("gram"))
    return placed.select("gram", new.cast("bigint").alias("first"))


def frequent_grams(docs: DataFrame, n: int, shorter: DataFrame, least: Column, options: Options) -> DataFrame:
    """(word, total_count, doc_freq) of n-grams in at least `least` texts; `shorter` has those of
    n - 1 words."""
    parts = cut(shorter.select("word"))
    if is_small(parts, F.octet_length("word") + 16):
        marked = batch_counts(docs, n, [row.word for row in parts.collect()], options)
    else:
        marked = joined_grams(docs, n, parts, options)
    counts = marked.groupBy("word").agg(
        F.sum("total_count").alias("total_count"), F.sum("doc_freq").alias("doc_freq")
    )
    return counts.filter(F.col("doc_freq") >= least)


def joined_grams(docs: DataFrame, n: int, parts: DataFrame, options: Options) -> DataFrame:
    """(word, total_count, doc_freq) of every n-gram whose two parts are in a table of any size,
    a row for each occurrence."""
    marked = marked_grams(docs, n, options).withColumns(
        {
            "_head": F.substring_index("gram", " ", n - 1),
            "_tail": F.substring_index("gram", " ", -(n - 1)),
        }
    )
    for part in ("_head", "_tail"):
        marked = marked.join(parts.withColumnRenamed("word", part), part, "left_semi")
    once = F.lit(1).cast("bigint").alias("total_count")
    return marked.select(F.col("gram").alias("word"), once, F.col("first").alias("doc_freq"))


def batch_counts(docs: DataFrame, n: int, parts: list[str], options: Options) -> DataFrame:
    """The same for a bounded list of parts, a row for each gram of a batch."""
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    kept = kept_by(options)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.string())
        for batch in batches:
            for part in slices(batch):
                grams, times, texts = Runs(part["text"], *kept).frequent(n, known)
                yield pa.RecordBatch.from_arrays(
                    [grams, pa.array(times), pa.array(texts)], ["word", "total_count", "doc_freq"]
                )

    words = docs.select(F.lower("text").alias("text"))
    return words.mapInArrow(counted, "word string, total_count long, doc_freq long")


def ngram_vocabulary(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """(index, word, n, doc_freq, idf) of the words and n-grams, up to `feature_ngrams` words
    long, that get a feature: at most `max_features`, the most frequent first.

    Bounds on texts hold for words and n-grams alike; n-grams are runs of kept words. Every word
    has a bounded length, so the table's bytes are bounded too.
    """
    counts, total = stored_counts(docs, options)
    least = F.greatest(
        F.lit(options.min_document_frequency).cast("bigint"), F.floor(total * F.lit(0.01))
    )
    level = counts.filter(F.col("doc_freq") >= least)
    every = level.withColumn("n", F.lit(1))
    for n in range(2, options.feature_ngrams + 1):
        level = cut(frequent_grams(docs, n, level, least, options))
        every = every.unionByName(level.withColumn("n", F.lit(n)))
    order = [F.desc("total_count"), F.asc("word")]
    top = top_words(with_count_bounds(every, total, options), options)
    top = top.orderBy(*order).limit(options.max_features)
    # limit() has left one small partition; numbering it adds no data movement.
    index = (F.row_number().over(Window.orderBy(*order)) - 1).alias("index")
    idf = F.log((total + 1) / (F.col("doc_freq") + 1))
    return top.select(index, "word", "n", "doc_freq", idf.alias("idf"))


def ngram_tfidf(docs: DataFrame, vocab: DataFrame, options: Options = Options(), *keys: str) -> DataFrame:
    """(keys, word, tf, idf, tfidf) for the vocabulary's words and n-grams: one scan, no shuffle.

    The vocabulary, bounded as `ngram_vocabulary` makes it, is sent to the workers.
    """
    keys = keys or ("doc_id",)
    rows = vocab.select("word", "idf").collect()
    entries = [row.word for row in rows], [row.idf for row in rows]
    sent = docs.sparkSession.sparkContext.broadcast(entries)
    kept, longest = kept_by(options), options.feature_ngrams

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = pa.array(sent.value[0], pa.string()), pa.array(sent.value[1], pa.float64())
        for batch in batches:
            for part in slices(batch):
                text, place, times = Runs(part["_text"], *kept).terms(longest, known)
                columns = [part[key].take(pa.array(text)) for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [*columns, known.take(place), pa.array(times), idf.take(place)],
                    [*keys, "word", "tf", "idf"],
                )

    lowered = docs.select(*keys, F.lower("text").alias("_text"))
    schema = lowered.select(*keys).schema.add("word", "string").add("tf", "long").add("idf", "double")
    terms = lowered.mapInArrow(weighted, schema)
    return terms.select("*", (F.col("tf") * F.col("idf")).alias("tfidf"))
