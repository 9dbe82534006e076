"""Word counts, document frequencies and the bounded vocabulary: the reduce side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.words import keeps_word
from wordloom.operators.pairs import WHOLE_TEXT, marked_words
from wordloom.options import Options
from wordloom.session import cut


def word_counts(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """(word, total_count, doc_freq) over cleaned texts: one scan and one shuffle, on the word.

    Map-side partial sums collapse a frequent word to one row per task before the shuffle.
    """
    return _with_texts(docs, options).filter(F.col("word") != WHOLE_TEXT)


def reduce_counts(pairs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The same from (doc_id, word, count) rows, for pairs that did not come from one row."""
    per_doc = pairs.groupBy(doc, "word").agg(F.sum("count").cast("bigint").alias("tf"))
    return per_doc.groupBy("word").agg(
        F.sum("tf").alias("total_count"), F.count("*").alias("doc_freq")
    )


def total_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("word").agg(F.sum("count").cast("bigint").alias("total_count"))


def doc_freqs(pairs: DataFrame, doc: str = "doc_id") -> DataFrame:
    distinct = pairs.select(doc, "word").distinct()
    return distinct.groupBy("word").agg(F.count("*").alias("doc_freq"))


def doc_total(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("total_docs"))


def with_count_bounds(counts: DataFrame, total_docs: Column, options: Options) -> DataFrame:
    """Keep words in at least max(min_df, 1%) and at most the given share of the texts."""
    least = F.greatest(
        F.lit(options.min_document_frequency).cast("bigint"), F.floor(total_docs * F.lit(0.01))
    )
    most = F.floor(total_docs * F.lit(float(options.max_document_frequency)))
    return counts.filter(F.col("doc_freq").between(least, most))


def stored_counts(docs: DataFrame, options: Options = Options()) -> tuple[DataFrame, Column]:
    """`word_counts`, computed and stored, and the number of texts as a scalar column.

    The bounds need the number of texts before any word can be dropped. Counting texts along
    with the words and storing the word table reads the corpus once; asking for the number in
    a job of its own would read and clean it a second time.
    """
    table = cut(_with_texts(docs, options))
    total = table.filter(F.col("word") == WHOLE_TEXT).select("doc_freq")
    # An empty corpus has no such row.
    return table.filter(F.col("word") != WHOLE_TEXT), F.coalesce(total.scalar(), F.lit(0))


def bounded_counts(docs: DataFrame, options: Options = Options()) -> tuple[DataFrame, Column]:
    counts, total = stored_counts(docs, options)
    return with_count_bounds(counts, total, options), total


def vocabulary(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """The `max_vocab_size` most frequent words within the bounds; ties go by word."""
    return top_words(bounded_counts(docs, options)[0], options)


def top_words(counts: DataFrame, options: Options = Options()) -> DataFrame:
    ordered = counts.orderBy(F.desc("total_count"), F.asc("word"))
    return ordered.limit(options.max_vocab_size)


def vocabulary_list(vocab: DataFrame) -> list[str]:
    """The words of a bounded vocabulary in its own order (at most `max_vocab_size`)."""
    ordered = vocab.orderBy(F.desc("total_count"), F.asc("word"))
    return [row.word for row in ordered.select("word").collect()]


def word_statistics(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.sum("total_count").alias("total_words"),
        F.avg("total_count").alias("avg_word_freq"),
        F.max("total_count").alias("max_word_freq"),
        F.min("total_count").alias("min_word_freq"),
        F.count("*").alias("vocabulary_size"),
    )


def label_summary(docs: DataFrame) -> DataFrame:
    """Rows per label and, with `is_total` 1, rows in all, from one job."""
    return (
        docs.rollup("label")
        .agg(F.grouping("label").cast("int").alias("is_total"), F.count("*").alias("n"))
        .select("is_total", "label", "n")
    )


def length_statistics(docs: DataFrame, *by: str) -> DataFrame:
    """Words per lightly cleaned text, whose words are one space apart: average, most, least."""
    length = F.size(F.split("text", " "))
    return docs.groupBy(*by).agg(
        F.count("*").alias("total_samples"),
        F.avg(length).alias("avg_text_length"),
        F.max(length).alias("max_text_length"),
        F.min(length).alias("min_text_length"),
    )


def _with_texts(docs: DataFrame, options: Options) -> DataFrame:
    kept = keeps_word(F.col("word"), options) | (F.col("word") == WHOLE_TEXT)
    return marked_words(docs).filter(kept).groupBy("word").agg(
        F.count("*").alias("total_count"), F.sum("first").alias("doc_freq")
    )
