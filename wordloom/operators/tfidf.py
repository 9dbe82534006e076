"""Bag-of-words and TF-IDF as tables: the relational form of the feature vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.operators.pairs import kept_term_counts
from wordloom.operators.wordstats import bounded_counts, top_words
from wordloom.options import Options


def feature_vocabulary(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """(index, word, doc_freq, idf) of the words that get a feature: at most `max_features`.

    Every word is at most `max_word_length` long, which bounds the bytes of this table too.
    """
    order = [F.desc("total_count"), F.asc("word")]
    bounded, total = bounded_counts(docs, options)
    top = top_words(bounded, options).orderBy(*order).limit(options.max_features)
    # limit() has left one small partition; numbering it adds no data movement.
    index = (F.row_number().over(Window.orderBy(*order)) - 1).alias("index")
    idf = F.log((total + 1) / (F.col("doc_freq") + 1))
    return top.select(index, "word", "doc_freq", idf.alias("idf"))


def bag_of_words(docs: DataFrame, vocab: DataFrame, options: Options = Options(), *keys: str):
    """(keys, word, tf) for the vocabulary's words."""
    terms = kept_term_counts(docs, options, *(keys or ("doc_id",)))
    return terms.join(F.broadcast(vocab.select("word")), "word").select(*terms.columns)


def tfidf(docs: DataFrame, vocab: DataFrame, options: Options = Options(), *keys: str):
    """(keys, word, tf, idf, tfidf): one scan, no shuffle, the bounded vocabulary broadcast."""
    terms = kept_term_counts(docs, options, *(keys or ("doc_id",)))
    joined = terms.join(F.broadcast(vocab.select("word", "idf")), "word")
    return joined.select(*terms.columns, "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))
