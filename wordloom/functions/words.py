"""Word-level column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.options import Options

# Fixed value: the stopword list.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from",
    "has", "he", "in", "is", "it", "its", "of", "on", "that", "the",
    "to", "was", "will", "with", "i", "you", "we", "they", "this",
    "these", "those", "have", "had", "do", "does", "did", "can",
    "could", "would", "should", "may", "might", "must", "shall",
)


def split_words(text: Column) -> Column:
    """Lower-cased words of any text, without empty ones."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: word != "")


def split_clean_words(text: Column) -> Column:
    """Lower-cased words of cleaned text, whose words are one space apart."""
    return F.split(F.lower(text), " ")


def is_stopword(word: Column) -> Column:
    return word.isin(*STOPWORDS)


def normalise_word(word: Column, unicode: bool = False) -> Column:
    return F.regexp_replace(F.trim(F.lower(word)), ("(?U)" if unicode else "") + r"\W", "")


def has_word_length(word: Column, options: Options) -> Column:
    return F.length(word).between(options.min_word_length, options.max_word_length)


def keeps_word(word: Column, options: Options) -> Column:
    """True for the words of cleaned text that statistics and features are built from."""
    kept = has_word_length(word, options)
    return kept & ~is_stopword(word) if options.remove_stopwords else kept


def kept_words(text: Column, options: Options) -> Column:
    """The words of cleaned text that pass `keeps_word`, in text order."""
    return F.filter(split_clean_words(text), lambda word: keeps_word(word, options))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n neighbouring words joined by a space; empty when there are fewer than n."""
    if n == 1:
        return words
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    grams = F.transform(starts, lambda start: F.array_join(F.slice(words, start, n), " "))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))
