"""Runs of kept words, counted a batch of texts at a time with Arrow and NumPy.

What a row of Spark's array functions does to one gram, comparing and joining strings, is done here
to numbers: a batch's words are numbered, a run of n words is the number of its first n - 1 words
beside that of its last one, and only different runs are spelled out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from wordloom.functions.words import STOPWORDS
from wordloom.options import Options

# Workers need not have this library: what runs there is sent to them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 16 << 20  # text taken at once, so that a batch of long texts needs no more memory


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about SLICE_BYTES, one text at least."""
    rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, SLICE_BYTES))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def kept_by(options: Options) -> tuple[int, int, tuple[str, ...]]:
    """The shortest and the longest word that is kept, and the words left out."""
    stopwords = STOPWORDS if options.remove_stopwords else ()
    return options.min_word_length, options.max_word_length, stopwords


class Runs:
    """The kept words of cleaned, lower-cased texts: for each its text and its number.

    `places(n)` numbers the runs of n words: an entry per word, -1 where its text ends before the
    run does, and the runs that the numbers stand for.
    """

    def __init__(self, texts: pa.Array, shortest: int, longest: int, stopwords: tuple[str, ...]):
        lists = pc.split_pattern(texts, " ")
        coded = pc.list_flatten(lists).dictionary_encode()
        self.words = coded.dictionary
        length = pc.utf8_length(self.words)
        kept = pc.and_(pc.greater_equal(length, shortest), pc.less_equal(length, longest))
        kept = pc.and_not(kept, pc.is_in(self.words, pa.array(stopwords, self.words.type)))
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        chosen = np.asarray(kept, bool)[numbers]
        self.numbers = numbers[chosen]
        self.text = np.asarray(pc.list_parent_indices(lists)).astype(np.int64)[chosen]

    def starts(self, n: int) -> np.ndarray:
        """Places from which n words follow in the same text."""
        if n > len(self.text):
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[n - 1 :] == self.text[: len(self.text) - n + 1])

    def places(self, n: int) -> tuple[np.ndarray, pa.Array]:
        if n == 1:
            return self.numbers, self.words
        shorter, spelled = self.places(n - 1)
        starts = self.starts(n)
        found, spelled, inverse = self._joined(shorter, spelled, starts, n)
        placed = np.full(len(self.text), -1, np.int64)
        placed[starts] = inverse
        return placed, spelled

    def _joined(self, shorter, spelled, starts, n):
        pairs = shorter[starts] * len(self.words) + self.numbers[starts + n - 1]
        found, inverse = np.unique(pairs, return_inverse=True)
        return found, self._spelled(found, spelled), inverse

    def _spelled(self, found, spelled):
        heads, tails = np.divmod(found, max(1, len(self.words)))
        return pc.binary_join_element_wise(spelled.take(heads), self.words.take(tails), " ")

    def counts(self, low: int, high: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(n, runs, occurrences) for each n; the longest runs are not numbered by place."""
        shorter, spelled = self.places(max(1, high - 1))
        for n in range(low, high):
            numbers, runs = self.places(n) if n < high - 1 else (shorter, spelled)
            yield n, runs, np.bincount(numbers[numbers >= 0], minlength=len(runs))
        if high == 1:
            yield 1, spelled, np.bincount(shorter, minlength=len(spelled))
        else:
            starts = self.starts(high)
            pairs = shorter[starts] * len(self.words) + self.numbers[starts + high - 1]
            found, times = np.unique(pairs, return_counts=True)
            yield high, self._spelled(found, spelled), times

    def frequent(self, n: int, known: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(runs, occurrences, texts) of n words, both parts of n - 1 words being known ones."""
        shorter, spelled = self.places(n - 1)
        is_known = np.asarray(pc.is_in(spelled, known), bool)
        starts = self.starts(n)
        starts = starts[is_known[shorter[starts]] & is_known[shorter[starts + 1]]]
        found, runs, inverse = self._joined(shorter, spelled, starts, n)
        once = np.unique(self.text[starts] * max(1, len(found)) + inverse)
        texts = np.bincount(once % max(1, len(found)), minlength=len(found))
        return runs, np.bincount(inverse, minlength=len(found)), texts

    def terms(self, high: int, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place in the vocabulary, occurrences) of runs of up to `high` words."""
        found = []
        for n in range(1, high + 1):
            numbers, runs = self.places(n)
            place = pc.fill_null(pc.index_in(runs, vocabulary), -1).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(numbers >= 0)
            there = place[numbers[at]].astype(np.int64)
            at, there = at[there >= 0], there[there >= 0]
            found.append(self.text[at] * len(vocabulary) + there)
        both, times = np.unique(np.concatenate(found), return_counts=True)
        text, place = np.divmod(both, max(1, len(vocabulary)))
        return text, place, times
