"""Distinct word shingles of texts, as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wordloom.llm.bytewise import (
    U64,
    WordHasher,
    byte_view,
    lowered,
    mix,
    runs,
    seeded,
    sorted_sets,
    word_limits,
)


def shingles(words: np.ndarray, owner: np.ndarray, n_owners: int, width: int):
    """Hash of each run of `width` words of one owner; fewer words make one shingle."""
    counts = np.bincount(owner, minlength=n_owners)
    first = np.cumsum(counts) - counts
    odd = seeded(width, 11)
    place = np.arange(len(words)) - first[owner]
    left = counts[owner] - place
    begins = np.flatnonzero((left >= width) | ((place == 0) & (left > 0)))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(begins), U64)
        for k in range(width):
            there = begins + k
            ok = k < left[begins]
            sums[ok] += words[there[ok]] * odd[k]
        sums += np.minimum(left[begins], width).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
        return mix(sums), owner[begins]


def shingle_sets(column: pa.Array, width: int):
    """For each run of texts: its range, the sorted distinct shingles, their owners and sizes."""
    data, offsets = byte_view(column)
    hasher = WordHasher()
    for i, j in runs(offsets):
        part = lowered(data[offsets[i] : offsets[j]])
        starts, ends, owner = word_limits(part, offsets[i : j + 1] - offsets[i])
        values, owner = shingles(hasher(part, starts, ends), owner, j - i, width)
        yield i, j, *sorted_sets(owner, values, j - i)
