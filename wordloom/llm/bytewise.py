"""Words of many texts at once, as byte ranges and 64-bit hashes in NumPy arrays.

Texts come as Arrow string columns and are read in runs of bounded size, so that memory does not
follow the size of an Arrow batch. A word is what stands between ASCII white space
(`[^\\x20\\x09-\\x0D]+`). Word hashes are polynomials over the bytes, mixed at the end: two different
words share one with odds of about 1 in 2^60.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
RUN_TEXTS = 4096
HASH_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all bits; a bijection."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers for a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=U64) + U64(1 + (seed << 32))) * U64(0x9E3779B97F4A7C15)) | U64(1)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each text; a null text has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        places = np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), places


def runs(offsets: np.ndarray, most_bytes: int = RUN_BYTES, most_texts: int = RUN_TEXTS):
    """Consecutive texts (i, j) of bounded total size; a text beyond the bound stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most_bytes, "right")) - 1
        j = min(max(j, i + 1), i + most_texts, n)
        yield i, j
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_limits(data: np.ndarray, offsets: np.ndarray):
    """First byte, byte after the last, and text number of each word.

    `offsets` count from 0 = the first byte of `data`.
    """
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    inside = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty_like(inside)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1] & ~cut[1:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    if len(data):
        after[-1] = False
        after[:-1] = inside[1:] & ~cut[1:-1]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class WordHasher:
    """Hashes byte ranges; keeps the powers of the polynomial's base for as long as it lives."""

    BASE = 0x9E6C63D0676A9A99  # odd, so that it has an inverse

    def __init__(self):
        self.bytes = seeded(256, 7)
        self.up = self.down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, HASH_BYTES + 1)
            steps = np.full(size, U64(self.BASE))
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=U64)
            steps[1:] = U64(pow(self.BASE, -1, 1 << 64))
            self.down = np.cumprod(steps, dtype=U64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), U64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(starts):
                base = starts[i]
                j = max(int(np.searchsorted(ends, base + HASH_BYTES, "right")), i + 1)
                part = data[base : ends[j - 1]]
                self._powers(len(part))
                sums = np.zeros(len(part) + 1, U64)
                np.cumsum(self.bytes[part] * self.up[: len(part)], out=sums[1:])
                a, b = starts[i:j] - base, ends[i:j] - base
                raw = (sums[b] - sums[a]) * self.down[a]
                out[i:j] = mix(raw + (b - a).astype(U64) * U64(0xD6E8FEB86659FD93))
                i = j
        return out


def sorted_sets(owner: np.ndarray, values: np.ndarray, n_owners: int):
    """Distinct values of each owner in rising order: values, owners, sizes.

    `owner` must not fall.
    """
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, owner, np.bincount(owner, minlength=n_owners)


def sums_by(owner: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each owner's values modulo 2^64; `owner` must not fall."""
    out = np.zeros(len(sizes), U64)
    some = sizes > 0
    if len(values):
        first = np.cumsum(sizes) - sizes
        out[some] = np.add.reduceat(values, first[some])
    return out


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow list column whose rows hold the next `sizes[i]` values each."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def lean(run):
    """`run` over Arrow batches, giving memory back to the system when a partition ends.

    Workers live on from stage to stage. What their allocators keep for a next batch would count
    against the executor all along.
    """

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # Only the GNU library has it.

    return tidy
