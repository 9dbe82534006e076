"""Sub-word lattices: the probability of a word over all its segmentations into known pieces.

Words of one length form a matrix of characters; a rolling hash finds the piece at each place and
length, and the log-space recursions run over all words of the matrix at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from wordloom.llm.bytewise import U64, mix

SPACE = 0x2581
STEP = U64(0xD1342543DE82EF95)
CELLS = 1 << 18  # characters handled at once


def _log_sum(parts: list[np.ndarray]) -> np.ndarray:
    stack = np.stack(parts)
    top = stack.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(stack - safe).sum(axis=0))


def _keys(hashes: np.ndarray, length: int) -> np.ndarray:
    return mix(hashes + U64(length) * U64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Units:
    """Pieces by the hash of their characters, a row for each byte after them, and log weights."""

    keys: np.ndarray  # sorted
    longest: int
    weights: np.ndarray  # natural logarithms, pieces in the order of keys, then bytes 0 to 255

    def with_weights(self, weights: np.ndarray) -> "Units":
        return Units(self.keys, self.longest, weights)


def read_units(path: str) -> Units:
    """Pieces and scores of a model file. Unigram scores are log-probabilities; the scores of a BPE
    model are ranks, taken as a law of 1 / (rank + 50). Bytes get the least weight of all."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    unigram = model.trainer_spec.model_type == 1
    found = {}
    with np.errstate(over="ignore"):
        for p in model.pieces:
            if p.type != 1:
                continue
            h = U64(0)
            for c in p.piece:
                h = h * STEP + mix(U64(ord(c) + 1))
            weight = p.score if unigram else -np.log(min(-p.score, 1e6) + 50)
            found[int(_keys(h, len(p.piece)))] = weight
    longest = max(len(p.piece) for p in model.pieces if p.type == 1)
    keys = np.array(sorted(found), U64)
    weights = np.array([found[int(k)] for k in keys])
    weights = np.concatenate([weights, np.full(256, weights.min())])
    return Units(keys, longest, weights - _log_sum([weights[k : k + 1] for k in range(len(weights))])[0])


def _matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words, each after a space, as matrices of code points; and their numbers."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(sizes, kind="stable")
    points = np.frombuffer(
        "".join(chr(SPACE) + words[k] for k in order).encode("utf-32-le", "surrogatepass"), np.uint32
    )
    sizes = sizes[order]
    ends = np.cumsum(sizes)
    i = 0
    while i < len(order):
        length = sizes[i]
        j = min(np.searchsorted(sizes, length, "right"), i + max(1, CELLS // length))
        block = points[ends[i] - length : ends[j - 1]].reshape(j - i, length)
        yield order[i:j], block.astype(np.int64)
        i = j


class Lattice:
    def __init__(self, units: Units):
        self.units = units

    def _arcs(self, block: np.ndarray):
        """For each piece length k: the row of the piece at each place (-1: none) and its weight.

        A character that is no piece is spelt in bytes.
        """
        units, out = self.units, []
        marks = mix(block.astype(U64) + U64(1))
        hashes = np.zeros_like(marks)
        with np.errstate(over="ignore"):
            for k in range(1, min(units.longest, block.shape[1]) + 1):
                hashes = hashes[:, : block.shape[1] - k + 1] * STEP + marks[:, k - 1 :]
                keys = _keys(hashes, k)
                at = np.minimum(np.searchsorted(units.keys, keys), len(units.keys) - 1)
                row = np.where(units.keys[at] == keys, at, -1)
                weight = np.where(row >= 0, units.weights[row], -np.inf)
                if k == 1:
                    for c in np.unique(block[row < 0]).tolist():
                        spelt = chr(c).encode("utf-8", "surrogatepass")
                        cost = sum(units.weights[len(units.keys) + b] for b in spelt)
                        weight[(block == c) & (row < 0)] = cost
                out.append((row, weight))
        return out

    @staticmethod
    def _forward(arcs, length: int) -> list[np.ndarray]:
        reached = [np.zeros(len(arcs[0][0]))]
        for t in range(1, length + 1):
            ways = range(1, min(t, len(arcs)) + 1)
            reached.append(_log_sum([reached[t - k] + arcs[k - 1][1][:, t - k] for k in ways]))
        return reached

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's probability, summed over its segmentations."""
        out = np.zeros(len(words))
        for numbers, block in _matrices(words):
            out[numbers] = self._forward(self._arcs(block), block.shape[1])[-1]
        return out

    def expected_uses(self, words: list[str]) -> np.ndarray:
        """How often each piece is used in the words, by the weights of their segmentations."""
        uses = np.zeros(len(self.units.weights))
        for _, block in _matrices(words):
            arcs, n = self._arcs(block), block.shape[1]
            reached = self._forward(arcs, n)
            left = [np.zeros(len(block))]  # from place n backwards
            for t in range(n - 1, -1, -1):
                ways = range(1, min(n - t, len(arcs)) + 1)
                left.append(_log_sum([left[n - t - k] + arcs[k - 1][1][:, t] for k in ways]))
            left.reverse()
            for k, (row, weight) in enumerate(arcs, 1):
                for t in range(n - k + 1):
                    share = np.exp(reached[t] + weight[:, t] + left[t + k] - reached[n])
                    known = row[:, t] >= 0
                    uses += np.bincount(row[known, t], share[known], minlength=len(uses))
        return uses
