import random

import numpy as np
import pyarrow as pa

from tests_llm_helpers import words_of
from wordloom.llm.bytewise import WordHasher, byte_view, lowered, mix, runs, word_limits
from wordloom.llm.shingles import shingle_sets


def sample(seed=1, n=300):
    rnd = random.Random(seed)
    letters = "aAbBzZ09 \t\n\r\x0b\x0c.,éÀ日😀\x00\x1c"
    return ["".join(rnd.choice(letters) for _ in range(rnd.choice((0, 1, 5, 80)))) for _ in range(n)]


def test_words_are_those_between_ascii_white_space():
    texts = sample()
    data, offsets = byte_view(pa.array(texts))
    low = lowered(data)
    starts, ends, owner = word_limits(low, offsets)
    got = [[] for _ in texts]
    for a, b, k in zip(starts, ends, owner):
        got[k].append(low[a:b].tobytes().decode())
    assert got == [words_of(t) for t in texts]


def test_equal_words_have_equal_hashes_and_others_do_not():
    texts = sample(2, 2000)
    data, offsets = byte_view(pa.array(texts))
    starts, ends, _ = word_limits(data, offsets)
    hashes = WordHasher()(data, starts, ends)
    raw = data.tobytes()
    by_word = {}
    for a, b, h in zip(starts, ends, hashes):
        assert by_word.setdefault(raw[a:b], h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_hash_of_a_word_longer_than_a_block():
    data = np.frombuffer(b"x" * 3_000_000 + b" y", np.uint8)
    starts, ends = np.array([0, 3_000_001]), np.array([3_000_000, 3_000_002])
    first = WordHasher()(data, starts, ends)
    assert (WordHasher()(data, starts, ends) == first).all() and first[0] != first[1]


def test_runs_cover_all_texts_in_order():
    offsets = np.array([0, 0, 10, 10, 500, 501, 501])
    found = list(runs(offsets, 20, 2))
    assert [i for i, _ in found] == [0, *[j for _, j in found[:-1]]] and found[-1][1] == 6
    assert all(j - i <= 2 for i, j in found)


def test_views_of_slices_and_nulls():
    column = pa.array(["ab", None, "", "cdé"]).slice(1)
    data, offsets = byte_view(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == ["", "", "cdé"]
    assert len(byte_view(pa.array([], pa.string()))[1]) == 1


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mix(x))) == len(x)


def test_shingle_sets_have_the_right_sizes():
    texts = sample(3) + ["a b c d e f", "a a a a a a a a", "a b", "  "]
    sizes = []
    for _, _, values, owner, n in shingle_sets(pa.array(texts), 5):
        assert len(values) == n.sum()
        sizes += n.tolist()
    want = []
    for t in texts:
        w = words_of(t)
        want.append(len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0)
    assert sizes == want
