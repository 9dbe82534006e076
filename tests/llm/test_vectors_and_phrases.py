import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import frame

from wordloom.llm import top_inner_products as T
from wordloom.llm.collocations import collocations, flows, longest_grams, paths
from wordloom.llm.top_inner_products import top_inner_products
from wordloom.llm.whitening import whitened

VECTORS = "vec_id long, embedding array<float>"


def vectors(seed, n, d, common=0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, d)).astype(np.float32)
    x[rnd.permutation(n)[:common]] = x[0]
    return [(i, x[i].tolist()) for i in range(n)]


# --- top-k --------------------------------------------------------------------------------


def best_of(rows, queries, k, scale=1024):
    x = {i: [math.floor(scale * c) for c in v] for i, v in rows}
    out = []
    for q in queries:
        scores = [(-sum(a * b for a, b in zip(x[q], y)), i) for i, y in x.items() if i != q]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("common", [0, 120])
def test_top_products_against_brute_force(spark, monkeypatch, parts, common):
    # Small blocks and tiles, so that scores come from several blocks of several groups.
    monkeypatch.setattr(T, "GROUP_BLOCKS", 1)
    rows = vectors(3, 300, 12, common)
    df = frame(spark, rows, VECTORS).repartition(parts)
    got = top_inner_products(df, F.col("vec_id") % 20 == 0, k=7)
    assert sorted(map(tuple, got.collect())) == best_of(rows, range(0, 300, 20), 7)


def packed(x, ids=None):
    order = np.argsort(x, axis=0, kind="stable").T
    values = np.ascontiguousarray(np.take_along_axis(x.T, order, 1))
    ids = np.arange(len(x)) if ids is None else ids
    return {
        "n": len(x), "d": x.shape[1], "most": float(np.abs(x).max()), "ids": ids.tobytes(),
        "values": values.tobytes(), "rows": order.astype(np.uint16).tobytes(),
    }


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1500])
def test_bounds_leave_out_no_row_and_stop_early(n):
    rnd = np.random.default_rng(n)
    x = (rnd.normal(size=(n, 5)) ** 3 * 100).astype(np.int64)
    queries = (rnd.normal(size=(9, 5)) * 100).astype(np.int64)
    lists = T.Lists(packed(x))
    top = T.Best(9, 4)
    at, row, score = T.block_best(lists, np.arange(-9, 0), queries, top.floor(), 4)
    top.add(at, lists.ids[row], score)
    exact = queries @ x.T
    for q in range(9):
        want = np.lexsort((np.arange(n), -exact[q]))[:4]
        assert top.vec[top.query == q].tolist() == want.tolist()
        assert top.score[top.query == q].tolist() == exact[q][want].tolist()
    if n == 1500:
        assert len(at) < 9 * 4 * T.FEW + 1


def test_a_block_that_cannot_qualify_is_left_at_the_first_depth():
    x = np.ones((1000, 3), np.int64)
    lists = T.Lists(packed(x))
    at, _, _ = T.block_best(lists, np.array([-1]), np.ones((1, 3), np.int64), np.array([50.0]), 2)
    assert not len(at) and lists.depth == math.ceil(1000 / 16)


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>, rank string, score string, id string, x string"
    nan, inf = float("nan"), float("inf")
    odd = [None, [None, 1.0], [nan, 1.0], [inf, 1.0], [1.0, -inf]]
    rows = [(0, [1.0, 1.0]), (1, [2.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [9.0, 9.0]), (4, [])]
    rows += [(10 + i, v) for i, v in enumerate(odd)]
    df = frame(spark, [(*r, "r", "s", "i", "x") for r in rows], schema)
    got = sorted(map(tuple, top_inner_products(df, F.col("vec_id") == 0, k=3, scale=1).collect()))
    assert got == [(0, 1, 1, 2), (0, 2, 2, 2), (0, 3, 2, 2)]
    assert top_inner_products(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert top_inner_products(df, F.lit(None).cast("boolean")).collect() == []
    # An id that two rows have: a list for each, none of them holding that id.
    twice = top_inner_products(df, F.col("vec_id") == 2, k=9, scale=1).collect()
    assert Counter(r.vec_id for r in twice) == {0: 2, 1: 2, 4: 2}


def test_products_beyond_floating_point_stay_exact(spark):
    big = 2.0**27
    rows = [(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, 2.0]), (3, [big, 0.0])]
    df = frame(spark, rows, VECTORS)
    got = top_inner_products(df, F.col("vec_id") == 0, k=3, scale=1).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2**54 + 2), (1, 2**54 + 1), (3, 2**54)]


# --- whitening ----------------------------------------------------------------------------


def checked_whitening(df, rows, k=4):
    got = whitened(df).collect()
    x = {}
    d = max(len(v) for _, v in rows)
    every = [(i, tuple(math.floor(256 * c) for c in v) + (0,) * (d - len(v))) for i, v in rows]
    fit = np.array(sorted({v for _, v in every}))
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    assert len(got) == k * len(rows)
    for r in got:
        x.setdefault(r.vec_id, []).append(r)
    signs = {}
    for i, v in every:
        for r in x[i]:
            e, axis = values[r.component - 1], vecs[:, r.component - 1]
            want = float((np.array(v) - sums / n) @ axis / math.sqrt(e))
            if abs(want) > 1e-6:
                assert signs.setdefault(r.component, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(r.whitened) - abs(want)) < 1e-9
            assert r.deviation == sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
            assert r.n == n and abs(r.explained - e / values.sum()) < 1e-9
            assert r.identity_error < 1e-9
    return got


@pytest.mark.parametrize("parts", [1, 6])
def test_whitening_against_numpy(spark, parts):
    rows = vectors(8, 2500, 6, common=800)
    checked_whitening(frame(spark, rows, VECTORS).repartition(parts), rows)


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, n string, x string, component string, w string"
    nan = float("nan")
    good = [(1, [1.0, 2.0, 0.5]), (2, [0.0]), (3, [1.0, 2.0, 0.5]), (4, [-3.0, 1.0]), (5, []), (6, [0.1, -7.0, 2.0])]
    bad = [(7, None), (8, [None, 1.0]), (9, [nan, 0.0, 0.0]), (10, [float("inf")])]
    df = frame(spark, [(*r, "n", "x", "c", "w") for r in good + bad], schema)
    checked_whitening(df, good, k=3)
    assert whitened(df.limit(0)).collect() == []
    assert whitened(df.filter("vec_id in (1, 3, 7)")).collect() == []
    # Null and repeated ids keep their rows; two vectors have one component with variance.
    same = df.filter("vec_id in (1, 2)").withColumn("vec_id", F.lit(None).cast("long"))
    flat = whitened(same.union(same)).collect()
    assert [(r.vec_id, r.component, abs(round(r.whitened, 9))) for r in flat] == [(None, 1, 1.0)] * 4


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(i) * 2.0**18, 1.0]) for i in range(40)]
    got = whitened(frame(spark, rows, "vec_id long, embedding array<double>"), components=1).collect()
    assert len(got) == 40 and {r.deviation is None for r in got} == {True, False}


# --- collocations -------------------------------------------------------------------------


def brute_phrases(rows, least, most, share):
    uses, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                uses.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in uses.items() if len(key[1]) > 1 and a >= least}
    inside = {
        (lang, words[i : i + m])
        for (lang, words), a in often.items()
        for m in range(2, len(words))
        for i in range(len(words) - m + 1)
        if 100 * a >= share * often[lang, words[i : i + m]]
    }
    ranked = []
    for (lang, words), a in often.items():
        if (lang, words) not in inside:
            cut = [(uses[lang, words[:k]], uses[lang, words[k:]]) for k in range(1, len(words))]
            score, _, (left, right) = min((2_000_000 * a // sum(c), k, c) for k, c in enumerate(cut))
            ranked.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(ranked):
        place[lang] += 1
        if place[lang] <= most:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def prose(seed, n):
    rnd = random.Random(seed)
    words = ["la", "Le", "le", "äh", "x1", "(b)", "don't"] + [f"w{i}" for i in range(25)]
    passage = "one fixed passage of many words that always stand in this very order here"
    out = []
    for _ in range(n):
        text = "".join(
            rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", ";", "\x0b"])
            for _ in range(rnd.randint(0, 60))
        )
        if rnd.random() < 0.4:
            text += rnd.choice(["", ". ", "la "]) + passage
        out.append((rnd.choice(["en", "en", "de", None]), text + " la la la la la" * rnd.randint(0, 3)))
    return out


@pytest.mark.parametrize("least, most, share", [(3, 2000, 80), (8, 5, 80), (5, 40, 30)])
def test_phrases_against_brute_force(spark, least, most, share):
    rows = prose(least, 250)
    docs = frame(spark, rows, "lang string, text string").repartition(3)
    got = collocations(docs, least, most, share)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, most, share)


def test_flows_are_counts_and_chains_are_joined(spark):
    passage = "a b c d e f g h i j k l"
    rows = [("en", passage)] * 9 + [("en", "c d e f z y x")] * 4
    docs = frame(spark, rows, "lang string, text string")
    grams = longest_grams(docs, 2)
    at = flows(grams)
    count = {r.phrase: r.uses for m in (1, 2, 3) for r in at[m].collect()}
    assert count["c d e"] == count["e f"] == count["d"] == 13 and count["j k l"] == count["l"] == 9
    found = sorted((r.phrase, r.uses) for r in paths(at[4], at[3]).collect())
    assert found == [
        ("a b c d", 9), ("b c d e", 9), ("c d e f", 13), ("d e f g h i j k l", 9), ("d e f z y x", 4),
    ] or found == sorted([("a b c d e", 9), ("c d e f", 13), ("d e f g h i j k l", 9), ("d e f z y x", 4)])


def test_odd_texts(spark):
    schema = "lang string, text string, phrase string, uses string, m string, n string, rank string"
    rows = [(None, None), ("en", ""), ("en", " \t\n ,;"), (None, "a b c"), ("und", "A  b\tC")]
    rows += [("en", "same words " * 30_000), ("en", "x" * 200_000 + " tail"), ("en", "x" * 200_000 + " tail")]
    df = frame(spark, [(*r, "p", "u", "m", "n", "r") for r in rows], schema)
    got = sorted(map(tuple, collocations(df, least=2).collect()))
    assert got == brute_phrases(rows, 2, 2000, 80)
    assert ("und", 1, "a b c", 2, 2, 2, 6, 1_000_000) in got
    assert collocations(df.limit(0)).collect() == []
    assert collocations(df.limit(3)).collect() == []
