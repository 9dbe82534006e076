import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import ODD, frame, odd_rows, words_of

from wordloom.llm import fingerprints, quality, scoring
from wordloom.llm.lattice import Lattice, read_units
from wordloom.llm.queries import piece_model
from wordloom.llm.sentence_pieces import decode, digests, encode
from wordloom.sources.reviews import read_table


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def strange_texts(library, seed=1):
    rnd = random.Random(seed)
    letters = "  ▁aaabbcdeeiouthhnrs\n\t.,!190éàü日本語한д\u0000ﬁ𝒳😀"
    pieces = [library.id_to_piece(k).replace("▁", " ") for k in range(259, 32000)]
    texts = ["", "a", " ", "aaa", "the" * 2000, "日本" * 500, "ab" * 2000 + " " * 700 + "x"]
    texts += [" " * k + "y" + " " * k for k in range(40)]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    return texts


def test_ids_are_those_of_the_library(spark, library):
    texts = strange_texts(library)
    docs = frame(spark, list(enumerate(texts))).repartition(4)
    got = decode(encode(docs, piece_model()), piece_model()).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["ids"] == want and r["text"] == library.decode(want)


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    import pyarrow as pa

    from wordloom.llm import sentence_pieces
    from wordloom.llm.bytewise import byte_view

    monkeypatch.setattr(sentence_pieces, "LONG_TEXT", 40)
    encoder = sentence_pieces.Encoder(sentence_pieces.read_pieces(piece_model()))
    for text in strange_texts(library, 9)[:900]:
        data, offsets = byte_view(pa.array([text * 3]))
        ids, counts = encoder.encode(data, offsets)
        assert ids.tolist() == library.encode(text * 3) and counts.tolist() == [len(ids)]
        shown, places = encoder.decode(ids, counts)
        assert shown.tobytes().decode() == library.decode(ids.tolist())


def test_digests_are_those_of_ids_and_texts(spark, folder, library):
    docs = read_table(spark, folder, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in digests(docs, piece_model()).collect():
        ids = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_tokens_of_odd_rows(spark, library):
    rows = odd_rows()
    got = encode(frame(spark, rows, ODD), piece_model()).collect()
    want = [(r[0], library.encode(r[1] or "", add_bos=True, add_eos=True)) for r in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    assert encode(frame(spark, [], ODD), piece_model()).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in decode(none, piece_model()).collect()] == ["", ""]


def by_hand(units, library, word):
    """Sum over segmentations, one prefix after the other."""
    weights = {}
    text = "▁" + word
    known = Lattice(units)
    for a in range(len(text)):
        for b in range(a + 1, min(len(text), a + units.longest) + 1):
            weights[a, b] = library.get(text[a:b])
    reach = [1.0] + [0.0] * len(text)
    for b in range(1, len(text) + 1):
        for a in range(max(0, b - units.longest), b):
            w = weights[a, b]
            if w is not None:
                reach[b] += reach[a] * math.exp(w)
            elif b == a + 1:
                spelt = text[a:b].encode()
                reach[b] += reach[a] * math.exp(sum(known.units.weights[len(units.keys) + x] for x in spelt))
    return math.log(reach[-1])


def test_the_lattice_sums_over_all_segmentations(library):
    units = read_units(piece_model())
    raw = {library.id_to_piece(k): -math.log(min(-library.get_score(k), 1e6) + 50) for k in range(259, 32000)}
    least = min(raw.values())
    norm = math.log(sum(math.exp(w) for w in raw.values()) + 256 * math.exp(least))
    pieces = {p: w - norm for p, w in raw.items()}
    words = ["the", "a", "éauouon", "日本語x", "\x01z", "thoulyly.***", "über" * 6, "▁▁"]
    got = Lattice(units).log_probabilities(words)
    assert np.allclose(got, [by_hand(units, pieces, w) for w in words], atol=1e-9)
    uses = Lattice(units).expected_uses(["the", "the"])
    assert 2 <= uses.sum() <= 8


def training(rows):
    return [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]


def test_scores_against_counting(spark, folder):
    docs = read_table(spark, folder, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts = Counter()
    for _, text in training(rows):
        counts.update(words_of(text))
        counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    texts = dict(rows)
    few = scoring.language_scores(docs, piece_model(), head_words=50).collect()
    for r in few:
        tokens = [*words_of(texts[r["doc_id"]]), None]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    # How many words are settled in place does not matter.
    many = scoring.language_scores(docs, piece_model()).collect()
    scores = {r["doc_id"]: r["score"] for r in many}
    assert all(math.isclose(r["score"], scores[r["doc_id"]], rel_tol=1e-9) for r in few)


def test_frequent_words_are_likelier_and_the_model_leaks_no_mass(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    learnt = [(ids[k], t) for k, t in enumerate(["b a a", "a c", "a", "b d", "a a"])]
    docs = frame(spark, learnt + [(None, w) for w in "abcdexyz"])
    rows = scoring.language_scores(docs, piece_model()).collect()
    assert all(r["train_tokens"] == 15 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[ids[2]] > score[ids[4]] > score[ids[3]]
    # Of all words these eight are a part; the end's probability is a common factor.
    unseen = sorted(r["score"] for r in rows if r["doc_id"] is None and r["n_tokens"] == 2)
    assert sum(10**s for s in unseen) < 1


def test_scores_of_odd_rows(spark):
    rows = odd_rows()
    got = scoring.language_scores(frame(spark, rows, ODD), piece_model()).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert scoring.language_scores(frame(spark, [], ODD), piece_model()).collect() == []
    unseen = [r for r in scoring.language_scores(frame(spark, [(None, "a b")]), piece_model()).collect()]
    assert unseen[0]["train_tokens"] == 0 and unseen[0]["n_known"] == 0


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (read_table(spark, folder, t) for t in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels).join(labels, "doc_id")
    rows = scored.filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows) > 50
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) for r in rows)


def test_the_model_is_the_gaussian_of_each_class(spark):
    rnd = np.random.default_rng(2)
    d = len(quality.FEATURES)
    x = {y: rnd.normal(y, 1 + y, (200, d)) for y in (0, 1)}
    rows = [(y, r.tolist()) for y in x for r in x[y]]
    model = quality.fit_quality(spark.createDataFrame(rows, "label int, features array<double>"))
    pooled = np.mean([np.var(x[y], axis=0) for y in x], axis=0)
    for y in (0, 1):
        cov = 0.9 * np.cov(x[y].T, bias=True) + 0.1 * np.diag(pooled + 1e-3)
        assert np.allclose(model.means[y], x[y].mean(axis=0))
        assert np.allclose(model.factors[y] @ model.factors[y].T, cov)
    point = rnd.normal(0, 1, (5, d))
    want = []
    for p in point:
        parts = []
        for y in (0, 1):
            cov = model.factors[y] @ model.factors[y].T
            z = p - model.means[y]
            parts.append(-0.5 * z @ np.linalg.inv(cov) @ z - 0.5 * np.linalg.slogdet(cov)[1])
        want.append(parts[1] - parts[0])
    assert np.allclose(model.margins(point), want)


def test_statistics_do_not_depend_on_block_or_run(monkeypatch):
    import pyarrow as pa

    from wordloom.llm.bytewise import WordHasher, byte_view

    texts = ["Some words, and MORE!! words\n" * k for k in range(40)] + ["", "é ü 日本 12 | $$"]
    data, offsets = byte_view(pa.array(texts))
    whole = quality.statistics(data, offsets, WordHasher())
    one = [quality.statistics(*byte_view(pa.array([t])), WordHasher())[0] for t in texts]
    monkeypatch.setattr(quality, "BLOCK_BYTES", 17)
    assert np.allclose(quality.statistics(data, offsets, WordHasher()), whole)
    assert np.allclose(one, whole) and np.isfinite(whole).all()


def test_quality_of_odd_rows(spark):
    docs = frame(spark, odd_rows(), ODD)
    for labels in ([(1, 1), (2, 0), (5, None), (None, 1)], [(1, 1)], []):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        got = quality.quality_scores(docs, known).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
        good = quality.good_texts(docs, known)
        assert good.columns == docs.columns
        assert good.count() == sum(r["predicted"] for r in got)
    assert quality.quality_scores(frame(spark, [], ODD), known).collect() == []


def edited(rows):
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        yield i, t, t[: len(t) - half] + follower[:half], follower


def test_fingerprints_against_brute_force(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text").limit(150)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in fingerprints.fingerprints_with_edits(docs).collect()}
    assert len(got) == len(rows)

    def distinct(text):
        return set(w for w in fingerprints_split(text))

    def fingerprints_split(text):
        import re

        return [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]

    frequency = Counter(w for _, t in rows for w in distinct(t))
    band = {w for w, c in frequency.items() if 3.0 <= math.log(len(rows) / c) <= 7.0}
    hashes = {
        r["w"]: r["h"] for r in frame(spark, [(0, w) for w in sorted(band)], "k int, w string")
        .select("w", F.xxhash64("w").alias("h")).collect()
    }

    def subsets(text):
        own = frozenset(hashes[w] for w in distinct(text) & band)
        out = [own]
        levels = [[own] * fingerprints.CHAINS]
        for level in range(fingerprints.LEVELS):
            row = []
            for c in range(fingerprints.CHAINS):
                shift, bits = (4 * c, 7) if level == 0 else (4 * c + 1 + 2 * level, 3)
                row.append(frozenset(h for h in levels[-1][c] if h >> shift & bits == 0))
            levels.append(row)
            out += row
        return out

    def like(a, b):
        a, b = subsets(a), subsets(b)
        either = sum(bool(x or y) for x, y in zip(a, b))
        return sum(x == y and bool(x) for x, y in zip(a, b)) / either if either else None

    for i, text, other, follower in edited(rows):
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        near = like(text, other), like(text, follower)
        near = [float(text == t) if n is None else n for n, t in zip(near, (other, follower))]
        assert np.allclose([r["near_edited"], r["near_next"]], near), i
    by_text = {}
    for i, t in rows:
        assert by_text.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_fingerprints_of_odd_rows(spark):
    rows = odd_rows()
    got = fingerprints.fingerprints_with_edits(frame(spark, rows, ODD)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(r["n_chars"], set()).add(r["fingerprint"])
    assert len(by_text[0]) == 1 and len(by_text[len(rows[0][1])]) == 1
    assert fingerprints.fingerprints_with_edits(frame(spark, [], ODD)).collect() == []
    alone = fingerprints.fingerprints_with_edits(frame(spark, [(1, "just one text")])).collect()
    assert alone[0]["near_next"] == 1.0


@pytest.mark.parametrize("chunks", [2, 3, 50])
def test_every_row_finds_its_follower(spark, chunks):
    rows = [(k * 3 % 101, f"t{k * 3 % 101}") for k in range(101)]
    got = fingerprints.in_reading_order(frame(spark, rows).repartition(4), chunks).filter("NOT ghost")
    want = {i: f"t{(i - 1) % 101}" for i in range(101)}
    assert {r["doc_id"]: r["next"] for r in got.collect()} == want
