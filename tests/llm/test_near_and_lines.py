import random
from collections import defaultdict

import numpy as np
import pytest
from tests_llm_helpers import ODD, frame, odd_rows, words_of

import corpus_pipeline
import wordloom.llm.near_duplicates as near
from wordloom.llm import line_duplicates
from wordloom.llm.bytewise import U64, WordHasher
from wordloom.llm.components import components
from wordloom.llm.line_duplicates import deduplicated
from wordloom.llm.near_duplicates import near_duplicates, one_of_each
from wordloom.llm.tables import BATCH_ROWS, BATCH_SETTING


def least_labels(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    ring = [(300 + k, 300 + (k + 1) % 30) for k in range(30)]
    loose = [(rnd.randint(400, 500), rnd.randint(400, 500)) for _ in range(40)]
    links = chain + star + ring + loose
    rnd.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a != b]
    want = least_labels({x for l in real for x in l}, real)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def families(seed=4):
    """Texts with copies edited here and there, so that stars alone would leave links out."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice((4, 6, 30, 120)))]
        for _ in range(rnd.choice((1, 3, 12))):
            words = list(base)
            for _ in range(rnd.choice((0, 0, 1, 2, 4))):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append(" ".join(words))
    rnd.shuffle(rows)
    return list(enumerate(rows, 10))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("percent", [85, 60])
def test_components_are_those_of_all_pairs(spark, percent):
    rows = families()
    sets = {i: shingle_set(t) for i, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b
        and sets[a]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    got = near_duplicates(frame(spark, rows), percent).collect()
    label = least_labels(sets, links)
    assert {r["doc_id"]: r["component_id"] for r in got} == label
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_rows()
    got = near_duplicates(frame(spark, rows, ODD), 80).collect()
    assert len(got) == len(rows)
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append((r["component_id"], r["kept"], r["n_shingles"]))
    assert found[1] == [(1, True, 4)] and found[2] == [(1, False, 4)] * 2
    assert found[3] == [(3, True, 0)] and found[6] == [(6, True, 1)]
    assert sorted(found[None], key=str) == sorted([(1, False, 4), (None, True, 6), (None, True, 0)], key=str)


def test_one_row_stays_of_each_group(spark):
    docs = frame(spark, odd_rows(), ODD)
    got = one_of_each(docs, 80)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "3", "4", "5", "6", "7", "None", "None"]


def test_empty_tables(spark):
    empty = frame(spark, [], ODD)
    assert near_duplicates(empty).collect() == [] and one_of_each(empty).collect() == []
    assert deduplicated(empty).collect() == []


def line_texts(seed=6):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)] + ["the"] * 100
    lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice((2, 5, 9, 25)))) for _ in range(60)]
    rows = []
    for k in range(120):
        own = []
        for _ in range(rnd.randint(0, 6)):
            words = rnd.choice(lines).split()
            for _ in range(rnd.choice((0, 0, 1, 1, 3))):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            own.append(" ".join(words))
        rows.append((k, "\n".join(own)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 60])
def test_lines_that_match_an_earlier_line_go(spark, percent):
    rows = line_texts()
    want = without_like_lines(rows, percent)
    got = deduplicated(frame(spark, rows).repartition(6), percent).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert all(
        r["lines_removed"] == len(dict(rows)[r["doc_id"]].split("\n")) - len(r["text"].split("\n"))
        for r in got
        if r["text"]
    )


def test_lines_of_odd_rows(spark):
    rows = odd_rows()
    docs = frame(spark, rows, ODD)
    got = deduplicated(docs)
    assert got.columns == docs.columns
    by_id = defaultdict(list)
    for r in got.collect():
        by_id[r["doc_id"]].append((r["text"], r["lines_removed"]))
    same = rows[0][1]
    assert by_id[1] == [(same, 0)] and by_id[2] == [("", 1)] * 2
    assert by_id[3] == [(None, 0)] and by_id[4] == [("", 0)] and by_id[5] == [(" \n\t ", 0)]
    assert by_id[7] == [("a b", 0), (rows[11][1], 0)] or by_id[7] == [(rows[11][1], 0), ("a b", 0)]
    assert sorted(by_id[None], key=str) == sorted([("", 1), (rows[8][1], 0), (None, 0)], key=str)


def short_line_texts(seed=9):
    rnd = random.Random(seed)
    rows = []
    for k in range(150):
        own = []
        for _ in range(rnd.randint(1, 5)):
            words = rnd.sample("a b c d e f g h i j k".split(), rnd.choice((1, 2, 3, 4, 4, 5, 6)))
            own.append(" ".join(words + words[:1] * rnd.randint(0, 1)))
        rows.append((k, "\n".join([*own, *["", " \t"][: k % 3]])))
    return rows


def without_like_lines(rows, percent, least_words=1):
    seen, want = [], {}
    for i, text in sorted(rows):
        rest = []
        for line in text.split("\n"):
            own = set(words_of(line)) if len(words_of(line)) >= least_words else set()
            like = own and any(100 * len(own & s) >= percent * len(own | s) for s in seen)
            if own:
                seen.append(own)
            if not like:
                rest.append(line)
        want[i] = "\n".join(rest)
    return want


@pytest.mark.parametrize("percent", [100, 80, 60])
def test_short_lines_take_part(spark, percent):
    rows = short_line_texts()
    got = deduplicated(frame(spark, rows).repartition(4), percent).collect()
    assert {r["doc_id"]: r["text"] for r in got} == without_like_lines(rows, percent)


def test_short_lines_stay_where_asked_for(spark):
    rows = short_line_texts()
    got = deduplicated(frame(spark, rows).repartition(4), 80, least_words=4).collect()
    assert {r["doc_id"]: r["text"] for r in got} == without_like_lines(rows, 80, 4)


def test_the_line_stage_takes_out_short_repeats(spark, folder):
    rows = short_line_texts()
    got = corpus_pipeline.lines(spark, frame(spark, rows).repartition(4), folder).collect()
    want = {i: t for i, t in without_like_lines(rows, 80).items() if words_of(t) or t == dict(rows)[i]}
    assert {r["doc_id"]: r["text"] for r in got} == want


def test_near_duplicates_hand_texts_to_python_in_small_batches(spark, monkeypatch):
    most = BATCH_ROWS

    def checked(make):
        def build(*args):
            run = make(*args)

            def seen(batches):
                for batch in batches:
                    if batch.num_rows > most:
                        raise ValueError(f"{batch.num_rows} rows in a batch")
                    yield batch

            return lambda batches: run(seen(batches))

        return build

    for name in ("_signatures", "_sets"):
        monkeypatch.setattr(near, name, checked(getattr(near, name)))
    before = spark.conf.get(BATCH_SETTING)
    # A text and a near copy of it, 1,500 times.
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(1_500)]
    rows = [(2 * k + e, text + " more" * e) for k, text in enumerate(texts) for e in (0, 1)]
    got = near.near_duplicates(frame(spark, rows).coalesce(1), percent=80)
    assert {r.doc_id: r.component_id for r in got.collect()} == {d: d - d % 2 for d, _ in rows}
    assert spark.conf.get(BATCH_SETTING) == before


def test_only_lines_asked_for_become_sets():
    texts = ["b a b\nc\n\nd a", "", "a\nB b c d"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    hasher = WordHasher()
    hashes = dict(zip("abcd", hasher(np.frombuffer(b"abcd", np.uint8), np.arange(4), np.arange(1, 5))))
    ranks = line_duplicates._Ranks(np.array([hashes["c"], hashes["a"]], U64))
    rank = dict(zip("abcd", ranks(np.array([hashes[w] for w in "abcd"]))))
    want = {(0, 0): "ab", (0, 1): "c", (0, 3): "ad", (2, 0): "a", (2, 1): "bcd"}
    for asked in (None, [], [(0, 3), (2, 1)], [(1, 0), (2, 0)], list(want)):
        places = None if asked is None else np.array([t << 32 | k for t, k in asked], np.int64)
        text, number, values, owner, sizes = line_duplicates._line_sets(
            data, offsets, hasher, ranks, 1, places
        )
        found = list(zip(text.tolist(), number.tolist()))
        assert found == [p for p in want if asked is None or p in asked]
        assert sizes.tolist() == [len(want[p]) for p in found]
        assert owner.tolist() == [k for k, p in enumerate(found) for _ in want[p]]
        assert values.tolist() == [v for p in found for v in sorted(int(rank[w]) for w in want[p])]
