import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from tests_llm_helpers import ODD, frame, odd_rows

from wordloom.llm.exact_duplicates import exact_duplicates
from wordloom.llm.sharding import shards


def copies(seed=5, n=300):
    rnd = random.Random(seed)
    texts = [f"text {k} " * rnd.randint(1, 9) for k in range(60)]
    # One text holds a third of all rows.
    return [(k, texts[0] if k % 3 == 0 else rnd.choice(texts)) for k in rnd.sample(range(n), n)]


def groups(rows):
    found = defaultdict(list)
    for i, t in rows:
        found[t or ""].append(i)
    return found


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("chunks", [1, 2, 40])
def test_groups_and_the_row_that_stays(spark, keep, chunks):
    rows = copies()
    got = exact_duplicates(frame(spark, rows).repartition(7), keep, chunks=chunks).collect()
    best = min if keep == "smallest" else max
    want = {
        i: (best(ids), len(ids), i == best(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups(rows).items()
        for i in ids
    }
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


def test_normalised_texts(spark):
    from pyspark.sql import functions as F

    rows = [(1, "A b"), (2, "a B"), (3, "a  b")]
    got = exact_duplicates(frame(spark, rows), normalise=F.lower).collect()
    assert {r["doc_id"]: r["keep_id"] for r in got} == {1: 1, 2: 1, 3: 3}


def test_odd_rows(spark):
    rows = odd_rows()
    got = exact_duplicates(frame(spark, rows, ODD)).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(list)
    for r in got:
        by_text[r["text_sha256"]].append(r)
    assert all(sum(r["kept"] for r in g) == 1 for g in by_text.values())
    copied = by_text[hashlib.sha256(rows[0][1].encode()).hexdigest()]
    assert {(r["keep_id"], r["group_size"]) for r in copied} == {(1, 4)}
    lone = by_text[hashlib.sha256(rows[8][1].encode()).hexdigest()]
    assert [(r["doc_id"], r["keep_id"], r["kept"]) for r in lone] == [(None, None, True)]


def test_empty_tables(spark):
    empty = frame(spark, [], ODD)
    assert exact_duplicates(empty).collect() == [] and shards(empty).collect() == []


def test_an_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError):
        exact_duplicates(frame(spark, []), keep="longest")


def needed(sizes, capacity):
    n, held = 1, 0
    for s in sizes:
        if held + s > capacity:
            n, held = n + 1, 0
        held += s
    return n


@pytest.mark.parametrize("count", [1, 3, 8])
def test_the_largest_shard_is_as_small_as_can_be(spark, count):
    rows = copies()
    got = shards(frame(spark, rows).repartition(5), count).collect()
    order = sorted((min(i), sum(len(t.encode()) + 1 for _ in i)) for t, i in groups(rows).items())
    sizes = [s for _, s in order]
    best = next(c for c in range(max(sizes), sum(sizes) + 1) if needed(sizes, c) <= count)
    load, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    texts = dict(rows)
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[texts[r["doc_id"]]].add(r["shard"])
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1
    assert max(load.values()) == best and set(load) <= set(range(count))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())


def test_shards_of_odd_rows(spark):
    got = shards(frame(spark, odd_rows(), ODD), 3).collect()
    assert len(got) == len(odd_rows())
    assert sorted(r["size"] for r in got if r["text_crc32"] == 0) == [1, 1, 1]
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
