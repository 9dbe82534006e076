import hashlib

import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import frame, words_of

from wordloom.llm.mixing import MOST_REPEATS, PHI, cyclic_weights, mix, mixed, targets, word_count
from wordloom.llm.warc import fixity_audit, laid_out, read_archive, write_archive

SOURCED = "doc_id long, text string, source string, size string, s string, begin string"


def sourced(n=200):
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else ["a", "b", "Z", None, "tiny"][k % 5]
        words = 0 if k % 17 == 0 else (k * 7) % 40 + 1
        rows.append((k, " ".join(["w"] * words), source, "x", "y", "z"))
    rows.append((None, None, None, "x", "y", "z"))
    rows.append((500, "long " * 9_000, "a", "x", "y", "z"))
    return rows


def test_targets_share_the_excess_by_weight():
    got = targets([100, 10, 1000], [1.0, 2.0, 3.0])
    assert got[1] == 30 and abs(sum(got) - 1110) < 1e-9
    assert got == [270.0, 30.0, 810.0]
    assert targets([0, 0], [1.0, 2.0]) == [0.0, 0.0]


def test_the_mixture_meets_its_targets(spark):
    rows = sourced()
    table, plan = mix(frame(spark, rows, SOURCED).repartition(5), block=64)
    got = table.collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        own = taken.setdefault(r["source"], [0, r["target"], r["source_size"]])
        own[0] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    total = sum(len(words_of(r[1])) for r in rows)
    assert abs(sum(t for _, t, _ in taken.values()) - total) < 1e-6
    assert all(abs(n - t) <= 0.5 and t <= 3 * size + 1e-9 for n, t, size in taken.values())
    again = mix(frame(spark, rows, SOURCED).repartition(3), block=64)[0].collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_every_stretch_holds_each_source_by_its_share(spark):
    rows = [(k, "w " * 50, "abc"[k % 3], "", "", "") for k in range(300)]
    _, plan = mix(frame(spark, rows, SOURCED), lambda names: [1.0, 2.0, 1.0], block=25)
    slots = plan.groupBy("slot", "s").agg(F.sum("words").alias("words")).orderBy("slot").collect()
    # Blocks of a source are equal but for its last.
    assert sum(not 20 <= r["words"] <= 30 for r in slots) <= 3
    for first in range(0, len(slots) - 40, 40):
        part = [r["s"] for r in slots[first : first + 40]]
        assert abs(part.count(1) - 20) <= 2 and abs(part.count(0) - 10) <= 2


def test_mixed_rows_keep_their_columns(spark):
    docs = frame(spark, sourced(), SOURCED)
    got = mixed(docs)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert None not in ids and max(ids.count(i) for i in ids) <= 3


def dealt(rows, weights, block):
    """The ids of whole documents in the order of the slots, one word stream of each source after
    another."""
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    own = {
        s: sorted(
            ((r[0], len(words_of(r[1]))) for r in rows if r[2] == s),
            key=lambda r: (hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r),
        )
        for s in sources
    }
    sizes = [sum(n for _, n in own[s]) for s in sources]
    quotas = [min(3 * n, int(t + 0.5)) for n, t in zip(sizes, targets(sizes, weights(sources)))]
    total = sum(quotas)
    limits = [sum(quotas[: k + 1]) / total for k in range(len(quotas) - 1)]
    turns = [[] for _ in sources]
    for slot in range(-(-total // block)):
        turns[sum(limit <= slot * PHI % 1.0 for limit in limits)].append(slot)
    found = []
    for k, s in enumerate(sources):
        mine = turns[k] or [-(-total // block) + k]
        each, p, first = max(1, -(-quotas[k] // len(mine))), 0, True
        for doc_id, n in own[s] * MOST_REPEATS:
            if n and p < quotas[k] and (first or 2 * min(n, quotas[k] - p) >= n):
                found.append((mine[p // each], p, doc_id))
            p, first = p + n, first and not n
    return [doc_id for *_, doc_id in sorted(found)]


@pytest.mark.parametrize("block", [16, 64, 2048])
def test_mixed_rows_stand_as_the_schedule_deals_them(spark, block):
    rows = sourced()[:-2] + [(r[0], r[1], r[2], "again", "y", "z") for r in sourced()[40:60]]
    got = mixed(frame(spark, rows, SOURCED).repartition(5), block=block).collect()
    assert [r["doc_id"] for r in got] == dealt(rows, cyclic_weights, block)


def test_a_source_whose_first_document_exceeds_its_quota_gives_it(spark):
    rows = [(k, "w " * 10, "a", "", "", "") for k in range(200)] + [(500, "long " * 900, "b", "", "", "")]
    weights = lambda names: [1.0, 0.1]
    got = [r["doc_id"] for r in mixed(frame(spark, rows, SOURCED), weights, block=64).collect()]
    assert got.count(500) == 1 and got == dealt(rows, weights, 64)


def test_words_are_counted_between_ascii_white_space(spark):
    texts = ["", " ", "a", " a b\x0b\nc ", "é\x00x  y\t", None, "a\n"]
    got = frame(spark, list(enumerate(texts))).select("doc_id", word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in got.orderBy("doc_id").collect()] == [len(words_of(t)) for t in texts]


def test_empty_mixture(spark):
    table, plan = mix(frame(spark, [], SOURCED))
    assert table.collect() == [] and plan.collect() == []
    assert mixed(frame(spark, [], SOURCED)).collect() == []


PAGES = "page_id long, url string, html string, place string, file string"


def pages(n=70):
    rows = [(k, f"http://x/{k}", f"<p>{k} é\r\n\r\n</p>" * (k % 5), "p", "f") for k in range(n)]
    return rows + [(None, None, None, "p", "f"), (3, "http://x/3", rows[3][2], "p", "f")]


def test_files_hold_the_records_at_their_ranges(spark, tmp_path):
    docs = frame(spark, pages(), PAGES)
    manifest = write_archive(docs, str(tmp_path / "warc"), records_in_file=16)
    rows = manifest.orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(72))
    files = {}
    for path in sorted((tmp_path / "warc").glob("file=*/part-*")):
        files[int(path.parent.name[5:])] = path.read_bytes()
    for r in rows:
        part = files[r["file"]][r["offset"] : r["offset"] + r["length"]]
        assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n")
        assert hashlib.sha256(part).hexdigest() == r["record_sha256"]
    assert {k: len(v) for k, v in files.items()} == {
        k: sum(r["length"] for r in rows if r["file"] == k) for k in files
    }


def test_damage_in_a_replica_is_found(spark, tmp_path):
    manifest = write_archive(frame(spark, pages(), PAGES), str(tmp_path / "warc"), records_in_file=16)
    sound = fixity_audit(manifest, read_archive(spark, str(tmp_path / "warc"), manifest), fanout=4)
    assert {r["status"] for r in sound.collect()} == {"sound"}
    hit = manifest.filter("place = 20").first()
    path = next((tmp_path / "warc" / f"file={hit['file']}").glob("part-*"))
    raw = bytearray(path.read_bytes())
    raw[hit["offset"] + 5] ^= 1
    path.write_bytes(bytes(raw))
    for check in path.parent.glob(".part*.crc"):
        check.unlink()
    last = next((tmp_path / "warc" / "file=4").glob("part-*"))
    last.unlink()
    got = fixity_audit(manifest, read_archive(spark, str(tmp_path / "warc"), manifest), fanout=4)
    status = {r["place"]: r["status"] for r in got.collect()}
    assert {p for p, s in status.items() if s == "corrupt"} == {20}
    assert {p for p, s in status.items() if s == "missing"} == set(range(64, 72))


def test_extra_records_and_empty_archives(spark):
    whole = laid_out(frame(spark, pages(), PAGES), 16)
    part = whole.filter("place < 50")
    status = [r["status"] for r in fixity_audit(part, whole).collect()]
    assert status.count("extra") == 22 and status.count("sound") == 50
    none = whole.filter("place < 0")
    assert fixity_audit(none, none).collect() == []
    assert {r["status"] for r in fixity_audit(part, none).collect()} == {"missing"}
    assert laid_out(frame(spark, [], PAGES)).collect() == []


@pytest.mark.parametrize("where", ["bytes", "offset"])
def test_a_change_of_bytes_or_place_is_corruption(spark, where):
    whole = laid_out(frame(spark, pages(20), PAGES), 16)
    change = F.when(F.col("place") == 7, F.lit("0")).otherwise(F.col("record_sha256"))
    other = whole.withColumn("record_sha256", change)
    if where == "offset":
        other = whole.withColumn("offset", F.col("offset") + F.when(F.col("place") == 7, 1).otherwise(0))
    got = fixity_audit(whole, other, fanout=2).collect()
    assert {r["place"] for r in got if r["status"] == "corrupt"} == {7}
