import random
from collections import Counter

import pytest

from wordloom.sources import reviews as R
from wordloom.sources.split_csv import csv_records, read_split_csv

SMALL = {"spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"}


@pytest.fixture(params=["64m", "300", "40"])
def parts_of(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for key in SMALL:
        spark.conf.unset(key)


def table(seed, end):
    """Quoted and plain fields, quotes out of place, missing and surplus fields, empty lines."""
    rnd = random.Random(seed)
    bits = ["a", "b c", ",", "\n", '""', "é", " ", "\r\n", "x" * 5, "\n\n"]
    lines = ["text,label"]
    for _ in range(150):
        body = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        kinds = [f'"{body}"'] * 6 + ['he said "wow', '"abc"def', ' "lead', "", "plain"]
        lines.append(rnd.choice(kinds) + "," + rnd.choice(["1", "0", "x", "", '"2"', "1,extra"]))
        if rnd.random() < 0.05:
            lines.append("")
    return end.join(lines) + end * (seed % 2)


def whole(spark, path, header=True):
    reader = spark.read.option("header", header).option("multiLine", True)
    return Counter(map(tuple, reader.option("quote", '"').option("escape", '"').csv(path).collect()))


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_rows_of_a_whole_file_reader(spark, tmp_path, parts_of, seed, end):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(table(seed, end), newline="")
        seed += 10
    got = read_split_csv(spark, str(tmp_path))
    assert got.columns == ["text", "label"]
    assert Counter(map(tuple, got.collect())) == whole(spark, str(tmp_path))


def test_many_tasks_and_one_long_record(spark, tmp_path, parts_of):
    path = tmp_path / "long.csv"
    path.write_text('text,label\n"' + "line\n" * 500 + '",1\nplain,0\n"open' + "\nline" * 30)
    got = {tuple(r) for r in R.read_csv(spark, str(path)).collect()}
    assert got == {("line\n" * 500, "1"), ("plain", "0"), ("open" + "\nline" * 30, None)}
    if parts_of != "64m":
        assert csv_records(spark, str(path)).rdd.getNumPartitions() > 4


def test_without_header_and_empty(spark, tmp_path):
    (tmp_path / "p.csv").write_text('"a\nb",1\n,\n')
    assert Counter(map(tuple, R.read_csv(spark, str(tmp_path / "p.csv"), header=False).collect())) == {
        ("a\nb", "1"): 1, (None, None): 1,
    }
    (tmp_path / "e.csv").write_text("text,label\n")
    assert R.read_csv(spark, str(tmp_path / "e.csv")).collect() == []
