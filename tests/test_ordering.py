import pytest
from conftest import rows
from pyspark.sql import functions as F

from wordloom import Options
from wordloom.operators import ordering, sequences


@pytest.fixture
def numbers(spark):
    return spark.range(0, 5_000, 1, 6).select(
        F.concat(F.lit("k"), F.md5(F.col("id").cast("string").cast("binary"))).alias("key"),
        (F.col("id") % 7).alias("value"),
    )


def test_rank_over_many_partitions(spark, numbers):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ordering.with_rank(numbers, "key")
        chunks = ordering.in_chunks(numbers, "key").select("chunk").distinct().count()
        sums = ordering.with_total_before(numbers, "key", "value")
        got, totals = rows(ranked), rows(sums)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert chunks > 1
    want = sorted(map(tuple, numbers.collect()))
    assert [(key, rank) for key, _, rank in got] == [(k, i) for i, (k, _) in enumerate(want)]
    before, expected = 0, []
    for key, value in want:
        expected.append((key, value, before))
        before += value
    assert totals == expected


def test_rank_of_nothing(numbers):
    assert ordering.with_rank(numbers.filter("value > 100"), "key").count() == 0


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_id_vocabulary_and_sequences(spark):
    docs = docs_of(spark, "b a b", "a C c, é é", "once")
    vocab = sequences.id_vocabulary(docs)
    assert {r.word: r.word_id for r in vocab.collect()} == {
        "<PAD>": 0, "<UNK>": 1, "<START>": 2, "<END>": 3, "a": 4, "b": 5, "é": 6,
    }
    encoded = sequences.id_sequences(docs, vocab, Options(sequence_length=4))
    assert rows(encoded) == [
        (0, [5, 4, 5, 0], [1, 1, 1, 0]),
        (1, [4, 1, 1, 6], [1, 1, 1, 1]),
        (2, [1, 0, 0, 0], [1, 0, 0, 0]),
    ]


@pytest.mark.parametrize("head_rows", [1, 50])
def test_the_size_of_the_head_does_not_change_the_ids(spark, folder, head_rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    vocab = sequences.id_vocabulary(docs)
    assert rows(sequences.id_sequences(docs, vocab)) == rows(
        sequences.id_sequences(docs, vocab, head_rows=head_rows)
    )


def test_sequences_of_a_bounded_vocabulary_need_no_shuffle(spark):
    docs = docs_of(spark, "b a b", "A c é é d", "once", "", None, "a " * 9 + "b")
    words = ["b", "é", "a"]
    entries = [(word, i + len(sequences.RESERVED), 0) for i, word in enumerate(words)]
    vocab = spark.createDataFrame(entries, "word string, word_id int, total_count long")
    options = Options(sequence_length=4)
    got = sequences.bounded_id_sequences(docs, words, options)
    assert rows(got) == rows(sequences.id_sequences(docs, vocab, options))
    assert got.dtypes == sequences.id_sequences(docs, vocab, options).dtypes
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_hot_unknown_word_is_settled_before_the_shuffle(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("unknown")).otherwise(F.col("id").cast("string"))
    words = spark.range(9_000).select(hot.alias("word"))
    vocab = spark.range(9_000).select(
        F.col("id").cast("string").alias("word"), F.col("id").cast("int").alias("word_id")
    )
    got = sequences.with_word_ids(words, vocab, head_rows=5)
    assert got.filter("word = 'unknown'").select("word_id").distinct().collect() == [(1,)]
    assert got.count() == 9_000
    # The rows that meet the whole vocabulary: no word has many of them.
    head = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(5)
    rest = words.join(head, "word", "left_anti").repartition(8, "word")
    sizes = rest.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2 * 6_000 / 8
