from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom import Options
from wordloom.functions import words as W
from wordloom.operators import pairs, wordstats

WORDS = st.sampled_from(["the", "The", "film", "Film", "a", "x", "12", "plot", "w" * 50, "w" * 51])
CORPORA = st.lists(st.lists(WORDS, min_size=1, max_size=20), min_size=1, max_size=12)
SLOW = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def corpus(spark, docs, labels=None):
    labels = labels or [i % 2 for i in range(len(docs))]
    data = [(i, " ".join(words), label) for i, (words, label) in enumerate(zip(docs, labels))]
    return spark.createDataFrame(data, "doc_id long, text string, label int")


def kept(words):
    lowered = [w.lower() for w in words]
    return [w for w in lowered if 2 <= len(w) <= 50 and w not in W.STOPWORDS]


def test_map_phase_emits_every_word_with_one(spark):
    docs = spark.createDataFrame(
        [(0, "hello world", 1), (1, "good movie", 0)], "doc_id long, text string, label int"
    )
    assert rows(pairs.map_phase(docs)) == sorted(
        [(0, 1, "hello", 1), (0, 1, "world", 1), (1, 0, "good", 1), (1, 0, "movie", 1)], key=repr
    )


def test_map_phase_cleans_words_of_raw_text_after_the_stopword_test(spark):
    docs = spark.createDataFrame([(0, "  The, the GOOD... ' x")], "doc_id long, text string")
    words = [row.word for row in pairs.map_phase(docs, Options(), "doc_id").collect()]
    assert sorted(words) == ["good", "the"]


def test_numeric_words_count(spark):
    docs = spark.createDataFrame([(0, "hello 12 12")], "doc_id long, text string")
    counted = wordstats.total_counts(pairs.map_phase(docs, Options(), "doc_id"))
    assert rows(counted) == [("12", 2), ("hello", 1)]


def test_stopwords_can_stay(spark):
    docs = spark.createDataFrame([(0, "the film")], "doc_id long, text string")
    words = pairs.map_phase(docs, Options(remove_stopwords=False), "doc_id")
    assert sorted(row.word for row in words.collect()) == ["film", "the"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = df.select(W.ngrams(F.col("w"), 1), W.ngrams(F.col("w"), 2), W.ngrams(F.col("w"), 3))
    assert [tuple(r) for r in got.collect()] == [
        (["a", "b", "c"], ["a b", "b c"], ["a b c"]),
        (["a"], [], []),
        ([], [], []),
    ]


@SLOW
@given(CORPORA)
def test_term_counts_and_word_counts_match_brute_force(spark, docs):
    table = corpus(spark, docs)
    want = [(i, w, n) for i, d in enumerate(docs) for w, n in Counter(map(str.lower, d)).items()]
    assert rows(pairs.term_counts(table)) == sorted(want, key=repr)

    total, freq = Counter(), Counter()
    for d in docs:
        total.update(kept(d))
        freq.update(set(kept(d)))
    want = sorted(((w, total[w], freq[w]) for w in total), key=repr)
    assert rows(wordstats.word_counts(table)) == want
    assert rows(wordstats.reduce_counts(pairs.map_phase(table))) == want
    assert rows(wordstats.reduce_counts(pairs.map_phase(table, cleaned=True))) == want
    counts, n = wordstats.stored_counts(table)
    assert rows(counts) == want
    assert spark.range(1).select(n).first()[0] == len(docs)


@SLOW
@given(CORPORA)
def test_ngram_counts_match_brute_force(spark, docs):
    want = Counter()
    for d in docs:
        words = kept(d)
        want.update((1, w) for w in words)
        want.update((2, f"{a} {b}") for a, b in zip(words, words[1:]))
    got = {(r.n, r.gram): r.total_count for r in pairs.ngram_counts(corpus(spark, docs)).collect()}
    assert got == dict(want)


def test_document_frequency_counts_documents_not_labels(spark):
    table = corpus(spark, [["film"], ["film", "film"], ["film"]], labels=[1, 1, 1])
    assert rows(wordstats.word_counts(table)) == [("film", 4, 3)]


def test_bounds_and_ties(spark):
    docs = [["bb", "cc"], ["bb", "cc", "aa"], ["aa", "rare"], ["cc", "aa", "bb"]]
    table = corpus(spark, docs)
    everywhere = Options(max_document_frequency=1.0)
    top = wordstats.vocabulary(table, Options(max_vocab_size=2, max_document_frequency=1.0))
    assert [r.word for r in top.collect()] == ["aa", "bb"]
    assert wordstats.vocabulary_list(wordstats.vocabulary(table, everywhere)) == ["aa", "bb", "cc"]
    assert wordstats.vocabulary_list(
        wordstats.vocabulary(table, Options(max_document_frequency=0.5))
    ) == []


def test_one_percent_raises_the_lower_bound(spark):
    docs = [["common", "pair" if i < 2 else "other"] for i in range(300)]
    words = wordstats.vocabulary_list(wordstats.vocabulary(corpus(spark, docs)))
    # 1% of 300 is 3, so two documents are too few; 95% is 285, so everywhere is too many.
    assert words == []
    assert wordstats.vocabulary_list(
        wordstats.vocabulary(corpus(spark, docs), Options(max_document_frequency=1.0))
    ) == ["common", "other"]


def test_empty_corpus(spark):
    table = corpus(spark, [["film"]]).filter("doc_id > 5")
    assert wordstats.vocabulary(table).count() == 0


def test_statistics_and_summaries(spark):
    table = corpus(spark, [["aa", "bb"], ["aa"], ["aa"]], labels=[1, 0, 1])
    stats = wordstats.word_statistics(wordstats.word_counts(table)).first()
    assert tuple(stats) == (4, 2.0, 3, 1, 2)
    assert rows(wordstats.label_summary(table)) == [(0, 0, 1), (0, 1, 2), (1, None, 3)]
    assert tuple(wordstats.length_statistics(table).first()) == (3, 4 / 3, 2, 1)


def test_a_word_in_a_third_of_all_rows_stays_one_row_per_task_in_the_shuffle(spark):
    docs = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("word"), "id")).alias("text"),
    )
    counts = wordstats.word_counts(docs)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1 and plan.count("Exchange hashpartitioning") == 1
    assert counts.filter("word = 'hot'").first()[1:] == (10_000, 10_000)


def test_term_counts_do_not_shuffle(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = pairs.term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rare_ngrams_are_not_gathered_before_the_shuffle(train):
    """A table of all the grams of a task outgrew its memory on larger tables."""
    plan = pairs.ngram_counts(train)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "Exchange" in plan and "HashAggregate" not in below and "posexplode" not in below
