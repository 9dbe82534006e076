import math
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from wordloom.functions.words import STOPWORDS
from wordloom.operators import batch_grams, bayes, metrics, ngrams, pairs
from wordloom.operators.ngrams import ngram_tfidf, ngram_vocabulary
from wordloom.operators.splits import with_fold
from wordloom.options import Options
from wordloom.plans import evaluation, pipeline, tuning
from wordloom.plans.bayes_folds import cross_validated_bayes
from wordloom.session import cut


def fitted_by_fold(train, options, smoothings, leaky, unsupervised):
    """The averages by a fit of the ML classifier for each fold and smoothing."""
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    folded = cut(with_fold(train, options))
    totals = [0.0] * len(smoothings)
    for fold in range(options.cv_folds):
        part = folded.filter(F.col("fold") != fold)
        texts = (folded if leaky else part).select("doc_id", "text")
        if unsupervised is not None:
            texts = texts.unionByName(unsupervised)
        vocab = pipeline.fit_vocabulary(texts, options)
        features = pipeline.fit_features(part, options, vocab, cleaned=True)
        test = pipeline.prepare(features, folded.filter(F.col("fold") == fold))
        for i, smoothing in enumerate(smoothings):
            estimator = pipeline.create_classifier("naive_bayes", options).setSmoothing(smoothing)
            model = estimator.fit(pipeline.prepare(features, part))
            totals[i] += evaluator.evaluate(model.transform(test))
    return [total / options.cv_folds for total in totals]


@pytest.mark.parametrize("leaky, more, blocks", [(False, False, (True, True)), (True, True, (False, True))])
def test_folds_by_counts_are_folds_by_fits(spark, train, leaky, more, blocks):
    options = Options(cv_folds=3, max_features=60, use_bow=blocks[0], use_tfidf=blocks[1])
    unsupervised = train.select("doc_id", "text").limit(20) if more else None
    rows = cut(with_fold(train, options))
    got, vocab = cross_validated_bayes(rows, [0.5, 2.0], options, leaky, unsupervised)
    want = fitted_by_fold(train, options, [0.5, 2.0], leaky, unsupervised)
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want)), (got, want)
    texts = train.select("doc_id", "text")
    texts = texts if unsupervised is None else texts.unionByName(unsupervised)
    assert vocab.words == pipeline.fit_vocabulary(texts, options).words


def test_folds_without_a_class_or_a_text(spark):
    texts = [(i, "good film" if i % 2 else "bad book", 3 if i < 4 else i % 2, i % 2) for i in range(12)]
    schema = "doc_id long, text string, label int, fold int"
    options = Options(cv_folds=4, min_document_frequency=1, max_document_frequency=1.0)
    got, _ = cross_validated_bayes(spark.createDataFrame(texts, schema), [1.0], options)
    assert 0.0 <= got[0] <= 1.0
    none, vocab = cross_validated_bayes(spark.createDataFrame([], schema), [1.0, 2.0], options)
    assert none == [0.0, 0.0] and vocab.words == ()


def test_the_source_is_read_once(spark, folder, monkeypatch):
    from wordloom.sources.reviews import clean_reviews

    reads = []
    real = tuning.cut
    monkeypatch.setattr(tuning, "cut", lambda df: reads.append(df) or real(df))
    tuned = tuning.cross_validate(clean_reviews(spark, folder), "naive_bayes")
    assert len(reads) == 1 and len(tuned.averages) == 3
    assert tuned.model.transform(clean_reviews(spark, folder)).count() > 0


# --- n-grams ------------------------------------------------------------------------------


def grams(text, longest):
    words = [w for w in text.lower().split(" ") if 2 <= len(w) <= 50 and w not in STOPWORDS]
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("longest", [2, 3])
def test_ngram_vocabulary_and_weights_by_hand(spark, train, longest):
    options = Options(feature_ngrams=longest, max_features=400)
    rows = [(r.doc_id, r.text) for r in train.collect()]
    total, freq = Counter(), Counter()
    for _, text in rows:
        total.update(grams(text, longest))
        freq.update(set(grams(text, longest)))
    n = len(rows)
    low, high = max(2, math.floor(n * 0.01)), math.floor(n * 0.95)
    top = sorted((g for g in total if low <= freq[g] <= high), key=lambda g: (-total[g], g))[:400]
    vocab = cut(ngram_vocabulary(train, options))
    got = vocab.orderBy("index").collect()
    assert [r.word for r in got] == top
    assert all(r.n == r.word.count(" ") + 1 and r.doc_freq == freq[r.word] for r in got)
    want = {
        (i, g, c) for i, text in rows for g, c in Counter(grams(text, longest)).items() if g in set(top)
    }
    weights = ngram_tfidf(train, vocab, options).collect()
    assert {(r.doc_id, r.word, r.tf) for r in weights} == want and len(weights) == len(want)
    assert all(math.isclose(r.idf, math.log((n + 1) / (freq[r.word] + 1))) for r in weights)


def test_classifier_over_ngrams_is_saved_and_scores(spark, train, tmp_path):
    options = Options(feature_ngrams=2, max_features=300)
    model = pipeline.fit_classifier(train, "naive_bayes", options)
    pipeline.save_model(model, str(tmp_path / "m"))
    again = pipeline.load_model(spark, str(tmp_path / "m"))
    docs = spark.createDataFrame([("",), ("one",), (None,), ("of the",)], "text string")
    assert again.transform(docs).select("prediction").count() == 4
    assert any(" " in word for word in again.stages[1].vocabulary)
    tuned = tuning.cross_validate(train, "naive_bayes", Options(feature_ngrams=2, max_features=50, cv_folds=2))
    assert len(tuned.averages) == 3


# --- labels beyond two --------------------------------------------------------------------


def three(spark):
    rows = [(0, 0, 0.7, 0.2, 0.1), (1, 1, 0.1, 0.8, 0.1), (2, 1, 0.2, 0.5, 0.3), (None, 0, 1.0, 0.0, 0.0)]
    return spark.createDataFrame(
        rows, "label int, prediction int, probability_0 double, probability_1 double, probability_2 double"
    )


def test_log_loss_of_three_labels(spark):
    want = -sum(map(math.log, (0.7, 0.8, 0.3))) / 3
    assert math.isclose(metrics.log_loss(three(spark)).first().value, want)
    two = three(spark).select(
        "label", F.col("probability_0").alias("probability_negative"), F.col("probability_1").alias("probability_positive")
    )
    with pytest.raises(Exception, match="no probability column for label 2"):
        metrics.log_loss(two).collect()


def test_one_score_ranks_two_labels_only(spark):
    with pytest.raises(Exception, match="labels 0 and 1"):
        metrics.area_under_roc(three(spark), "probability_1").collect()
    with pytest.raises(ValueError, match="labels 0 and 1"):
        evaluation.exact_auc(three(spark), "probability_1")
    some = three(spark).filter("label is null or label < 2")
    assert metrics.area_under_roc(some, "probability_1").first().value == 1.0


def test_too_many_classes_are_refused_when_scoring(spark, monkeypatch):
    monkeypatch.setattr(bayes, "MOST_CLASSES", 3)
    priors = spark.createDataFrame([(i, -1.0) for i in range(4)], "label int, log_prior double")
    weights = spark.createDataFrame([], "word string, label int, idf double, theta_bow double, theta_tfidf double")
    docs = spark.createDataFrame([(1, "a word")], "doc_id long, text string")
    with pytest.raises(ValueError, match="classes"):
        bayes.score_classes(docs, priors, weights)


# --- n-grams by batch ---------------------------------------------------------------------


def test_ngrams_of_slices_and_of_large_part_tables_are_the_same(spark, train, monkeypatch):
    options = Options(feature_ngrams=3, max_features=400)
    whole = ngram_vocabulary(train, options).collect()
    weights = {tuple(r) for r in ngram_tfidf(train, cut(ngram_vocabulary(train, options)), options).collect()}
    monkeypatch.setattr(ngrams, "is_small", lambda *_: False)
    assert ngram_vocabulary(train, options).collect() == whole
    monkeypatch.undo()
    monkeypatch.setattr(batch_grams, "SLICE_BYTES", 2_000)
    assert ngram_vocabulary(train, options).collect() == whole
    vocab = cut(ngram_vocabulary(train, options))
    assert {tuple(r) for r in ngram_tfidf(train, vocab, options).collect()} == weights


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 2), (1, 3), (3, 3)])
def test_ngram_counts_of_any_range(spark, low, high):
    texts = ["", "of", "film", "Film film good film", "the one of film", None, "İ Été film", "x" * 51]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    want = Counter()
    for text in filter(None, texts):
        words = [w for w in text.lower().split(" ") if 2 <= len(w) <= 50 and w not in STOPWORDS]
        for n in range(low, high + 1):
            want.update((n, " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    got = pairs.ngram_counts(docs, Options(ngram_range=(low, high))).collect()
    assert {(r.n, r.gram): r.total_count for r in got} == want and len(got) == len(want)


def test_ngrams_are_not_spelled_out_row_by_row(spark, train):
    """The array functions that joined and sorted each occurrence made these jobs slow."""
    options = Options(feature_ngrams=2)
    parts = train.sparkSession.createDataFrame([("film",)], "word string")
    for frame in (
        ngrams.frequent_grams(train, 2, parts, F.lit(1), options),
        ngram_tfidf(train, ngram_vocabulary(train, options), options),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(step in plan for step in ("array_join", "posexplode", "sort_array"))
