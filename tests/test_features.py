import math

import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import functions as F

from wordloom import Options
from wordloom.operators import bayes, splits, tfidf
from wordloom.plans import pipeline, scoring


def rounded(df, places=8):
    return {
        tuple(r)[:-1]: round(r[-1], places) for r in df.collect()
    }


def test_vectors_agree_with_the_tables(train):
    vocab_table = tfidf.feature_vocabulary(train)
    vocab = pipeline.fit_vocabulary(train)
    vectors = pipeline.fit_features(train, vocab=vocab).transform(train)
    index = vocab_table.select("word", "index")
    for column, value in (("bow_features", "tf"), ("tfidf_features", "tfidf")):
        entries = scoring.vector_entries(vectors, column, "doc_id").join(index, "index")
        table = tfidf.tfidf(train, vocab_table).filter(F.col(value) != 0)
        assert rounded(entries.select("doc_id", "word", "value")) == rounded(
            table.select("doc_id", "word", F.col(value).cast("double"))
        )


def test_scaling_vector_is_the_fitted_idf(train):
    vocab = pipeline.fit_vocabulary(train)
    stages = pipeline.feature_stages(Options(), vocab)
    counts = Pipeline(stages=stages[:2]).fit(train).transform(train)
    fitted = IDF(inputCol="bow_features", outputCol="x").fit(counts)
    assert isinstance(stages[1], CountVectorizerModel)
    assert max(abs(a - b) for a, b in zip(fitted.idf.toArray(), vocab.idf)) < 1e-12


def test_unseen_words_leave_the_vector_length_alone(spark, train):
    vocab = pipeline.fit_vocabulary(train)
    features = pipeline.fit_features(train, vocab=vocab)
    other = spark.createDataFrame([(1, "zzzz unseen", 0)], "doc_id long, text string, label int")
    vector = features.transform(other).first().features
    assert vector.size == 2 * len(vocab.words) and vector.numNonzeros() == 0


@pytest.mark.parametrize(
    ("bow", "weighted", "info", "blocks"),
    [(True, True, "bow_tfidf", 2), (True, False, "bow", 1), (False, True, "tfidf", 1)],
)
def test_feature_switches(train, bow, weighted, info, blocks):
    options = Options(use_bow=bow, use_tfidf=weighted)
    vocab = pipeline.fit_vocabulary(train, options)
    features = pipeline.fit_features(train, options, vocab)
    assert options.feature_info == info
    assert features.transform(train).first().features.size == blocks * len(vocab.words)


def test_no_features_is_an_error():
    with pytest.raises(ValueError, match="feature blocks"):
        pipeline.feature_stages(Options(use_bow=False, use_tfidf=False))


def test_vocabulary_fitted_inside_the_pipeline(train):
    features = pipeline.fit_features(train, Options(max_features=50))
    assert features.transform(train).first().features.size == 100
    words = features.stages[2].vocabulary
    assert "the" not in words and "" not in words


@pytest.mark.parametrize(
    "options",
    [Options(), Options(use_bow=False), Options(use_tfidf=False), Options(smoothing=0.5)],
    ids=["both", "tfidf", "bow", "smoothing"],
)
def test_closed_form_bayes_is_the_ml_model(train, options):
    vocab_table = tfidf.feature_vocabulary(train, options)
    priors = bayes.class_priors(train, options)
    weights = bayes.word_likelihoods(train, vocab_table, options)
    model = pipeline.fit_classifier(train, "naive_bayes", options)
    fitted = model.stages[-1]
    for row in priors.collect():
        assert math.isclose(row.log_prior, fitted.pi[row.label], rel_tol=1e-12)
    theta = fitted.theta.toArray()
    size = vocab_table.count()
    for row in weights.join(vocab_table.select("word", "index"), "word").limit(200).collect():
        at = 0
        for block in options.feature_blocks:
            expected = theta[row.label][row["index"] + at * size]
            assert math.isclose(row[f"theta_{block}"], expected, rel_tol=1e-9)
            at += 1
    table = bayes.score(train, priors, weights).select("doc_id", "probability_positive")
    scored = scoring.score_table(model, train, "doc_id").select("doc_id", "probability_positive")
    assert rounded(table, 6) == rounded(scored, 6)


def test_closed_form_of_three_classes_is_the_ml_model(train):
    three = train.withColumn("label", (F.col("doc_id") % 3).cast("int"))
    vocab = tfidf.feature_vocabulary(three)
    priors, weights = bayes.class_priors(three), bayes.word_likelihoods(three, vocab)
    assert priors.count() == 3 and weights.select("label").distinct().count() == 3
    model = pipeline.fit_classifier(three, "naive_bayes")
    scored = scoring.score_table(model, three, "doc_id").collect()
    want = {(r.doc_id, k): round(r[f"probability_{k}"], 6) for r in scored for k in range(3)}
    table = bayes.score_classes(three.drop("label"), priors, weights)
    assert {(r.doc_id, r.label): round(r.probability, 6) for r in table.collect()} == want
    with pytest.raises(Exception, match="labels 0 and 1"):
        bayes.score(three, priors, weights).collect()


def test_shares_that_are_no_whole_percents(spark):
    many = spark.range(50_000).select(F.col("id").alias("doc_id"))
    for share in (0.125, 0.004):
        held_out = splits.train_validation(many, Options(test_size=share))[1].count()
        assert abs(held_out / 50_000 - share) < 0.005 and held_out > 0


def test_text_without_known_words_is_scored_by_the_priors(spark, train):
    vocab = tfidf.feature_vocabulary(train)
    priors, weights = bayes.class_priors(train), bayes.word_likelihoods(train, vocab)
    other = spark.createDataFrame([(1, "zzzz unseen")], "doc_id long, text string")
    row = bayes.score(other, priors, weights).first()
    share = train.filter("label = 1").count() + 1
    assert math.isclose(row.probability_positive, share / (train.count() + 2), rel_tol=1e-9)


def test_splits_are_stable_and_complete(spark, train):
    a, b = splits.train_validation(train)
    assert a.count() + b.count() == train.count() and 0 < b.count() < a.count()
    shuffled = train.repartition(3, "text")
    assert rows(splits.train_validation(shuffled)[1].select("doc_id")) == rows(b.select("doc_id"))
    many = spark.range(20_000).select(F.col("id").alias("doc_id"))
    share = splits.train_validation(many)[1].count() / 20_000
    assert abs(share - 0.2) < 0.01
    folds = rows(splits.with_fold(many).groupBy("fold").count())
    assert len(folds) == 5 and all(abs(n - 4_000) < 250 for _, n in folds)
