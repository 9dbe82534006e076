"""Entry points: the flagship query, all registered queries, and their SQL counterparts."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import ORACLES
from wordloom import Options
from wordloom.functions import cleaning as C
from wordloom.operators import bayes, metrics, ngrams, pairs, sequences, splits, tfidf, wordstats
from wordloom.plans import evaluation, pipeline, scoring, training, tuning
from wordloom.plans.runlog import RunLog, compare_runs
from wordloom.session import cut, new_folder
from wordloom.sources import reviews as R
from wordloom.sources import sinks, stages
from wordloom.sources.split_csv import read_split_csv
from wordloom.streaming.scoring import arriving_texts, start_scoring

SMALLEST = "/root/testdata/sf0.001"
DEFAULTS = Options()
METRIC_PLACES = 4


def entry(spark: SparkSession) -> DataFrame:
    """The most frequent words of all texts with their total and document counts."""
    return vocabulary_topk(spark, SMALLEST)


# --- tables -------------------------------------------------------------------------------


def clean_documents(spark, folder):
    return C.with_clean_text(R.documents(spark, folder))


def light_documents(spark, folder):
    return C.with_clean_text(R.documents(spark, folder), C.light_clean)


def pages(spark, folder):
    return R.read_table(spark, folder, "pages").select("page_id", F.col("html").alias("text"))


def train_test(spark, folder):
    """Cleaned reviews, prepared once and stored by split, as every later pass reads them."""
    docs = R.labelled(R.clean_reviews(spark, folder))
    split = F.when(splits.is_validation(F.col("doc_id")), "test").otherwise("train")
    path = new_folder(spark, "prepared")
    stages.write_prepared(docs.withColumn("split", split), path)
    return (
        stages.read_prepared(spark, path, "train").drop("split"),
        stages.read_prepared(spark, path, "test").drop("split"),
    )


def rounded(df: DataFrame, places: int = 6, **exceptions: int) -> DataFrame:
    """Doubles to a fixed number of places, so that summation order does not show."""
    return df.select(
        *[
            F.round(name, exceptions.get(name, places)).alias(name) if kind == "double" else name
            for name, kind in df.dtypes
        ]
    )


# --- scans and cleaning -------------------------------------------------------------------


def reviews_typed(spark, folder):
    return R.reviews(spark, folder)


def clean_steps(spark, folder):
    text = F.col("text")
    return R.documents(spark, folder).select(
        "doc_id",
        C.trim_spaces(text).alias("trimmed"),
        C.breaks_to_spaces(text).alias("without_breaks"),
        C.punctuation_to_spaces(text).alias("without_punctuation"),
        C.collapse_spaces(text).alias("collapsed"),
    )


def mixed_labels(spark, folder):
    """Reviews whose label is a text that is not always a number."""
    labels = R.read_table(spark, folder, "labels").select("doc_id", "quality")
    docs = R.read_table(spark, folder, "documents").select("doc_id", "text", "source")
    label = F.when(F.col("doc_id") % 10 == 3, F.col("source")).otherwise(
        F.col("quality").cast("string")
    )
    rows = docs.join(labels, "doc_id").select("doc_id", "text", label.alias("label"))
    return R.typed_reviews(rows, "doc_id")


def mixed_labels_typed(spark, folder):
    return mixed_labels(spark, folder).select("doc_id", "label")


def label_rejects(spark, folder):
    return R.rejects(mixed_labels(spark, folder))


def page_steps(spark, folder):
    text = F.col("text")
    return pages(spark, folder).select(
        "page_id",
        C.trim_spaces(text).alias("trimmed"),
        C.breaks_to_spaces(text).alias("without_breaks"),
        C.punctuation_to_spaces(text).alias("without_punctuation"),
        C.collapse_spaces(text).alias("collapsed"),
    )


def page_classic(spark, folder):
    return C.with_clean_text(pages(spark, folder))


def page_pipeline_cleaning(spark, folder):
    clean = F.expr(C.classic_clean_sql("text"))
    return pages(spark, folder).select("page_id", clean.alias("text"))


def blanked(spark, folder, pattern, by):
    """Documents of which every fifth is rid of what the pattern finds."""
    text = F.when(F.col("doc_id") % 5 == 0, F.regexp_replace("text", pattern, by))
    return R.documents(spark, folder).withColumn("text", text.otherwise(F.col("text")))


def clean_blanked(spark, folder):
    return C.with_clean_text(blanked(spark, folder, r"\w+", ".")).select("doc_id", "text")


def blanked_status(spark, folder):
    texts = blanked(spark, folder, r"[^\x20\n]", "")
    return texts.select("doc_id", C.input_status(F.col("text")).alias("status"))


def clean_classic(spark, folder):
    return R.clean_reviews(spark, folder)


def clean_unicode(spark, folder):
    return C.with_clean_text(
        R.documents(spark, folder), lambda text: C.classic_clean(text, unicode=True)
    )


def clean_light_pages(spark, folder):
    return C.with_clean_text(pages(spark, folder), C.light_clean)


def tags_stripped(spark, folder):
    return pages(spark, folder).select("page_id", C.strip_tags(F.col("text")).alias("text"))


def input_status(spark, folder):
    turns = R.read_table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", C.input_status(F.col("text")).alias("status"))


def csv_reviews(spark, folder):
    path = new_folder(spark, "csv")
    sinks.write_table(R.reviews(spark, folder).select("text", "label"), path)
    table = R.load_reviews(spark, path, "train").drop("doc_id")
    return table.withColumn("split", F.col("split").cast("string"))


def csv_split_documents(spark, folder):
    """All documents written as delimited files, with the line breaks and quotes of their texts,
    and read back by as many tasks as the files have blocks."""
    path = new_folder(spark, "csv")
    sinks.write_table(R.read_table(spark, folder, "documents").select("doc_id", "text", "source"), path)
    table = read_split_csv(spark, path)
    return table.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def prepared_by_split(spark, folder):
    labels = R.read_table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    docs = clean_documents(spark, folder).join(labels, "doc_id", "left")
    held_out = splits.is_validation(F.col("doc_id"))
    split = F.when(F.col("label").isNull(), "unsupervised").otherwise(
        F.when(held_out, "test").otherwise("train")
    )
    table = stages.write_prepared(docs.withColumn("split", split), new_folder(spark, "prepared"))
    return table.withColumn("split", F.col("split").cast("string"))


# --- words --------------------------------------------------------------------------------


def tokens(spark, folder):
    return pairs.tokens(R.clean_reviews(spark, folder), "doc_id")


def tokens_nostop(spark, folder):
    return pairs.without_stopwords(tokens(spark, folder))


def tokens_normalised(spark, folder):
    words = pairs.tokens(R.reviews(spark, folder), "doc_id").drop("pos")
    return pairs.normalised(words)


def tokens_by_length(spark, folder):
    return pairs.of_word_length(tokens(spark, folder))


def map_phase(spark, folder):
    return pairs.map_phase(R.clean_reviews(spark, folder), cleaned=True)


def map_phase_raw_text(spark, folder):
    return pairs.map_phase(R.reviews(spark, folder))


def bigrams(spark, folder):
    only_pairs = Options(ngram_range=(2, 2))
    return pairs.ngram_pairs(R.clean_reviews(spark, folder), only_pairs).drop("n")


def ngram_counts(spark, folder):
    return pairs.ngram_counts(clean_documents(spark, folder))


# --- word statistics ----------------------------------------------------------------------


def document_pairs(spark, folder):
    return pairs.map_phase(clean_documents(spark, folder), DEFAULTS, "doc_id", cleaned=True)


def word_count(spark, folder):
    return wordstats.total_counts(document_pairs(spark, folder))


def doc_freq(spark, folder):
    counts = wordstats.word_counts(clean_documents(spark, folder))
    return counts.select("word", "doc_freq")


def doc_total(spark, folder):
    return wordstats.doc_total(clean_documents(spark, folder))


def count_join_df(spark, folder):
    return wordstats.word_counts(clean_documents(spark, folder))


def reduce_phase_pairs(spark, folder):
    return wordstats.reduce_counts(map_phase(spark, folder))


def df_bounds(spark, folder):
    return wordstats.bounded_counts(clean_documents(spark, folder))[0]


def vocabulary_topk(spark, folder):
    return wordstats.vocabulary(clean_documents(spark, folder))


def vocabulary_words(spark, folder):
    words = wordstats.vocabulary_list(wordstats.vocabulary(R.clean_reviews(spark, folder)))
    return spark.createDataFrame(list(enumerate(words)), "position bigint, word string")


def word_stats(spark, folder):
    return rounded(wordstats.word_statistics(vocabulary_topk(spark, folder)))


def label_summary(spark, folder):
    return wordstats.label_summary(R.clean_reviews(spark, folder))


def text_length_stats(spark, folder):
    return rounded(wordstats.length_statistics(light_documents(spark, folder)))


def role_length_stats(spark, folder):
    turns = R.read_table(spark, folder, "conversations").select("role", "text")
    return rounded(wordstats.length_statistics(C.with_clean_text(turns, C.light_clean), "role"))


def id_vocabulary(spark, folder):
    return sequences.id_vocabulary(light_documents(spark, folder)).select("word", "word_id")


def id_sequences(spark, folder):
    docs = light_documents(spark, folder)
    encoded = sequences.id_sequences(docs, sequences.id_vocabulary(docs))
    return encoded.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"),
    )


# --- features -----------------------------------------------------------------------------


def tf(spark, folder):
    docs = R.clean_reviews(spark, folder)
    return tfidf.bag_of_words(docs, tfidf.feature_vocabulary(docs))


def idf(spark, folder):
    return rounded(tfidf.feature_vocabulary(clean_documents(spark, folder)))


def tfidf_unsupervised_vocabulary(spark, folder):
    """Words and weights from all texts, labelled or not; vectors for the labelled ones."""
    vocab = tfidf.feature_vocabulary(clean_documents(spark, folder))
    return rounded(tfidf.tfidf(R.clean_reviews(spark, folder), vocab))


def tfidf_table(spark, folder):
    docs = R.clean_reviews(spark, folder)
    return rounded(tfidf.tfidf(docs, tfidf.feature_vocabulary(docs)))


def assembled_features(spark, folder):
    docs = R.clean_reviews(spark, folder)
    model = pipeline.fit_features(docs, DEFAULTS, pipeline.fit_vocabulary(docs))
    vectors = pipeline.prepare(model, docs, "doc_id")
    stored = stages.write_features(vectors, new_folder(spark, "features"))
    return rounded(scoring.vector_entries(stored, "features", "doc_id"))


TWO_WORDS = Options(feature_ngrams=2)


def ngram_vocabulary(spark, folder):
    return rounded(ngrams.ngram_vocabulary(clean_documents(spark, folder), TWO_WORDS))


def ngram_tfidf(spark, folder):
    docs = R.clean_reviews(spark, folder)
    return rounded(ngrams.ngram_tfidf(docs, ngrams.ngram_vocabulary(docs, TWO_WORDS), TWO_WORDS))


def ngram_features(spark, folder):
    """Vectors of words and word pairs from the pipeline that is saved, raw text in."""
    docs = R.clean_reviews(spark, folder)
    vocab = pipeline.fit_vocabulary(docs, TWO_WORDS)
    model = pipeline.fit_features(docs, TWO_WORDS, vocab)
    vectors = pipeline.prepare(model, R.reviews(spark, folder), "doc_id")
    return rounded(scoring.vector_entries(vectors, "features", "doc_id"))


def hash_split(spark, folder):
    docs = splits.with_fold(R.clean_reviews(spark, folder))
    return docs.select(
        "doc_id", splits.is_validation(F.col("doc_id")).alias("validation"), "fold"
    )


# --- models -------------------------------------------------------------------------------


def fitted_tables(train, options=DEFAULTS):
    vocab = tfidf.feature_vocabulary(train, options)
    return (
        bayes.class_priors(train, options),
        bayes.word_likelihoods(train, vocab, options),
    )


def nb_priors(spark, folder):
    train, _ = train_test(spark, folder)
    return rounded(bayes.class_priors(train))


def nb_likelihoods(spark, folder):
    train, _ = train_test(spark, folder)
    return rounded(fitted_tables(train)[1].drop("idf"))


def document_scores(spark, folder, options=DEFAULTS):
    train, _ = train_test(spark, folder)
    return bayes.score(clean_documents(spark, folder), *fitted_tables(train, options))


def nb_bow_scores(spark, folder):
    return rounded(document_scores(spark, folder, Options(use_tfidf=False)).drop("margin"))


def nb_tfidf_scores(spark, folder):
    train, _ = train_test(spark, folder)
    model = pipeline.fit_classifier(train, "naive_bayes", Options(use_bow=False))
    return rounded(scoring.score_table(model, raw_documents(spark, folder), "doc_id"))


def nb_scores(spark, folder):
    return rounded(document_scores(spark, folder), margin=5)


def held_out_scores(spark, folder, options=DEFAULTS):
    train, test = train_test(spark, folder)
    return bayes.score(test, *fitted_tables(train, options), "doc_id", "label")


def sentiment_labels(spark, folder):
    return scoring.presented(document_scores(spark, folder), "doc_id")


def confusion(spark, folder):
    return metrics.confusion(held_out_scores(spark, folder))


def confusion_wide(spark, folder):
    return metrics.confusion_wide(confusion(spark, folder))


def metrics_accuracy_prf(spark, folder):
    return rounded(metrics.weighted_scores(confusion(spark, folder)))


def auc_rank(spark, folder):
    scores = held_out_scores(spark, folder).withColumn("margin", F.round("margin", 6))
    return rounded(metrics.area_under_roc(scores, "margin"))


def log_loss(spark, folder):
    return rounded(metrics.log_loss(held_out_scores(spark, folder)))


def fitted_pipeline(spark, folder, algorithm=None) -> PipelineModel:
    train, _ = train_test(spark, folder)
    return pipeline.fit_classifier(train, algorithm)


def raw_documents(spark, folder):
    return scoring.usable(R.documents(spark, folder))


def pipeline_scores(spark, folder, algorithm):
    model = fitted_pipeline(spark, folder, algorithm)
    return rounded(scoring.score_table(model, raw_documents(spark, folder), "doc_id"))


def nb_pipeline_scores(spark, folder):
    return pipeline_scores(spark, folder, "naive_bayes")


def lr_scores(spark, folder):
    return pipeline_scores(spark, folder, "logistic_regression")


def rf_scores(spark, folder):
    return pipeline_scores(spark, folder, "random_forest")


def saved_model_scores(spark, folder):
    path = new_folder(spark, "model")
    pipeline.save_model(fitted_pipeline(spark, folder), path)
    model = pipeline.load_model(spark, path)
    return rounded(scoring.score_table(model, raw_documents(spark, folder), "doc_id"))


def predictions_csv(spark, folder):
    model = fitted_pipeline(spark, folder)
    scores = scoring.score_table(model, raw_documents(spark, folder), "doc_id", "text")
    path = new_folder(spark, "predictions")
    sinks.write_predictions(scores, path, "doc_id")
    stored = R.read_csv(spark, path)
    return rounded(
        stored.select(
            F.col("doc_id").cast("bigint"),
            "text",
            F.col("prediction").cast("int"),
            F.col("probability_negative").cast("double"),
            F.col("probability_positive").cast("double"),
        )
    )


ALL_METRICS = ("accuracy", "precision", "recall", "f1", "auc", "auc_raw", "log_loss")


def measured(spark, values):
    table = spark.createDataFrame(list(values.items()), "metric string, value double")
    return table.select("metric", F.round("value", METRIC_PLACES).alias("value"))


def evaluate_pipeline(spark, folder):
    train, test = train_test(spark, folder)
    model = pipeline.fit_classifier(train)
    return measured(spark, evaluation.evaluate(model, test, ALL_METRICS))


def smoothing_scores(spark, folder):
    """(smoothing, held-out scores): one prepared corpus and one vocabulary for all of them."""
    train, test = train_test(spark, folder)
    vocab = cut(tfidf.feature_vocabulary(train))
    for smoothing in (0.5, 1.0, 2.0):
        options = Options(smoothing=smoothing)
        tables = bayes.class_priors(train, options), bayes.word_likelihoods(train, vocab, options)
        yield smoothing, bayes.score(test, *tables, "doc_id", "label")


def best_step(spark, folder):
    log = RunLog(spark, new_folder(spark, "runs"))
    for step, (_, scores) in enumerate(smoothing_scores(spark, folder)):
        named = metrics.log_loss(scores).withColumn("metric", F.lit("val_loss"))
        log.log_metric_table("smoothing", named, step)
    return rounded(metrics.best_step(log.table("run_metrics")))


def compare_smoothings(spark, folder):
    log = RunLog(spark, new_folder(spark, "runs"))
    runs = []
    for smoothing, scores in smoothing_scores(spark, folder):
        runs.append(f"smoothing_{round(10 * smoothing)}")
        scores = cut(scores)
        log.log_metric_table(runs[-1], metrics.weighted_scores(metrics.confusion(scores)))
        log.log_metric_table(runs[-1], metrics.log_loss(scores))
    return rounded(compare_runs(log.table("run_metrics"), runs))


def by_language(spark, folder):
    """Documents with one of three labels: English, German or another language."""
    label = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).otherwise(2)
    docs = R.read_table(spark, folder, "documents").select("doc_id", "text", label.alias("label"))
    return C.with_clean_text(docs)


def nb_three_classes(spark, folder):
    docs = by_language(spark, folder)
    train, test = splits.train_validation(docs)
    scores = bayes.score_classes(test.drop("label"), *fitted_tables(train))
    return rounded(scores, joint=4)


FEW = Options(max_features=20, use_tfidf=False)


def few_features(train):
    """Training vectors of twenty word counts, and the words."""
    vocab = pipeline.fit_vocabulary(train, FEW)
    features = pipeline.fit_features(train, FEW, vocab, cleaned=True)
    return pipeline.placed(pipeline.prepare(features, train, "doc_id"), FEW), vocab.words


def word_table(spark, words):
    return spark.createDataFrame(list(enumerate(words)), "index int, word string")


def lr_optimality(spark, folder):
    """How far the fitted regression is from its optimum, by feature: the derivative of the
    regularised loss in the feature's weight, in units of its standard deviation."""
    vectors, words = few_features(train_test(spark, folder)[0])
    estimator = pipeline.create_classifier("logistic_regression", FEW)
    model = estimator.fit(vectors)
    scored = model.transform(vectors)
    miss = F.get(F.unwrap_udt("probability")["values"], F.lit(1)) - F.col("label")
    entries = scoring.vector_entries(scored.withColumn("miss", miss), "features", "doc_id", "miss")
    n = vectors.count()
    sums = entries.groupBy("index").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.col("miss") * F.col("value")).alias("slope"),
        F.sum("value").alias("total"),
        F.sum(F.col("value") * F.col("value")).alias("squares"),
    )
    weights = spark.createDataFrame(
        list(enumerate(map(float, model.coefficients.toArray()))), "index int, weight double"
    )
    variance = (F.col("squares") - F.col("total") * F.col("total") / n) / (n - 1)
    slope = F.col("slope") / n + F.lit(estimator.getRegParam()) * variance * F.col("weight")
    both = sums.join(weights, "index").join(word_table(spark, words), "index")
    residual = F.round(F.abs(slope) / F.sqrt(variance), 3)
    return both.select("index", "word", "n_docs", residual.alias("residual"))


def forest_stump(spark, folder):
    """A forest of one tree of depth one, over all rows and features, that tells English texts from
    others: the best Gini split. Of equal splits the feature with the lower index, then the lower
    threshold, is taken."""
    docs = by_language(spark, folder).withColumn("label", F.least("label", F.lit(1)))
    vectors, words = few_features(splits.train_validation(docs)[0])
    forest = RandomForestClassifier(
        numTrees=1, maxDepth=1, maxBins=1024, featureSubsetStrategy="all", bootstrap=False, seed=42
    )
    tree = forest.fit(vectors).trees[0].toDebugString
    feature, threshold = re.search(r"If \(feature (\d+) <= ([\d.E+-]+)\)", tree).groups()
    chosen = F.lit(int(feature))
    entries = scoring.vector_entries(vectors, "features", "doc_id").filter(F.col("index") == chosen)
    rows = vectors.select("doc_id", "label").join(entries, "doc_id", "left")
    left = F.coalesce("value", F.lit(0.0)) <= float(threshold)
    cells = [
        F.count_if((left if side == "left" else ~left) & (F.col("label") == label)).alias(f"{side}_{label}")
        for side in ("left", "right")
        for label in (0, 1)
    ]
    counts = rows.agg(*cells)
    return counts.select(
        F.lit(words[int(feature)]).alias("word"), F.lit(float(threshold)).alias("threshold"), "*"
    )


def training_run(spark, folder):
    """The parameters that the training job logs after tuning, with unlabelled texts for the words
    and labels that are not all numbers."""
    labels = C.with_clean_text(mixed_labels(spark, folder))
    held_out = splits.is_validation(F.col("doc_id"))
    unlabelled = clean_documents(spark, folder).join(labels, "doc_id", "left_anti")
    log = RunLog(spark, new_folder(spark, "runs"))
    training.train(
        labels.filter(~held_out), labels.filter(held_out), log, "tuned",
        unsupervised=unlabelled, tune=True,
    )
    return log.table("run_params")


def cv_naive_bayes(spark, folder):
    tuned = tuning.cross_validate(R.clean_reviews(spark, folder), "naive_bayes")
    rows = [
        (point["smoothing"], average) for point, average in zip(tuned.grid, tuned.averages)
    ]
    return rounded(spark.createDataFrame(rows, "smoothing double, accuracy double"))


def compare_models(spark, folder):
    train, test = train_test(spark, folder)
    log = RunLog(spark, new_folder(spark, "runs"))
    runs = ["naive_bayes", "logistic_regression", "random_forest"]
    vocab = pipeline.fit_vocabulary(train)
    for name in runs:
        model = pipeline.fit_classifier(train, name, DEFAULTS, vocab)
        evaluation.evaluate(model, test, DEFAULTS.metrics, log, name)
    return rounded(compare_runs(log.table("run_metrics"), runs))


def batch_udf_scores(spark, folder):
    """The Naive Bayes weights as a plain NumPy model that knows nothing of Spark."""
    model = fitted_pipeline(spark, folder)
    fitted: NaiveBayesModel = model.stages[-1]
    weights, bias = np.ascontiguousarray(fitted.theta.toArray().T), fitted.pi.toArray()
    features = PipelineModel(model.stages[:-1])
    vectors = features.transform(raw_documents(spark, folder)).select("doc_id", "features")
    logits = scoring.linear_logits(F.col("features"), weights, bias)
    scored = scoring.with_softmax(vectors.select("doc_id", logits.alias("logits")), "logits")
    return rounded(scored)


def sequence_udf_scores(spark, folder):
    """An outside model over fixed-length ids: a sum of one weight per id, ids being places in
    the feature vocabulary, which bounds the weights that travel to the workers."""
    train, _ = train_test(spark, folder)
    options = Options(use_tfidf=False)
    model = pipeline.fit_classifier(train, "naive_bayes", options)
    fitted, words = model.stages[-1], model.stages[1].vocabulary
    first = len(sequences.RESERVED)
    weights = np.zeros((first + len(words), 2))
    weights[first:] = fitted.theta.toArray().T
    bias = fitted.pi.toArray()
    encoded = sequences.bounded_id_sequences(clean_documents(spark, folder), words, options)

    def make_predict():
        def predict(ids, mask):
            return (weights[ids.astype(int)] * mask[:, :, None]).sum(axis=1) + bias

        return predict

    call = scoring.sequence_logits(make_predict, options.sequence_length)
    logits = call("input_ids", "attention_mask").alias("logits")
    return rounded(scoring.with_softmax(encoded.select("doc_id", logits), "logits"))


def evaluate_saved_model(spark, folder):
    train, _ = train_test(spark, folder)
    model_path, test_path = new_folder(spark, "model"), new_folder(spark, "test")
    pipeline.save_model(pipeline.fit_classifier(train), model_path)
    held_out = R.reviews(spark, folder).filter(splits.is_validation(F.col("doc_id")))
    sinks.write_table(held_out.select("text", "label"), test_path)
    return measured(spark, evaluation.evaluate_saved(spark, model_path, test_path, ALL_METRICS))


def stream_scores(spark, folder):
    model = fitted_pipeline(spark, folder)
    # As a pattern the path may be one file or a folder of files.
    texts = arriving_texts(spark, f"{folder}/documents.parquet*", "doc_id bigint, text string")
    output = new_folder(spark, "stream-scores")
    query = start_scoring(
        model, texts, output, new_folder(spark, "stream-state"), "doc_id", available_now=True
    )
    query.awaitTermination()
    columns = ["doc_id", "prediction", "probability_negative", "probability_positive"]
    return rounded(spark.read.parquet(output).select(*columns))


QUERIES = {
    f.__name__: f
    for f in (
        reviews_typed, clean_steps, clean_classic, clean_unicode, clean_light_pages,
        tags_stripped, input_status, csv_reviews, prepared_by_split,
        tokens, tokens_nostop, tokens_normalised, tokens_by_length, map_phase,
        map_phase_raw_text, bigrams, ngram_counts,
        word_count, doc_freq, doc_total, count_join_df, reduce_phase_pairs, df_bounds,
        vocabulary_topk, vocabulary_words, word_stats, label_summary, text_length_stats,
        role_length_stats, id_vocabulary, id_sequences,
        tf, idf, assembled_features, hash_split,
        nb_priors, nb_likelihoods, nb_scores, sentiment_labels, confusion, confusion_wide,
        metrics_accuracy_prf, auc_rank, log_loss, nb_pipeline_scores, lr_scores, rf_scores,
        saved_model_scores, predictions_csv, evaluate_pipeline, best_step, cv_naive_bayes,
        compare_models, batch_udf_scores, sequence_udf_scores, stream_scores,
        mixed_labels_typed, label_rejects, page_steps, page_classic, page_pipeline_cleaning,
        clean_blanked, blanked_status, compare_smoothings, nb_three_classes, lr_optimality,
        forest_stump, training_run,
        csv_split_documents, ngram_vocabulary, ngram_tfidf, ngram_features,
        nb_bow_scores, nb_tfidf_scores, tfidf_unsupervised_vocabulary, evaluate_saved_model,
    )
}
QUERIES["tfidf"] = tfidf_table
SQL = dict(ORACLES)

try:
    import corpus_pipeline
    from wordloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The training-data operators are an optional folder; anything else that is missing is not.
    if not str(missing.name).startswith(("corpus_pipeline", "wordloom.llm")):
        raise
else:
    QUERIES |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    SQL |= llm_queries.ORACLES
    if corpus_pipeline.ORACLE_SQL:
        SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
