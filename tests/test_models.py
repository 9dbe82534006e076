import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wordloom import Options
from wordloom.functions.cleaning import with_clean_text
from wordloom.operators import sequences, splits
from wordloom.plans import evaluation, pipeline, scoring, training, tuning
from wordloom.plans.runlog import RunLog
from wordloom.sources import sinks, stages
from wordloom.sources.reviews import labelled, read_csv
from wordloom.streaming.scoring import arriving_texts, scored_stream, start_scoring

SMALL = Options(max_features=200)


def test_classifier_by_name(spark):
    assert pipeline.create_classifier().getSmoothing() == 1.0
    regression = pipeline.create_classifier("logistic_regression")
    assert (regression.getMaxIter(), regression.getRegParam()) == (100, 0.01)
    forest = pipeline.create_classifier("random_forest")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 10, 42)
    assert pipeline.create_classifier(options=Options(algorithm="random_forest")).getNumTrees()
    with pytest.raises(ValueError, match="no classifier 'none'"):
        pipeline.create_classifier("none")


@pytest.mark.parametrize(
    ("name", "size"), [("naive_bayes", 3), ("logistic_regression", 9), ("random_forest", 9)]
)
def test_grid_sizes(spark, name, size):
    assert len(tuning.param_grid(pipeline.create_classifier(name), name)) == size


def test_unknown_classifier_has_an_empty_grid(spark):
    assert tuning.param_grid(pipeline.create_classifier("naive_bayes"), "other") == [{}]


def test_saved_pipeline_scores_raw_text_like_the_one_in_memory(spark, nb_model, folder, tmp_path):
    path = str(tmp_path / "model")
    for _ in range(2):
        pipeline.save_model(nb_model, path)
    loaded = pipeline.load_model(spark, path)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    assert rows(scoring.score_table(nb_model, docs, "doc_id")) == rows(
        scoring.score_table(loaded, docs, "doc_id")
    )


def test_raw_and_cleaned_text_score_alike(spark, nb_model, train, folder):
    raw = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labelled = raw.join(train.select("doc_id"), "doc_id")
    assert rows(scoring.score_table(nb_model, labelled, "doc_id")) == rows(
        scoring.score_table(nb_model, train, "doc_id")
    )


def test_one_text(spark, nb_model):
    row = scoring.score_text(nb_model, spark, "The <br/> film!")
    assert math.isclose(row.probability_negative + row.probability_positive, 1.0)
    with pytest.raises(ValueError, match="blank"):
        scoring.score_text(nb_model, spark, "  \n")


def test_null_and_empty_texts(spark, nb_model):
    docs = spark.createDataFrame([(1, None), (2, " "), (3, "fine")], "doc_id long, text string")
    assert scoring.score_table(nb_model, docs, "doc_id").count() == 3
    assert [r.doc_id for r in scoring.usable(docs).collect()] == [3]


def test_texts_that_cleaning_empties_are_not_scored(spark, train):
    texts = ["...", "<br />", "<br/>!", "\u00a0", "\u0434\u0430", "1", "<b>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in scoring.usable(docs).orderBy("doc_id").collect()] == [5, 6]
    kept = [r.doc_id for r in with_clean_text(docs).orderBy("doc_id").collect()]
    assert kept == [5, 6]
    wide = pipeline.fit_classifier(train, "naive_bayes", Options(unicode=True, max_features=200))
    assert sorted(r.doc_id for r in scored_stream(wide, docs, "doc_id").collect()) == [4, 5, 6]


def test_more_rows_take_more_fit_partitions(train, monkeypatch):
    features = pipeline.fit_features(train, SMALL, pipeline.fit_vocabulary(train, SMALL), cleaned=True)
    vectors = pipeline.prepare(features, train, "doc_id")
    few = pipeline.placed(vectors, SMALL)
    assert few.rdd.getNumPartitions() == SMALL.fit_partitions
    monkeypatch.setattr(pipeline, "PARTITION_BYTES", 4 * 400 * 2)
    many = pipeline.placed(vectors, SMALL)
    assert many.rdd.getNumPartitions() == math.ceil(train.count() / 2) > SMALL.fit_partitions
    assert rows(many) == rows(few)


def test_file_to_file(spark, nb_model, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('text\n"good ""film"", yes"\n" "\nbad\n', encoding="utf-8")
    scoring.score_file(nb_model, spark, str(source), str(tmp_path / "out"))
    stored = read_csv(spark, str(tmp_path / "out"))
    assert stored.columns == [
        "text", "prediction", "probability_negative", "probability_positive",
    ]
    assert sorted(r.text for r in stored.collect()) == ["bad", 'good "film", yes']


def test_presentation(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.148, 0.852), (2, 0, 0.66666, 0.33334)],
        "doc_id long, prediction int, probability_negative double, probability_positive double",
    )
    assert rows(scoring.presented(df, "doc_id")) == [
        (1, "Positive", 85.2, 14.8, 85.2),
        (2, "Negative", 66.67, 66.67, 33.33),
    ]


def test_evaluation_and_run_log(spark, train, nb_model, tmp_path):
    log = RunLog(spark, str(tmp_path))
    wanted = ("accuracy", "f1", "auc", "auc_raw", "log_loss")
    got = evaluation.evaluate(nb_model, train, wanted, log, "nb")
    assert list(got) == list(wanted) and got["auc"] > got["auc_raw"]
    assert {r.key for r in log.table("run_metrics").collect()} == set(wanted)


def test_saved_model_is_measured_on_a_raw_file(spark, nb_model, train, folder, tmp_path):
    model = str(tmp_path / "model")
    pipeline.save_model(nb_model, model)
    raw = spark.read.parquet(f"{folder}/documents.parquet")
    labelled = raw.join(train.select("doc_id", "label"), "doc_id").select("text", "label")
    test = str(tmp_path / "test")
    labelled.write.option("header", True).option("escape", '"').csv(test)
    again = evaluation.evaluate_saved(spark, model, test)
    direct = evaluation.evaluate(nb_model, train)
    assert again == pytest.approx(direct)


def test_training_run_writes_its_rows(spark, train, tmp_path):
    log = RunLog(spark, str(tmp_path))
    a, b = splits.train_validation(train)
    training.train(a, b, log, "run", options=SMALL)
    params = {r.key: r.value for r in log.table("run_params").collect()}
    assert params == {
        "algorithm": "naive_bayes",
        "train_samples": str(a.count()),
        "train_rejected": "0",
        "test_rejected": "0",
        "features_used": "bow_tfidf",
        "features": "400",
    }
    assert log.table("run_metrics").count() == 5


def test_training_from_files(spark, train, folder, tmp_path):
    raw = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    reviews = raw.join(train.select("doc_id", "label"), "doc_id")
    first, second = splits.train_validation(reviews)
    files = {
        "train": first.select("text", "label"),
        "test": second.select("text", "label"),
        "more": raw.join(train, "doc_id", "left_anti").select(
            "text", F.lit(None).cast("int").alias("label")
        ),
    }
    for name, table in files.items():
        sinks.write_table(table, str(tmp_path / name))
    paths = [str(tmp_path / name) for name in files]
    options = Options(max_features=300, cv_folds=2)
    model = training.train_from_files(
        spark, str(tmp_path / "job"), "nb", *paths, options=options, tune=False
    )
    log = RunLog(spark, str(tmp_path / "job" / "runs"))
    artifact = log.table("run_artifacts").first()
    assert artifact.path == f"{tmp_path}/job/models/nb"
    loaded = pipeline.load_model(spark, artifact.path)
    assert loaded.stages[1].vocabulary == model.stages[1].vocabulary
    prepared = stages.read_prepared(spark, f"{tmp_path}/job/prepared")
    assert prepared.select("doc_id").distinct().count() == prepared.count()
    # Unlabelled texts take part in choosing the words.
    alone = pipeline.fit_vocabulary(labelled(stages.read_prepared(
        spark, f"{tmp_path}/job/prepared", "train")), options)
    assert list(alone.words) != model.stages[1].vocabulary

    training.train_from_files(
        spark, str(tmp_path / "job"), "tuned", *paths, options=options, tune=True
    )
    tuned = pipeline.load_model(spark, f"{tmp_path}/job/models/tuned")
    # With unlabelled texts too, tuned or not, the words are the same.
    assert tuned.stages[1].vocabulary == loaded.stages[1].vocabulary
    params = {r.key: r.value for r in log.table("run_params").filter("run_id = 'tuned'").collect()}
    assert params["cv_folds"] == "2" and "best_smoothing" in params
    keys = {r.key for r in log.table("run_metrics").filter("run_id = 'tuned'").collect()}
    assert {"auc", "accuracy smoothing=1.0"} <= keys


def test_description(train):
    summary, stats = training.describe(train)
    assert summary.filter("is_total = 1").first().n == train.count()
    assert stats.first().vocabulary_size > 0


def test_cross_validation(train):
    options = Options(max_features=200, cv_folds=3)
    tuned = tuning.cross_validate(train, "naive_bayes", options)
    assert len(tuned.averages) == 3 and all(0 <= value <= 1 for value in tuned.averages)
    best = max(tuned.averages)
    assert tuned.best == tuned.grid[tuned.averages.index(best)]
    assert tuned.model.stages[-1].getSmoothing() == tuned.best["smoothing"]
    assert set(tuning.tuning_metrics(tuned)) == {
        f"accuracy smoothing={value}" for value in (0.5, 1.0, 2.0)
    }
    leaky = tuning.cross_validate(train, "naive_bayes", options, leaky=True)
    assert len(leaky.averages) == 3


def test_outside_linear_model_equals_logistic_regression(train):
    model = pipeline.fit_classifier(train, "logistic_regression", SMALL)
    fitted = model.stages[-1]
    weights = np.stack([np.zeros_like(c := fitted.coefficients.toArray()), c], axis=1)
    bias = np.array([0.0, fitted.intercept])
    vectors = PipelineModel(model.stages[:-1]).transform(train)
    logits = scoring.linear_logits(F.col("features"), weights, bias).alias("logits")
    outside = scoring.with_softmax(vectors.select("doc_id", logits), "logits")
    inside = scoring.score_table(model, train, "doc_id")
    for a, b in zip(rows(outside), rows(inside)):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9)


def test_outside_sequence_model_gets_ids_and_mask(train):
    vocab = sequences.id_vocabulary(train)
    encoded = sequences.id_sequences(train, vocab, Options(sequence_length=32))

    def make_predict():
        def predict(ids, mask):
            total = (ids * mask).sum(axis=1)
            return np.stack([np.zeros(len(ids)), np.where(total % 2 == 0, 1.0, -1.0)], axis=1)

        return predict

    logits = scoring.sequence_logits(make_predict, 32)("input_ids", "attention_mask")
    scored = scoring.with_softmax(encoded.withColumn("logits", logits), "logits")
    for row in scored.collect():
        assert row.prediction == (1 if sum(row.input_ids) % 2 == 0 else 0)
        assert row.probability_positive == pytest.approx(
            1 / (1 + math.exp(-1 if row.prediction else 1))
        )


def test_stream_scores_like_batch_and_each_file_once(spark, nb_model, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    blank = spark.createDataFrame([(-1, "  ")], docs.schema)
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    half = docs.filter("doc_id % 2 = 0").unionByName(blank)
    half.write.parquet(source)

    def run():
        texts = arriving_texts(spark, source, "doc_id long, text string")
        start_scoring(
            nb_model, texts, output, str(tmp_path / "state"), "doc_id", available_now=True
        ).awaitTermination()

    run()
    docs.filter("doc_id % 2 = 1").write.mode("append").parquet(source)
    run()
    run()
    batch = scored_stream(nb_model, docs, "doc_id")
    assert rows(spark.read.parquet(output).select(batch.columns)) == rows(batch)


def test_scoring_is_one_narrow_job(spark, nb_model, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    scored = scoring.score_table(nb_model, docs, "doc_id")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("algorithm", ["random_forest", "logistic_regression"])
def test_fits_do_not_depend_on_input_partitions(train, algorithm):
    vocab = pipeline.fit_vocabulary(train, SMALL)
    scores = [
        rows(
            scoring.score_table(
                pipeline.fit_classifier(train.repartition(n), algorithm, SMALL, vocab), train, "doc_id"
            )
        )
        for n in (1, 3, 7)
    ]
    assert scores[0] == scores[1] == scores[2]


def test_a_forest_learns_and_scores(train):
    model = pipeline.fit_classifier(train, "random_forest", SMALL)
    values = evaluation.evaluate(model, train, ("accuracy", "auc"))
    share = train.filter("label = 1").count() / train.count()
    assert values["accuracy"] >= share and values["auc"] > 0.9


def test_fits_read_clean_text_as_it_is(train):
    vocab = pipeline.fit_vocabulary(train, SMALL)
    for cleaned, times in ((True, 0), (False, 1)):
        features = pipeline.fit_features(train, SMALL, vocab, cleaned)
        plan = pipeline.prepare(features, train)._jdf.queryExecution().optimizedPlan().toString()
        assert ("regexp_replace" in plan) == bool(times)


def test_null_labels_are_left_out_of_fits_and_folds(spark, train):
    odd = spark.createDataFrame([(-1, "some text", None)], train.schema)
    options = Options(max_features=100, cv_folds=2)
    with_odd = train.unionByName(odd)
    a = tuning.cross_validate(train, "naive_bayes", options)
    b = tuning.cross_validate(with_odd, "naive_bayes", options)
    assert a.averages == b.averages
    assert pipeline.fit_classifier(with_odd, "naive_bayes", options)


def test_rejected_rows_are_counted(spark, train, tmp_path):
    odd = spark.createDataFrame([(-1, "some text", None), (-2, "more", None)], train.schema)
    log = RunLog(spark, str(tmp_path))
    training.train(train.unionByName(odd), train.unionByName(odd.limit(1)), log, "r", options=SMALL)
    params = {r.key: r.value for r in log.table("run_params").collect()}
    assert (params["train_rejected"], params["test_rejected"]) == ("2", "1")
    assert params["train_samples"] == str(train.count())


def test_probabilities_of_three_classes(spark, train):
    three = train.withColumn("label", (F.col("doc_id") % 3).cast("int"))
    model = pipeline.fit_classifier(three, "naive_bayes", SMALL)
    scored = scoring.score_table(model, three, "doc_id")
    assert scored.columns[2:] == ["probability_0", "probability_1", "probability_2"]
    assert all(math.isclose(sum(r[2:]), 1.0) for r in scored.collect())


def test_linear_logits_of_empty_dense_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    vectors = [Vectors.sparse(3, [], []), Vectors.sparse(3, [2], [4.0]), Vectors.dense([1, 2, 3])]
    df = spark.createDataFrame(list(enumerate(vectors)), ["k", "features"]).repartition(1)
    weights, bias = np.arange(6.0).reshape(3, 2), np.array([0.5, -0.5])
    got = df.select("k", scoring.linear_logits(F.col("features"), weights, bias).alias("x")).collect()
    assert {r.k: r.x for r in got} == {
        k: (v.toArray() @ weights + bias).tolist() for k, v in enumerate(vectors)
    }


def test_a_third_logit_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "logits array<double>")
    with pytest.raises(Exception, match="two logits"):
        scoring.with_softmax(df, "logits").collect()
