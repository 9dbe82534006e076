import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wordloom.operators import metrics
from wordloom.plans.evaluation import exact_auc
from wordloom.plans.runlog import RunLog, compare_runs


def predictions(spark, pairs):
    data = [(label, int(p > 0.5), 1 - p, p) for label, p in pairs]
    df = spark.createDataFrame(
        data,
        "label int, prediction int, probability_negative double, probability_positive double",
    )
    both = F.array("probability_negative", "probability_positive")
    return df.withColumn("probability", array_to_vector(both))


@pytest.fixture
def scored(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(0, 1), rng.choice([0.1, 0.25, 0.5, 0.7, 0.999])) for _ in range(400)]
    return predictions(spark, pairs)


def values(df):
    return {row.metric: row.value for row in df.collect()}


def test_weighted_scores_match_the_evaluator(scored):
    got = values(metrics.weighted_scores(metrics.confusion(scored)))
    as_double = scored.withColumn("prediction", F.col("prediction").cast("double"))
    names = {"accuracy": "accuracy", "precision": "weightedPrecision",
             "recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(metricName=theirs)
        assert math.isclose(got[ours], evaluator.evaluate(as_double), rel_tol=1e-12)
    loss = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(as_double)
    assert math.isclose(values(metrics.log_loss(scored))["log_loss"], loss, rel_tol=1e-12)


def test_auc_counts_ties_half(scored):
    got = values(metrics.area_under_roc(scored, "probability_positive"))["auc"]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    assert math.isclose(got, evaluator.evaluate(scored), rel_tol=1e-12)


def test_one_class_has_no_auc(spark):
    only = predictions(spark, [(1, 0.2), (1, 0.9)])
    assert values(metrics.area_under_roc(only, "probability_positive")) == {"auc": 0.0}
    assert exact_auc(only, "probability") == 0.0


def test_a_score_shared_by_a_third_of_all_rows(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 30_000).alias("score"),
    )
    got = values(metrics.area_under_roc(rows, "score"))["auc"]
    pdf = rows.toPandas()
    ranks = pdf["score"].rank(method="average")
    positive = pdf["label"] == 1
    n = int(positive.sum())
    expected = (ranks[positive].sum() - n * (n + 1) / 2) / (n * (len(pdf) - n))
    assert math.isclose(got, expected, rel_tol=1e-12)


def test_confusion_wide_fills_missing_cells(spark):
    counts = metrics.confusion(predictions(spark, [(1, 0.9), (1, 0.8), (0, 0.7)]))
    got = {tuple(r) for r in metrics.confusion_wide(counts).collect()}
    assert got == {(0, 0, 1), (1, 0, 2)}


def test_confusion_of_three_classes(spark):
    pairs = [(0, 0), (1, 2), (2, 2), (2, 1)]
    counts = metrics.confusion(spark.createDataFrame(pairs, "label int, prediction int"))
    wide = metrics.confusion_wide(counts)
    assert wide.columns == ["label", "predicted_0", "predicted_1", "predicted_2"]
    assert {tuple(r) for r in wide.collect()} == {(0, 1, 0, 0), (1, 0, 0, 1), (2, 0, 1, 1)}


def test_a_run_table_nobody_wrote_to(spark, tmp_path):
    assert RunLog(spark, str(tmp_path / "none")).table("run_metrics").count() == 0


def test_a_class_that_is_never_predicted_has_no_precision(spark):
    got = values(metrics.weighted_scores(metrics.confusion(predictions(spark, [(1, .9), (0, .9)]))))
    assert got == {"accuracy": 0.5, "precision": 0.25, "recall": 0.5, "f1": 1 / 3}


def test_metrics_by_name(scored):
    assert set(values(metrics.all_metrics(scored, "probability_positive", ("auc", "f1")))) == {
        "auc", "f1",
    }
    with pytest.raises(ValueError):
        metrics.all_metrics(scored, "probability_positive", ("unknown",))


def test_run_log_appends_and_finds_the_best_step(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    for step, loss in enumerate([0.9, 0.5, 0.7, 0.3, 0.4]):
        log.log_metrics("a", {"val_loss": loss, "val_f1": 1 - loss}, step)
    log.log_metrics("b", {"val_loss": 0.1}, 0)
    best = {tuple(r) for r in metrics.best_step(log.table("run_metrics")).collect()}
    assert best == {("a", 3, "val_loss", 0.3), ("a", 3, "val_f1", 0.7), ("b", 0, "val_loss", 0.1)}
    log.log_params("a", {"algorithm": "naive_bayes", "train_samples": 3})
    log.log_artifacts("a", {"model": "/models/a"})
    assert log.table("run_params").count() == 2
    assert tuple(log.table("run_artifacts").first()) == ("a", "model", "/models/a")
    wide = compare_runs(log.table("run_metrics"), ["a", "b"]).filter("metric = 'val_loss'").first()
    assert wide.a == 0.4 and wide.b == 0.1 and math.isclose(wide.b_delta, -0.3)
