"""Measuring fitted pipelines on labelled texts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.metrics import confusion, log_loss, weighted_scores
from wordloom.options import Options
from wordloom.plans.pipeline import load_model
from wordloom.plans.runlog import RunLog
from wordloom.plans.scoring import probability_columns
from wordloom.session import cut
from wordloom.sources.reviews import labelled, load_reviews


def predictions(model: PipelineModel, docs: DataFrame, *keys: str) -> DataFrame:
    """(keys, label, prediction, probabilities, vectors) of labelled texts."""
    scored = model.transform(docs)
    return scored.select(
        *keys,
        "label",
        F.col("prediction").cast("int").alias("prediction"),
        *probability_columns(model),
        "probability",
        "rawPrediction",
    )


def evaluate(
    model: PipelineModel, docs: DataFrame, metrics=Options().metrics, log: RunLog | None = None,
    run_id: str = "evaluation",
) -> dict[str, float]:
    """The chosen metrics of a model on labelled texts, from predictions computed once.

    `auc` ranks by the probability. `auc_raw` ranks by the raw score, which for Naive Bayes
    is a joint likelihood and says little about the class.
    """
    scored = cut(predictions(model, docs))
    values: dict[str, float] = {}
    from_counts = {"accuracy", "precision", "recall", "f1"} & set(metrics)
    if from_counts:
        rows = weighted_scores(confusion(scored)).collect()
        values.update({r.metric: r.value for r in rows if r.metric in from_counts})
    for name, column in (("auc", "probability"), ("auc_raw", "rawPrediction")):
        if name in metrics:
            values[name] = exact_auc(scored, column)
    if "log_loss" in metrics:
        values["log_loss"] = log_loss(scored).first().value
    ordered = {name: values[name] for name in metrics if name in values}
    if log is not None:
        log.log_metrics(run_id, ordered)
    return ordered


def exact_auc(scored: DataFrame, column: str) -> float:
    """Area under ROC over every distinct score; 0.0 when only one class is present.

    Rows without a label are left out; a label other than 0 and 1 is an error.
    """
    scored = scored.filter(F.col("label").isNotNull())
    found = {row.label for row in scored.select("label").distinct().limit(3).collect()}
    if found - {0, 1}:
        raise ValueError(f"labels 0 and 1 are needed, not {sorted(found)}")
    if len(found) < 2:
        return 0.0
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=column, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored)


def evaluate_saved(
    spark: SparkSession, model_path: str, test_path: str, metrics=Options().metrics
) -> dict[str, float]:
    """Load a saved pipeline and measure it on a delimited test file, read into a stage table."""
    test = labelled(load_reviews(spark, test_path, "test"))
    return evaluate(load_model(spark, model_path), test, metrics)
