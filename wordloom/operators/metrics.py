"""Evaluation over prediction tables (label, prediction, probabilities, a ranking score)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.ordering import with_total_before

# Fixed value: the smallest probability that enters a logarithm.
LOG_FLOOR = 1e-15


def confusion(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n): at most classes squared rows."""
    pair = [F.col("label").cast("int").alias("label"), F.col("prediction").cast("int")]
    return predictions.groupBy(pair[0], pair[1].alias("prediction")).agg(F.count("*").alias("n"))


def confusion_wide(counts: DataFrame, classes=None) -> DataFrame:
    """One row per label, one column per class: 0, 1 and all others among labels and predictions.

    `counts` has classes squared rows at most; its class names are read first.
    """
    if classes is None:
        seen = counts.select(F.explode(F.array("label", "prediction")).alias("c")).distinct()
        classes = sorted({0, 1} | {row.c for row in seen.collect() if row.c is not None})
    wide = counts.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))
    named = [F.coalesce(str(c), F.lit(0)).cast("bigint").alias(f"predicted_{c}") for c in classes]
    return wide.select("label", *named)


def weighted_scores(counts: DataFrame) -> DataFrame:
    """(metric, value): accuracy and the label-weighted precision, recall and F1.

    Everything comes from the confusion counts, so the predictions are read once.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = counts.select(
        F.inline(
            F.array(
                _side(F.col("label"), F.col("n"), none, hit.cast("bigint")),
                _side(F.col("prediction"), none, F.col("n"), none),
            )
        )
    )
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("actual"))
    # 2pr / (p + r) written in counts.
    f1 = _ratio(2 * F.col("hits"), F.col("actual") + F.col("predicted"))
    total = F.sum("actual")
    row = classes.agg(
        _ratio(F.sum("hits"), total).alias("accuracy"),
        _ratio(F.sum(F.col("actual") * precision), total).alias("precision"),
        _ratio(F.sum(F.col("actual") * recall), total).alias("recall"),
        _ratio(F.sum(F.col("actual") * f1), total).alias("f1"),
    )
    return long_form(row)


def area_under_roc(scored: DataFrame, score: str) -> DataFrame:
    """(metric, value): the chance that a positive outranks a negative, ties counting half.

    Rows with equal scores are summed first, so a value shared by many rows is one row when
    the scores are ordered; the order itself is taken chunk by chunk. 0.0 for a single class.
    Rows without a label are left out; a label other than 0 and 1 is an error, as one score
    ranks two classes.
    """
    scored = scored.filter(F.col("label").isNotNull())
    positive = two_class(F.col("label"))
    steps = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    ranked = with_total_before(steps, "score", "negatives")
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    below = F.col("before").cast("double") + F.col("negatives") / 2
    wins = F.sum(F.col("positives") * below)
    return ranked.agg(
        F.lit("auc").alias("metric"),
        F.coalesce(F.when(pairs > 0, wins / pairs), F.lit(0.0)).alias("value"),
    )


def two_class(label: Column) -> Column:
    """Whether a label is 1 and not 0; any other is an error."""
    other = F.raise_error(F.concat(F.lit("labels 0 and 1 are needed, not "), label.cast("string")))
    return F.when(label == 1, True).when(label == 0, False).otherwise(other.cast("boolean"))


def log_loss(predictions: DataFrame) -> DataFrame:
    """(metric, value): the mean cross-entropy of the probability given to the true label.

    Probabilities are `probability_negative` and `probability_positive`, or `probability_0` and so
    on for any number of classes. A label that has none is an error; rows without a label are
    left out.
    """
    named = {"negative": 0, "positive": 1}
    of_label = F.raise_error(
        F.concat(F.lit("no probability column for label "), F.col("label").cast("string"))
    ).cast("double")
    for column in predictions.columns:
        name = column.removeprefix("probability_")
        if column != name and (name in named or name.isdigit()):
            there = F.col("label") == named.get(name, int(name) if name.isdigit() else None)
            of_label = F.when(there, F.col(column)).otherwise(of_label)
    loss = F.avg(-F.log(F.greatest(of_label, F.lit(LOG_FLOOR))))
    some = predictions.filter(F.col("label").isNotNull())
    return some.agg(F.lit("log_loss").alias("metric"), loss.alias("value"))


def all_metrics(predictions: DataFrame, score: str, wanted) -> DataFrame:
    """(metric, value) for the wanted names; `predictions` should be stored, not recomputed."""
    parts = []
    if set(wanted) & {"accuracy", "precision", "recall", "f1"}:
        parts.append(weighted_scores(confusion(predictions)))
    if "auc" in wanted:
        parts.append(area_under_roc(predictions, score))
    if "log_loss" in wanted:
        parts.append(log_loss(predictions))
    if not parts:
        raise ValueError(f"no known metric in {list(wanted)}")
    return reduce(DataFrame.unionByName, parts).filter(F.col("metric").isin(*wanted))


def best_step(run_metrics: DataFrame, by: str = "val_loss") -> DataFrame:
    """Per run, the step with the lowest `by` and all metrics logged at that step."""
    lowest = (
        run_metrics.filter(F.col("key") == by)
        .groupBy("run_id")
        .agg(F.min_by("step", F.struct("value", "step")).alias("step"))
    )
    return run_metrics.join(lowest, ["run_id", "step"]).select("run_id", "step", "key", "value")


def long_form(row: DataFrame) -> DataFrame:
    """One-row metrics as (metric, value) rows."""
    return row.unpivot([], row.columns, "metric", "value")


def _side(label: Column, actual: Column, predicted: Column, hits: Column) -> Column:
    return F.struct(
        label.alias("class"),
        actual.alias("actual"),
        predicted.alias("predicted"),
        hits.alias("hits"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
