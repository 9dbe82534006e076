"""Grid search by k-fold cross-validation over the whole text pipeline."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from wordloom.operators.splits import with_fold
from wordloom.options import Options
from wordloom.plans.bayes_folds import cross_validated_bayes
from wordloom.plans.pipeline import (
    ITERATIVE,
    create_classifier,
    fit_features,
    fit_vocabulary,
    for_raw_text,
    placed,
    prepare,
)
from wordloom.session import cut
from wordloom.sources.reviews import labelled


@dataclass(frozen=True)
class Tuned:
    model: PipelineModel
    best: dict
    grid: list[dict]
    averages: list[float]


def param_grid(estimator: Estimator, algorithm: str) -> list[dict]:
    """The settings tried for each classifier."""
    grid = ParamGridBuilder()
    if algorithm == "naive_bayes":
        grid.addGrid(estimator.smoothing, [0.5, 1.0, 2.0])
    elif algorithm == "logistic_regression":
        grid.addGrid(estimator.regParam, [0.01, 0.1, 1.0])
        grid.addGrid(estimator.maxIter, [50, 100, 200])
    elif algorithm == "random_forest":
        grid.addGrid(estimator.numTrees, [50, 100, 200])
        grid.addGrid(estimator.maxDepth, [5, 10, 15])
    return grid.build()


def cross_validate(
    train: DataFrame,
    algorithm: str | None = None,
    options: Options = Options(),
    leaky: bool = False,
    parallelism: int = 4,
    unsupervised: DataFrame | None = None,
) -> Tuned:
    """Pick the grid point with the best mean accuracy and refit it on all of `train`.

    `train` holds cleaned (doc_id, text, label) rows; folds come from the row id. Vocabulary
    and IDF are fitted on the training part of each fold, once for all grid points, and the
    fold's vectors are stored because every grid point reads them. With `leaky` one vocabulary
    fitted on all rows serves every fold. `unsupervised` texts (doc_id, text) take part in every
    vocabulary and its weights. Rows without a label are left out.

    Naive Bayes over single words goes without fits by fold: `bayes_folds` takes all averages
    from counts.
    """
    name = algorithm or options.algorithm
    if name == "naive_bayes" and options.feature_ngrams == 1:
        return _validated_bayes(train, options, leaky, unsupervised)
    train = labelled(train)

    def words_of(rows: DataFrame):
        texts = rows.select("doc_id", "text")
        if unsupervised is not None:
            texts = texts.unionByName(unsupervised.select("doc_id", "text"))
        return fit_vocabulary(texts, options)

    def stored(features: PipelineModel):
        vectors = prepare(features, folded, "doc_id", "fold")
        return placed(vectors, options) if name in ITERATIVE else cut(vectors)

    estimator = create_classifier(name, options)
    grid = param_grid(estimator, name)
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    folded = with_fold(train, options)
    whole = fit_features(train, options, words_of(train), cleaned=True)
    shared = stored(whole) if leaky else None

    totals = [0.0] * len(grid)
    for fold in range(options.cv_folds):
        held_out = F.col("fold") == fold
        if leaky:
            vectors = shared
        else:
            fold_train = folded.filter(~held_out)
            vectors = stored(fit_features(fold_train, options, words_of(fold_train), cleaned=True))
        fit_part, test_part = vectors.filter(~held_out), vectors.filter(held_out)

        def accuracy(params, fit_part=fit_part, test_part=test_part):
            return evaluator.evaluate(estimator.fit(fit_part, params).transform(test_part))

        task = inheritable_thread_target(train.sparkSession)(accuracy)
        with ThreadPool(min(parallelism, len(grid))) as pool:
            for i, value in enumerate(pool.map(task, grid)):
                totals[i] += value

    averages = [total / options.cv_folds for total in totals]
    everything = prepare(whole, train, "doc_id")
    everything = placed(everything, options) if name in ITERATIVE else everything
    return _refitted(estimator, grid, averages, whole, everything, options)


def _refitted(estimator, grid, averages, features, vectors, options) -> Tuned:
    best = max(range(len(grid)), key=lambda i: averages[i])
    model = estimator.fit(vectors, grid[best])
    named = [{param.name: value for param, value in point.items()} for point in grid]
    return Tuned(for_raw_text(features, model, options), named[best], named, averages)


def _validated_bayes(train, options, leaky, unsupervised) -> Tuned:
    estimator = create_classifier("naive_bayes", options)
    grid = param_grid(estimator, "naive_bayes")
    # Read once from the source: the counts, the scores and the last fit go over this copy.
    rows = cut(with_fold(labelled(train), options).select("doc_id", "text", "label", "fold"))
    smoothings = [point[estimator.smoothing] for point in grid]
    averages, vocabulary = cross_validated_bayes(rows, smoothings, options, leaky, unsupervised)
    features = fit_features(rows, options, vocabulary, cleaned=True)
    return _refitted(estimator, grid, averages, features, prepare(features, rows), options)


def tuning_metrics(tuned: Tuned) -> dict[str, float]:
    """The mean accuracy of every grid point, keyed by its settings, for the run log."""
    return {
        "accuracy " + " ".join(f"{k}={v}" for k, v in sorted(point.items())): value
        for point, value in zip(tuned.grid, tuned.averages)
    }
