"""The training job: from review tables or files to a saved, measured and logged model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from wordloom.operators.wordstats import label_summary, vocabulary, word_statistics
from wordloom.options import Options
from wordloom.plans.evaluation import evaluate
from wordloom.plans.pipeline import fit_classifier, fit_vocabulary, save_model
from wordloom.plans.runlog import RunLog
from wordloom.plans.tuning import cross_validate, tuning_metrics
from wordloom.session import temporary_tables
from wordloom.sources.reviews import labelled, load_splits, rejects
from wordloom.sources.stages import read_prepared


def train(
    reviews: DataFrame,
    test: DataFrame,
    log: RunLog,
    run_id: str,
    algorithm: str | None = None,
    options: Options = Options(),
    unsupervised: DataFrame | None = None,
    tune: bool = False,
    model_path: str | None = None,
) -> PipelineModel:
    """Fit on cleaned reviews, measure on others, write the run's rows, store the model.

    Unlabelled texts, where given, take part in choosing the words and weighing them, and in
    nothing else. With `tune` the settings come from cross-validation. Rows of either table
    without a usable label are counted as rejected and left out.
    """
    name = algorithm or options.algorithm
    rejected = [rejects(table).first().rejected for table in (reviews, test)]
    reviews, test = labelled(reviews), labelled(test)
    params = {
        "algorithm": name,
        "train_samples": reviews.count(),
        "train_rejected": rejected[0],
        "test_rejected": rejected[1],
        "features_used": options.feature_info,
    }
    if tune:
        tuned = cross_validate(reviews, name, options, unsupervised=unsupervised)
        model = tuned.model
        params["cv_folds"] = options.cv_folds
        params.update({f"best_{key}": value for key, value in tuned.best.items()})
        log.log_metrics(run_id, tuning_metrics(tuned))
    else:
        texts = reviews.select("doc_id", "text")
        if unsupervised is not None:
            texts = texts.unionByName(unsupervised.select("doc_id", "text"))
        model = fit_classifier(reviews, name, options, fit_vocabulary(texts, options))
    params["features"] = model.stages[-1].numFeatures
    log.log_params(run_id, params)
    evaluate(model, test, options.metrics, log, run_id)
    if model_path:
        save_model(model, model_path)
        log.log_artifacts(run_id, {"model": model_path})
    return model


def train_from_files(
    spark: SparkSession,
    folder: str,
    run_id: str,
    train_file: str,
    test_file: str,
    unsupervised_file: str | None = None,
    algorithm: str | None = None,
    options: Options = Options(),
    tune: bool = False,
) -> PipelineModel:
    """The whole job below one folder: prepared table, run log and model.

    Vectors and other tables made on the way are deleted when the job ends.
    """
    files = {"train": train_file, "test": test_file, "unsupervised": unsupervised_file}
    stage = f"{folder}/prepared"
    load_splits(spark, stage, **{split: path for split, path in files.items() if path})
    unlabelled = read_prepared(spark, stage, "unsupervised") if unsupervised_file else None
    with temporary_tables(spark):
        return train(
            read_prepared(spark, stage, "train"),
            read_prepared(spark, stage, "test"),
            RunLog(spark, f"{folder}/runs"),
            run_id,
            algorithm,
            options,
            unlabelled,
            tune,
            f"{folder}/models/{run_id}",
        )


def describe(reviews: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """Rows per label and the statistics of the vocabulary, as the job reports them."""
    return label_summary(reviews), word_statistics(vocabulary(reviews, options))
