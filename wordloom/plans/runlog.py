"""Runs as rows: append-only tables of parameters, metrics and artifacts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "run_params": "run_id string, key string, value string",
    "run_metrics": "run_id string, key string, value double, step int",
    "run_artifacts": "run_id string, name string, path string",
}


class RunLog:
    """The three run tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def log_params(self, run_id: str, params: dict) -> None:
        self._append("run_params", [(run_id, str(k), str(v)) for k, v in params.items()])

    def log_metrics(self, run_id: str, metrics: dict, step: int = 0) -> None:
        rows = [(run_id, str(k), float(v), step) for k, v in metrics.items()]
        self._append("run_metrics", rows)

    def log_metric_table(self, run_id: str, metrics: DataFrame, step: int = 0) -> None:
        """Append a (metric, value) table without passing it through the driver."""
        rows = metrics.select(
            F.lit(run_id).alias("run_id"),
            F.col("metric").alias("key"),
            F.col("value").cast("double"),
            F.lit(step).alias("step"),
        )
        rows.write.mode("append").parquet(f"{self.folder}/run_metrics")

    def log_artifacts(self, run_id: str, artifacts: dict) -> None:
        self._append("run_artifacts", [(run_id, str(k), str(v)) for k, v in artifacts.items()])

    def table(self, name: str) -> DataFrame:
        """A run table; one that nothing was logged to has no rows."""
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def _append(self, name: str, rows: list[tuple]) -> None:
        if rows:
            table = self.spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1)
            table.write.mode("append").parquet(f"{self.folder}/{name}")


def compare_runs(run_metrics: DataFrame, runs: list[str]) -> DataFrame:
    """One row per metric, one column per run, and how far each run is from the first."""
    wide = run_metrics.groupBy("key").pivot("run_id", runs).agg(F.max_by("value", "step"))
    first = F.col(f"`{runs[0]}`")
    deltas = [
        (F.col(f"`{run}`") - first).alias(f"{run}_delta") for run in runs[1:]
    ]
    return wide.select(F.col("key").alias("metric"), *[F.col(f"`{r}`") for r in runs], *deltas)
