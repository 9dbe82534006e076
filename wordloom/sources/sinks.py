"""Where predictions go."""

from __future__ import annotations

from pyspark.sql import DataFrame

PREDICTION_COLUMNS = ("text", "prediction", "probability_negative", "probability_positive")


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite `path` with CSV files that `read_csv` reads back unchanged."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_predictions(df: DataFrame, path: str, *ids: str) -> None:
    write_table(df.select(*ids, *PREDICTION_COLUMNS), path)


def show_predictions(df: DataFrame, rows: int = 20) -> None:
    df.select(*PREDICTION_COLUMNS).show(rows, truncate=False)


def emit_predictions(df: DataFrame, path: str | None = None) -> None:
    """To files when a path is given, else to the console."""
    if path:
        write_predictions(df, path)
    else:
        show_predictions(df)
