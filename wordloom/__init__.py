"""Text analytics and supervised text classification on Spark DataFrames."""

from wordloom.options import Options

__all__ = ["Options"]
