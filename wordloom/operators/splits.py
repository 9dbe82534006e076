"""Seeded splits that depend on the row id alone, so any run and any engine agree on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.options import Options


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """An even number in [0, buckets) from the first 8 hex digits of md5('seed:key')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def is_validation(key: Column, options: Options = Options()) -> Column:
    """Rows of the held-out share, in steps of one in a million; whole percents take the rows that
    a hundred buckets would."""
    millionths = round(options.test_size * 1_000_000)
    if millionths % 10_000 == 0:
        return hash_bucket(key, options.random_state, 100) < millionths // 10_000
    return hash_bucket(key, options.random_state, 1_000_000) < millionths


def train_validation(docs: DataFrame, options: Options = Options(), key: str = "doc_id"):
    held_out = is_validation(F.col(key), options)
    return docs.filter(~held_out), docs.filter(held_out)


def with_fold(docs: DataFrame, options: Options = Options(), key: str = "doc_id") -> DataFrame:
    fold = hash_bucket(F.col(key), options.random_state, options.cv_folds)
    return docs.withColumn("fold", fold)
