"""Word counts of a corpus that changes, kept as differences.

A log is a folder with one table of count differences per change: a split of the corpus arrives, is
taken out or is replaced. The counts of any version are the sums of the differences up to it, so
only arriving texts are ever read: taking a split out negates what the log holds of it. A base is a
table of sums that spares readers the changes before it; `compact` writes one.

A change counts once its folder is complete, so a job that dies on the way leaves the log as it was.
A log has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.pairs import WHOLE_TEXT
from wordloom.operators.wordstats import counts_with_texts, top_words, with_count_bounds
from wordloom.options import Options

#: `splits` is 1 (arrives) or -1 (goes) in one row of the word WHOLE_TEXT, else 0: so a split
#: without any text is known as well.
DIFFERENCES = "split string, word string, total_count long, doc_freq long, splits long"
SUMS = ("total_count", "doc_freq", "splits")


def add_split(
    spark: SparkSession, log: str, split: str, docs: DataFrame, options: Options = Options()
) -> int:
    """Count the cleaned texts of a new split and return the version that holds it.

    A split that is there already is an error. Without texts it is a member with no words.
    """
    if split in members(spark, log):
        raise ValueError(f"the log holds {split!r} already; replace_split changes it")
    return _commit(spark, log, _counted(spark, docs, split, options))


def remove_split(spark: SparkSession, log: str, split: str) -> int:
    """Take a split out again. Its texts are not read."""
    return _commit(spark, log, _negated(spark, log, split))


def replace_split(
    spark: SparkSession, log: str, split: str, docs: DataFrame, options: Options = Options()
) -> int:
    """Put other texts in the place of a split's, as one change; words that both use equally often
    take no row."""
    both = _negated(spark, log, split).union(_counted(spark, docs, split, options))
    return _commit(spark, log, _summed(both))


def members(spark: SparkSession, log: str, version: int | None = None) -> list[str]:
    """Names of the splits that a version holds, in order."""
    marks = _differences(spark, log, version).filter(F.col("word") == WHOLE_TEXT)
    held = marks.groupBy("split").agg(F.sum("splits").alias("held")).filter("held > 0")
    return sorted(row.split for row in held.select("split").collect())


def versions(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the complete changes, from 1; 0 is the empty log."""
    return sorted(_complete(spark, log, "change"))


def counts_at(spark: SparkSession, log: str, version: int | None = None) -> DataFrame:
    """(word, total_count, doc_freq) of a version, the last one by default: what counting all the
    texts of its splits at once gives."""
    return _table(spark, log, version).filter(F.col("word") != WHOLE_TEXT)


def texts_at(spark: SparkSession, log: str, version: int | None = None) -> DataFrame:
    """(total_docs): the number of texts of a version."""
    texts = _differences(spark, log, version).filter(F.col("word") == WHOLE_TEXT)
    return texts.agg(F.coalesce(F.sum("doc_freq"), F.lit(0)).alias("total_docs"))


def vocabulary_at(
    spark: SparkSession, log: str, version: int | None = None, options: Options = Options()
) -> DataFrame:
    """The vocabulary of a version, bounds and size as in `wordstats.vocabulary`."""
    total = texts_at(spark, log, version).scalar()
    return top_words(with_count_bounds(counts_at(spark, log, version), total, options), options)


def vocabulary_changes(
    spark: SparkSession, log: str, before: int, after: int, options: Options = Options()
) -> DataFrame:
    """(word, change, count_before, count_after): words that entered or left the vocabulary."""
    old, new = (
        vocabulary_at(spark, log, v, options).select("word", F.col("total_count").alias(name))
        for v, name in ((before, "count_before"), (after, "count_after"))
    )
    change = F.when(F.col("count_before").isNull(), "entered").otherwise("left")
    one_side = F.col("count_before").isNull() | F.col("count_after").isNull()
    both = old.join(new, "word", "full_outer").filter(one_side)
    return both.select("word", change.alias("change"), "count_before", "count_after")


def compact(spark: SparkSession, log: str) -> int:
    """Write the sums up to the last version as a base and return that version. The changes stay,
    so earlier versions can still be read."""
    version = max(versions(spark, log), default=0)
    if version and version not in _complete(spark, log, "base"):
        sums = _summed(_differences(spark, log, version))
        # A base is never read before it is complete; one that is left unfinished is overwritten.
        sums.write.mode("overwrite").parquet(_path(log, "base", version))
    return version


def _counted(spark, docs: DataFrame, split: str, options: Options) -> DataFrame:
    counts = counts_with_texts(docs, options).select(
        F.lit(split).alias("split"), "word", "total_count", "doc_freq", F.lit(0).cast("long").alias("splits")
    )
    return counts.union(spark.createDataFrame([(split, WHOLE_TEXT, 0, 0, 1)], DIFFERENCES))


def _negated(spark, log: str, split: str) -> DataFrame:
    if split not in members(spark, log):
        raise ValueError(f"the log holds no split {split!r}")
    held = _summed(_differences(spark, log, None).filter(F.col("split") == split))
    return held.select("split", "word", *[(-F.col(c)).alias(c) for c in SUMS])


def _summed(differences: DataFrame) -> DataFrame:
    """Sums by split and word; what comes to nothing takes no row."""
    sums = differences.groupBy("split", "word").agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.filter(" OR ".join(f"{c} <> 0" for c in SUMS))


def _table(spark, log: str, version: int | None) -> DataFrame:
    sums = _differences(spark, log, version).groupBy("word").agg(
        F.sum("total_count").alias("total_count"), F.sum("doc_freq").alias("doc_freq")
    )
    return sums.filter("doc_freq <> 0")


def _differences(spark, log: str, version: int | None) -> DataFrame:
    """The last base that the version allows, and the changes after it."""
    changes = versions(spark, log)
    version = max(changes, default=0) if version is None else version
    if version and version not in changes:
        raise ValueError(f"the log has no version {version}")
    base = max((b for b in _complete(spark, log, "base") if b <= version), default=0)
    paths = [_path(log, "base", base)] if base else []
    paths += [_path(log, "change", v) for v in changes if base < v <= version]
    if not paths:
        return spark.createDataFrame([], DIFFERENCES)
    return spark.read.schema(DIFFERENCES).parquet(*paths)


def _commit(spark, log: str, differences: DataFrame) -> int:
    version = max(_numbers(spark, log, "change-*"), default=0) + 1
    differences.write.mode("error").parquet(_path(log, "change", version))
    return version


def _path(log: str, kind: str, version: int) -> str:
    return f"{log.rstrip('/')}/{kind}-{version:08d}"


def _complete(spark, log: str, kind: str) -> list[int]:
    return _numbers(spark, log, f"{kind}-*/_SUCCESS")


def _numbers(spark, log: str, pattern: str) -> list[int]:
    """Version numbers in the names of the folders that match, in whatever store the log is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{log.rstrip('/')}/{pattern}")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    depth = pattern.count("/") + 1
    names = [str(found.getPath()).split("/")[-depth] for found in store.globStatus(path) or []]
    return [int(name.rpartition("-")[2]) for name in names]
