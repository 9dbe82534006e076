"""Multinomial Naive Bayes in closed form, over tables.

It fits and scores the same model as the ML classifier on the same features; the parameters
are rows that can be queried and checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.functions.words import split_clean_words
from wordloom.options import Options

MOST_CLASSES = 1_000


def class_priors(docs: DataFrame, options: Options = Options()) -> DataFrame:
    """(label, n_docs, log_prior), one row per class."""
    with_label = docs.filter(F.col("label").isNotNull())
    counts = with_label.groupBy("label").agg(F.count("*").alias("n_docs"))
    # One row per class, so a window over all of them is small.
    whole = Window.partitionBy()
    docs_in_all, classes = F.sum("n_docs").over(whole), F.count("*").over(whole)
    smoothed = (F.col("n_docs") + options.smoothing) / (
        docs_in_all + classes * F.lit(options.smoothing)
    )
    return counts.select("label", "n_docs", F.log(smoothed).alias("log_prior"))


def word_likelihoods(
    docs: DataFrame, vocab: DataFrame, options: Options = Options(), classes=None
) -> DataFrame:
    """(word, label, idf, theta_bow, theta_tfidf): log-likelihood weights, all words x classes.

    The classes are those of the labels, read by a job of its own unless they are given.

    One scan, one shuffle on the word; counts per class are columns until the table is bounded
    by the vocabulary, so no class becomes a single group. A word's TF-IDF mass is its count
    times its IDF, so plain words are enough and nothing is counted per text.
    """
    if classes is None:
        classes = label_classes(docs)
    words = _words(docs, "label").join(F.broadcast(vocab.select("word")), "word")
    sums = [
        F.count_if(F.col("label") == label).cast("double").alias(f"n_{i}")
        for i, label in enumerate(classes)
    ]
    seen = words.groupBy("word").agg(*sums)
    # Words the labelled texts lack stay in the model with nothing but the smoothing.
    weights = vocab.select("word", "idf").join(seen, "word", "left")
    by_class = weights.select(
        "word",
        "idf",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.coalesce(f"n_{i}", F.lit(0.0)).alias("bow"),
                        F.coalesce(F.col(f"n_{i}") * F.col("idf"), F.lit(0.0)).alias("tfidf"),
                    )
                    for i, label in enumerate(classes)
                ]
            )
        ),
    )
    # A window per class holds one row per vocabulary word, so it is bounded as the table is.
    whole_class = Window.partitionBy("label")
    blocks = options.feature_blocks
    mass = sum(F.sum(block).over(whole_class) for block in blocks)
    features = F.count("*").over(whole_class) * len(blocks)
    denominator = mass + F.lit(options.smoothing) * features
    thetas = []
    for block in ("bow", "tfidf"):
        log_share = F.log((F.col(block) + options.smoothing) / denominator)
        theta = log_share if block in blocks else F.lit(0.0)
        thetas.append(theta.alias(f"theta_{block}"))
    return by_class.select("word", "label", "idf", *thetas)


def label_classes(docs: DataFrame) -> list[int]:
    """The labels in order. More than `MOST_CLASSES` are refused: each becomes a column."""
    found = docs.filter(F.col("label").isNotNull()).select("label").distinct()
    labels = [row.label for row in found.limit(MOST_CLASSES + 1).collect()]
    if len(labels) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    return sorted(labels)


def score_classes(docs: DataFrame, priors: DataFrame, likelihoods: DataFrame, *keys: str):
    """(keys, label, joint, probability) per cleaned text and class, for any number of classes.

    `joint` is the log of prior times likelihood. The weights (vocabulary x classes) are broadcast;
    one partly summed row per text is shuffled, with the classes as an array. More than
    `MOST_CLASSES` are an error, as each is a column.
    """
    keys = keys or ("doc_id",)
    classes = label_classes(priors)
    weight = F.col("theta_bow") + F.col("theta_tfidf") * F.col("idf")
    wide = likelihoods.groupBy("word").agg(
        *[F.sum(F.when(F.col("label") == c, weight)).alias(f"w{k}") for k, c in enumerate(classes)]
    )
    words = _words(docs, *keys).join(F.broadcast(wide), "word", "left")
    sums = words.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(f"w{k}"), F.lit(0.0))).alias(f"w{k}") for k in range(len(classes))]
    )
    pairs = [F.struct(F.lit(c).alias("label"), F.col(f"w{k}").alias("sum")) for k, c in enumerate(classes)]
    listed = sums.select(*keys, F.inline(F.array(*pairs)))
    joined = listed.join(F.broadcast(priors.select("label", "log_prior")), "label")
    joint = joined.select(*keys, "label", (F.col("sum") + F.col("log_prior")).alias("joint"))
    # As many rows per text as there are classes.
    text = Window.partitionBy(*keys)
    best = F.max("joint").over(text)
    share = F.exp(F.col("joint") - F.col("best"))
    both = joint.withColumn("best", best).withColumn("share", share)
    probability = F.col("share") / F.sum("share").over(text)
    return both.select(*keys, "label", "joint", probability.alias("probability"))


def score(docs: DataFrame, priors: DataFrame, likelihoods: DataFrame, *keys: str) -> DataFrame:
    """(keys, prediction, margin, probability_negative, probability_positive) per cleaned text.

    The weights (vocabulary x 2 classes) are broadcast, so only one partly summed row per text
    is shuffled. A text without a known word keeps its row and is scored by the priors. Labels
    other than 0 and 1 in the tables are an error: `score_classes` takes any.
    """
    keys = keys or ("doc_id",)
    wide = likelihoods.groupBy("word", "idf").agg(
        F.sum(_signed("theta_bow")).alias("bow"), F.sum(_signed("theta_tfidf")).alias("tfidf")
    )
    weight = F.col("bow") + F.col("tfidf") * F.col("idf")
    weights = wide.select("word", weight.alias("weight"))
    words = _words(docs, *keys).join(F.broadcast(weights), "word", "left")
    bias = priors.agg(F.sum(_signed("log_prior"))).scalar()
    margins = words.groupBy(*keys).agg(
        F.sum(F.coalesce(F.col("weight"), F.lit(0.0))).alias("_evidence")
    )
    margin = F.col("_evidence") + bias
    scored = margins.select(*keys, margin.alias("margin"))
    return scored.select(
        *keys,
        (F.col("margin") > 0).cast("int").alias("prediction"),
        "margin",
        (1 / (1 + F.exp(F.col("margin")))).alias("probability_negative"),
        (1 / (1 + F.exp(-F.col("margin")))).alias("probability_positive"),
    )


def _words(docs: DataFrame, *keys: str) -> DataFrame:
    words = F.explode_outer(split_clean_words(F.col("text")))
    return docs.select(*keys, words.alias("word"))


def _signed(column: str):
    other = F.raise_error(F.lit("a two-class score needs labels 0 and 1"))
    return (
        F.when(F.col("label") == 1, F.col(column))
        .when(F.col("label") == 0, -F.col(column))
        .otherwise(other.cast("double"))
    )
