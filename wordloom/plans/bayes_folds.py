"""Cross-validation of the closed-form Naive Bayes from counts per fold.

All that a fit needs of a training part are sums over its texts. They are taken once, for each word,
fold and label; the training part of a fold is everything less that fold. So five vocabularies,
fifteen fits and their scores come from one pass for the counts and one for the scores, over texts
that are read from their source once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.words import keeps_word, split_clean_words
from wordloom.operators.bayes import label_classes
from wordloom.operators.pairs import WHOLE_TEXT
from wordloom.operators.wordstats import top_words, with_count_bounds
from wordloom.options import Options
from wordloom.plans.pipeline import Vocabulary
from wordloom.session import cut

#: The fold of texts that take part in every vocabulary and are never held out, and the model of
#: the vocabulary that leaves out no fold.
NO_FOLD = -1


@dataclass(frozen=True)
class FoldCounts:
    """Sums per (word, fold, label), and what is known of whole texts on the driver."""

    table: DataFrame
    classes: list[int]
    #: Texts by fold and label.
    texts: dict[tuple[int, int | None], int]

    def texts_outside(self, fold: int) -> int:
        return sum(n for (f, _), n in self.texts.items() if f != fold)

    def of_class_outside(self, fold: int, label: int) -> int:
        return sum(n for (f, c), n in self.texts.items() if f != fold and c == label)


def fold_counts(rows: DataFrame, options: Options) -> FoldCounts:
    """One pass over (text, label, fold): uses and texts of each word, by fold and label.

    Sorted words put equal ones side by side, so a text's first use of a word is told by its
    neighbour. Partial sums keep a frequent word from meeting in one task.
    """
    words = F.array_append(split_clean_words(F.col("text")), WHOLE_TEXT)
    listed = rows.select("label", "fold", F.sort_array(words).alias("_words"))
    placed = listed.select("label", "fold", "_words", F.posexplode("_words").alias("pos", "word"))
    new = (F.col("pos") == 0) | (F.get("_words", F.col("pos") - 1) != F.col("word"))
    kept = keeps_word(F.col("word"), options) | (F.col("word") == WHOLE_TEXT)
    counts = placed.select("word", "fold", "label", new.cast("bigint").alias("first")).filter(kept)
    table = cut(
        counts.groupBy("word", "fold", "label").agg(
            F.count("*").alias("uses"), F.sum("first").alias("texts")
        )
    )
    whole = table.filter(F.col("word") == WHOLE_TEXT).collect()
    classes = label_classes(table.filter(F.col("word") == WHOLE_TEXT))
    texts = {(r.fold, r.label): r.texts for r in whole}
    return FoldCounts(table.filter(F.col("word") != WHOLE_TEXT), classes, texts)


def fold_vocabularies(counts: FoldCounts, options: Options, leaky: bool = False) -> DataFrame:
    """(model, word, idf, total_count): the feature words of each fold's training part, by
    subtraction, and of all texts."""
    folds = range(options.cv_folds)
    of_fold = [
        F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}_{k}")
        for k in folds
        for c in ("uses", "texts")
    ]
    words = cut(
        counts.table.groupBy("word").agg(
            F.sum("uses").alias("uses"), F.sum("texts").alias("texts"), *of_fold
        )
    )
    parts = None
    for k in (NO_FOLD, *folds):
        every = leaky or k == NO_FOLD
        own = (lambda c: F.lit(0)) if every else (lambda c, k=k: F.col(f"{c}_{k}"))
        total = sum(counts.texts.values()) if every else counts.texts_outside(k)
        outside = words.select(
            "word",
            (F.col("uses") - own("uses")).alias("total_count"),
            (F.col("texts") - own("texts")).alias("doc_freq"),
        ).filter("total_count > 0")
        bounded = with_count_bounds(outside, F.lit(total), options)
        top = top_words(bounded, options).orderBy(F.desc("total_count"), "word")
        idf = F.log((F.lit(float(total)) + 1) / (F.col("doc_freq") + 1))
        part = top.limit(options.max_features).select(
            F.lit(k).alias("model"), "word", idf.alias("idf"), "total_count"
        )
        parts = part if parts is None else parts.union(part)
    return parts


def fold_weights(
    counts: FoldCounts, vocabularies: DataFrame, options: Options, smoothings: list[float]
) -> DataFrame:
    """(model, word, weights): log-likelihoods by grid point and class, one after the other.

    As many rows as the vocabularies have; class counts are columns, so no class is a group.
    """
    classes = range(len(counts.classes))
    blocks = options.feature_blocks
    outside = (F.col("fold") != F.col("model")) | F.col("fold").isNull()
    n = [
        F.sum(F.when(outside & (F.col("label") == label), F.col("uses")).otherwise(0)).cast("double").alias(f"n_{c}")
        for c, label in enumerate(counts.classes)
    ]
    # The vocabularies have at most max_features words of bounded length for each fold.
    vocabularies = vocabularies.filter(F.col("model") != NO_FOLD)
    seen = counts.table.filter(F.col("label").isNotNull()).join(F.broadcast(vocabularies), "word")
    found = seen.groupBy("model", "word").agg(*n)
    each = vocabularies.join(found, ["model", "word"], "left").select(
        "model", "word", "idf", *[F.coalesce(f"n_{c}", F.lit(0.0)).alias(f"n_{c}") for c in classes]
    )
    each = cut(each)
    value = {"bow": lambda c: F.col(f"n_{c}"), "tfidf": lambda c: F.col(f"n_{c}") * F.col("idf")}
    mass = each.groupBy("model").agg(
        F.count("*").alias("features"),
        *[F.sum(sum(value[b](c) for b in blocks)).alias(f"mass_{c}") for c in classes],
    )
    scale = {"bow": F.lit(1.0), "tfidf": F.col("idf")}

    def weight(smoothing: float, c: int) -> Column:
        whole = F.col(f"mass_{c}") + F.col("features") * F.lit(float(len(blocks)) * smoothing)
        return sum(scale[b] * F.log((value[b](c) + smoothing) / whole) for b in blocks)

    weights = F.array(*[weight(s, c) for s in smoothings for c in classes])
    return each.join(F.broadcast(mass), "model").select("model", "word", weights.alias("weights"))


def fold_accuracies(
    rows: DataFrame, counts: FoldCounts, weights: DataFrame, smoothings: list[float]
) -> DataFrame:
    """(model, point, accuracy): each fold's labelled texts scored by the fit without them."""
    size = len(counts.classes)
    held_out = rows.filter(F.col("label").isNotNull() & (F.col("fold") != NO_FOLD))
    words = held_out.select("row", "fold", "label", F.explode(split_clean_words(F.col("text"))).alias("word"))
    known = words.join(F.broadcast(weights.withColumnRenamed("model", "fold")), ["fold", "word"], "left")
    at = range(len(smoothings) * size)
    sums = known.groupBy("row", "fold", "label").agg(
        *[F.sum(F.coalesce(F.get("weights", F.lit(i)), F.lit(0.0))).alias(f"s{i}") for i in at]
    )
    hits = []
    for p, smoothing in enumerate(smoothings):
        # A class that the training part lacks is none of its fit's.
        joint = F.array(
            *[F.col(f"s{p * size + c}") + _log_prior(counts, label, smoothing) for c, label in enumerate(counts.classes)]
        )
        best = F.array_position(joint, F.array_max(joint)) - 1
        labels = F.array(*[F.lit(label) for label in counts.classes])
        hits.append((F.get(labels, best.cast("int")) == F.col("label")).cast("double").alias(f"hit_{p}"))
    scored = sums.select("fold", *hits)
    points = [F.struct(F.lit(p).alias("point"), F.avg(f"hit_{p}").alias("accuracy")) for p in range(len(smoothings))]
    return scored.groupBy(F.col("fold").alias("model")).agg(F.array(*points).alias("points")).select(
        "model", F.inline("points")
    )


def _log_prior(counts: FoldCounts, label: int, smoothing: float) -> Column:
    """The log prior of a class in the training part of the row's fold."""
    out = F.lit(float("-inf"))
    for fold in sorted({f for f, _ in counts.texts}):
        of = {c: counts.of_class_outside(fold, c) for c in counts.classes}
        there = {c: n for c, n in of.items() if n}
        if label in there:
            share = (there[label] + smoothing) / (sum(there.values()) + smoothing * len(there))
            out = F.when(F.col("fold") == fold, F.log(F.lit(share))).otherwise(out)
    return out


def cross_validated_bayes(
    train: DataFrame,
    smoothings: list[float],
    options: Options = Options(),
    leaky: bool = False,
    unsupervised: DataFrame | None = None,
) -> tuple[list[float], Vocabulary]:
    """The mean accuracy of each smoothing over the folds, in their order, and the feature words
    of all texts.

    `train` holds stored, cleaned (text, label, fold) rows, `unsupervised` further texts for the
    words and weights. Labels are any integers. A fold without labelled texts has no accuracy and
    counts in no mean; without any the means are 0.
    """
    rows = train.select("text", "label", "fold")
    if unsupervised is not None:
        more = unsupervised.select("text", F.lit(None).cast("int").alias("label"), F.lit(NO_FOLD).alias("fold"))
        rows = rows.unionByName(more)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    counts = fold_counts(rows, options)
    vocabularies = cut(fold_vocabularies(counts, options, leaky))
    order = [F.desc("total_count"), F.asc("word")]
    top = vocabularies.filter(F.col("model") == NO_FOLD).orderBy(*order).collect()
    vocabulary = Vocabulary(tuple(r.word for r in top), tuple(r.idf for r in top))
    if not counts.classes:
        return [0.0] * len(smoothings), vocabulary
    weights = fold_weights(counts, vocabularies, options, smoothings)
    means = fold_accuracies(rows, counts, weights, smoothings).groupBy("point").agg(F.avg("accuracy").alias("mean"))
    found = {r.point: r["mean"] for r in means.collect()}
    return [found.get(p, 0.0) for p in range(len(smoothings))], vocabulary
