"""Text quality by regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics of its bytes and words, in one pass
over the table. Sums and cross products per class are added up by Spark, so the fit sees every
labelled row and the driver a few hundred numbers. Each class has its own mean and covariance,
shrunk towards the pooled diagonal; the score is the logistic of the difference of the two
log-densities, with distances from Cholesky factors that are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bytewise import WordHasher, byte_view, lean, lists, lowered, runs, word_limits
from wordloom.llm.names import unused
from wordloom.llm.tables import broadcast_if_small, stored
from wordloom.session import cut

FEATURES = (
    "words word_length length_spread capitals digits symbols stops shouts spaces breaks repeats "
    "variety commonest short_words long_words"
).split()
SHRINKAGE = 0.1
THRESHOLD = 0.7
BINS = 9  # kinds of bytes told apart
BLOCK_BYTES = 1 << 20


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # inner bytes of longer characters
    kind[ord("a") : ord("z") + 1] = 1
    kind[192:] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[33:48] = kind[58:65] = kind[91:97] = kind[123:127] = 4
    kind[[ord(c) for c in ".,;:?'\"()-"]] = 5
    kind[ord("!")] = 6
    kind[[9, 11, 12, 13, 32]] = 7
    kind[10] = 8
    return kind


def statistics(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """The feature vectors of texts given as bytes; a text without words has defined ones too."""
    n = len(offsets) - 1
    kinds, table = np.zeros(n * BINS, np.int64), _kinds()
    for a in range(0, len(data), BLOCK_BYTES):
        length = np.diff(np.clip(offsets, a, a + BLOCK_BYTES))
        text_of_byte = np.repeat(np.arange(n) * BINS, length)
        kinds += np.bincount(text_of_byte + table[data[a : a + BLOCK_BYTES]], minlength=n * BINS)
    kinds = kinds.reshape(n, BINS)
    starts, ends, owner = word_limits(data, offsets)
    words = np.bincount(owner, minlength=n)
    size = (ends - starts).astype(float)
    per_word = np.maximum(words, 1)
    mean = np.bincount(owner, size, minlength=n) / per_word
    spread = np.sqrt(np.bincount(owner, (size - mean[owner]) ** 2, minlength=n) / per_word)
    hashes = hasher(lowered(data), starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    distinct = np.bincount(o[first], minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, o[first], np.diff(np.append(first, len(h))))
    chars = np.maximum(kinds[:, 1:].sum(axis=1), 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)

    def share(part, whole):
        return np.log(part / whole + 0.01)

    return np.column_stack(
        [
            np.log1p(words),
            np.log1p(mean),
            np.log1p(spread),
            share(kinds[:, 2], letters),
            share(kinds[:, 3], chars),
            share(kinds[:, 4], chars),
            share(kinds[:, 5], chars),
            share(kinds[:, 6], chars),
            share(kinds[:, 7], chars),
            share(kinds[:, 8], per_word),
            share(np.bincount(owner[again], minlength=n), per_word),
            # A text of n distinct words out of few repeats them more the longer it is.
            np.log(np.maximum(distinct, 1)) - 0.8 * np.log(per_word),
            share(commonest, per_word),
            share(np.bincount(owner[size <= 3], minlength=n), per_word),
            share(np.bincount(owner[size > 12], minlength=n), per_word),
        ]
    )


def _features(batches):
    hasher = WordHasher()
    for batch in batches:
        data, offsets = byte_view(batch.column("text"))
        for i, j in runs(offsets):
            x = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], hasher)
            names = [n for n in batch.schema.names if n != "text"]
            kept = [batch.column(n).slice(i, j - i) for n in names]
            rows = lists(x.ravel(), np.full(j - i, x.shape[1]))
            yield pa.RecordBatch.from_arrays([*kept, rows], [*names, "features"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, features) for rows (doc_id, text); a null text counts as empty."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(_features), f"doc_id {kind}, features array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Means, lower Cholesky factors and log priors of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    priors: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included."""
        parts = []
        for mean, factor, prior in zip(self.means, self.factors, self.priors):
            z = np.linalg.solve(factor, (x - mean).T)
            parts.append(prior - 0.5 * (z**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return parts[1] - parts[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -500, 500)))


def _moments(batches):
    for batch in batches:
        x = np.array(batch.column("features").to_pylist(), float).reshape(batch.num_rows, -1)
        y = batch.column("label").to_numpy(zero_copy_only=False)
        for label in (0, 1):
            own = x[y == label]
            if len(own):
                sums = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pa.RecordBatch.from_pydict({"label": [label], "sums": [sums.tolist()]})


def fit_quality(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> QualityModel:
    """Fit to (features, label); labels other than 0 and 1 are left out.

    Without rows of a class there is nothing to tell apart: the other class gets all the weight.
    """
    usable = labelled.filter(F.col("label").isin(0, 1)).select(F.col("label").cast("int"), "features")
    parts = usable.mapInArrow(_moments, "label long, sums array<double>")
    place = parts.select("label", F.posexplode("sums").alias("k", "v"))
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for row in place.groupBy("label", "k").agg(F.sum("v").alias("v")).collect():
        total[row["label"], row["k"]] = row["v"]
    counts = total[:, 0]
    many = np.maximum(counts, 1)[:, None]
    means = total[:, 1 : 1 + d] / many
    raw = (total[:, 1 + d :] / many).reshape(2, d, d)
    spreads = raw - means[:, :, None] * means[:, None, :]
    pooled = (spreads * counts[:, None, None]).sum(axis=0) / max(counts.sum(), 1)
    target = np.diag(np.diag(pooled) + 1e-3)
    if not counts.all():
        means = np.repeat(means[counts.argmax()][None], 2, axis=0)
        spreads = np.repeat(spreads[counts.argmax()][None], 2, axis=0)
    shrunk = (1 - shrinkage) * spreads + shrinkage * target
    priors = np.log((counts + 1e-6) / (counts.sum() + 2e-6))
    return QualityModel(means, np.linalg.cholesky(shrunk), priors)


def with_scores(rows: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """Add the chance of class 1 to rows with `features`."""

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack(features.to_list())))

    return rows.withColumn(name, score("features"))


def good_texts(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """The rows of docs that the classifier, fitted as in `quality_scores`, takes for good.

    Texts go through Python alone, without the other columns; what comes back are the digests of
    those that are rejected, which docs are held against.
    """
    model = fit_quality(labelled_statistics(docs, labels), shrinkage)

    def rejected(batches):
        hasher = WordHasher()
        for batch in batches:
            data, offsets = byte_view(batch.column("text"))
            for i, j in runs(offsets):
                part, limits = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                low = np.flatnonzero(model.scores(statistics(part, limits, hasher)) < THRESHOLD)
                digests = [sha256(part[limits[k] : limits[k + 1]]).digest() for k in low]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary())], ["digest"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    (name,) = unused(docs, "digest")
    found = docs.select(text.alias("text")).mapInArrow(lean(rejected), "digest binary").distinct()
    bad = broadcast_if_small(stored(found, "rejected"), F.lit(64)).withColumnRenamed("digest", name)
    own = docs.withColumn(name, F.unhex(F.sha2(text, 256)))
    return own.join(bad, name, "left_anti").drop(name)


def labelled_statistics(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(features, label) of the rows that are not held out and have a label."""
    train = document_statistics(docs.filter(~held_out(F.col("doc_id"))))
    return _with_labels(train, labels)


def _with_labels(table: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(
        F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label")
    )
    return table.join(known, F.col("doc_id") == F.col("labelled_id"))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Rows that no fit may see. A null id is held out too, as no label can belong to it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def quality_scores(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    Learns from the labels (doc_id, quality) of rows that are not held out; rows without a label,
    or with a null one, are only scored. A null text counts as empty, and empty texts are scored
    by their statistics like others. Several labels of one id all count. An empty table gives no
    rows. Extra columns are ignored.
    """
    table = cut(document_statistics(docs).withColumn("held_out", held_out(F.col("doc_id"))))
    train = _with_labels(table.filter(~F.col("held_out")), labels)
    scored = with_scores(table, fit_quality(train, shrinkage))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"))
