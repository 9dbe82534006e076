"""Knobs shared by the operators; every default is a fixed value of the data model."""

from __future__ import annotations

from dataclasses import dataclass

ALGORITHMS = ("naive_bayes", "logistic_regression", "random_forest")


@dataclass(frozen=True)
class Options:
    # words
    min_word_length: int = 2
    max_word_length: int = 50
    remove_stopwords: bool = True
    unicode: bool = False
    # vocabulary
    max_vocab_size: int = 10_000
    min_document_frequency: int = 2
    max_document_frequency: float = 0.95
    # features
    use_bow: bool = True
    use_tfidf: bool = True
    ngram_range: tuple[int, int] = (1, 2)
    # The longest n-gram that gets a feature beside the single words.
    feature_ngrams: int = 1
    max_features: int = 5_000
    sequence_length: int = 256
    # models
    algorithm: str = "naive_bayes"
    smoothing: float = 1.0
    test_size: float = 0.2
    random_state: int = 42
    cv_folds: int = 5
    # Partitions that iterative fits place their rows in by id, at least; more rows than fit in
    # them take more (`pipeline.partitions_to_fit`). Cores do not decide it, as bagging is seeded
    # by partition.
    fit_partitions: int = 16
    metrics: tuple[str, ...] = ("accuracy", "precision", "recall", "f1", "auc")

    @property
    def feature_blocks(self) -> tuple[str, ...]:
        """The vector columns that reach the classifier, in assembly order."""
        switches = (("bow", self.use_bow), ("tfidf", self.use_tfidf))
        blocks = tuple(name for name, on in switches if on)
        if not blocks:
            raise ValueError("both feature blocks are off: set use_bow or use_tfidf")
        return blocks

    @property
    def feature_info(self) -> str:
        return "_".join(self.feature_blocks)
