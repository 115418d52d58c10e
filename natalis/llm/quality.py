"""Document quality by regularised quadratic discriminant analysis.

A document becomes a short vector of transformed statistics. Each class gets a mean and a covariance that is
shrunk twice: towards the covariance of all classes together and towards a multiple of the identity. The score
is the logistic function of the difference of the two log densities, which come from Mahalanobis distances by
forward substitution with the Cholesky factors kept in the model, plus the log ratio of the class sizes.

Training needs counts, sums and sums of products per class only. Spark adds these up over all labelled rows, so
the driver sees a few hundred numbers whatever the number of documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.llm.shared import bounded_batches, remainder_of_id, saved

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "marks",
    "symbols",
    "exclaims",
    "other_bytes",
    "blanks",
    "distinct_words",
    "top_word",
    "repeated_next",
    "repeated_lines",
    "log_line_length",
    "bare_marks",
)
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _EXCLAIM, _OTHER, _BLANK = range(8)


def _kinds() -> np.ndarray:
    """The kind of each byte value."""
    kind = np.full(256, _OTHER)
    kind[: ord("!")] = _BLANK
    for first, last, what in (("!", "~", _MARK), ("A", "Z", _UPPER), ("a", "z", _LOWER), ("0", "9", _DIGIT)):
        kind[ord(first) : ord(last) + 1] = what
    kind[[ord(c) for c in "#*$%&|<>{}[]=\\^~_"]] = _SYMBOL
    kind[ord("!")] = _EXCLAIM
    return kind


_KIND = _kinds()


_FEW_WORDS, _FEW_BYTES, _FEW_LINES = 20, 100, 3


def _share(part: float, whole: float, few: float) -> float:
    """Root of a share: small shares stay apart, and the spread is about the same everywhere.

    ``few`` units that do not count are added to the whole, since a short text's shares tell little.
    """
    return float(np.sqrt(part / (whole + few)))


def statistics(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one whole text; NULL, empty and blank texts have zeros only."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND, np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=8)
    letters = kinds[_UPPER] + kinds[_LOWER] + kinds[_OTHER]
    solid = kinds.sum() - kinds[_BLANK]
    counts = Counter(words)
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    # distinct words relative to the length, as a power, so that long texts do not look repetitive
    variety = np.log1p(len(counts)) / np.log1p(n)
    return [
        float(np.log1p(n)),
        float(np.log1p(solid / n)),
        _share(kinds[_UPPER], letters, _FEW_BYTES),
        _share(kinds[_DIGIT], solid, _FEW_BYTES),
        _share(kinds[_MARK], solid, _FEW_BYTES),
        _share(kinds[_SYMBOL], solid, _FEW_BYTES),
        _share(kinds[_EXCLAIM], solid, _FEW_BYTES),
        _share(kinds[_OTHER], solid, _FEW_BYTES),
        _share(kinds[_BLANK], len(data), _FEW_BYTES),
        float(variety),
        _share(max(counts.values()), n, _FEW_WORDS),
        _share(again, n, _FEW_WORDS),
        _share(len(lines) - len(set(lines)), len(lines), _FEW_LINES),
        float(np.log1p(len(data) / len(lines))),
        _share(sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()), n, _FEW_WORDS),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Fitted model: one mean, Cholesky factor and log determinant per class, class 1 against class 0."""

    means: np.ndarray
    factors: np.ndarray
    offset: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        logit = np.full(len(rows), self.offset)
        for mean, factor, sign in zip(self.means, self.factors, (0.5, -0.5), strict=True):
            y = (rows - mean).T.copy()
            for i in range(len(y)):  # forward substitution, all rows at once
                y[i] = (y[i] - factor[i, :i] @ y[:i]) / factor[i, i]
            logit += sign * np.einsum("ij,ij->j", y, y)
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -700, 700)))


def fit_moments(
    counts: np.ndarray, sums: np.ndarray, products: np.ndarray, to_common: float = 0.3, to_round: float = 0.05
) -> Discriminant:
    """Model from the class counts (2), sums (2, d) and sums of products (2, d, d).

    A class without rows takes the other's mean and covariance, so that class sizes alone decide (smoothed by
    one row each). Without any rows every score is one half.
    """
    d = sums.shape[1]
    total = counts.sum()
    means, spreads = np.zeros((2, d)), np.zeros((2, d, d))
    for k in (0, 1):
        if counts[k]:
            means[k] = sums[k] / counts[k]
            spreads[k] = products[k] / counts[k] - np.outer(means[k], means[k])
    for k in (0, 1):
        if not counts[k]:
            means[k], spreads[k] = means[1 - k], spreads[1 - k]
    common = (counts[0] * spreads[0] + counts[1] * spreads[1]) / total if total else np.eye(d)
    scale = np.sqrt(np.clip(np.diag(common), 1e-6, None))  # shrinkage acts on features of equal spread
    factors, log_dets = [], []
    for k in (0, 1):
        shrunk = ((1 - to_common) * spreads[k] + to_common * common) / np.outer(scale, scale)
        size = max(np.trace(shrunk) / d, 1e-6)
        shrunk = (1 - to_round) * shrunk + to_round * size * np.eye(d)
        factor = np.linalg.cholesky(shrunk) * scale[:, None]
        factors.append(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    offset = np.log((counts[1] + 1) / (counts[0] + 1)) - 0.5 * (log_dets[1] - log_dets[0])
    return Discriminant(means, np.array(factors), float(offset))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features): the statistics of every whole text."""

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.select(F.col(id_col), of(F.col(text_col).cast("string")).alias("features"))


def fit(
    described: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    train: Column | None = None,
    **shrinkage: float,
) -> Discriminant:
    """Model from the rows of ``described`` (id, features) that ``labels`` marks 0 or 1.

    ``train`` selects rows by the id. Rows with a NULL id or label are not learned from; an id with both labels
    counts as 0. Repeated documents count as often as they occur.
    """
    d = len(FEATURES)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_label"))
    rows = described.filter(train) if train is not None else described
    rows = rows.select(F.col(id_col).alias("_id"), "features").join(known, "_id")

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch["features"].tolist()).reshape(-1, d)
            for k in (0, 1):
                own = x[batch["_label"].to_numpy() == k]
                got[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        place = np.tile(np.arange(got.shape[1]), 2)
        yield pd.DataFrame({"label": np.repeat([0, 1], got.shape[1]), "place": place, "value": got.ravel()})

    parts = rows.select("_label", "features").mapInPandas(moments, "label int, place int, value double")
    total = np.zeros((2, 1 + d + d * d))
    for row in parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        total[row["label"], row["place"]] = row["value"]
    return fit_moments(total[:, 0], total[:, 1 : d + 1], total[:, d + 1 :].reshape(2, d, d), **shrinkage)


def score_of_features(model: Discriminant, column: str | Column = "features") -> Column:
    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(rows.tolist(), dtype=float).reshape(-1, len(FEATURES))))

    return of(column)


def score_of_text(model: Discriminant, column: str | Column = "text") -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))))

    return of(F.col(column).cast("string") if isinstance(column, str) else column)


def training_rows(id_col: str = "doc_id") -> Column:
    """Rows to learn from: those whose id has a nonzero crc32 remainder."""
    return remainder_of_id(id_col) != 0


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every document; the labels of held-out rows are not looked at.

    NULL and empty texts are scored as texts whose statistics are all zero. An empty ``docs`` gives no rows and an
    empty ``labels`` scores of one half.
    """
    described = saved(features(docs, id_col, text_col), "features")
    model = fit(described, labels, id_col, train=training_rows(id_col))
    score = described.select(F.col(id_col), (~training_rows(id_col)).alias("held_out"), score_of_features(model).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns. Texts are not shuffled for it."""
    model = fit(features(docs, id_col, text_col), labels, id_col, train=training_rows(id_col))
    return docs.filter(score_of_text(model, text_col) >= THRESHOLD)
