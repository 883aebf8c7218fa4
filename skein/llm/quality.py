"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of a whole text (counts of kinds of characters, words, lines, repeats) are transformed towards normal shape.
Each class has a mean and a covariance shrunk towards its diagonal and towards the pooled covariance; the score is the
logistic of the difference of Mahalanobis log densities plus log priors, with Cholesky factors computed once. Sums for
means and covariances are added up over all labelled rows, in the executors; the driver gets two classes' sums.

Odd inputs: null and blank texts have statistics of zeros and are scored by them; null labels and labels other than 0
and 1 are not learned; several labels of one id are rows of their own; rows of null id are scored, never learned and
not held out; without labels every score is 0.5, with one class only it is that class; other columns may have any
names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import materialize, slices

FOLDS, THRESHOLD = 5, 0.3
#: Shrinkage towards the own diagonal and towards the pooled covariance; least variance of a statistic.
TO_DIAGONAL, TO_POOLED, LEAST_VARIANCE = 0.1, 0.05, 1e-4
STATISTICS = ["word_length", "distinct", "top_word", "upper", "symbols", "marks", "digits", "lines", "other_bytes", "plain_words", "capital_words", "distinct_lines", "sentence"]
#: Words that each text starts from, their length with the blank, their shares of capitals, symbols, marks, digits, line feeds, other bytes.
PRIOR, PRIOR_LENGTH, _ORDINARY = 20.0, 6.0, np.array([0.02, 0.0, 0.025, 0.0, 0.01, 0.02])
_KIND = np.zeros((256, 6))
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*+/<=>@[\\]^_`{|}~!", b".,;:?'\"()-", b"0123456789", b"\n", bytes(range(128, 256)))):
    _KIND[list(_chars), _i] = 1


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    # a text starts from PRIOR words of ordinary make, so that a few words alone say little
    kinds = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KIND + PRIOR * PRIOR_LENGTH * _ORDINARY) / (len(raw) + PRIOR * PRIOR_LENGTH)
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    lines = raw.split(b"\n")
    plain = sum(map(bytes.isalnum, words)) + 0.7 * PRIOR
    capital = sum(map(bytes.isupper, words))
    ends = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".") + PRIOR / 9
    upper, symbols, marks, digits, feeds, other = np.sqrt(kinds).tolist()
    m = n + PRIOR
    return [
        np.log((len(raw) + PRIOR * PRIOR_LENGTH) / m),
        np.log(len(counts) + PRIOR) / np.log(m),  # distinct words fall off with length: the exponent is the steadier statistic
        np.sqrt(max(counts.values()) / m),
        upper,
        symbols,
        marks,
        digits,
        feeds,
        other,
        np.sqrt(plain / m),
        np.sqrt(capital / m),
        (len(set(lines)) + 3) / (len(lines) + 3),
        np.log(m / ends),
    ]


@F.arrow_udf(ArrayType(DoubleType()))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in slices(batch):
            yield pa.array([statistics(text) for text in texts], pa.list_(pa.float64()))


def statistics_of(text: Column) -> Column:
    return _statistics(text)


class Discriminant:
    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> None:
        """sums: for each class the number of rows, the sum of their vectors and of the outer products."""
        sums = {k: v for k, v in sums.items() if v[0] > 0}
        self.only = None if len(sums) == 2 else float(max(sums)) if sums else 0.5
        if self.only is not None:
            return
        total = sum(n for n, _, _ in sums.values())
        own = {k: outer / n - np.outer(s / n, s / n) for k, (n, s, outer) in sums.items()}
        pooled = sum(sums[k][0] / total * own[k] for k in sums)
        self.classes = {}
        for k, (n, s, _) in sums.items():
            cov = (1 - TO_POOLED) * own[k] + TO_POOLED * pooled
            cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + LEAST_VARIANCE * np.eye(len(s))
            factor = np.linalg.cholesky(cov)
            self.classes[k] = (s / n, np.linalg.inv(factor), np.log(n / total) - np.log(np.diag(factor)).sum())

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if self.only is not None:
            return np.full(len(x), self.only)
        density = {k: const - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1) for k, (mean, inverse, const) in self.classes.items()}
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, at, value): this partition's count, sum and outer products of each class, laid out by at."""
    d = len(STATISTICS)
    held = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
        for k in (0, 1):
            own = x[label == k]
            held[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    label, at = np.indices(held.shape)
    yield pa.record_batch({"label": label.ravel(), "at": at.ravel(), "value": held.ravel()})


def fit(rows: DataFrame) -> Discriminant:
    """From rows (label 0 or 1, x array of statistics): all of them, without a sample."""
    d = len(STATISTICS)
    found = rows.select(F.col("label").cast("long"), "x").mapInArrow(_sums, "label long, at long, value double").groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    held = np.zeros((2, 1 + d + d * d))
    for label, at, value in found:
        held[label, at] = value
    return Discriminant({k: (held[k, 0], held[k, 1 : 1 + d], held[k, 1 + d :].reshape(d, d)) for k in (0, 1)})


def score_of(model: Discriminant, x: Column) -> Column:
    @F.arrow_udf(DoubleType())
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.scores(np.asarray(batch.flatten()).reshape(len(batch), -1)) if len(batch) else [], pa.float64())

    return scores(x)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and key, a hash of the text, for every row of docs."""
    rows = materialize(docs.select("doc_id", F.xxhash64("text").alias("key"), statistics_of(F.col("text")).alias("x")), docs.sparkSession)
    marks = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    model = fit(rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).join(marks, "doc_id"))
    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(model, F.col("x")).alias("score"), "key")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier predicts as 1.

    Texts go to Python once, and no stage holds two Python operators (each has workers of its own).
    """
    rows = materialize(docs.select(F.struct("*").alias("row"), statistics_of(F.col("text")).alias("x")), docs.sparkSession)
    marks = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    train = rows.select(F.col("row.doc_id").alias("doc_id"), "x").where(~held_out(F.col("doc_id"))).join(marks, "doc_id")
    return rows.where(score_of(fit(train), F.col("x")) >= THRESHOLD).select("row.*")
