"""Document quality by a regularised quadratic discriminant over document statistics."""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwright.session import shared_dir

SHRINKAGE = 0.1
THRESHOLD = 0.3
#: Each statistic is held within so many deviations of the labelled rows.
REACH = 8.0
FEATURES = [
    "log_words",
    "word_length",
    "word_length_spread",
    "letters",
    "upper",
    "digits",
    "symbols",
    "marks",
    "ends",
    "spaces",
    "entropy",
    "distinct_words",
    "top_word",
    "bare_words",
    "short_words",
    "repeated_lines",
]
_BYTE_CLASSES = {
    "lower": [*range(97, 123), *range(128, 256)],
    "upper": range(65, 91),
    "digits": range(48, 58),
    "symbols": b"#*$%&|<>~^_=+@{}[]\\/",
    "marks": b"!?",
    "ends": b".,;:",
    "spaces": b" \t\n\r\x0b\x0c",
}
_CLASS_OF_BYTE = np.zeros((len(_BYTE_CLASSES), 256))
for _row, _members in enumerate(_BYTE_CLASSES.values()):
    _CLASS_OF_BYTE[_row, list(_members)] = 1


def _log_share(part: float, whole: float) -> float:
    """A share on a log scale, so that 0.1 % and 1 % are as far apart as 10 % and 100 %."""
    return math.log((part + 0.5) / (whole + 1.0))


def statistics(text: str) -> list[float]:
    """The statistics in FEATURES of one text, whole; an empty text has the values of nothing counted."""
    raw = text.encode()
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lower, upper, digits, symbols, marks, ends, spaces = (_CLASS_OF_BYTE @ histogram).tolist()
    size = len(raw)
    words = text.split()
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = histogram[histogram > 0] / max(size, 1)
    return [
        math.log1p(len(words)),
        math.log1p(lengths.mean()) if words else 0.0,
        math.log1p(lengths.std()) if words else 0.0,
        _log_share(size - lower - upper, size),
        _log_share(upper, size),
        _log_share(digits, size),
        _log_share(symbols, size),
        _log_share(marks, size),
        _log_share(ends, size),
        _log_share(spaces, size),
        float(-(share * np.log(share)).sum()),
        math.log1p(len(counts)) / math.log(len(words) + 2),
        _log_share(max(counts.values(), default=0), len(words)),
        _log_share(sum(n for w, n in counts.items() if not any(map(str.isalnum, w))), len(words)),
        _log_share(float((lengths <= 3).sum()), len(words)),
        _log_share(len(lines) - len(set(lines)), len(lines)),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the array ``x`` of statistics, a row for each row of docs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "x": [statistics(t) for t in batch["text"]]})

    # The id travels as text: pandas would make a float of a long with nulls.
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, "id string, x array<double>").select(
        F.col("id").cast("long").alias("doc_id"), "x"
    )


def held_out(doc_id) -> "F.Column":
    """Rows whose labels are never learnt from; a null id has no label to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Discriminant:
    """A Gaussian for each class with its inverse Cholesky factor, and the log of the classes' odds."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverses: list[np.ndarray]
    log_dets: list[float]
    log_odds: float
    constant: float | None = None

    def transformed(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -REACH, REACH)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 by the difference of the log densities."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self.transformed(x)
        log_density = [
            -0.5 * (((z - mean) @ inverse.T) ** 2).sum(axis=1) - 0.5 * log_det
            for mean, inverse, log_det in zip(self.means, self.inverses, self.log_dets)
        ]
        difference = np.clip(log_density[1] - log_density[0] + self.log_odds, -700, 700)
        return 1.0 / (1.0 + np.exp(-difference))


def _moments(frame: DataFrame, prepare) -> dict[int, np.ndarray]:
    """By class, the sum of (1, z)(1, z)' over all rows, added up by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for label, rows in batch.groupby("label"):
                z = prepare(np.stack(rows["x"].to_numpy()))
                one = np.hstack([np.ones((len(z), 1)), z])
                sums[label] = sums.get(label, 0) + one.T @ one
        for label, matrix in sums.items():
            flat = matrix.ravel()
            yield pd.DataFrame({"label": label, "cell": np.arange(len(flat)), "value": flat})

    cells = frame.select("label", "x").mapInPandas(run, "label int, cell int, value double")
    side = len(FEATURES) + 1
    sums: dict[int, np.ndarray] = {}
    for row in cells.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():  # two small matrices
        sums.setdefault(row.label, np.zeros(side * side))[row.cell] = row.value
    return {label: flat.reshape(side, side) for label, flat in sums.items()}


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From rows with ``label`` 0 or 1 and ``x``.

    Each class's covariance is drawn towards the diagonal of the pooled one by ``shrinkage``. Where a class
    has no rows, every score is the share of class 1, or 0.5 without any labels.
    """
    side = len(FEATURES)
    raw = _moments(labelled, lambda x: x)
    n = {label: raw[label][0, 0] if label in raw else 0.0 for label in (0, 1)}
    if not n[0] or not n[1]:
        share = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        nothing = np.zeros(side)
        return Discriminant(nothing, nothing + 1, [], [], [], 0.0, share)
    both = raw[0] + raw[1]
    centre = both[0, 1:] / both[0, 0]
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / both[0, 0] - centre**2, 1e-6))
    frame = Discriminant(centre, scale, [], [], [], math.log(n[1] / n[0]))
    sums = _moments(labelled, frame.transformed)
    means = [sums[label][0, 1:] / n[label] for label in (0, 1)]
    covariances = [sums[label][1:, 1:] / n[label] - np.outer(means[label], means[label]) for label in (0, 1)]
    pooled = sum(n[label] * covariances[label] for label in (0, 1)) / (n[0] + n[1])
    target = np.diag(np.diag(pooled))
    for covariance in covariances:
        shrunk = (1 - shrinkage) * covariance + shrinkage * target + 1e-6 * np.eye(side)
        factor = np.linalg.cholesky(shrunk)
        frame.inverses.append(np.linalg.inv(factor))
        frame.log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    frame.means = means
    return frame


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and label of the rows to learn from: not held out, with an id and a label of 0 or 1.

    An id that is labelled twice counts with its smaller label.
    """
    plain = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    return (
        plain.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )


def learn(spark: SparkSession, rows: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """The discriminant of all labelled rows of ``rows`` (doc_id, x)."""
    path = shared_dir(spark, "learnt")
    rows.join(known_labels(labels), "doc_id").select("label", "x").write.parquet(path)
    return fit(spark.read.parquet(path), shrinkage)


def with_score(rows: DataFrame, model: Discriminant) -> DataFrame:
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return rows.withColumn("score", score("x"))


def score_documents(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Statistics are taken from the whole text, once, and kept in the shared folder. Labels are learnt from
    all labelled rows that are not held out. A null text is an empty one; a null doc_id stays null and is never
    learnt from; repeated rows are scored each; no rows give no rows. Other columns are left out.
    """
    path = shared_dir(spark, "statistics")
    document_statistics(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    scored = with_score(rows, learn(spark, rows, labels, shrinkage))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_by_quality(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of docs, with all their columns, whose score reaches the threshold.

    Rows are scored where their text is: the text is read twice and never shuffled. A null text is scored as an
    empty one and stays null; repeated rows stay or go together; rows without an id are scored like others; no rows
    give no rows.
    """
    model = learn(spark, document_statistics(docs), labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = [statistics(t) for t in text]
        return pd.Series(model.score(np.array(x)) if x else [], dtype="float64")

    return docs.where(score(F.coalesce("text", F.lit(""))) >= threshold)
