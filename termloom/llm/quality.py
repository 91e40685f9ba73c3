"""Quality scores learnt from preferences between pairs of documents.

Of a good and a bad document the good one is preferred. The Bradley-Terry model
gives each document a score, linear in its features, and the odds that one is
preferred are exp of the difference of their scores; so the weights come from a
logistic loss on feature differences of (good, bad) pairs, without a constant.
The threshold is a quantile of the scores: as large a share of the training
documents lies below it as is labelled bad.

Features are counts and ratios of characters, words and lines, the same for any
language, computed over whole texts in batches. Training uses a bounded,
documented sample of the labelled rows, drawn by hash; the weights are a few
dozen numbers, and every document is scored in one pass without a shuffle.

Null texts count as empty; both have a score like any text. Rows are scored
one by one, so repeated rows have equal scores and null ids stay null. Without
training rows of both labels all scores are 0.5. Empty tables give no row.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import labelled, prepare_workers, uniform

# Labelled rows that a fit reads, at most and about: they are drawn by hash.
SAMPLE_ROWS = 20_000
PAIRS = 100_000
SEED = 5

_DIGITS = bytes(range(0x30, 0x3A))
_UPPER = bytes(range(0x41, 0x5B))
_SYMBOLS = b"#*$%&|<>{}[]=~^_\\/@+"
_PUNCTUATION = b".,;:!?'\"-()"
_ENDS = re.compile(rb"[.!?\"')]\s*$")


def text_features(text: str) -> list[float]:
    """Measures of one text; all are 0 for an empty one."""
    raw = text.encode()
    size = max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_lines = max(1, len(lines))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    again = sum(map(operator.eq, words, words[1:])) / n
    pairs = len(set(zip(words, words[1:], strict=False))) / n
    ended = sum(1 for line in lines if _ENDS.search(line[-8:])) / n_lines
    letters = len(raw.translate(None, _DIGITS + _SYMBOLS + _PUNCTUATION + b" \n\t\r")) / size
    return [
        np.log1p(len(words)),
        len(counts) / n,
        pairs,
        again,
        (counts.most_common(1)[0][1] / n) if words else 0.0,
        len(raw) / n / 10,
        np.log1p(max(map(len, words), default=0)),
        share(_DIGITS),
        share(_UPPER),
        share(_SYMBOLS),
        np.sqrt(share(_SYMBOLS)),
        share(_PUNCTUATION),
        letters,
        np.log1p(len(lines)),
        1 - len(set(lines)) / n_lines if lines else 0.0,
        np.log1p(len(words) / n_lines),
        ended,
        sum(1 for word in words if len(word) < 4) / n,
    ]


N_FEATURES = len(text_features(""))


@dataclass(frozen=True)
class QualityModel:
    """Feature means and scales, weights, threshold and spread of the scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return _bounded((features - self.mean) / self.scale) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 is the threshold."""
        return 1 / (1 + np.exp(-np.clip((self.raw(features) - self.threshold) * self.spread, -500, 500)))


def _bounded(z: np.ndarray) -> np.ndarray:
    """Near 0 as they are; far values count as far, not how far."""
    return 4 * np.tanh(z / 4)


def fit_bradley_terry(
    good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = SEED
) -> QualityModel:
    """Weights from random (good, bad) pairs by Newton's method."""
    both = np.vstack([good, bad])
    width = both.shape[1]
    if not len(good) or not len(bad):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    mean, deviation = both.mean(0), both.std(0)
    scale = np.where(deviation > 1e-9, deviation, 1.0)
    rng = np.random.default_rng(seed)
    z = _bounded((both - mean) / scale)
    differences = (
        z[rng.integers(0, len(good), pairs)] - z[len(good) + rng.integers(0, len(bad), pairs)]
    )
    weights = np.zeros(width)
    for _ in range(50):
        preferred = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
        gradient = differences.T @ (preferred - 1) / pairs + ridge * weights
        curvature = (differences * (preferred * (1 - preferred))[:, None]).T @ differences / pairs
        step = np.linalg.solve(curvature + ridge * np.eye(width), gradient)
        weights -= step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(z @ weights)
    threshold = float(raw[len(bad) - 1] + raw[len(bad)]) / 2
    return QualityModel(mean, scale, weights, threshold, 1.0)


def _features(documents: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the features of each text as an array."""
    prepare_workers(documents.sparkSession)
    table = documents.select(*keep, "text")
    fields = ", ".join(f"{name} {table.schema[name].dataType.simpleString()}" for name in keep)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(rows, pa.list_(pa.float64()))],
                names=[*keep, "features"],
            )

    return table.mapInArrow(measure, f"{fields}, features array<double>")


def train_quality(
    documents: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> QualityModel:
    """A model from the documents that have a label in ``labels``."""
    known = labelled(labels, label)
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    # About sample_rows ids, whatever the number of labels.
    drawn = known.filter(uniform("doc_id", seed=SEED) < share)
    texts = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    # Ids are drawn, and rows may share one: the limit holds all the same.
    rows = _features(texts, ["label"]).orderBy(F.xxhash64("features"), "label").limit(4 * sample_rows)
    rows = rows.toPandas()
    features = np.array(rows["features"].tolist(), float).reshape(-1, N_FEATURES)
    return fit_bradley_terry(features[rows["label"] == 1], features[rows["label"] == 0])


def quality_scores(documents: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """The documents, every column kept, and the score of each text.

    A column that has the score's name already is replaced.
    """
    prepare_workers(documents.sparkSession)
    kept = documents.drop(column) if column in documents.columns else documents

    # On Arrow as it is, so that workers need no pandas.
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        features = [text_features(text.as_py() or "") for text in texts]
        return pa.array(model.score(np.array(features, float).reshape(-1, N_FEATURES)))

    return kept.withColumn(column, score(F.col("text")))
