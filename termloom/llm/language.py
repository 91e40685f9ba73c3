"""Language of a text by a convolutional network over its bytes.

A text is cut into windows of ``WINDOW`` bytes. In a window every byte has a
learnt vector; filters of several widths slide over them, each keeps its
highest answer, and a softmax over these names the language. A text has the
language with the highest mean probability over all of its windows, long texts
and short ones alike, weighed by the bytes a window holds.

Training is plain numpy with Adam on windows of a bounded, documented number of
labelled texts, about as many of every language, drawn by hash. Windows are
cut where the texts are and only they come to the driver. The network has some
ten thousand numbers, whatever the data, and every text is labelled in one pass
without a shuffle, a bounded number of windows at a time.

A text that is null or has no letter is ``und`` with score 0. Rows are labelled
one by one, so repeated rows have equal answers and null ids stay null; rows
with a null label are not learnt from. Without any label every answer is
``und``. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import prepare_workers, uniform

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
BYTE_DIM = 8
# Texts of each language to learn from, about, and windows of each of them.
TEXTS_PER_LANGUAGE = 800
WINDOWS_PER_TEXT = 3
MAX_LANGUAGES = 1000
EPOCHS = 6
BATCH = 64
# Windows labelled at a time.
CHUNK = 512
SEED = 2


def windows_of(raw: bytes, start: int = 0, count: int | None = None) -> np.ndarray:
    """Windows of the bytes as rows, the last one filled up with zeros."""
    total = max(1, -(-len(raw) // WINDOW))
    stop = total if count is None else min(total, start + count)
    part = np.frombuffer(raw[start * WINDOW : stop * WINDOW], np.uint8)
    out = np.zeros((stop - start) * WINDOW, np.uint8)
    out[: len(part)] = part
    return out.reshape(-1, WINDOW)


@dataclass
class ByteNet:
    """The network's numbers; rows of the last layer are filters, columns languages."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    output_bias: np.ndarray

    @classmethod
    def random(cls, languages: list[str], rng: np.random.Generator) -> ByteNet:
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        return cls(
            languages,
            rng.normal(0, 0.5, (256, BYTE_DIM)).astype(np.float32),
            [draw(width * BYTE_DIM, FILTERS) for width in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(len(WIDTHS) * FILTERS, len(languages)),
            np.zeros(len(languages), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.output_bias]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest answer of each filter over each window, and where it was.

        Filters see all places as the windows' vectors cut into stretches of
        the filter's width, once for each place a stretch may begin at: so the
        convolution is a few plain matrix products and copies nothing.
        """
        n = len(windows)
        vectors = self.embedding[windows]
        best, where = [], []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            top = np.full((n, FILTERS), -np.inf, np.float32)
            at = np.zeros((n, FILTERS), np.int32)
            for shift in range(width):
                places = (WINDOW - shift) // width
                part = vectors[:, shift : shift + places * width]
                answers = (part.reshape(n, places, width * BYTE_DIM) @ weights).astype(np.float32)
                index = answers.argmax(1)
                value = np.take_along_axis(answers, index[:, None], 1)[:, 0]
                better = value > top
                top = np.where(better, value, top)
                at = np.where(better, index * width + shift, at)
            best.append(top)
            where.append(at)
        return np.concatenate(best, 1), np.concatenate(where, 1)

    def highest(self, windows: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places."""
        n = len(windows)
        vectors = self.embedding[windows]
        best = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            top = None
            for shift in range(width):
                places = (WINDOW - shift) // width
                part = vectors[:, shift : shift + places * width].reshape(n * places, width * BYTE_DIM)
                value = (part @ weights).reshape(n, places, FILTERS).max(1)
                top = value if top is None else np.maximum(top, value)
            best.append(top)
        return np.concatenate(best, 1)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        bias = np.concatenate(self.biases)
        logits = np.maximum(pooled + bias, 0) @ self.output + self.output_bias
        odds = np.exp(logits - logits.max(1, keepdims=True))
        return odds / odds.sum(1, keepdims=True)

    def probabilities(self, raw: bytes) -> np.ndarray:
        """Mean probabilities of a text's windows, weighed by their bytes."""
        total = np.zeros(len(self.languages))
        windows = max(1, -(-len(raw) // WINDOW))
        for start in range(0, windows, CHUNK):
            part = windows_of(raw, start, CHUNK)
            weight = np.full(len(part), WINDOW, float)
            if start + len(part) == windows:
                weight[-1] = max(1, len(raw) - (windows - 1) * WINDOW)
            total += weight @ self._softmax(self.highest(part))
        return total / total.sum()

    def batch_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Rows of ``probabilities``, short texts together."""
        result = np.zeros((len(texts), len(self.languages)))
        held: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            nonlocal held, parts, size
            if not held:
                return
            scores = self._softmax(self.highest(np.concatenate(parts)))
            start = 0
            for row, part in zip(held, parts, strict=True):
                weight = np.full(len(part), WINDOW, float)
                weight[-1] = max(1, len(texts[row]) - (len(part) - 1) * WINDOW)
                result[row] = weight @ scores[start : start + len(part)] / weight.sum()
                start += len(part)
            held, parts, size = [], [], 0

        for row, raw in enumerate(texts):
            if len(raw) > CHUNK * WINDOW:
                result[row] = self.probabilities(raw)
                continue
            part = windows_of(raw)
            if size + len(part) > CHUNK:
                flush()
            held.append(row)
            parts.append(part)
            size += len(part)
        flush()
        return result


def train_byte_net(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = SEED
) -> ByteNet:
    """Cross entropy by Adam, on windows that are rows of bytes."""
    rng = np.random.default_rng(seed)
    net = ByteNet.random(languages, rng)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            gradients = _gradients(net, windows[rows], labels[rows])
            for p, g, m, v in zip(net.parameters(), gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: ByteNet, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    n = len(windows)
    pooled, where = net.pooled(windows)
    hidden = np.maximum(pooled + np.concatenate(net.biases), 0)
    wrong = net._softmax(pooled)
    wrong[np.arange(n), labels] -= 1
    wrong /= n
    d_output, d_output_bias = hidden.T @ wrong, wrong.sum(0)
    d_hidden = (wrong @ net.output.T) * (hidden > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_biases = [], []
    for k, (width, weights) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        d_top, at = d_hidden[:, part], where[:, part]
        # The bytes under each filter's highest answer: window, filter, place.
        under = windows[np.arange(n)[:, None, None], at[:, :, None] + np.arange(width)]
        seen = net.embedding[under].reshape(n, FILTERS, width * BYTE_DIM)
        d_filters.append(np.einsum("nf,nfd->df", d_top, seen))
        d_biases.append(d_top.sum(0))
        back = (d_top[:, :, None] * weights.T[None]).reshape(n, FILTERS, width, BYTE_DIM)
        np.add.at(d_embedding, under.ravel(), back.reshape(-1, BYTE_DIM))
    return [d_embedding, *d_filters, *d_biases, d_output, d_output_bias]


def train_language(
    documents: DataFrame, label: str = "lang", texts_per_language: int = TEXTS_PER_LANGUAGE
) -> ByteNet | None:
    """A network for the languages that ``label`` names, None if there are none."""
    spark = documents.sparkSession
    prepare_workers(spark)
    known = documents.filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col(label).cast("string").alias("label"), "doc_id", "text"
    )
    counts = (
        known.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_LANGUAGES).collect()
    )
    languages = sorted(row["label"] for row in counts)
    if not languages:
        return None
    shares = spark.createDataFrame(
        [(row["label"], min(1.0, texts_per_language / row["count"])) for row in counts],
        "label string, share double",
    )
    drawn = known.join(F.broadcast(shares), "label").filter(
        uniform("doc_id", "text", seed=SEED) < F.col("share")
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, rows = [], []
            for language, text in zip(batch.column("label").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_py().encode()
                total = max(1, -(-len(raw) // WINDOW))
                step = max(1, -(-total // WINDOWS_PER_TEXT))
                for start in range(0, total, step):
                    labels.append(language)
                    rows.append(windows_of(raw, start, 1).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()), pa.array(rows, pa.binary())], names=["label", "window"]
            )

    # Rows alike are drawn together, and the limit holds however many they are.
    most = 2 * texts_per_language * WINDOWS_PER_TEXT * len(languages)
    sample = drawn.select("label", "text").mapInArrow(cut, "label string, window binary")
    sample = sample.orderBy(F.xxhash64("window"), "label", "window").limit(most).toPandas()
    sample = sample.sort_values(["label", "window"], ignore_index=True)
    windows = np.frombuffer(b"".join(sample["window"]), np.uint8).reshape(-1, WINDOW)
    index = {language: i for i, language in enumerate(languages)}
    labels = sample["label"].map(index).to_numpy(np.int64)
    return train_byte_net(windows, labels, languages)


def identify_language(
    documents: DataFrame, net: ByteNet | None, language: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The documents, every column kept, and the language of each text with its probability.

    Columns that have these names already are replaced.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    kept = documents.drop(*[name for name in (language, score) if name in documents.columns])
    undetermined = F.lit(UNDETERMINED)
    if net is None:
        return kept.withColumns({language: undetermined, score: F.lit(0.0)})
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("struct<language:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            scores = shared.value.batch_probabilities([(text or "").encode() for text in texts])
            best = scores.argmax(1)
            yield pd.DataFrame(
                {
                    "language": np.array(shared.value.languages, object)[best],
                    "score": np.minimum(1.0, scores[np.arange(len(best)), best]),
                }
            )

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    answered = kept.withColumn("__answer", predict(F.col("text"))).withColumn("__letter", has_letter)
    return answered.withColumns(
        {
            language: F.when(F.col("__letter"), F.col("__answer.language")).otherwise(undetermined),
            score: F.when(F.col("__letter"), F.col("__answer.score")).otherwise(0.0),
        }
    ).drop("__answer", "__letter")
