"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts.

Each class has an interpolated Kneser-Ney bigram model. A word's probability
after another falls back on the class's continuation counts (after how many
different words it occurs) and these on the continuation counts of both classes
together, so a word one class has rarely or never seen gets the shared share
in both models, and its ratio is near 1.

A text's evidence is the log ratio of the two likelihoods, normalised by
length: over the whole text, and over each run of as many words as ``SPANS``
says, of which the highest counts, since a long text may be toxic in one place. A logistic curve over both
and the text's length, fitted on labelled texts that the counts have not seen,
turns them into a score.

Counting covers every labelled training text and is a plain aggregation. Words
of fewer than ``MIN_DOCUMENTS`` documents are one unknown word, pairs of fewer
than ``MIN_COUNT`` occurrences are scored by the models' backoff, whatever the
size of the corpus; their counts are in the totals.

The most frequent words and pairs, at most ``MAX_WORDS`` and ``MAX_PAIRS``, are
broadcast. All others lie in a table (`ToxicityModel.rest`), where words go by 62
bits of a hash and pairs by 63. A sieve of bounded size, broadcast too, tells for
nearly all keys that they are not in it; the keys that a text has left are looked
up by a join and come back to the text. What lies where changes no score.

Null and empty texts, and texts without words, have evidence 0 and a score like
any text. Rows are scored one by one: repeated rows score alike, null ids stay
null. Without training texts of both labels every score is 0. Empty tables give
no row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import labelled, prepare_workers, uniform
from termloom.operators.joins import broadcast_if_small, join_by_load, measure
from termloom.plans.workspace import Workspace

MAX_WORDS = 250_000
MAX_PAIRS = 1_000_000
# Bits of the sieve for each key, and all its bits, as a power of two.
SIEVE_BITS = 16
MAX_SIEVE = 28
# A word of fewer documents, or a pair of fewer occurrences, tells little about a class.
MIN_DOCUMENTS = 5
MIN_COUNT = 5
SPANS = (1, 2, 8)
# Labelled texts that fit the curve and are not counted: a share, and a bound.
FIT_SHARE = 0.2
FIT_ROWS = 20_000
SEED = 6
N_EVIDENCE = len(SPANS) + 2
# Ids of the unknown word and of the beginning of a line; words come after.
UNKNOWN, BEGIN, FIRST = 0, 1, 2

# Ids from here on are hashes of words that are not listed.
HASHED = 1 << 62

_WORDS = re.compile(r"[^\W\d_]+|\n")
_PAIR_BITS = 32
_CLASSES = ("toxic", "ordinary")


def tokens(text: str) -> list[str]:
    """Words in lower case, and a line end for every line."""
    return _WORDS.findall(text.lower())


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        return UNKNOWN


class _HashedIds(dict):
    def __missing__(self, word: str) -> int:
        return hashed_id(word)


def hashed_id(word: str) -> int:
    digest = blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return HASHED | int.from_bytes(digest, "little") >> 2


def _word_ids(words: Iterable[str], hashed: bool = False) -> dict[str, int]:
    """Ids of listed words; others are unknown, or go by their hash."""
    ids = (_HashedIds if hashed else _Ids)((word, FIRST + i) for i, word in enumerate(words))
    ids["\n"] = BEGIN
    return ids


def word_pairs(text: str, ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Each word, after the one before it; lines begin anew."""
    found = tokens(text)
    words = np.fromiter(map(ids.__getitem__, found), np.int64, len(found))
    before = np.concatenate([[BEGIN], words[:-1]]) if len(words) else words
    return before[words != BEGIN], words[words != BEGIN]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of 64 bits, one to one (the finalizer of SplitMix64)."""
    z = numbers.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for each pair: both ids of listed words, else a negative hash of them."""
    if not len(before) or max(before.max(), word.max()) < HASHED:
        return before << _PAIR_BITS | word
    mixed = _mixed(_mixed(before) * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64))
    return np.where(
        np.maximum(before, word) < HASHED,
        before << _PAIR_BITS | word,
        (mixed | np.uint64(1 << 63)).astype(np.int64),
    )


def _backoff_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of what a hashed word has as the first and as the second of a pair."""
    tag = np.full(len(words), -1, np.int64)
    return pair_keys(tag, words), pair_keys(tag - 1, words)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Two places of each key in a sieve of so many bits."""
    mixed = _mixed(keys)
    most = np.uint64(bits - 1)
    return np.stack([mixed & most, (mixed >> np.uint64(32)) & most]).astype(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted keys are among sorted ones, and which of them are."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class ToxicityModel:
    """What scoring needs: ids of words, parts of the log ratio, and the curve.

    The log ratio of a pair is listed, or else the sum of what its first word
    has in backoff weights and what its second has in backoff probabilities.
    """

    words: list[str]
    first: np.ndarray
    second: np.ndarray
    pairs: np.ndarray
    ratios: np.ndarray
    curve: np.ndarray | None = None
    # (key, value) of what is not listed, whether words are, and the sieve of its keys.
    rest: DataFrame | None = None
    hashed: bool = False
    sieve: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def word_ids(self) -> dict[str, int]:
        return _word_ids(self.words, self.hashed)

    def asked(self, text: str, ids: dict[str, int]) -> np.ndarray:
        """Keys of the text that the rest may have, each once."""
        before, word = word_pairs(text, ids)
        if not len(word):
            return before
        wanted = [pair_keys(before, word)]
        hashes = np.unique(np.concatenate([before, word]))
        hashes = hashes[hashes >= HASHED]
        if len(hashes):
            # A hashed word may turn out to be an unknown one.
            before_unknown, word_unknown = (np.where(x >= HASHED, UNKNOWN, x) for x in (before, word))
            wanted.append(pair_keys(before_unknown, word))
            wanted.append(pair_keys(before, word_unknown))
            wanted.append(pair_keys(before_unknown, word_unknown))
            wanted.extend(_backoff_keys(hashes))
        keys = np.unique(np.concatenate(wanted))
        one, two = _places(keys, 64 * len(self.sieve))
        bit = lambda at: self.sieve[at >> 6] >> (at & 63) & 1
        keys = keys[(bit(one) & bit(two)).astype(bool)]
        return keys[~_find(self.pairs, keys)[1]]

    def evidence(
        self, text: str, ids: dict[str, int], keys: np.ndarray | None = None, values: np.ndarray | None = None
    ) -> tuple[float, ...]:
        """Mean log ratio, highest means of runs, and log of the number of words.

        ``keys``, sorted, and ``values`` are what the rest has of the keys asked for.
        """
        before, word = word_pairs(text, ids)
        if not len(word):
            return (0.0,) * N_EVIDENCE
        if self.hashed:
            before, first = self._backoff(before, self.first, 0, keys, values)
            word, second = self._backoff(word, self.second, 1, keys, values)
            ratio = first + second
        else:
            ratio = self.first[before] + self.second[word]
        pairs = pair_keys(before, word)
        for listed, ratios in ((self.pairs, self.ratios), (keys, values)):
            if listed is not None and len(listed):
                at, found = _find(listed, pairs)
                ratio = np.where(found, ratios[at], ratio)
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        highest = []
        for span in SPANS:
            run = min(span, len(ratio))
            # A text shorter than a run is measured against a whole one.
            highest.append(float((sums[run:] - sums[:-run]).max()) / span)
        return (float(ratio.mean()), *highest, float(np.log(len(ratio))))

    def _backoff(
        self, words: np.ndarray, listed: np.ndarray, side: int, keys: np.ndarray | None, values: np.ndarray | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The words, unknown ones told from hashed ones, and what they have on this side."""
        hashed = words >= HASHED
        if not hashed.any():
            return words, listed[words]
        at, found = _find(np.zeros(0, np.int64) if keys is None else keys, _backoff_keys(words)[side])
        words = np.where(hashed & ~found, UNKNOWN, words)
        known = hashed & found
        parts = listed[np.where(known, UNKNOWN, words)]
        parts[known] = values[at[known]] if known.any() else 0.0
        return words, parts

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(_inputs(evidence) @ self.curve, -500, 500)))


def _inputs(evidence: np.ndarray) -> np.ndarray:
    mean, *highest, size = evidence.reshape(-1, N_EVIDENCE).T
    with_size = [column * size / 5 for column in (mean, *highest)]
    return np.column_stack([np.ones(len(mean)), mean * 10, *highest, size / 5, *with_size])


def _counted(texts: DataFrame, make, schema: str, keys: list[str]) -> DataFrame:
    """Sums of what ``make`` counts in batches of (text, label); keys of two columns are tuples."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                make(text.as_py() or "", counters[1 if label == 1 else 0])
            if sum(map(len, counters.values())) > 200_000:
                yield _rows(counters, schema)
                counters = {0: Counter(), 1: Counter()}
        yield _rows(counters, schema)

    sums = [F.sum(name).alias(name) for name in ("toxic", "ordinary")]
    return texts.mapInArrow(count, schema).groupBy(*keys).agg(*sums)


def _rows(counters: dict[int, Counter], schema: str) -> pa.RecordBatch:
    keys = list(counters[0].keys() | counters[1].keys())
    names = [part.split()[0] for part in schema.split(", ")]
    if len(names) == 4:
        flat = np.array(keys, np.int64).reshape(-1, 2)
        columns = [pa.array(flat[:, 0]), pa.array(flat[:, 1])]
    else:
        columns = [pa.array(keys, pa.string() if schema.startswith("word string") else pa.int64())]
    for label in (1, 0):
        columns.append(pa.array([counters[label][key] for key in keys], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _with_labels(documents: DataFrame, known: DataFrame) -> DataFrame:
    """(text, label) of the labelled documents.

    Labels of a checked size are broadcast; more are joined by a shuffle.
    """
    side = F.broadcast(known) if measure(known).broadcastable else known.hint("merge")
    return documents.select("doc_id", "text").join(side, "doc_id").select("text", "label")


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
    workspace: Workspace | None = None,
) -> ToxicityModel:
    """Counts of all labelled documents but those that fit the curve."""
    spark = documents.sparkSession
    workspace = workspace or Workspace(spark)
    prepare_workers(spark)
    known = labelled(labels, label)
    share = min(FIT_SHARE, fit_rows / max(1, known.count()))
    apart = uniform("doc_id", seed=SEED) < share
    texts = _with_labels(documents, known.filter(~apart))

    def count_words(text: str, into: Counter) -> None:
        into.update(set(tokens(text)))

    words = workspace.save(
        _counted(texts, count_words, "word string, toxic long, ordinary long", ["word"]), "words"
    ).filter(F.col("word") != "\n")
    floor = _floor(words, MIN_DOCUMENTS, MAX_WORDS)
    # Through Arrow, since rows in Python take many times their size on the driver.
    vocabulary = sorted(words.filter(_both() >= floor).select("word").toArrow()["word"].to_pylist())
    hashed = floor > MIN_DOCUMENTS
    shared = spark.sparkContext.broadcast(vocabulary)
    cache: list[dict[str, int]] = []

    def pairs_of(text: str) -> tuple[np.ndarray, np.ndarray]:
        if not cache:
            cache.append(_word_ids(shared.value, hashed))
        return word_pairs(text, cache[0])

    def count_pairs(text: str, into: Counter) -> None:
        into.update(pair_keys(*pairs_of(text)).tolist())

    def count_hashed_pairs(text: str, into: Counter) -> None:
        before, word = pairs_of(text)
        into.update(zip(before.tolist(), word.tolist(), strict=True))

    if hashed:
        rare = words.filter(_both().between(MIN_DOCUMENTS, floor - 1)).select("word")
        known_ids = workspace.save(rare.mapInArrow(_hash_words, "id long"), "rare-words")
        counted = _counted(
            texts, count_hashed_pairs, "first long, second long, toxic long, ordinary long", ["first", "second"]
        )
        pairs = workspace.save(_resolved(workspace.save(counted, "hashed-pairs"), known_ids), "pairs")
    else:
        pairs = workspace.save(
            _counted(texts, count_pairs, "pair long, toxic long, ordinary long", ["pair"]), "pairs"
        )
    model = _estimate(pairs, vocabulary, known_ids.count() if hashed else 0, workspace)
    fit = _with_labels(documents, known.filter(apart))
    # Ids are drawn, and rows may share one: the limit holds all the same.
    seen = _evidence(fit, model).orderBy(F.xxhash64("evidence"), "label").limit(4 * fit_rows).toPandas()
    evidence = np.array(seen["evidence"].tolist(), float).reshape(-1, N_EVIDENCE)
    model.curve = _fit_curve(evidence, (seen["label"] == 1).to_numpy())
    return model


def _both() -> Column:
    return F.col("toxic") + F.col("ordinary")


def _floor(table: DataFrame, least: int, most: int) -> int:
    """The lowest count, from ``least`` on, that no more than ``most`` rows reach."""
    reached = table.filter(_both() >= least)
    if reached.count() <= most:
        return least
    # Rows of a count are few where counts are many: there are no more counts than roots of the total.
    by_count = reached.groupBy(_both().alias("n")).count().toArrow().to_pandas().sort_values("n", ascending=False)
    within = by_count["n"][by_count["count"].cumsum() <= most]
    return int(within.min()) if len(within) else int(by_count["n"].max()) + 1


def _hash_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [hashed_id(word) for word in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], names=["id"])


def _resolved(counted: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Pairs with hashed words that are not known as the unknown word, and their counts merged."""
    settled = (F.col("first") < HASHED) & (F.col("second") < HASHED)
    found = counted.filter(~settled)
    ids = broadcast_if_small(known_ids.withColumnRenamed("id", "_id"))
    for side in ("first", "second"):
        # Listed words find nothing, and are no one task's work.
        spread = F.lit(-1) - F.shiftrightunsigned(F.xxhash64("first", "second"), 1)
        key = F.when(F.col(side) >= HASHED, F.col(side)).otherwise(spread)
        met = found.withColumn("_key", key).join(ids, F.col("_key") == F.col("_id"), "left")
        word = F.when((F.col(side) >= HASHED) & F.col("_id").isNull(), UNKNOWN).otherwise(F.col(side))
        found = met.withColumn(side, word).drop("_key", "_id")
    sums = [F.sum(c).alias(c) for c in _CLASSES]
    return counted.filter(settled).unionByName(found.groupBy("first", "second").agg(*sums))


def _estimate(
    pairs: DataFrame, vocabulary: list[str], n_rare: int = 0, workspace: Workspace | None = None
) -> ToxicityModel:
    """The log ratios of the two models from the table of pairs.

    ``n_rare`` words are not in the vocabulary, and go by their hashes.
    """
    workspace = workspace or Workspace(pairs.sparkSession)
    n_listed = FIRST + len(vocabulary)
    size = n_listed + n_rare
    split = pairs
    if "pair" in pairs.columns:
        split = pairs.select(
            F.shiftright("pair", _PAIR_BITS).alias("first"),
            F.col("pair").bitwiseAND(F.lit((1 << _PAIR_BITS) - 1)).alias("second"),
            *_CLASSES,
        )
    by_second = split.groupBy("second").agg(
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"after_{c}") for c in _CLASSES],
        F.count("*").alias("after_both"),
    )
    by_first = split.groupBy("first").agg(
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"n_{c}") for c in _CLASSES],
        *[F.sum(c).alias(c) for c in _CLASSES],
        F.count("*").alias("n_both"),
    )
    counts = [f"{kind}{c}" for c in _CLASSES for kind in ("after_", "n_", "")]
    words = workspace.save(
        by_second.withColumnRenamed("second", "word")
        .join(by_first.withColumnRenamed("first", "word"), "word", "full")
        .fillna(0),
        "word-counts",
    )
    once = split.agg(
        F.count("*").alias("pairs"),
        *[F.sum((F.col(c) == k).cast("long")).alias(f"{c}{k}") for c in _CLASSES for k in (1, 2)],
    ).first().asDict()
    seen = words.agg(
        *[F.sum(f"after_{c}").alias(c) for c in _CLASSES],
        *[F.sum((F.col(f"after_{c}") > 0).cast("long")).alias(f"n_{c}") for c in _CLASSES],
    ).first().asDict()
    discount = {}
    for c in _CLASSES:
        n1, n2 = once[f"{c}1"] or 0, once[f"{c}2"] or 0
        discount[c] = n1 / (n1 + 2 * n2) if n1 else 0.5

    def parts(table: pd.DataFrame) -> pd.DataFrame:
        """Backoff weight and probability of each word in both models."""
        made = {}
        # What both classes share: continuation counts and, for the unseen, equal parts.
        shared = (table["after_both"].to_numpy(float) + 1.0) / (once["pairs"] + size)
        for c in _CLASSES:
            after, own, total = (table[f"{kind}{c}"].to_numpy(float) for kind in ("after_", "n_", ""))
            everything = max(1.0, seen[c] or 0)
            n_seen = seen[f"n_{c}"] or 0
            held = np.maximum(after - discount[c], 0) / everything
            rest = discount[c] * n_seen / everything if n_seen else 1.0
            made[f"lower_{c}"] = held + max(rest, 1e-9) * shared
            with np.errstate(divide="ignore", invalid="ignore"):
                weight = np.where(total > 0, discount[c] * own / total, 1.0)
            made[f"weight_{c}"] = np.maximum(weight, 1e-9)
            made[f"total_{c}"] = total
        return pd.DataFrame(made, index=table.index)

    def ratios(table: Mapping[str, np.ndarray]) -> np.ndarray:
        """Log ratios of pairs with the parts of their words."""
        log = {}
        for c in _CLASSES:
            held = np.maximum(table[c] - discount[c], 0) / np.maximum(1.0, table[f"total_{c}"])
            log[c] = np.log(held + table[f"weight_{c}"] * table[f"lower_{c}"])
        return np.asarray(log["toxic"] - log["ordinary"])

    def backoff(made: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return tuple(
            (np.log(made[f"{kind}_toxic"]) - np.log(made[f"{kind}_ordinary"])).to_numpy()
            for kind in ("weight", "lower")
        )

    listed = words.filter(F.col("word") < HASHED).select("word", "after_both", *counts)
    listed = listed.toArrow().to_pandas().set_index("word")
    made = parts(listed.reindex(range(n_listed), fill_value=0))
    first, second = backoff(made)

    floor = _floor(split, MIN_COUNT, MAX_PAIRS)
    of_listed = (F.col("first") < HASHED) & (F.col("second") < HASHED)
    frequent = split.filter((_both() >= floor) & of_listed).toArrow()
    frequent = {name: frequent[name].to_numpy() for name in frequent.column_names}
    keys = pair_keys(frequent["first"], frequent["second"])
    order = np.argsort(keys)
    lower, others = [f"lower_{c}" for c in _CLASSES], [f"{kind}_{c}" for kind in ("weight", "total") for c in _CLASSES]
    frequent |= {name: made[name].to_numpy()[frequent["first"]] for name in others}
    frequent |= {name: made[name].to_numpy()[frequent["second"]] for name in lower}
    model = ToxicityModel(vocabulary, first, second, keys[order], ratios(frequent)[order])
    if floor == MIN_COUNT and not n_rare:
        return model

    def with_parts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in batches:
            yield pd.concat([table[["word", "n_both", "after_both"]], parts(table)], axis=1)

    def pair_values(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in batches:
            keys = pair_keys(table["first"].to_numpy(np.int64), table["second"].to_numpy(np.int64))
            yield pd.DataFrame({"key": keys, "value": ratios(table)})

    def word_values(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in batches:
            keys, values = _backoff_keys(table["word"].to_numpy(np.int64)), backoff(table)
            yield pd.DataFrame({"key": np.concatenate(keys), "value": np.concatenate(values)})

    named = ["word", "n_both", "after_both"]
    # Column order of the frame must be that of the schema.
    doubles = ", ".join(f"{kind}_{c} double" for c in _CLASSES for kind in ("lower", "weight", "total"))
    known = workspace.save(
        words.mapInPandas(with_parts, f"word long, n_both long, after_both long, {doubles}"), "word-parts"
    )
    rare = split.filter((_both() >= MIN_COUNT) & ((_both() < floor) | ~of_listed))
    of_word = measure(known)
    met = join_by_load(
        rare, known.select(F.col("word").alias("first"), "n_both", *others), "first", "n_both", once["pairs"], of_word
    )
    met = join_by_load(
        met, known.select(F.col("word").alias("second"), "after_both", *lower), "second", "after_both",
        once["pairs"], of_word,
    )
    values = met.mapInPandas(pair_values, "key long, value double").unionByName(
        known.filter(F.col("word") >= HASHED).mapInPandas(word_values, "key long, value double")
    )
    model.rest = workspace.save(values, "rest")
    model.hashed = n_rare > 0
    model.sieve = _sieve(model.rest)
    return model


def _sieve(rest: DataFrame) -> np.ndarray:
    """Bits at the two places of each key."""
    bits = 1 << min(MAX_SIEVE, max(10, (SIEVE_BITS * rest.count()).bit_length()))

    def set_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(batch.column("key").to_numpy(), bits).ravel()
            bit = np.left_shift(np.int64(1), places & 63)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array(bit)], names=["word", "bits"])

    set_words = rest.select("key").mapInArrow(set_bits, "word long, bits long")
    filled = set_words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    sieve = np.zeros(bits // 64, np.int64)
    sieve[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    return sieve


def _with_rest(texts: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows, and (_keys, _values) that the rest has of their text.

    Texts go by two hashes, so those that are alike ask once.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, rest=None))
    cache: list[dict[str, int]] = []
    signs = ["_one", "_two"]
    text = F.coalesce("text", F.lit(""))
    signed = texts.withColumns({"_one": F.xxhash64(text), "_two": F.xxhash64(F.lit(1), text)})

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(shared.value.word_ids())
        for batch in batches:
            keys = [shared.value.asked(one.as_py() or "", cache[0]) for one in batch.column("text")]
            sizes = [len(found) for found in keys]
            columns = [pa.array(np.repeat(batch.column(sign).to_numpy(), sizes)) for sign in signs]
            columns.append(pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays(columns, names=[*signs, "key"])

    asked = signed.select(*signs, "text").mapInArrow(ask, "_one long, _two long, key long").distinct()
    entry = F.sort_array(F.collect_list(F.struct("key", "value")))
    answers = (
        asked.join(broadcast_if_small(model.rest), "key")
        .groupBy(*signs)
        .agg(entry.alias("_entries"))
        .select(*signs, F.col("_entries.key").alias("_keys"), F.col("_entries.value").alias("_values"))
    )
    return signed.join(answers, signs, "left").drop(*signs)


def _evidence(texts: DataFrame, model: ToxicityModel) -> DataFrame:
    """(label, evidence) of labelled texts."""
    shared = texts.sparkSession.sparkContext.broadcast(replace(model, rest=None))
    cache: list[dict[str, int]] = []

    def measure_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(shared.value.word_ids())
        for batch in batches:
            rows = [
                shared.value.evidence(text or "", cache[0], *_found(keys, values))
                for text, keys, values in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))],
                names=["label", "evidence"],
            )

    return _answered(texts, model).select("label", "text", "_keys", "_values").mapInArrow(
        measure_texts, "label int, evidence array<double>"
    )


def _answered(texts: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows with _keys and _values, null where nothing is looked up."""
    if model.rest is not None:
        return _with_rest(texts, model)
    nothing = {"_keys": F.lit(None).cast("array<bigint>"), "_values": F.lit(None).cast("array<double>")}
    return texts.withColumns(nothing)


def _found(keys, values) -> tuple[np.ndarray | None, np.ndarray | None]:
    if keys is None:
        return None, None
    return np.asarray(keys, np.int64), np.asarray(values, float)


def _fit_curve(evidence: np.ndarray, toxic: np.ndarray, ridge: float = 1e-3) -> np.ndarray | None:
    """Logistic regression by Newton's method; None without both labels."""
    if not toxic.any() or toxic.all():
        return None
    x = _inputs(evidence)
    weights = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - toxic) / len(x) + ridge * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(x)
        step = np.linalg.solve(curvature + ridge * np.eye(len(weights)), gradient)
        weights -= step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-7:
            break
    return weights


def toxicity_scores(documents: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """The documents, every column kept, and the score of each text.

    A column that has the score's name already is replaced.
    """
    spark = documents.sparkSession
    prepare_workers(spark)
    kept = documents.drop(column) if column in documents.columns else documents
    shared = spark.sparkContext.broadcast(replace(model, rest=None))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ids = shared.value.word_ids()
        for batch in batches:
            rows = [
                shared.value.evidence(text or "", ids, *_found(keys, values))
                for text, keys, values in zip(*batch, strict=True)
            ]
            yield pd.Series(shared.value.score(np.array(rows, float).reshape(-1, N_EVIDENCE)))

    answered = _answered(kept, model)
    return answered.withColumn(column, score("text", "_keys", "_values")).drop("_keys", "_values")
