"""Tokens of two tokenizers over the same text, aligned where both end.

Both encode the text with a space before it: the byte-level one (A) is given the
space, the piece model (B) adds it itself. Ends common to both cut the tokens into
groups. They are found by halving: an end of A near the middle of an interval that
is an end of B as well, looked up by bisection, cuts the interval in two, and so on
with both halves; the ends looked at spread out from the middle in doubling steps,
and an interval without a common end is a leaf. All intervals of a round of texts
are halved at once.

A link is a pair of occurrences whose byte ranges overlap. Between two neighbouring
ends of either tokenizer there is one token of each, and each link has one such
stretch, so links are as many as there are different ends. Counts of linked
id pairs cover the corpus: each task adds up its rounds, Spark the rest. To score
the links, the most frequent pairs, at most ``HEAD_PAIRS``, and the highest count
of each B id, no more than the vocabulary has, are broadcast. Links of rarer pairs
leave their task, summed per text, meet the counts by a shuffle in which no pair
has many rows, and return as sums per text.

Texts are encoded once and written as ids. Memory follows a round of
``ROUND_BYTES`` and the longest text. Texts beyond ``CHUNK`` characters are
encoded in parts, cut at a single space between two other characters, which no
piece crosses (checked when the model is read); a text without one is one part.

Null and empty texts have no tokens, nor have texts that one of the tokenizers
does not give back byte for byte: all counts are 0 and the digest is ''. Every row is
a text of its own, repeated ones too, and links of all of them count. Null ids stay
null. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import prepare_workers, run_bounds
from termloom.llm.tokens import Encoder
from termloom.plans.workspace import Workspace

PIECES = "piece_bpe_32k.model"
MARK = "▁"
CHUNK = 1_000_000
ROUND_BYTES = 4 * 1024 * 1024
ROUND_LINKS = 4_000_000
# Pairs that are broadcast, at 17 bytes each.
HEAD_PAIRS = 1_000_000
# Rows of a task are numbered from its number.
TASK_BITS = 40

ENCODED = "place long, a binary, b binary, n_a long, n_b long, n_groups long, groups_sha256 string"


class PieceEncoder:
    """Encodes whole texts with a piece model that travels by broadcast."""

    def __init__(self, context, path: str | None = None):
        with open(path or public_tokenizers.path(PIECES), "rb") as file:
            self._model = context.broadcast(file.read())

    def ids(self, text: str) -> list[int]:
        model, _, _ = _pieces(self._model.value)
        return [token for part in text_parts(text, CHUNK) for token in model.encode(part)]

    def bytes_of(self, ids: Iterable[int]) -> bytes:
        _, table, _ = _pieces(self._model.value)
        return b"".join([table[token] for token in ids])

    @property
    def all_widths(self) -> np.ndarray:
        return _pieces(self._model.value)[2]


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes], np.ndarray]:
    """The model, the bytes of each id, and how many they are."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    table = []
    for token in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(token)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {piece!r} crosses a space, so texts can't be cut there")
        plain = not pieces.is_byte(token)
        table.append(piece.replace(MARK, " ").encode() if plain else bytes([int(piece[3:5], 16)]))
    return pieces, table, np.array([len(piece) for piece in table], np.int64)


def text_parts(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, less the single spaces between them."""

    def cuts(at: int) -> bool:
        around = text[at - 1], text[at + 1]
        return text[at] == " " and not any(char.isspace() or char == MARK for char in around)

    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) - 1 and not cuts(cut):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places in ``a_ends`` of ends that ``b_ends`` has as well, ascending.

    Both rise, and ``bounds`` are places in ``a_ends``, from 0, between which
    texts lie. The last end of each text is common.
    """
    last = bounds[1:] - 1
    found = [last]
    # Open intervals [low, high) of places, and how far from the middle has been looked.
    low, high = bounds[:-1], last
    low, high = low[high > low], high[high > low]
    reach = np.zeros(len(low), np.int64)
    while len(low):
        middle = (low + high) // 2
        further = np.where(reach == 0, 1, 2 * reach)
        # Places at distances reach to further - 1 on either side of the middle.
        lefts = np.maximum(low, middle - further + 1), np.maximum(low, middle - reach + 1)
        rights = np.minimum(high, middle + np.maximum(reach, 1)), np.minimum(high, middle + further)
        lefts = lefts[0], np.where(reach == 0, middle + 1, lefts[1])
        owner, place = _ranges(lefts, rights)
        at = np.searchsorted(b_ends, a_ends[place])
        shared = b_ends[at] == a_ends[place]
        owner, place = owner[shared], place[shared]
        # Of the common ends of an interval the one nearest to its middle.
        order = np.lexsort((np.abs(place - middle[owner]), owner))
        owner, place = owner[order], place[order]
        nearest = run_bounds(owner)[:-1] if len(owner) else np.zeros(0, np.int64)
        owner, place = owner[nearest], place[nearest]
        found.append(place)
        cut = np.zeros(len(low), bool)
        cut[owner] = True
        covered = (middle - further + 1 <= low) & (middle + further >= high)
        going = ~cut & ~covered
        low, high, reach = (
            np.concatenate([low[owner], place + 1, low[going]]),
            np.concatenate([place, high[owner], high[going]]),
            np.concatenate([np.zeros(2 * len(owner), np.int64), further[going]]),
        )
        filled = high > low
        low, high, reach = low[filled], high[filled], reach[filled]
    return np.sort(np.concatenate(found))


def _ranges(*sides: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which interval, and which place, of all places in [first, last) of each side."""
    owners, places = [], []
    for first, last in sides:
        lengths = np.maximum(last - first, 0)
        owner = np.repeat(np.arange(len(first)), lengths)
        skipped = np.cumsum(lengths) - lengths
        owners.append(owner)
        places.append(np.arange(len(owner)) - skipped[owner] + first[owner])
    return np.concatenate(owners), np.concatenate(places)


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A token and of the B token of every link, in text order."""
    ends = np.concatenate([a_ends, b_ends])
    ends.sort(kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def align_tokens(
    documents: DataFrame,
    tokenizer: str | None = None,
    pieces: str | None = None,
    workspace: Workspace | None = None,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row a row."""
    spark = documents.sparkSession
    prepare_workers(spark)
    workspace = workspace or Workspace(spark)
    first = Encoder(spark.sparkContext, tokenizer)
    second = PieceEncoder(spark.sparkContext, pieces)
    encoded = workspace.save(encode_texts(documents, first, second), "encoded")
    pairs = workspace.save(linked_pairs(encoded, first, second), "pairs")
    return _scored(encoded, pairs, first, second, workspace, head_pairs)


def encode_texts(documents: DataFrame, first: Encoder, second: PieceEncoder) -> DataFrame:
    """(doc_id, place, a, b, n_a, n_b, n_groups, groups_sha256): ids as little-endian numbers.

    ``place`` numbers the rows; written once, it tells rows of one id apart.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        place = (context.partitionId() if context else 0) << TASK_BITS
        writer = GroupWriter(first, second)
        for batch in batches:
            texts = batch.column("text")
            start, held, tokens = 0, 0, []
            for row in range(batch.num_rows):
                text = texts[row].as_py() or ""
                tokens.append(_encode(text, first, second))
                held += len(text)
                if held >= ROUND_BYTES or row + 1 == batch.num_rows:
                    done = batch.slice(start, row + 1 - start).column("doc_id")
                    yield _encoded_batch(done, place, tokens, writer)
                    place += len(tokens)
                    start, held, tokens = row + 1, 0, []

    return documents.select("doc_id", "text").mapInArrow(encode, f"doc_id {id_type}, {ENCODED}")


def _encode(text: str, first: Encoder, second: PieceEncoder) -> tuple[np.ndarray, np.ndarray]:
    nothing = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    if not text:
        return nothing
    whole = " " + text
    expected = whole.encode()
    b = second.ids(text)
    if second.bytes_of(b) != expected:
        return nothing
    a = first.ids(whole)
    # A's bytes are those of the text in their order; some could only be missing.
    if int(first.widths(a).sum()) != len(expected):
        return nothing
    return a, np.array(b, np.uint32)


class GroupWriter:
    """Digests of groups, written as ``a1,a2|b1;a3|b2,b3`` in decimal ids."""

    def __init__(self, first: Encoder, second: PieceEncoder):
        self.first, self.second = first, second
        self._strings: np.ndarray | None = None

    def strings(self) -> np.ndarray:
        """Every id with each sign that can follow it: A's, then B's."""
        if self._strings is None:
            n_a = len(self.first.all_widths)
            n_b = len(self.second.all_widths)
            made = [b"%d%s" % (i, end) for i in range(n_a) for end in (b",", b"|")]
            made += [b"%d%s" % (i, end) for i in range(n_b) for end in (b",", b";")]
            self._strings = np.array(made, object)
        return self._strings

    def write(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[str]]:
        """Number of groups and digest of each text."""
        a, b, a_ends, b_ends, a_bounds, b_bounds = joined(tokens, self.first, self.second)
        filled = np.flatnonzero(np.diff(a_bounds))
        counts, digests = [0] * len(tokens), [""] * len(tokens)
        if not len(filled):
            return counts, digests
        a_cuts = shared_ends(a_ends, b_ends, np.append(a_bounds[filled], len(a)))
        b_cuts = np.searchsorted(b_ends, a_ends[a_cuts])
        offset = 2 * len(self.first.all_widths)
        a_group, a_last = _groups(len(a), a_cuts)
        b_group, b_last = _groups(len(b), b_cuts)
        # Sorted runs merge in linear time: A's tokens of a group, then B's.
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        which = np.concatenate(
            [2 * a.astype(np.int64) + a_last, offset + 2 * b.astype(np.int64) + b_last]
        )
        written = self.strings()[which[order]].tolist()
        groups = np.searchsorted(a_cuts, a_bounds)
        for text in filled.tolist():
            counts[text] = int(groups[text + 1] - groups[text])
            begin, end = a_bounds[text] + b_bounds[text], a_bounds[text + 1] + b_bounds[text + 1]
            digests[text] = hashlib.sha256(b"".join(written[begin:end])[:-1]).hexdigest()
        return counts, digests


def _groups(length: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token, and whether it is the last of its group."""
    last = np.zeros(length, np.int64)
    last[cuts] = 1
    return np.cumsum(last) - last, last


def joined(
    tokens: list[tuple[np.ndarray, np.ndarray]], first: Encoder, second: PieceEncoder
) -> tuple[np.ndarray, ...]:
    """Ids of both, ends of both in bytes, and where each text's tokens begin, of texts in a row.

    Both cover the same bytes, so the ends of all texts can share one scale.
    """
    a = np.concatenate([pair[0] for pair in tokens])
    b = np.concatenate([pair[1] for pair in tokens])
    a_bounds = np.concatenate([[0], np.cumsum([len(pair[0]) for pair in tokens])])
    b_bounds = np.concatenate([[0], np.cumsum([len(pair[1]) for pair in tokens])])
    return (
        a,
        b,
        np.cumsum(first.all_widths[a]),
        np.cumsum(second.all_widths[b]),
        a_bounds,
        b_bounds,
    )


def _encoded_batch(
    ids: pa.Array, place: int, tokens: list[tuple[np.ndarray, np.ndarray]], writer: GroupWriter
) -> pa.RecordBatch:
    counts, digests = writer.write(tokens)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.arange(place, place + len(tokens))),
            *[
                pa.array([pair[side].astype(width).tobytes() for pair in tokens], pa.binary())
                for side, width in ((0, _width(writer.first)), (1, _width(writer.second)))
            ],
            *[pa.array([len(pair[side]) for pair in tokens], pa.int64()) for side in (0, 1)],
            pa.array(counts, pa.int64()),
            pa.array(digests, pa.string()),
        ],
        names=["doc_id", "place", "a", "b", "n_a", "n_b", "n_groups", "groups_sha256"],
    )


def _width(encoder: Encoder | PieceEncoder) -> str:
    return "<u2" if len(encoder.all_widths) <= 1 << 16 else "<u4"


def _link_codes(
    batch: pa.RecordBatch, first: Encoder, second: PieceEncoder
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rounds of rows [start, stop) with the pair code and the row of every link."""
    n_b = len(second.all_widths)
    widths = _width(first), _width(second)
    sizes = np.cumsum(
        batch.column("n_a").to_numpy(zero_copy_only=False) + batch.column("n_b").to_numpy(zero_copy_only=False)
    )
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + ROUND_LINKS)))
        tokens = [
            tuple(
                np.frombuffer(batch.column(name)[row].as_buffer(), width)
                for name, width in zip(("a", "b"), widths, strict=True)
            )
            for row in range(start, stop)
        ]
        a, b, a_ends, b_ends, a_bounds, _ = joined(tokens, first, second)
        a_at, b_at = links(a_ends, b_ends)
        rows = np.searchsorted(a_bounds, a_at, side="right") - 1
        yield start, stop, a[a_at].astype(np.int64) * n_b + b[b_at], rows
        start = stop


def linked_pairs(encoded: DataFrame, first: Encoder, second: PieceEncoder) -> DataFrame:
    """(code, n): how many links hold the ids a and b linked; code is a * (ids of B) + b."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, codes, _ in _link_codes(batch, first, second):
                pairs, times = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["code", "n"])

    found = encoded.select("a", "b", "n_a", "n_b").mapInArrow(count, "code long, n long")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def _scored(
    encoded: DataFrame,
    pairs: DataFrame,
    first: Encoder,
    second: PieceEncoder,
    workspace: Workspace,
    head_pairs: int,
) -> DataFrame:
    n_b = len(second.all_widths)
    b_id = F.col("code") % n_b
    # One row for each id of B.
    best = np.zeros(n_b, np.int64)
    peaks = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("peak"))
    highest = peaks.toArrow()
    best[highest["b"].to_numpy()] = highest["peak"].to_numpy()
    least = _least_of_head(pairs, head_pairs)
    head = pairs.filter(F.col("n") >= least).toArrow().sort_by("code")
    shared = pairs.sparkSession.sparkContext.broadcast(
        (head["code"].to_numpy(), head["n"].to_numpy(), best)
    )
    texts = workspace.save(_scored_by_head(encoded, first, second, shared), "scored")
    if pairs.filter(F.col("n") < least).isEmpty():
        return texts.drop("place", "rare")
    # A pair here has fewer than `least` links, so none is hot.
    counts = (
        pairs.filter(F.col("n") < least)
        .join(F.broadcast(peaks), b_id == F.col("b"))
        .select("code", "n", (F.col("n") == F.col("peak")).cast("long").alias("is_best"))
    )
    rare = (
        texts.select("place", F.explode("rare").alias("pair"))
        .select("place", "pair.code", "pair.times")
        .join(counts, "code")
        .groupBy("place")
        .agg(
            F.sum(F.col("times") * F.col("is_best")).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    more = [F.coalesce(name, F.lit(0)) for name in ("more_best", "more_sum")]
    return texts.join(rare, "place", "left").select(
        *[name for name in texts.columns if name not in ("place", "rare", "n_best", "count_sum")],
        (F.col("n_best") + more[0]).alias("n_best"),
        (F.col("count_sum") + more[1]).alias("count_sum"),
    )


def _least_of_head(pairs: DataFrame, head_pairs: int) -> int:
    """The least count, a power of two, that at most ``head_pairs`` pairs reach."""
    octave = F.floor(F.log2("n")).cast("int").alias("octave")
    held = {row.octave: row["count"] for row in pairs.groupBy(octave).count().collect()}
    least, total = 64, 0
    for octave in sorted(held, reverse=True):
        total += held[octave]
        if total > head_pairs:
            break
        least = octave
    return 1 << min(least, 62)


def _scored_by_head(encoded: DataFrame, first: Encoder, second: PieceEncoder, shared) -> DataFrame:
    """Rows with n_links, n_best and count_sum of the pairs of the head, and the rarer pairs."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "place", "n_a", "n_b", "n_groups", "groups_sha256"]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of_head, counts_of_head, best = shared.value
        for batch in batches:
            for start, stop, codes, rows in _link_codes(batch, first, second):
                part = batch.select(kept).slice(start, stop - start)
                columns = _score_round(codes, rows, stop - start, codes_of_head, counts_of_head, best)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns], names=[*kept, "n_links", "n_best", "count_sum", "rare"]
                )

    return encoded.select(*kept, "a", "b").mapInArrow(
        score,
        f"doc_id {id_type}, place long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "n_links long, n_best long, count_sum long, rare array<struct<code: long, times: long>>",
    )


def _score_round(
    codes: np.ndarray,
    rows: np.ndarray,
    n_rows: int,
    codes_of_head: np.ndarray,
    counts_of_head: np.ndarray,
    best: np.ndarray,
) -> list[pa.Array]:
    if len(codes_of_head):
        at = np.minimum(np.searchsorted(codes_of_head, codes), len(codes_of_head) - 1)
        known = codes_of_head[at] == codes
        counts = np.where(known, counts_of_head[at], 0)
    else:
        known, counts = np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
    is_best = known & (counts == best[codes % len(best)])
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    totals = [np.arange(1, len(codes) + 1), np.cumsum(is_best), np.cumsum(counts)]
    sums = [np.diff(np.concatenate([[0], total])[bounds]) for total in totals]
    # Links of rarer pairs, summed per row.
    rare_rows, rare_codes = rows[~known], codes[~known]
    order = np.lexsort((rare_codes, rare_rows))
    rare_rows, rare_codes = rare_rows[order], rare_codes[order]
    if len(rare_rows):
        fresh = (rare_rows[1:] != rare_rows[:-1]) | (rare_codes[1:] != rare_codes[:-1])
        firsts = np.concatenate([[0], np.flatnonzero(fresh) + 1])
    else:
        firsts = np.zeros(0, np.int64)
    times = np.diff(np.append(firsts, len(rare_rows)))
    pairs = pa.StructArray.from_arrays(
        [pa.array(rare_codes[firsts]), pa.array(times.astype(np.int64))], names=["code", "times"]
    )
    offsets = np.searchsorted(rare_rows[firsts], np.arange(n_rows + 1)).astype(np.int32)
    return [*[pa.array(total.astype(np.int64)) for total in sums], pa.ListArray.from_arrays(pa.array(offsets), pairs)]
