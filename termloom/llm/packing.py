"""Packing documents into windows of tokens, best fit decreasing.

A document is its ids and a closing id. One longer than a window is first cut
into full windows; what is left of it, and every shorter document, is a piece.
Pieces are packed by falling length into the open window with the least room
that still holds them, found by a segment tree over the room left.

Best fit needs its pieces in one place, so each task packs what it reads, in
rounds of at most ``ROUND_TOKENS`` tokens. A round fills some thousand windows
and wastes little of them, its memory does not depend on the input, and no
text is shuffled. Lost tasks are run again on the same rows and give the same
sequences, since an id is made of the partition's and the round's number.

Null and empty texts are documents of the closing id alone. Repeated rows are
packed once each; null ids stay null. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from termloom.llm.common import prepare_workers
from termloom.llm.tokens import Encoder

WINDOW = 1024
ROUND_TOKENS = 1 << 22
CLOSING_ID = 0
# Pieces of an Arrow batch that is given back: 4 MB of full windows.
BATCH_PIECES = 1024
# Sequence ids: partition, then the number within the partition.
PARTITION_BITS = 40


class OpenWindows:
    """Open windows by room left, with a segment tree over the rooms.

    A node counts the open windows with a room in its range, so the smallest
    sufficient room is found by one walk up and one down.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, room: int) -> None:
        if room > 0:
            self.by_room[room].append(window)
            self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, taken out."""
        count = self.count
        node = self.leaves + need
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        self._change(room, -1)
        return self.by_room[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, and the number of windows.

    Equal lengths go in order of arrival.
    """
    where = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    windows = OpenWindows(window)
    used = 0
    order = np.argsort(-lengths, kind="stable")
    for piece, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        found = windows.take(length)
        if found is None:
            found = (used, window)
            used += 1
        number, room = found
        where[piece], offset[piece] = number, window - room
        windows.put(number, room - length)
    return where, offset, used


def pack_documents(
    documents: DataFrame,
    window: int = WINDOW,
    tokenizer: str | None = None,
    round_tokens: int = ROUND_TOKENS,
) -> DataFrame:
    """Pieces of every document: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are the piece's ids as unsigned little-endian 32-bit numbers,
    ``start`` counts the document's ids before it, ``offset`` the ids before it
    in its sequence.
    """
    prepare_workers(documents.sparkSession)
    encoder = Encoder(documents.sparkSession.sparkContext, tokenizer)
    table = documents.select("doc_id", "text")
    id_type = table.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, start long, length long, ids binary, "
        "doc_tokens long, sequence_id long, offset long"
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << PARTITION_BITS
        pieces: list[tuple] = []
        held = 0
        id_field = pa.field("doc_id", pa.int64())
        for batch in batches:
            id_field = batch.schema.field("doc_id")
            docs = batch.column("doc_id")
            for row, text in enumerate(batch.column("text")):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(CLOSING_ID))
                ids = ids.astype("<u4", copy=False)
                for start in range(0, len(ids), window):
                    pieces.append((docs[row], start, ids[start : start + window], len(ids)))
                held += len(ids)
                if held >= round_tokens:
                    yield from _packed(pieces, window, next_id, id_field)
                    next_id += len(pieces)
                    pieces, held = [], 0
        if pieces:
            yield from _packed(pieces, window, next_id, id_field)

    return table.mapInArrow(pack, schema)


def _packed(
    pieces: list[tuple], window: int, first_id: int, id_field: pa.Field
) -> Iterator[pa.RecordBatch]:
    lengths = np.array([len(piece[2]) for piece in pieces], np.int64)
    where, offset, _ = best_fit_decreasing(lengths, window)
    for at in range(0, len(pieces), BATCH_PIECES):
        part = pieces[at : at + BATCH_PIECES]
        end = at + len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([piece[0].as_py() for piece in part], id_field.type),
                pa.array([piece[1] for piece in part], pa.int64()),
                pa.array(lengths[at:end]),
                pa.array([piece[2].tobytes() for piece in part], pa.binary()),
                pa.array([piece[3] for piece in part], pa.int64()),
                pa.array(where[at:end] + first_id),
                pa.array(offset[at:end]),
            ],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
