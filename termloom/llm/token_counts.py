"""Tokens of sections, from one encoding of the whole document.

A document is encoded once, as a whole, so the counts add up to what a model
reads; encoding each section alone would not. Each token covers a span of
characters, the spans are joined with the sections' spans as intervals, and a
token that crosses a boundary is allocated by this rule:

    the section that holds most of the token's bytes gets it; of equals, the
    earliest. A token with all of its bytes between sections belongs to none
    and is counted as section -1.

Sections are a document's lines by default, or any spans a caller supplies as
a column of (start, end) pairs in characters, ascending and not overlapping
(others raise an error). Null and empty texts have one empty line of 0 tokens.
A null list of sections is an empty one. Repeated rows are counted once each,
null ids stay null, an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import prepare_workers
from termloom.llm.tokens import Encoder

OUTSIDE = -1
ROWS = 100_000


def byte_offsets(text: str, encoded: bytes) -> np.ndarray:
    """Byte at which each character starts, and the end."""
    raw = np.frombuffer(encoded, np.uint8)
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    return np.append(starts, len(raw))


def allocate(token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Section of each token, by bytes; OUTSIDE for tokens of none.

    Tokens are consecutive from byte 0, sections ascending and disjoint; empty
    ones hold no bytes. The first section that ends after a token's start is its
    first candidate. Most tokens end before the next one begins; the few that
    reach further are looked at one by one.
    """
    filled = np.flatnonzero(ends > starts)
    starts, ends = starts[filled], ends[filled]
    token_starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(ends, token_starts, side="right")
    beyond = np.searchsorted(starts, token_ends, side="left")  # sections that begin before the end
    chosen = np.where(first < beyond, first, OUTSIDE)
    for token in np.flatnonzero(beyond - first > 1).tolist():
        low, high = int(first[token]), int(beyond[token])
        held = np.minimum(ends[low:high], token_ends[token]) - np.maximum(
            starts[low:high], token_starts[token]
        )
        chosen[token] = low + int(np.argmax(held)) if held.max() > 0 else OUTSIDE
    return np.append(filled, OUTSIDE)[chosen]


def line_spans(text: str) -> list[tuple[int, int]]:
    spans, start = [], 0
    for line in text.split("\n"):
        spans.append((start, start + len(line)))
        start += len(line) + 1
    return spans


def token_counts(
    documents: DataFrame, sections: str | None = None, tokenizer: str | None = None
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, doc_tokens), sections in order.

    ``section`` counts from 0; -1 is there only if tokens lie in no section.
    ``sections`` names a column of arrays of two-field structs or pairs.
    """
    prepare_workers(documents.sparkSession)
    encoder = Encoder(documents.sparkSession.sparkContext, tokenizer)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, section long, start long, `end` long, n_tokens long, doc_tokens long"
    )
    columns = ["doc_id", "text"]
    table = documents.select(*columns)
    if sections is not None:
        table = documents.select(*columns, F.col(sections).alias("sections"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text")
            given = batch.column("sections") if sections is not None else None
            rows: list[int] = []
            parts: list[tuple[np.ndarray, ...]] = []
            size = 0
            for row in range(batch.num_rows):
                text = texts[row].as_py() or ""
                spans = line_spans(text) if given is None else _given(given[row].as_py())
                parts.append(_count_one(encoder, text, spans))
                rows += [row] * len(parts[-1][0])
                size += len(parts[-1][0])
                if size >= ROWS:
                    yield _batch(ids, rows, parts)
                    rows, parts, size = [], [], 0
            if parts:
                yield _batch(ids, rows, parts)

    return table.mapInArrow(count, schema)


def _given(spans) -> list[tuple[int, int]]:
    pairs = [tuple(span.values()) if isinstance(span, dict) else tuple(span) for span in spans or []]
    flat = [edge for pair in pairs for edge in pair]
    if flat != sorted(flat):
        raise ValueError("sections must be ascending and must not overlap")
    return pairs


def _count_one(encoder: Encoder, text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    encoded = text.encode()
    offsets = byte_offsets(text, encoded)
    edges = np.array(spans, np.int64).reshape(-1, 2)
    edges = np.clip(edges, 0, len(offsets) - 1)
    ids = encoder.ids(text)
    chosen = allocate(
        np.cumsum(encoder.widths(ids)) if len(ids) else np.zeros(0, np.int64),
        offsets[edges[:, 0]],
        offsets[edges[:, 1]],
    )
    counted = np.bincount(chosen + 1, minlength=len(spans) + 1)
    section = np.arange(len(spans) + 1) - 1
    start = np.concatenate([[0], edges[:, 0]])
    end = np.concatenate([[len(offsets) - 1], edges[:, 1]])
    keep = slice(0 if counted[0] else 1, None)
    total = np.full(len(section), len(ids), np.int64)
    return section[keep], start[keep], end[keep], counted[keep], total[keep]


def _batch(ids: pa.Array, rows: list[int], parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(column).astype(np.int64)) for column in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(rows, pa.int64())), *columns],
        names=["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"],
    )
