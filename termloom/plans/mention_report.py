"""Chunk, extract, count, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame

from termloom.operators.chunks import CHUNK_SIZE, OVERLAP, chunk_texts
from termloom.operators.mentions import (
    Extractor,
    count_mentions,
    extract_mentions,
    top_mentions,
)


def mention_report(
    documents: DataFrame,
    k: int = 10,
    size: int | None = None,
    extractor: Extractor | None = None,
    overlap: int | None = None,
) -> DataFrame:
    """(mention, n): the k most frequent mentions of (doc_id, text).

    The default pattern reads whole texts. An extractor may take no more than so
    many characters at a time, so it gets chunks, seen with ``OVERLAP`` characters
    on either side: names shorter than that are found as in the whole text. With
    a ``size`` of one's own the overlap is ``overlap``, or none, and then a mention
    that a chunk end cuts is lost or shortened.
    """
    if size is None and extractor is not None:
        size = CHUNK_SIZE
        overlap = OVERLAP if overlap is None else overlap
    chunks = chunk_texts(documents, size, overlap or 0)
    return top_mentions(count_mentions(extract_mentions(chunks, extractor)), k)
