"""Packing and token counts against the public tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from termloom.llm import packing, tokens
from termloom.llm.packing import best_fit_decreasing, pack_documents
from termloom.llm.token_counts import allocate, line_spans, token_counts

TEXTS = [
    "The hero's journey,  the HERO returns!\n\n  indented\tline 12345 $$$",
    "élan über naïve ñandú — “quotes” …  x y",
    "emoji 👩‍👩‍👧 and <|endoftext|> as text",
    "",
    " ",
    "\n",
    "a" * 3000,
    "word " * 2500,
]


@pytest.fixture(scope="module")
def public():
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_ids_equal_the_public_tokenizer(spark, public, monkeypatch):
    encoder = tokens.Encoder(spark.sparkContext)
    texts = [row.text for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for chunk in (tokens.CHUNK, 50):
        monkeypatch.setattr(tokens, "CHUNK", chunk)
        for text in TEXTS + texts[:60]:
            expected = public.encode(text, add_special_tokens=False).ids
            assert encoder.ids(text).tolist() == expected


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 60))]
        where, offset, used = best_fit_decreasing(np.array(lengths, np.int64), 64)
        rooms: list[int] = []
        for length in sorted(lengths, reverse=True):
            fitting = [room for room in rooms if room >= length]
            if fitting:
                rooms[rooms.index(min(fitting))] -= length
            else:
                rooms.append(64 - length)
        assert used == len(rooms)
        fill = [0] * used
        for piece in sorted(range(len(lengths)), key=lambda i: offset[i]):
            assert offset[piece] == fill[where[piece]]
            fill[where[piece]] += lengths[piece]
        assert sorted(64 - f for f in fill) == sorted(rooms)


@pytest.mark.parametrize("round_tokens", [packing.ROUND_TOKENS, 500])
def test_packing_is_a_round_trip(spark, documents, clashing, public, round_tokens):
    rows = [(i, text) for i, text in enumerate(TEXTS)] + [(100, None), (None, "no id"), (3, ""), (3, "")]
    table = clashing(documents(rows))
    pieces = pack_documents(table, round_tokens=round_tokens).collect()
    by_document = {}
    for piece in pieces:
        assert 0 < piece.length <= 1024 and len(piece.ids) == 4 * piece.length
        by_document.setdefault(piece.doc_id, []).append(piece)
    assert sorted(by_document, key=str) == sorted({row[0] for row in rows}, key=str)
    for doc_id, text in rows:
        if doc_id == 3:
            continue
        expected = public.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(by_document[doc_id], key=lambda p: p.start)
        got = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own])
        assert got.tolist() == expected
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own[:-1]]).tolist()
        assert all(p.doc_tokens == len(expected) for p in own)
    assert [(p.length, p.doc_tokens) for p in by_document[3]] == [(1, 1)] * 3
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append(piece)
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts[:-1]]).tolist()
        assert sum(p.length for p in parts) <= 1024


def test_packing_query_and_padding(spark, public):
    from termloom.llm.queries import op9_packing

    rows = op9_packing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in rows[:100]:
        ids = public.encode(texts[row.doc_id], add_special_tokens=False).ids + [0]
        part = np.array(ids[row.start : row.start + row.length], "<u4")
        assert zlib.crc32(part.tobytes()) == row.ids_crc32
    used = sum(row.length for row in rows)
    assert used > 0.99 * 1024 * len({row.sequence_id for row in rows})


def test_packing_of_nothing(spark, documents):
    assert pack_documents(documents([])).count() == 0


def brute_counts(public, text, spans):
    """Tokens of each section by the same rule, from the tokenizer's own pieces."""
    raw = text.encode()
    edges = [(len(text[:s].encode()), len(text[:e].encode())) for s, e in spans]
    widths = [len(public.decode([i]).encode()) for i in public.encode(text, add_special_tokens=False).ids]
    if sum(widths) != len(raw):
        return None  # a character split over tokens has no text of its own
    counts, at = {}, 0
    for width in widths:
        held = [min(e, at + width) - max(s, at) for s, e in edges]
        best = max(held, default=0)
        section = held.index(best) if best > 0 else -1
        counts[section] = counts.get(section, 0) + 1
        at += width
    return counts


def test_token_counts_against_brute_force(spark, documents, clashing, public):
    texts = [text for text in TEXTS if len(text) < 1000] + ["one\n\ntwo words\nthree", None]
    rows = token_counts(clashing(documents(list(enumerate(texts))))).collect()
    for i, text in enumerate(texts):
        own = {row.section: row for row in rows if row.doc_id == i}
        spans = line_spans(text or "")
        for k, (start, end) in enumerate(spans):
            assert (own[k].start, own[k].end) == (start, end)
        total = len(public.encode(text or "", add_special_tokens=False).ids)
        assert sum(row.n_tokens for row in own.values()) == total
        assert all(row.doc_tokens == total for row in own.values())
        expected = brute_counts(public, text or "", spans)
        if expected is not None:
            assert {k: row.n_tokens for k, row in own.items() if row.n_tokens} == expected


def test_boundary_tokens_go_where_most_of_them_is():
    ends = np.array([4, 8, 9])
    assert allocate(ends, np.array([0, 5]), np.array([5, 9])).tolist() == [0, 1, 1]
    assert allocate(ends, np.array([0, 6]), np.array([6, 9])).tolist() == [0, 0, 1]  # a tie
    assert allocate(ends, np.array([8]), np.array([9])).tolist() == [-1, -1, 0]
    assert allocate(ends, np.array([], int), np.array([], int)).tolist() == [-1, -1, -1]


def test_given_sections(spark, documents):
    from pyspark.sql import functions as F

    table = documents([(1, "alpha beta gamma"), (2, None), (None, "alpha beta")])
    spans = F.array(F.struct(F.lit(0).alias("a"), F.lit(5).alias("b")))
    rows = token_counts(table.withColumn("parts", F.when(F.col("doc_id") == 1, spans)), "parts").collect()
    found = {(row.doc_id, row.section): row.n_tokens for row in rows}
    assert found[(1, 0)] >= 1 and found[(1, -1)] >= 1
    assert (2, 0) not in found and found[(None, -1)] >= 2
    assert token_counts(documents([])).count() == 0


def test_token_counts_query(spark):
    from termloom.llm.queries import op4_token_counts

    rows = op4_token_counts(spark, "/root/testdata/sf0.001").collect()
    sums = {}
    for row in rows:
        sums.setdefault((row.doc_id, row.doc_tokens), []).append(row.n_tokens)
    assert all(sum(parts) == total for (_, total), parts in sums.items())


def test_packed_pieces_come_in_small_batches():
    """A batch of full windows is a few MB, however many a round has."""
    ids = np.arange(packing.WINDOW, dtype="<u4")
    pieces = [(pa.scalar(i), 0, ids, packing.WINDOW) for i in range(3000)]
    batches = list(packing._packed(pieces, packing.WINDOW, 0, pa.field("doc_id", pa.int64())))
    assert sum(batch.num_rows for batch in batches) == 3000
    assert max(batch.nbytes for batch in batches) < 5_000_000
    assert [i for batch in batches for i in batch.column("doc_id").to_pylist()] == list(range(3000))
