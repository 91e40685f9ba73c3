"""Alignment of two tokenizers against brute force on the public tokenizers themselves."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from termloom.llm import alignment
from termloom.llm.alignment import align_tokens, links, shared_ends, text_parts
from termloom.llm.tokens import _byte_of_symbol

ROWS = [
    (1, "The hero's journey,  the HERO returns!\n\n  indented\tline 12345 $$$"),
    (2, "élan über naïve ñandú — “quotes” …  x y"),
    (3, "emoji 👩‍👩‍👧 and <|endoftext|> as </s> text <0x41> <unk>"),
    (4, ""),
    (5, None),
    (6, " "),
    (7, "\n"),
    (8, "a" * 3000),
    (9, "word " * 500),
    (10, "a ▁ b"),
    (11, "日本語の文章です。これはテストです。"),
    (12, "\x00 null and   others\r\n"),
    (None, "rows without an id, twice"),
    (None, "rows without an id, twice"),
    (9, "word " * 500),
]


@pytest.fixture(scope="module")
def public():
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


def encode(public, text):
    """Lists of (id, bytes) of both, or nothing."""
    if not text:
        return [], []
    byte_of = _byte_of_symbol()
    first = public[0].encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(byte_of[s] for s in symbol)) for i, symbol in zip(first.ids, first.tokens)]
    b = []
    for i in public[1].encode(text):
        piece = public[1].id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if public[1].is_byte(i) else piece.replace("▁", " ").encode()
        b.append((i, raw))
    whole = (" " + text).encode()
    joined = [b"".join(raw for _, raw in tokens) for tokens in (a, b)]
    return (a, b) if joined == [whole, whole] else ([], [])


def spans(tokens):
    at, found = 0, []
    for i, raw in tokens:
        found.append((i, at, at + len(raw)))
        at += len(raw)
    return found


def brute(public, rows):
    texts, corpus = [], collections.Counter()
    for doc_id, text in rows:
        a, b = (spans(tokens) for tokens in encode(public, text))
        linked, low = [], 0
        for i, start, end in a:
            while low < len(b) and b[low][2] <= start:
                low += 1
            k = low
            while k < len(b) and b[k][1] < end:
                linked.append((i, b[k][0]))
                k += 1
        corpus.update(linked)
        groups, x, y = [], [], []
        ends = {t[2] for t in a} & {t[2] for t in b}
        for end in sorted(ends):
            x = [t[0] for t in a if t[2] <= end and t[1] >= (0 if not groups else last)]
            y = [t[0] for t in b if t[2] <= end and t[1] >= (0 if not groups else last)]
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            last = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        texts.append((doc_id, len(a), len(b), len(groups), linked, digest))
    peak = collections.Counter()
    for (_, j), n in corpus.items():
        peak[j] = max(peak[j], n)
    return sorted(
        (
            (doc_id, n_a, n_b, n_groups, len(linked), sum(corpus[p] == peak[p[1]] for p in linked),
             sum(corpus[p] for p in linked), digest)
            for doc_id, n_a, n_b, n_groups, linked, digest in texts
        ),
        key=repr,
    )


def aligned(table, **options):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = align_tokens(table, **options).select(columns).collect()
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.mark.parametrize("head", [1_000_000, 20, 0])
def test_against_brute_force(documents, clashing, public, head):
    """With all pairs broadcast, few of them, and none."""
    assert aligned(clashing(documents(ROWS)), head_pairs=head) == brute(public, ROWS)


def test_whole_texts_of_the_table(spark, sf, public):
    from termloom.llm.queries import op11_alignment

    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    short = [(i, text) for i, text in rows if len(text or "") < 6000]
    assert len(short) > 100
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert aligned(table.filter("length(text) < 6000 or text is null")) == brute(public, short)
    # Groups, links and counts of the whole table, without the slow brute force of groups.
    every = {row.doc_id: row for row in op11_alignment(spark, sf).select(columns).collect()}
    corpus, linked = collections.Counter(), {}
    for doc_id, text in rows:
        a, b = encode(public, text)
        ends_a, ends_b = (np.cumsum([len(raw) for _, raw in tokens], dtype=np.int64) for tokens in (a, b))
        places = zip(*(side.tolist() for side in links(ends_a, ends_b)))
        linked[doc_id] = [(a[i][0], b[j][0]) for i, j in places]
        corpus.update(linked[doc_id])
        assert (every[doc_id].n_a, every[doc_id].n_b) == (len(a), len(b))
        assert every[doc_id].n_groups == len(set(ends_a.tolist()) & set(ends_b.tolist()))
    peak = collections.Counter()
    for (_, j), n in corpus.items():
        peak[j] = max(peak[j], n)
    for doc_id, pairs in linked.items():
        assert every[doc_id].n_links == len(pairs)
        assert every[doc_id].n_best == sum(corpus[pair] == peak[pair[1]] for pair in pairs)
        assert every[doc_id].count_sum == sum(corpus[pair] for pair in pairs)


def test_rounds_do_not_matter(documents, public, monkeypatch):
    monkeypatch.setattr(alignment, "ROUND_BYTES", 40)
    monkeypatch.setattr(alignment, "ROUND_LINKS", 30)
    assert aligned(documents(ROWS)) == brute(public, ROWS)


def test_no_rows(documents):
    assert align_tokens(documents([])).collect() == []
    assert aligned(documents([(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_parts_of_a_text_give_the_ids_of_the_whole(spark, public, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()][:60]
    for text in [text for _, text in ROWS if text] + [text for text in texts if text]:
        for size in (5, 50):
            ids = [i for part in text_parts(text, size) for i in public[1].encode(part)]
            assert ids == public[1].encode(text)


def test_shared_ends_and_links_against_sets():
    rng = random.Random(0)
    for _ in range(1500):
        a, b, bounds, offset = [], [], [0], 0
        for _ in range(rng.randint(1, 4)):
            n = rng.randint(1, 40)
            for ends in (a, b):
                ends += [x + offset for x in sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n]]
            offset += n
            bounds.append(len(a))
        x, y = np.array(a), np.array(b)
        assert shared_ends(x, y, np.array(bounds)).tolist() == np.flatnonzero(np.isin(x, y)).tolist()
        found = set(zip(*(side.tolist() for side in links(x, y))))
        starts = [0, *a], [0, *b]
        assert found == {
            (i, j)
            for i in range(len(a))
            for j in range(len(b))
            if max(starts[0][i], starts[1][j]) < min(a[i], b[j])
        }


def test_long_texts_without_a_common_end_are_halved_in_few_steps():
    n = 1 << 18
    a, b = np.arange(1, n + 1) * 2 - 1, np.arange(1, n) * 2
    a, b = np.append(a, 2 * n), np.append(b, 2 * n)
    assert shared_ends(a, b, np.array([0, len(a)])).tolist() == [len(a) - 1]
