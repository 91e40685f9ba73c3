"""Byte-level BPE with a public vocabulary, and where each token lies."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark import SparkContext

VOCABULARY = "byte_bpe_50k.json"
# Characters a text is encoded by at a time.
CHUNK = 1_000_000


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def _byte_of_symbol() -> dict[str, int]:
    """Which byte each printable stand-in of a byte-level vocabulary means."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (byte for byte in range(256) if byte not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and the number of bytes of each id.

    The tokenizer file lists its merges in the order of their ids, so the ids
    are the merge ranks. tiktoken encodes by ranks and is several times as
    fast as the library the file was made for; a test holds the ids equal.
    """
    parsed = json.loads(vocabulary)
    special = {token["content"] for token in parsed["added_tokens"]}
    byte_of = _byte_of_symbol()
    ranks = {
        bytes(byte_of[symbol] for symbol in token): rank
        for token, rank in parsed["model"]["vocab"].items()
        if token not in special
    }
    encoding = tiktoken.Encoding(
        "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    widths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        widths[rank] = len(token)
    return encoding, widths


class Encoder:
    """Encodes whole texts in a worker; the vocabulary travels by broadcast.

    The vocabulary's size is fixed (some 1.5 MB), and executors need no
    copy of its file.
    """

    def __init__(self, context: SparkContext, path: str | None = None):
        with open(path or default_path(), "rb") as file:
            self._vocabulary = context.broadcast(file.read())

    def ids(self, text: str) -> np.ndarray:
        """Ids of the text, special strings taken as ordinary text."""
        encoding, _ = _encoding(self._vocabulary.value)
        parts = [np.array(encoding.encode_ordinary(part), np.uint32) for part in _parts(text)]
        return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint32)])

    def widths(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each token."""
        return self.all_widths[ids]

    @property
    def all_widths(self) -> np.ndarray:
        """Bytes of the token of each id."""
        return _encoding(self._vocabulary.value)[1]


def _parts(text: str) -> Iterator[str]:
    """The text in parts of about CHUNK characters, cut where no token crosses.

    No token goes from a character that is not white space to one that is, so
    a cut there leaves the ids as they are. A lone surrogate has no bytes in
    UTF-8; Spark texts hold none.
    """
    start = 0
    while len(text) - start > CHUNK:
        cut = start + CHUNK
        while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text) or not text:
        yield text[start:]
