"""The search rules once more in plain Python, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from termloom.functions.stop_words import ENGLISH

STOPS = set(ENGLISH)


def document_tokens(text: str, profile: str) -> list[str]:
    text = text.lower()
    if profile == "normalized":
        cleaned = " ".join(re.sub("[^a-z0-9]+", " ", text).split())
    elif profile == "smoothed":
        cleaned = re.sub(r"[^a-z0-9\s]", "", text)
    else:
        cleaned = text
    words = re.split(r"[\t-\r ]", cleaned)
    if len(words) > 1:
        while words and words[-1] == "":
            words.pop()
    return [word for word in words if word not in STOPS]


def query_tokens(text: str, profile: str) -> list[str]:
    if profile != "smoothed":
        return document_tokens(text, profile)
    return [w for w in re.sub(r"[^a-z0-9\s]", "", text.lower()).split() if w not in STOPS]


class Index:
    def __init__(self, rows: list[tuple[str, str | None]], profile: str):
        self.profile = profile
        rows = [row for row in rows if row[1] is not None]
        self.n = len(rows)
        self.tf: dict[str, Counter] = defaultdict(Counter)
        for doc_id, text in rows:
            self.tf[doc_id].update(document_tokens(text, profile))
        self.tf = {doc_id: counts for doc_id, counts in self.tf.items() if counts}
        self.df = Counter(term for counts in self.tf.values() for term in counts)
        self.vectors = {
            doc_id: {term: self._tf(counts, term) * self.idf(term) for term in counts}
            for doc_id, counts in self.tf.items()
        }

    def _tf(self, counts: Counter, term: str) -> float:
        return counts[term] / counts.total() if self.profile == "normalized" else counts[term]

    def idf(self, term: str) -> float:
        df = self.df[term]
        if self.profile == "normalized":
            return math.log(self.n / df)
        return math.log((self.n + 1) / (df + 1))

    def norm(self, doc_id: str) -> float:
        return math.sqrt(math.fsum(w * w for w in self.vectors[doc_id].values()))

    def search(self, query: str, k: int = 10) -> list[tuple[str, float]]:
        tokens = query_tokens(query, self.profile)
        if len(tokens) == 1:
            hits = [(d, v[tokens[0]]) for d, v in self.vectors.items() if tokens[0] in v]
            if tokens == [""]:
                hits = []
        else:
            hits = self._cosine(Counter(t for t in tokens if t))
        by_id = lambda hit: (hit[0] is not None, hit[0] or "")
        hits.sort(key=by_id, reverse=self.profile == "smoothed" and len(tokens) == 1)
        hits.sort(key=lambda hit: -hit[1])
        return hits[:k]

    def _cosine(self, counts: Counter) -> list[tuple[str, float]]:
        if self.profile == "normalized":
            counts = Counter({t: c for t, c in counts.items() if self.df[t] > 0})
        query = {term: count * self.idf(term) for term, count in counts.items()}
        query_norm = math.sqrt(math.fsum(w * w for w in query.values()))
        hits = []
        for doc_id, vector in self.vectors.items():
            repeats = counts if self.profile == "smoothed" else dict.fromkeys(counts, 1)
            norm = self.norm(doc_id)
            if query_norm > 0 and norm > 0:
                parts = (
                    vector.get(t, 0.0) / norm * (w / query_norm) * repeats[t] for t, w in query.items()
                )
                hits.append((doc_id, math.fsum(parts)))
        hits = [hit for hit in hits if hit[1] > 0]
        return hits
