"""Weighting profiles: the choices that change answers, held as data."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Profile:
    """How text is cleaned and how terms, queries and ties are weighed."""

    name: str
    # "space" | "delete" | "none": see termloom.functions.text
    cleaning: str
    # Divide a document's term count by the document's length.
    length_normalized: bool
    # ln((N+1)/(df+1)) instead of ln(N/df).
    smooth_idf: bool
    # Keep query terms the corpus does not have (df = 0), so that they
    # lengthen the query vector.
    keep_unknown_terms: bool
    # Count a repeated query term once per repeat in the dot product, on top
    # of its own frequency. Scores may then exceed 1.
    repeat_weight: bool
    # Break single-term ties by document id, read as text, largest first.
    single_ties_by_text_desc: bool
    # Shown for a hit whose document has no title row.
    default_title: str

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Profile:
        return Profile(**json.loads(text))


# The two weightings, and the titles they show for a miss.
NORMALIZED = Profile(
    name="normalized",
    cleaning="space",
    length_normalized=True,
    smooth_idf=False,
    keep_unknown_terms=False,
    repeat_weight=False,
    single_ties_by_text_desc=False,
    default_title="[Title Not Found]",
)

SMOOTHED = Profile(
    name="smoothed",
    cleaning="delete",
    length_normalized=False,
    smooth_idf=True,
    keep_unknown_terms=True,
    repeat_weight=True,
    single_ties_by_text_desc=True,
    default_title="Unknown Movie Name",
)

# Tokens of the text as it stands; the weighting is that of NORMALIZED.
RAW = Profile(
    name="raw",
    cleaning="none",
    length_normalized=True,
    smooth_idf=False,
    keep_unknown_terms=False,
    repeat_weight=False,
    single_ties_by_text_desc=False,
    default_title="[Title Not Found]",
)
