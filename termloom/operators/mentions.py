"""Names of several words: extracted, counted, ranked.

The default pattern takes runs of capitalised words, runs of one word included,
which are dropped afterwards. Every part of it is possessive: the engine never goes
back, so its time follows the length of the text and its stack does not grow, and
no second attempt starts within a word.

Chunks that come with the text around them (`chunk_texts` and `read_book` with an
overlap) are searched together with it, and a mention belongs to the chunk in which
it starts. Names shorter than the overlap are then found as in the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.rows import explode_computed

# Fixed value: a run of capitalised words.
CAPITALISED_RUN = r"\p{Lu}[\p{L}\p{N}]*+(?:[\t-\r ]++\p{Lu}[\p{L}\p{N}]*+)*+"

# From a text to names, or to their spans: (start, end) in characters.
Extractor = Callable[[str], Iterable[str | Sequence[int]]]


def extract_mentions(chunks: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """(mention): one row per occurrence, inner white space as one space.

    Without an extractor, runs of capitalised words. That is a pattern, not a
    trained tagger; for one, pass a function from text to names, or to spans. It
    runs in Arrow batches on the executors, and what it raises fails the job. To
    tell which chunk a name belongs to, names are looked up in the text, each
    after the one before; one that is not in the text raises an error. An
    extractor that changes names or finds overlapping ones returns spans.
    """
    texts = chunks
    around = {"before", "after"} <= set(chunks.columns)
    if extractor is None:
        # A filter on the chunks would have them worked out twice, and an empty one has no names.
        found = _owned_runs() if around else _runs("chunk")
    else:
        texts = chunks.filter(F.length("chunk") > 0)
        nothing = F.lit("")
        context = ("before", "after") if around else (nothing, nothing)
        found = _apply(extractor)("chunk", *context)
    mentions = explode_computed(texts, [], found, "mention").select(
        F.trim(F.regexp_replace("mention", "[\\t-\\r ]+", " ")).alias("mention")
    )
    return mentions.filter(_several_words(F.col("mention")))


def count_mentions(mentions: DataFrame) -> DataFrame:
    """(mention, n)."""
    return mentions.groupBy("mention").agg(F.count("*").alias("n"))


def top_mentions(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent; ties by name."""
    return counts.orderBy(F.col("n").desc(), F.col("mention")).limit(k)


def _several_words(mention: Column) -> Column:
    return F.contains(mention, F.lit(" "))


def _runs(text: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit(CAPITALISED_RUN), F.lit(0))


def _owned_runs() -> Column:
    """Runs of the chunk with the text around it that start within the chunk.

    Where runs start is decided by the text up to there alone, so the runs that
    start before a place are as many as the text up to that place has.
    """
    skipped = F.size(_runs("before"))
    owned = F.size(_runs(F.concat("before", "chunk"))) - skipped
    return F.slice(_runs(F.concat("before", "chunk", "after")), skipped + 1, owned)


def _apply(extractor: Extractor):
    """The extractor as a column function of chunk, before and after.

    All it needs is nested, so it travels by value and executors need no package.
    """

    def begins(name: str, text: str, last: int, after_last: int) -> int:
        for at in (after_last, last, 0):
            place = text.find(name, at)
            if place >= 0:
                return place
        raise ValueError(f"{name!r} is not in the text it was found in; return spans")

    def owned(text: str, start: int, end: int) -> list[str]:
        """Names that start in [start, end) of the text."""
        whole = start == 0 and end == len(text)
        names = []
        last, after_last = 0, 0
        for name in extractor(text):
            if not isinstance(name, str):
                begin, stop = name
                name = text[begin:stop]
            elif whole:
                begin = start
            else:
                begin = begins(name, text, last, after_last)
                last, after_last = begin + 1, begin + len(name)
            if start <= begin < end:
                names.append(name)
        return names

    @F.arrow_udf("array<string>")
    def extract(chunks: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        columns = (column.to_pylist() for column in (chunks, before, after))
        return pa.array(
            [
                owned(left + chunk + right, len(left), len(left) + len(chunk))
                for chunk, left, right in zip(*columns, strict=True)
            ],
            pa.list_(pa.string()),
        )

    return extract
