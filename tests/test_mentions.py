import random
import re
import time
from collections import Counter

import pytest
import regex

from termloom import mention_report
from termloom.operators.chunks import chunk_texts
from termloom.operators.mentions import count_mentions, extract_mentions

TEXT = """Captain Ahab met Moby
Dick. Captain  Ahab said: Call me Ishmael. Élan Vital, Captain Ahab; New York City"""


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def counted(frame):
    return {row.mention: row.n for row in frame.collect()}


def test_runs_of_capitalised_words(spark):
    chunks = chunk_texts(documents(spark, TEXT, "", None))
    assert counted(count_mentions(extract_mentions(chunks))) == {
        "Captain Ahab": 3,
        "Moby Dick": 1,
        "Élan Vital": 1,
        "New York City": 1,
    }


def test_report_ranks_by_count_then_name(spark):
    rows = mention_report(documents(spark, TEXT, TEXT), k=3).collect()
    assert [(row.mention, row.n) for row in rows] == [
        ("Captain Ahab", 6),
        ("Moby Dick", 2),
        ("New York City", 2),
    ]


def test_a_chunk_end_cuts_mentions(spark):
    report = mention_report(documents(spark, "aa Captain Ahab"), size=8)
    assert report.count() == 0


def test_own_extractor(spark):
    def pairs(text):
        words = text.split()
        return [" ".join(pair) for pair in zip(words, words[1:])] + words

    got = counted(mention_report(documents(spark, "a b a b", "a  b"), extractor=pairs))
    assert got == dict(Counter({"a b": 3, "b a": 1}))


def test_a_failing_extractor_fails_the_job(spark):
    def broken(text):
        raise RuntimeError("no model here")

    with pytest.raises(Exception, match="no model here"):
        mention_report(documents(spark, "Some Text"), extractor=broken).collect()


def spans_of(pattern):
    def extractor(text):
        return [match.span() for match in re.finditer(pattern, text)]

    return extractor


def names_of(pattern):
    def extractor(text):
        return re.findall(pattern, text)

    return extractor


RUN = r"[A-Z][a-z]*(?: [A-Z][a-z]*)+"


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["Ahab", "Moby", "Dick", "whale", "sea", "A", "the", "Élan", "Été2", "x,", "\n", "mcX Y"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("size", [40, 41, 97])
@pytest.mark.parametrize("kind", [None, names_of, spans_of])
def test_overlapping_chunks_lose_nothing(spark, size, kind):
    """Names shorter than the overlap are those of whole texts, whoever finds them."""
    texts = documents(spark, *random_texts(1, 60), "Ahab Moby " * 40 + "end")
    extractor = kind(RUN) if kind else None
    short = size - 1

    def found(chunks):
        names = extract_mentions(chunks, extractor)
        return counted(count_mentions(names.filter(f"length(mention) < {short}")))

    whole = found(chunk_texts(texts, None))
    assert whole and found(chunk_texts(texts, size, size)) == whole
    assert found(chunk_texts(texts, size)) != whole


def test_a_report_with_an_extractor_sees_past_chunk_ends(spark):
    text = "x" * 9_995 + " Captain Ahab and " + "y" * 9_984 + " Moby Dick"
    report = mention_report(documents(spark, text), extractor=names_of(RUN))
    assert counted(report) == {"Captain Ahab": 1, "Moby Dick": 1}
    assert counted(mention_report(documents(spark, text), extractor=names_of(RUN), size=10_000)) == {}


def test_a_name_that_is_not_in_the_text(spark):
    def changed(text):
        return [name.upper() for name in re.findall(RUN, text)]

    texts = documents(spark, "aa Captain Ahab")
    assert counted(mention_report(texts, extractor=changed)) == {"CAPTAIN AHAB": 1}
    with pytest.raises(Exception, match="return spans"):
        mention_report(texts, extractor=changed, size=12, overlap=12).collect()


def test_overlap_must_fit_the_chunk(spark):
    for overlap in (-1, 9):
        with pytest.raises(ValueError, match="overlap"):
            mention_report(documents(spark, "a"), size=8, overlap=overlap)


def test_the_pattern_finds_what_the_plain_one_finds(spark):
    texts = random_texts(2, 200) + ["ABC def GHI", "aBc De", "ÉLAN Vital", "A  B\t\x0bC", "A b", "İstanbul Ǆ"]
    plain = regex.compile(r"\p{Lu}[\p{L}\p{N}]*(?:[\t-\r ]+\p{Lu}[\p{L}\p{N}]*)+")
    expected = Counter(
        re.sub("[\t-\r ]+", " ", name)
        for text in texts
        for name in plain.findall(re.sub("\r\n|\n|\r", " ", text))
    )
    assert counted(count_mentions(extract_mentions(chunk_texts(documents(spark, *texts), None)))) == expected


def seconds(spark, text):
    table = documents(spark, text).repartition(1)
    start = time.time()
    rows = mention_report(table).collect()
    return time.time() - start, [(len(row.mention), row.n) for row in rows]


@pytest.mark.parametrize("unit, expected", [("Ab ", 1), ("A", 0), ("AB CD ", 1), ("Ab c ", 0)])
def test_long_runs_take_linear_time_and_no_stack(spark, unit, expected):
    n = 1_000_000
    seconds(spark, unit * 1000)
    half, _ = seconds(spark, unit * (n // 2))
    full, rows = seconds(spark, unit * n)
    assert len(rows) == expected
    if expected:
        assert rows == [(len(unit) * n - 1, 1)]
    # Twice the text may take twice the time, and a fixed part for the job.
    assert full < 3 * half + 2
