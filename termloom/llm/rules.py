"""Quality rules as one projection of ratios against a table of thresholds.

Every measure is an expression of built-in functions over one row, so nothing
is shuffled and nothing leaves the JVM. Repeated passages are found by sorting
the hashes of a text's three-word windows next to their places; neighbours
with one hash are compared word by word before they count as equal.

A null text has no words, like an empty one: it fails the base rule, and all
counts are 0. Rows are treated one by one; repeated rows, null ids and other
columns change nothing, an empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import WORD

GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[^#*$%&|<>]+"
# Frequent function words of four languages, fixed values.
STOP_WORDS = (
    "the of and to in is that it for was on with as be by this at from or an are "
    "le la les de des et un une est que en du dans pour pas au ce il "
    "der die das und ist ein eine zu den mit von auf nicht sich des dem im "
    "el los las y una por con del se no es"
)
STOP_PATTERN = r"(?i)(?<![^\x20\x09-\x0D])(?:" + "|".join(
    sorted(set(STOP_WORDS.split()))
) + r")(?=[\x20\x09-\x0D.,;:!?]|\z)"


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a denominator of 0 passes."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RULES = [
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("line_length", "n_words", "n_lines", 2.0, None),
]


def measures(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words)."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    split = texts.select(
        "doc_id",
        "text",
        F.split(F.btrim("text", F.lit(SPACES)), GAP).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    # The words of a text without any are one empty string.
    has_words = F.element_at("words", 1) != ""
    windows = split.select(
        "doc_id",
        F.when(has_words, F.size("words")).otherwise(0).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.regexp_count("text", F.lit(STOP_PATTERN)).cast("bigint").alias("n_stop_words"),
        "words",
        F.transform(
            F.when(F.size("words") > 2, F.slice("words", 1, F.size("words") - 2)).otherwise(
                F.array().cast("array<string>")
            ),
            lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("hashes"),
    )
    repeats = windows.select(
        "*",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("sorted"),
    )
    places = repeats.select("*", _repeated_places().alias("places"))
    return places.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        "n_lines",
        "n_stop_words",
    )


def _repeated_places() -> Column:
    """Places of the words of windows that are in the text twice or more."""

    def twins(pair: Column, k: Column) -> Column:
        """This window's place and the next one's, if the two are equal."""
        other = F.get("sorted", k + 1)
        at, then = pair["i"], other["i"]
        same = (
            (F.get("words", at) == F.get("words", then))
            & (F.get("words", at + 1) == F.get("words", then + 1))
            & (F.get("words", at + 2) == F.get("words", then + 2))
        )
        return F.when(
            (pair["h"] == other["h"]) & same,
            F.array(at, at + 1, at + 2, then, then + 1, then + 2),
        )

    found = F.array_compact(F.transform("sorted", twins))
    return F.when(F.col("sorted").isNotNull(), F.array_distinct(F.flatten(found)))


def rule_passes(rule: Rule) -> Column:
    top = F.col(rule.numerator)
    value = top if rule.denominator is None else top / F.nullif(F.col(rule.denominator), F.lit(0))
    passes = F.lit(True)
    if rule.low is not None:
        passes = passes & (value >= rule.low)
    if rule.high is not None:
        passes = passes & (value <= rule.high)
    return F.coalesce(passes, F.lit(True))


def quality_rules(documents: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Measures of every text, base_failed, failed (names of rules broken), kept."""
    rules = RULES if rules is None else rules
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    failed = F.array_compact(
        F.array(*[F.when(~rule_passes(rule), F.lit(rule.name)) for rule in rules])
        if rules
        else F.array().cast("array<string>")
    )
    judged = measures(documents).withColumns({"base_failed": base_failed, "failed": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
