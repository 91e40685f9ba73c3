"""Personal data: patterns propose spans, checks confirm, context scores.

Everything is column expressions. A pattern's matches come from
``regexp_extract_all``, their places from the texts between them, which
``split`` by the same pattern gives: a match starts where the texts and
matches before it end, which running sums over the array tell (`running`). The
nearby text of a match is the end of the text before it and the start of the one
after. So the work follows the text, and its matches as long as they are no more
than some million: running sums are made in blocks, and there the blocks' number
begins to tell.

Patterns are written with possessive groups and begin where the last match
ended or where a run of their first class begins. Both leave the leftmost
matches as they are and keep the time linear on long runs.

Kinds and checks: e-mail addresses; ip addresses with parts of at most 255;
card numbers of 13 to 19 digits that pass Luhn's check; phone numbers of 9 to
15 digits; account numbers (iban) whose remainder modulo 97 is 1. A match that
fails its check is dropped and not tried again from within.

The score of a span is its kind's prior, raised if a word that goes with the
kind stands nearby, at most 1.

Null and empty texts have no spans. Rows are treated one by one, so repeated
rows, null ids and clashing column names change nothing; an empty table gives
no row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEARBY = 40
CONTEXT_BONUS = 0.3
# Values of a block of `running`.
BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``hint`` is a text without which no match is."""

    name: str
    pattern: str
    hint: str
    prior: float
    context: str


def _at_run_start(first: str) -> str:
    return rf"(?:\G|(?<!{first}))"


KINDS = [
    Kind(
        "email",
        _at_run_start("[A-Za-z0-9._%+-]")
        + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.9,
        r"(?i)mail|contact|write",
    ),
    Kind(
        "ip",
        _at_run_start("[0-9]") + r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        r"[0-9]\.[0-9]",
        0.6,
        r"(?i)\bip\b|address|server|host",
    ),
    Kind(
        "card",
        _at_run_start("[0-9]") + r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9][\x20-]?[0-9]",
        0.7,
        r"(?i)card|visa|credit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        0.6,
        r"(?i)phone|call|tel|mobile|fax",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
        "[A-Z][A-Z][0-9][0-9]",
        0.8,
        r"(?i)iban|account|bank|transfer",
    ),
]
BASE = ["email", "ip", "card", "phone"]


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The last digit counts once, the one before it twice, and so on."""
    places = F.split(F.reverse(digits), "(?<=.)(?=.)")
    values = F.transform(
        places,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, value: total + value) % 10 == 0


def _mod97(found: Column) -> Column:
    """Country and check digits last, letters as 10 to 35."""
    turned = F.concat(F.substr(found, F.lit(5)), F.substr(found, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    rest = F.aggregate(
        F.split(turned, "(?<=.)(?=.)"),
        F.lit(0),
        lambda total, c: (total * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97,
    )
    return rest == 1


def _confirmed(kind: Kind, found: Column) -> Column:
    digits = _digits(found)
    n = F.length(digits)
    if kind.name == "ip":
        # Compared as text of three digits, since a part may be too long for a number.
        bare = lambda part: F.regexp_replace(part, "^0+(?=.)", "")
        return F.forall(
            F.split(found, r"\."),
            lambda part: (F.length(bare(part)) <= 3) & (F.lpad(bare(part), 3, "0") <= "255"),
        )
    if kind.name == "card":
        return F.when(n.between(13, 19), _luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return n.between(9, 15)
    if kind.name == "iban":
        return _mod97(found)
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value worked out once; a lambda would work it out in every step."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What the values before each one come to, from 0, and all of them at the end.

    ``merge`` is a sum or a maximum. Results are appended within blocks, so
    appending costs each value a block, not the array, and blocks are merged.
    """

    def append(acc: Column, value: Column) -> Column:
        return F.concat(acc, F.array(merge(F.element_at(acc, -1), value)))

    def gathered(array: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.size(array) / BLOCK).cast("int"))
        return F.transform(
            numbers,
            lambda i: F.aggregate(
                F.slice(array, i * BLOCK + 1, F.lit(BLOCK)), F.array(F.lit(0)), append
            ),
        )

    def joined(blocks: Column) -> Column:
        bases = F.aggregate(
            blocks, F.array(F.lit(0)), lambda acc, block: append(acc, F.element_at(block, -1))
        )
        return let(
            bases,
            lambda bases: F.concat(
                F.flatten(
                    F.transform(
                        blocks,
                        lambda block, i: F.transform(
                            F.slice(block, F.lit(1), F.size(block) - 1),
                            lambda value: merge(F.get(bases, i), value),
                        ),
                    )
                ),
                F.array(F.element_at(bases, -1)),
            ),
        )

    return let(values, lambda array: let(gathered(array), joined))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _spans(kind: Kind) -> Column:
    """Array of (kind, start, end, score, byte_start, byte_end) in ``__text``."""
    text = F.col("__text")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    none = F.filter(
        F.array(_one(kind, F.lit(0), F.lit(0), F.lit(0.0), F.lit(0), F.lit(0))), lambda _: F.lit(False)
    )

    def matches(found: Column, between: Column) -> Column:
        """Each match with the lengths of it and of the text before it, and the text nearby."""
        return F.transform(
            found,
            lambda match, i: F.struct(
                match.alias("found"),
                F.length(F.get(between, i)).alias("gap"),
                F.length(match).alias("length"),
                F.octet_length(F.get(between, i)).alias("byte_gap"),
                F.octet_length(match).alias("byte_length"),
                F.concat_ws(
                    " ",
                    F.right(F.get(between, i), F.lit(NEARBY)),
                    F.left(F.get(between, i + 1), F.lit(NEARBY)),
                ).alias("nearby"),
            ),
        )

    def spans(placed: Column, ends: Column, byte_ends: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            start = F.get(ends, i) + m["gap"]
            byte_start = F.get(byte_ends, i) + m["byte_gap"]
            bonus = F.when(m["nearby"].rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            score = F.least(F.lit(1.0), kind.prior + bonus)
            return F.when(
                _confirmed(kind, m["found"]),
                _one(kind, start, start + m["length"], score, byte_start, byte_start + m["byte_length"]),
            )

        return F.array_compact(F.transform(placed, span))

    gathered = let(
        let(between, lambda between: let(found, lambda found: matches(found, between))),
        lambda placed: let(
            running(F.transform(placed, lambda m: m["gap"] + m["length"]), _sum),
            lambda ends: let(
                running(F.transform(placed, lambda m: m["byte_gap"] + m["byte_length"]), _sum),
                lambda byte_ends: spans(placed, ends, byte_ends),
            ),
        ),
    )
    return F.when(text.rlike(kind.hint), gathered).otherwise(none)


def _one(kind: Kind, start, end, score, byte_start, byte_end) -> Column:
    return F.struct(
        F.lit(kind.name).alias("kind"),
        start.alias("start"),
        end.alias("end"),
        score.alias("score"),
        byte_start.alias("byte_start"),
        byte_end.alias("byte_end"),
    )


def find_pii(documents: DataFrame, kinds: list[Kind] | None = None) -> DataFrame:
    """(doc_id, text, spans): spans by kind as listed, then by start.

    A span is (kind, start, end, score, byte_start, byte_end), ends exclusive.
    """
    kinds = KINDS if kinds is None else kinds
    texts = documents.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("__text"))
    found = texts.select("doc_id", "text", *[_spans(kind).alias(kind.name) for kind in kinds])
    return found.select("doc_id", "text", F.concat(*[F.col(kind.name) for kind in kinds]).alias("spans"))


def redact(documents: DataFrame, min_score: float = 0.0, kinds: list[Kind] | None = None) -> DataFrame:
    """The documents with the spans of their text replaced by ``<kind>``.

    All columns stay, ``n_chars`` follows the text if there is one. Spans that
    overlap are replaced together, by the first one's kind. A text without
    spans, null included, is left as it is.
    """
    kinds = KINDS if kinds is None else kinds
    columns = documents.columns
    texts = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("__row"),
        F.coalesce("text", F.lit("")).alias("__text"),
    )
    found = texts.select("__row", "__text", *[_spans(kind).alias(f"__{kind.name}") for kind in kinds])
    spans = F.filter(
        F.concat(*[F.col(f"__{kind.name}") for kind in kinds]), lambda span: span["score"] >= min_score
    )
    ordered = found.select(
        "__row",
        "__text",
        F.sort_array(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["byte_start"].alias("start"), s["byte_end"].alias("end"), s["kind"].alias("kind")
                ),
            )
        ).alias("__spans"),
    )
    # __before: the furthest end before each span, and of all spans. Where none
    # reaches into a span, a run of overlapping spans begins.
    ends = ordered.select(
        "*",
        running(
            F.transform("__spans", lambda t: t["end"]), lambda a, b: F.greatest(a, b)
        ).alias("__before"),
    )
    runs = ends.select(
        "__row",
        "__text",
        "__spans",
        "__before",
        F.array_compact(
            F.transform("__spans", lambda s, i: F.when(s["start"] >= F.get("__before", i), i))
        ).alias("__starts"),
    )
    end_of = lambda i: F.get(
        "__before", F.coalesce(F.get("__starts", i + 1), F.size("__spans"))
    )
    first = F.get("__spans", F.get("__starts", F.lit(0)))["start"]

    def replaced_in(raw: Column) -> Column:
        piece = lambda start, length: F.decode(F.substring(raw, start + 1, length), "UTF-8")
        pieces = F.transform(
            "__starts",
            lambda s, i: F.concat(
                F.lit("<"),
                F.get("__spans", s)["kind"],
                F.lit(">"),
                piece(
                    end_of(i),
                    F.coalesce(
                        F.get("__spans", F.get("__starts", i + 1))["start"], F.octet_length("__text")
                    )
                    - end_of(i),
                ),
            ),
        )
        return F.concat(piece(F.lit(0), first), F.array_join(pieces, ""))

    # Bytes bound once: read from the row they would be copied whole for every piece.
    text = F.when(F.size("__spans") == 0, F.col("__row.text")).otherwise(
        let(F.encode(F.col("__text"), "UTF-8"), replaced_in)
    )
    out = runs.select("__row", text.alias("__new"))
    replaced = {"text": F.col("__new")}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        replaced["n_chars"] = F.when(
            F.col("__new") == F.col("__row.text"), F.col("__row.n_chars")
        ).otherwise(F.length("__new").cast(kind))
    return out.select(
        *[replaced.get(name, F.col(f"__row.`{name}`")).alias(name) for name in columns]
    )


def span_text(spans: Column, only: list[str] | None = None) -> Column:
    """kind:start:end of the spans, joined by commas."""
    if only is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(only))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def score_text(spans: Column) -> Column:
    """Scores of the spans in hundredths, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
