"""Cleaning and tokenising as column expressions; no Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.stop_words import ENGLISH
from termloom.profiles import Profile

# What counts as white space. Token splitting cuts on ASCII white
# space; the deleting cleaner leaves Unicode white space and the four separator
# controls in place.
ASCII_SPACE = r"\t-\r "
ASCII_SPACE_CHARS = " \t\n\x0b\f\r"
UNICODE_SPACE = r"\s\x1c-\x1f"


def clean_space(text: Column) -> Column:
    """Lower case; every run of other characters becomes one space; trimmed.

    One pass of one pattern: white space is itself outside ``[a-z0-9]``, so
    replacing, collapsing and stripping come down to this.
    """
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def clean_delete(text: Column) -> Column:
    """Lower case; other characters are deleted, white space stays as it is."""
    return F.regexp_replace(
        F.lower(F.coalesce(text, F.lit(""))), f"(?U)[^a-z0-9{UNICODE_SPACE}]+", ""
    )


def clean(text: Column, profile: Profile) -> Column:
    """Lower-case text as the profile wants it cleaned."""
    if profile.cleaning == "space":
        return clean_space(text)
    if profile.cleaning == "delete":
        return clean_delete(text)
    if profile.cleaning == "none":
        return F.lower(text)
    raise ValueError(f"unknown cleaning {profile.cleaning!r}")


def split_words(cleaned: Column) -> Column:
    """Words of lower-case text, cut at single white space characters.

    Gives what ``pyspark.ml.feature.Tokenizer`` gives: inner and leading empty
    tokens stay, trailing ones go, "" is one empty token, blanks are none.
    """
    body = F.rtrim(cleaned, F.lit(ASCII_SPACE_CHARS))
    blank = (F.length(cleaned) > 0) & (body == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(
        F.split(body, f"[{ASCII_SPACE}]")
    )


def remove_stop_words(tokens: Column, stop_words: Iterable[str] = ENGLISH) -> Column:
    """Drop stop words; the tokens are lower case, so the list is lowered too."""
    words = sorted({word.lower() for word in stop_words})
    if not words:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(words))


def document_tokens(
    cleaned: Column, profile: Profile, stop_words: Iterable[str] = ENGLISH
) -> Column:
    """Tokens of a cleaned document, stop words removed."""
    # Space-cleaned text holds single spaces only, so a plain split will do.
    tokens = F.split(cleaned, " ") if profile.cleaning == "space" else split_words(cleaned)
    return remove_stop_words(tokens, stop_words)


def query_tokens(
    cleaned: Column, profile: Profile, stop_words: Iterable[str] = ENGLISH
) -> Column:
    """Tokens of a cleaned query.

    The deleting profile cuts queries at runs of Unicode white space and
    knows no empty tokens; the others treat queries as documents.
    """
    if profile.cleaning != "delete":
        return document_tokens(cleaned, profile, stop_words)
    words = F.split(cleaned, f"(?U)[{UNICODE_SPACE}]+")
    return F.filter(remove_stop_words(words, stop_words), lambda token: token != "")


def text_chunks(text: Column, size: int) -> Column:
    """The whole text as an array of pieces of ``size`` characters.

    A pattern match walks the text once; cutting by position would start
    over from the first character for every piece.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
