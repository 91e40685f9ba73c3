"""TF-IDF and cosine arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.profiles import Profile


def idf_plain(n_docs: Column, df: Column) -> Column:
    """ln(N / df); 0 for a term every document has."""
    return F.log(n_docs / df)


def idf_smoothed(n_docs: Column, df: Column) -> Column:
    """ln((N + 1) / (df + 1)); defined for df = 0."""
    return F.log((n_docs + 1) / (df + 1))


def idf(profile: Profile, n_docs: Column, df: Column) -> Column:
    return (idf_smoothed if profile.smooth_idf else idf_plain)(n_docs, df)


def document_tf(profile: Profile, tf: Column, length: Column) -> Column:
    return tf / length if profile.length_normalized else tf.cast("double")


def share_of(weight: Column, norm: Column) -> Column:
    """A term's part of its document's vector scaled to length 1; 0 of a vector without length."""
    return F.coalesce(weight / F.nullif(norm, F.lit(0.0)), F.lit(0.0))
