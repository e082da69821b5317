"""Similarity expressions over pairs of columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import whitespace_tokens, words


def histogram_length(hist: Column) -> Column:
    """Number of characters a histogram counts."""
    return F.aggregate(hist, F.lit(0), lambda acc, x: acc + x["n"])


def char_jaccard(left: Column, right: Column, left_len: Column, right_len: Column) -> Column:
    """Character-multiset Jaccard of two ``map<char,count>`` histograms.

    Sum of minima over sum of maxima; the latter is both lengths minus the
    former. Two empty texts are identical.
    """
    shared = F.aggregate(
        F.map_values(
            F.map_zip_with(left, right, lambda _, a, b: F.least(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))))
        ),
        F.lit(0),
        lambda acc, n: acc + n,
    )
    either = left_len + right_len - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def token_jaccard(left: Column, right: Column) -> Column:
    """Shared over combined distinct ``\\w+`` tokens; a missing value reads as the word ``nan``."""
    a = F.array_distinct(words(F.coalesce(left, F.lit("nan"))))
    b = F.array_distinct(words(F.coalesce(right, F.lit("nan"))))
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / either)


def name_tokens(c: Column) -> Column:
    """Distinct lowercased whitespace tokens, as compared by :func:`token_overlap`."""
    return F.array_distinct(whitespace_tokens(F.lower(c)))


def token_overlap(left: Column, right: Column) -> Column:
    """Shared tokens over the larger of two distinct-token arrays."""
    return F.size(F.array_intersect(left, right)) / F.greatest(F.size(left), F.size(right))


def price_gap(left: Column, right: Column) -> Column:
    """Absolute price difference; null when a side is missing."""
    return F.abs(left - right)


def relative_price_gap(left: Column, right: Column) -> Column:
    """Price difference relative to the larger price; null when undefined."""
    return F.try_divide(price_gap(left, right), F.greatest(left, right))


def same_text(left: Column, right: Column) -> Column:
    """Case-insensitive equality that treats a missing value as empty."""
    return F.coalesce(F.lower(left), F.lit("")) == F.coalesce(F.lower(right), F.lit(""))
