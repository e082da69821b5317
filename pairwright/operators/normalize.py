"""Text normalisation of product tables. Narrow projections only: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.text import (
    PLAIN_WORD,
    collapse_whitespace,
    map_patterns,
    remove_words,
    replace_pattern,
    token_set_text,
    translate_terms,
)
from ..rules import StopGroup
from .vocabulary import translate_by_table

MISSING_TEXT = "nan"


def clean_symbols(c: Column) -> Column:
    """Replace everything but word characters, whitespace and ``- , . *`` by spaces."""
    return replace_pattern(c, fixed.UNSTRUCTURED_SYMBOLS)


def remove_stop_groups(c: Column, groups: Iterable[StopGroup], unicode_edges: bool = False) -> Column:
    """Remove stop words group by group.

    Removing whole words cannot change which other words are whole, so the words
    of neighbouring groups are removed together in one pass. So are patterns that
    only list plain words.
    """
    pending: list[str] = []
    for group in groups:
        pending.extend(group.words)
        listed = [word for pattern in group.patterns for word in pattern.split("|")]
        if all(PLAIN_WORD.fullmatch(word) for word in listed):
            pending.extend(listed)
        else:
            c = remove_words(c, pending, unicode_edges)
            pending = []
            either = "|".join(group.patterns)
            inner = rf"\b(?:{either})\b" if unicode_edges else f"(?:{either})"
            c = replace_pattern(c, rf"(?<![a-zA-Z0-9-]){inner}(?![a-zA-Z0-9-])")
    return remove_words(c, pending, unicode_edges)


def normalize_units(c: Column) -> Column:
    """Write megabyte-per-second spellings as ``MB/s``; two passes, as results require."""
    for _ in range(2):
        c = map_patterns(c, fixed.SPEED_MAPPING)
    return c


def translate_and_sort(c: Column, dictionary: Mapping[str, str]) -> Column:
    """Translate dictionary terms, then reduce the text to its sorted distinct tokens."""
    return token_set_text(translate_terms(c.cast("string"), dictionary))


def normalize_unstructured(
    products: DataFrame, stop_groups: Iterable[StopGroup], text: str = "title"
) -> DataFrame:
    """Clean a free-text column. A missing text becomes the word ``nan``."""
    c = clean_symbols(F.coalesce(F.col(text).cast("string"), F.lit(MISSING_TEXT)))
    return products.withColumn(text, collapse_whitespace(remove_stop_groups(c, stop_groups)))


def normalize_structured(
    products: DataFrame, dictionary: Mapping[str, str] | DataFrame, stop_groups: Iterable[StopGroup]
) -> DataFrame:
    """Clean ``name`` and ``description``, add their concatenation as ``title``.

    ``brand`` is renamed to ``companies``, the name it has as a blocking key. A
    dictionary given as a table ``(term, replacement)`` may have any size; ids must then
    be unique.
    """
    groups = tuple(stop_groups)
    texts = ("name", "description")
    products = products.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts})
    if isinstance(dictionary, DataFrame):
        for c in texts:
            products = translate_by_table(products, c, dictionary)
        translated = {c: token_set_text(F.col(c)) for c in texts}
    else:
        translated = {c: translate_and_sort(F.col(c), dictionary) for c in texts}

    def finished(c: Column) -> Column:
        return collapse_whitespace(remove_stop_groups(c, groups, unicode_edges=True))

    return (
        products.withColumn("name", finished(translated["name"]))
        .withColumn("description", finished(normalize_units(translated["description"])))
        .withColumn("title", F.concat(F.col("name"), F.lit(" "), F.col("description")))
        .withColumnRenamed("brand", "companies")
    )
