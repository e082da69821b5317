"""Dictionaries and stop words of any size, as tables.

Which terms occur at all is found by a join: each text's words (and runs of as many words
as some term has) meet the term table, counted down to distinct ones first. If few terms
occur, they become an expression, and texts stay where they are. Otherwise each text is
joined with the terms found in it, and its own alternation is built from those alone. Both
give what the expression over the whole vocabulary would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import MAX_LITERAL_TERMS, remove_words, translate_terms, word_runs
from ..session import materialize
from .tiles import checked_broadcast

_TERM_PATTERN = r"(?U)^\w+( \w+)*$"
_PIECES = r"(?U)\w+|\W+"


def _runs(c: Column, lengths: Sequence[int]) -> Column:
    """Distinct lowercased runs of so many words that are parted by single characters or gaps."""

    def of_size(pieces: Column, size: int) -> Column:
        starts = F.when(F.size(pieces) >= size, F.sequence(F.lit(1), F.size(pieces) - size + 1))
        none = F.array().cast("array<int>")
        return F.transform(F.coalesce(starts, none), lambda i: F.array_join(F.slice(pieces, i, size), ""))

    def of(pieces: Column) -> Column:
        return F.array_distinct(F.concat(*[of_size(pieces, 2 * n - 1) for n in lengths]))

    pieces = F.regexp_extract_all(F.lower(c), F.lit(_PIECES), F.lit(0))
    return F.get(F.transform(F.array(pieces), of), F.lit(0))


def _met(rows: DataFrame, text: str, candidates: Column, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, term)`` candidates of every text, and the terms that occur in any."""
    single = rows.where(F.col(text).isNotNull()).select("id", F.explode(candidates).alias("term"))
    return single, materialize(single.select("term").distinct().join(terms, "term"))


def _joined(rows: DataFrame, single: DataFrame, relevant: DataFrame) -> DataFrame:
    """Rows with ``_found``, a map of the terms in the row's text; null without any."""
    entries = F.map_from_entries(F.collect_list(F.struct("term", "replacement")))
    found = single.join(checked_broadcast(relevant), "term").groupBy("id").agg(entries.alias("_found"))
    return rows.join(found, "id", "left")


def _applied(
    rows: DataFrame,
    text: str,
    candidates: Column,
    terms: DataFrame,
    literal: Callable[[Mapping[str, str]], Column],
    by_row: Column,
    literal_terms: int,
) -> DataFrame:
    single, relevant = _met(rows, text, candidates, terms)
    if relevant.count() <= literal_terms:
        return rows.withColumn(text, literal({r.term: r.replacement for r in relevant.collect()}))
    joined = _joined(rows, single, relevant)
    replaced = F.when(F.col("_found").isNull(), F.col(text)).otherwise(by_row)
    return joined.withColumn(text, replaced).select(*rows.columns)


def translate_by_table(
    rows: DataFrame, text: str, dictionary: DataFrame, literal_terms: int = MAX_LITERAL_TERMS
) -> DataFrame:
    """:func:`translate_terms` of a column by a table ``(term, replacement)`` of any size.

    Rows need a unique ``id``. Of a term that is listed twice the greater replacement counts.
    """
    odd = dictionary.where(~F.col("term").rlike(_TERM_PATTERN)).limit(5).collect()
    if odd:
        raise ValueError(f"dictionary terms must be words or space-separated words: {[r.term for r in odd]}")
    terms = dictionary.groupBy(F.lower("term").alias("term")).agg(F.max("replacement").alias("replacement"))
    terms = materialize(terms.where("term is not null and replacement is not null"))
    counted = terms.select(F.size(F.split("term", " ")).alias("n")).distinct().collect()
    lengths = sorted(r.n for r in counted)
    if not lengths:
        return rows
    phrases = F.filter(F.map_keys("_found"), lambda t: F.contains(t, F.lit(" ")))
    longest_first = F.transform(
        F.array_sort(F.transform(phrases, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda x: x["t"]
    )
    either = F.concat(F.lit(r"(?iU)\b(?:"), F.array_join(longest_first, "|"), F.lit(r")\b|\w+|\W+"))
    pattern = F.when(F.size(phrases) > 0, either).otherwise(F.lit(_PIECES))
    pieces = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    by_row = F.array_join(F.transform(pieces, lambda z: F.coalesce(F.element_at("_found", F.lower(z)), z)), "")
    return _applied(
        rows, text, _runs(F.col(text), lengths), terms, lambda d: translate_terms(F.col(text), d), by_row, literal_terms
    )


def remove_words_by_table(
    rows: DataFrame, text: str, words: DataFrame, unicode_edges: bool = False, literal_terms: int = MAX_LITERAL_TERMS
) -> DataFrame:
    """:func:`remove_words` of a column by a table ``(word)`` of any size. Rows need a unique ``id``."""
    terms = words.select(F.lower("word").alias("term"), F.lit(" ").alias("replacement")).where("term is not null").distinct()
    pattern = F.lit(word_runs(unicode_edges))
    pieces = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    by_row = F.array_join(F.transform(pieces, lambda z: F.coalesce(F.element_at("_found", F.lower(z)), z)), "")
    candidates = F.array_distinct(F.transform(pieces, F.lower))
    return _applied(
        rows, text, candidates, materialize(terms), lambda d: remove_words(F.col(text), d, unicode_edges), by_row, literal_terms
    )
