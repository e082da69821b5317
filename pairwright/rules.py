"""Vocabularies as data.

Stop words and dictionaries belong to whoever runs the job. They are passed in
as Python values or read from small tables:

* ``rules(kind string, ordinal int, pattern string, is_word boolean)``
* ``dictionary(term string, replacement string)``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .functions.text import MAX_LITERAL_TERMS

MAX_RULES = 10_000


@dataclass(frozen=True)
class StopGroup:
    """One step of text cleaning: whole words to remove, and patterns to remove."""

    words: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()

    @classmethod
    def plural(cls, *words: str) -> "StopGroup":
        """Words that are removed with or without a trailing ``s``."""
        return cls(tuple(form for w in words for form in (w, w + "s")))


def _bounded_rows(table: DataFrame, limit: int, what: str) -> list:
    rows = table.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} table has more than {limit} rows: join it, see operators.vocabulary")
    return rows


def stop_groups_from_table(rules: DataFrame, kind: str) -> tuple[StopGroup, ...]:
    """Read the stop groups of one kind, in ordinal order. Errors beyond ``MAX_RULES`` rows."""
    chosen = rules.where(rules["kind"] == kind).select("ordinal", "pattern", "is_word")
    groups: dict[int, tuple[list[str], list[str]]] = {}
    for row in _bounded_rows(chosen, MAX_RULES, "rules"):
        words, patterns = groups.setdefault(row["ordinal"], ([], []))
        (words if row["is_word"] else patterns).append(row["pattern"])
    return tuple(StopGroup(tuple(w), tuple(p)) for _, (w, p) in sorted(groups.items()))


def dictionary_from_table(dictionary: DataFrame) -> dict[str, str]:
    """Read a translation dictionary. Errors beyond the size an expression may hold.

    :func:`..operators.vocabulary.translate_by_table` takes a table of any size as it is.
    """
    rows = _bounded_rows(dictionary.select("term", "replacement"), MAX_LITERAL_TERMS, "dictionary")
    return {row["term"]: row["replacement"] for row in rows}
