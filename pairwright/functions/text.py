"""Text expressions. Everything here stays inside the JVM.

Patterns are written once and run with Unicode character classes, so ``\\w``,
``\\b`` and ``\\s`` treat accented letters as letters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, functions as F

PLAIN_WORD = re.compile(r"[A-Za-z0-9-]+")
_TERM = re.compile(r"\w+(?: \w+)*")
MAX_LITERAL_TERMS = 10_000


def java_pattern(pattern: str, ignore_case: bool = True) -> str:
    """Prefix a pattern with the flags that give Unicode (and case-free) matching."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def literal_replacement(text: str) -> str:
    """Escape a replacement text so that ``$`` and ``\\`` stand for themselves."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def collapse_whitespace(c: Column) -> Column:
    """Turn every run of whitespace into one space; ends are not trimmed."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def words(c: Column) -> Column:
    """Lowercased ``\\w+`` tokens in order of appearance."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+"), F.lit(0))


def whitespace_tokens(c: Column) -> Column:
    """Whitespace-separated tokens; an empty or blank text has none."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\S+"), F.lit(0))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times in one expression while writing it into the plan once.

    Keys are built in layers; naming a layer's input twice would double the plan
    with every layer.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sorted_unique(tokens: Column) -> Column:
    """Distinct tokens in code-point order, joined by spaces; null when there are none."""
    return bind(
        F.sort_array(F.array_distinct(tokens)), lambda a: F.when(F.size(a) > 0, F.array_join(a, " "))
    )


def token_set_text(c: Column) -> Column:
    """The text's distinct whitespace tokens, sorted (case matters)."""
    return F.array_join(F.sort_array(F.array_distinct(whitespace_tokens(c))), " ")


def replace_pattern(c: Column, pattern: str, replacement: str = " ", ignore_case: bool = True) -> Column:
    """Replace every match of a regular expression by a literal text."""
    return F.regexp_replace(
        c, F.lit(java_pattern(pattern, ignore_case)), F.lit(literal_replacement(replacement))
    )


def word_runs(unicode_edges: bool) -> str:
    """Pattern of the maximal runs that :func:`remove_words` looks up, and of what lies between."""
    return r"(?U)[\w-]+|[^\w-]+" if unicode_edges else r"[A-Za-z0-9-]+|[^A-Za-z0-9-]+"


def remove_words(c: Column, vocabulary: Iterable[str], unicode_edges: bool = False) -> Column:
    """Replace whole vocabulary words by a space, ignoring case.

    A word counts as whole when neither neighbour is one of ``[A-Za-z0-9-]``
    (or, with ``unicode_edges``, any word character or hyphen). That is the same
    as asking whether a maximal run of such characters is in the vocabulary, so
    one linear split and a hash lookup replace a scan with a long alternation.
    """
    terms = sorted({w.lower() for w in vocabulary})
    odd = [w for w in terms if not PLAIN_WORD.fullmatch(w)]
    if odd:
        raise ValueError(f"not plain words, use a pattern rule instead: {odd[:5]}")
    if not terms:
        return c
    pieces = F.regexp_extract_all(c, F.lit(word_runs(unicode_edges)), F.lit(0))
    kept = F.transform(pieces, lambda z: F.when(F.lower(z).isin(terms), F.lit(" ")).otherwise(z))
    return F.array_join(kept, "")


def translate_terms(c: Column, dictionary: Mapping[str, str]) -> Column:
    """Replace whole dictionary terms in one pass, ignoring case, longest first.

    Replaced text is not looked at again. Terms are words, or words separated by
    single spaces. The text is cut into phrases, words and gaps; each piece is
    found (or not) by a hash lookup.
    """
    terms = {k.lower(): v for k, v in dictionary.items()}
    odd = [k for k in terms if not _TERM.fullmatch(k)]
    if odd:
        raise ValueError(f"dictionary terms must be words or space-separated words: {odd[:5]}")
    if len(terms) > MAX_LITERAL_TERMS:
        raise ValueError(f"dictionary has {len(terms)} terms, more than fit an expression: use translate_by_table")
    if not terms:
        return c
    phrases = sorted((k for k in terms if " " in k), key=len, reverse=True)
    piece = r"\w+|\W+"
    if phrases:
        piece = r"\b(?:" + "|".join(re.escape(p) for p in phrases) + r")\b|" + piece
    pieces = F.regexp_extract_all(c, F.lit(java_pattern(piece)), F.lit(0))
    pairs = [F.lit(x) for item in sorted(terms.items()) for x in item]
    table = F.create_map(*pairs)
    translated = F.transform(
        pieces,
        lambda z: F.when(F.lower(z).isin(sorted(terms)), F.element_at(table, F.lower(z))).otherwise(z),
    )
    return F.array_join(translated, "")


def extract_key(c: Column, pattern: str, group: int = 0, ignore_case: bool = True) -> Column:
    """All matches of a pattern: lowercased, distinct, sorted, joined; null without a match."""
    regex = F.lit(java_pattern(pattern, ignore_case))
    if ignore_case:
        found = F.regexp_extract_all(F.lower(c), regex, F.lit(group))
    else:
        found = F.transform(F.regexp_extract_all(c, regex, F.lit(group)), F.lower)
    return sorted_unique(found)


def map_patterns(c: Column, mapping: Iterable[tuple[str, str]]) -> Column:
    """Apply pattern replacements in order, each padded by spaces; then tidy whitespace."""
    for pattern, replacement in mapping:
        c = replace_pattern(c, pattern, f" {replacement} ")
    return F.trim(collapse_whitespace(c))


def canonical_key(c: Column, mapping: Iterable[tuple[str, str]], keep: str | None = None) -> Column:
    """Fold spelling variants of a key together, then re-extract the ``keep`` matches."""
    mapped = map_patterns(c, mapping)
    return mapped if keep is None else extract_key(mapped, keep)
