"""Blocking keys: short strings taken from the text. Narrow projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.text import bind, canonical_key, extract_key, java_pattern

UNSTRUCTURED_KEYS = ("companies", "cpu_gpu_companies", "intel_cpu", "nvidia_gpu")
STRUCTURED_KEYS = ("companies", "format", "capacity", "product_series")


def standalone(words: str) -> str:
    """Pattern for words not touching ``[a-zA-Z0-9-]`` on either side; the word is group 1."""
    return rf"(?<![a-zA-Z0-9-])({words})(?![a-zA-Z0-9-])"


def bounded(words: str) -> str:
    """Pattern for words between word boundaries; the word is group 1."""
    return rf"\b({words})\b"


def insert_key(products: DataFrame, name: str, key: Column, position: int) -> DataFrame:
    """Add a key as a new column at the given position."""
    columns = products.columns
    return products.withColumn(name, key).select(*columns[:position], name, *columns[position:])


def chip_maker_key(text: Column) -> Column:
    """Processor and graphics makers, product lines folded to their makers."""
    found = extract_key(text, standalone(fixed.CHIP_WORDS), 1)
    return canonical_key(found, fixed.CHIP_MAPPING, fixed.CHIP_WORDS)


def storage_maker_key(brand: Column, text: Column) -> Column:
    """Makers named in the brand field or the text, product lines folded to their makers; null if none."""
    in_text = extract_key(text, bounded(fixed.STORAGE_MAKER_WORDS), 1)
    both = F.concat(F.coalesce(brand, F.lit("")), F.lit(" "), F.coalesce(in_text, F.lit("")))
    return canonical_key(both, fixed.STORAGE_MAKER_MAPPING, fixed.STORAGE_MAKER_WORDS)


def format_key(text: Column) -> Column:
    """Storage formats, folded twice with the micro-card correction in between."""
    once = canonical_key(
        extract_key(text, bounded(fixed.FORMAT_WORDS), 1), fixed.FORMAT_MAPPING, fixed.FORMAT_WORDS
    )
    corrected = bind(
        once,
        lambda c: F.when(F.contains(c, F.lit("microsd")), F.replace(c, F.lit("sd"), F.lit(""))).otherwise(c),
    )
    return canonical_key(corrected, fixed.FORMAT_MAPPING, fixed.FORMAT_WORDS)


def capacity_key(text: Column, strict: bool = True) -> Column:
    """Capacities as number and unit.

    ``strict`` reproduces the established mapping, which looks for a digit
    anywhere in front of the unit and therefore reads ``32GB`` as ``2 gb``.
    Without it the number is kept whole.
    """
    found = extract_key(text, bounded(fixed.CAPACITY), 1)
    if strict:
        return canonical_key(found, fixed.CAPACITY_MAPPING, fixed.CAPACITY)
    whole = tuple((rf"(?<![\d.]){pattern}", to) for pattern, to in fixed.CAPACITY_MAPPING)
    return canonical_key(found, whole, rf"(?<![\d.]){fixed.CAPACITY}")


def baseline_key(text: Column) -> Column:
    """Word-and-model matches, sorted before lowercasing and not deduplicated; '' without one."""
    found = F.regexp_extract_all(
        F.coalesce(text.cast("string"), F.lit("nan")),
        F.lit(java_pattern(fixed.BASELINE_KEY, ignore_case=False)),
        F.lit(0),
    )
    return F.lower(F.array_join(F.sort_array(found), " "))


def add_unstructured_keys(products: DataFrame, text: str = "title") -> DataFrame:
    """Insert the five keys of free-text products behind the id."""
    c = F.col(text)
    keyed = insert_key(products, "companies", extract_key(c, standalone(fixed.LAPTOP_MAKERS), 1), 1)
    keyed = insert_key(keyed, "product_series", extract_key(c, standalone(fixed.LAPTOP_SERIES), 1), 2)
    keyed = insert_key(keyed, "cpu_gpu_companies", chip_maker_key(c), 3)
    keyed = insert_key(keyed, "intel_cpu", extract_key(c, fixed.INTEL_CPU, 0), 4)
    return insert_key(keyed, "nvidia_gpu", extract_key(c, fixed.NVIDIA_GPU, 1), 5)


def add_structured_keys(products: DataFrame, text: str = "title", strict: bool = True) -> DataFrame:
    """Put the four keys of structured products behind the id; ``companies`` is merged in place."""
    c = F.col(text)
    others = [x for x in products.columns if x not in ("id", "companies")]
    return products.select(
        "id",
        storage_maker_key(F.col("companies"), c).alias("companies"),
        format_key(c).alias("format"),
        capacity_key(c, strict).alias("capacity"),
        extract_key(c, bounded(fixed.STORAGE_SERIES), 1).alias("product_series"),
        *others,
    )
