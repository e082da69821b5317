"""The driver's tables seen as products, documents and known pairs.

``part`` holds no product texts, so they are derived from it: makers, series and
specifications are picked by part key. Each expression is written once and
rendered for Spark and for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..rules import StopGroup
from ..session import materialize

# Vocabularies for the registered queries: small, and made for these tables.
DOCUMENT_STOP_GROUPS = (
    StopGroup(("the", "and", "of", "to", "in", "is", "for", "by")),
    StopGroup.plural("de", "la", "le", "un", "el"),
    StopGroup(patterns=("der|die|das", "und", "nicht")),
    StopGroup(("que", "los", "et")),
)
PRODUCT_STOP_GROUPS = (
    StopGroup(("with", "new", "the")),
    StopGroup.plural("inch", "laptop", "screen"),
)
STORAGE_STOP_GROUPS = (StopGroup(("with", "for", "the", "fast")), StopGroup(("up", "original")))
DICTIONARY = {
    "carte memoire": "memory card",
    "merkplatte": "memory card",
    "lamina": "card",
    "recuerdo": "memory",
    "flink": "fast",
    "rapide": "fast",
    "karmin": "red",
    "neu": "new",
    "bolt": "screw",
    "ring": "",
    "32gib": "32GB",
    "64gib": "64GB",
    "eight": "8GB",
    "sixteen": "16GB",
}
DOCUMENT_DICTIONARY = {
    "que des": "whose",
    "le": "the",
    "la": "the",
    "der": "the",
    "für": "for",
    "en": "in",
    "de": "of",
    "un": "a",
    "que": "",
}

_MAKERS = ("Lenovo", "HP", "dell", "ASUS", "Packard Bell", "Acer HP", "no-name", "Apple")
_SERIES = ("ThinkPad", "Surface Pro", "Envy", "galaxy book", "Blade-X", "XPS")
_CHIPS = (
    "Intel Core i5-8250U",
    "intel core i7",
    "AMD Radeon",
    "Celeron (R)",
    "Nvidia GeForce GTX 960 ti",
    "Xeon",
    "",
    "atom i3",
    "gtx1050 i9",
)
_BRANDS = ("SanDisk", "Kingston", "lexar", "Samsung", "Western Digital", "Toshiba", "Unknown")
_LINES = ("Ultra", "DataTraveler", "evo", "Pendrive", "plain", "Exceria")
_SIZES = ("32GB", "16 GB", "64gib", "128 Gigabytes", "1 TB", "eight", "512.0 GB", "none")
_PHRASES = (
    "USB 3.0 Stick with 90MB/s",
    "microSDHC Merkplatte class 10 flink",
    "carte memoire SDXC rapide 45 mbyte per second",
    "SSD neu for the lamina",
    "CF Express up to 100 Mb / sec",
    "original recuerdo USB type-c sixteen",
)


def _pick(words: tuple[str, ...], index: str, duck: bool) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    place = f"CAST(({index}) % {len(words)} AS INT) + 1"
    return f"list_extract([{listed}], {place})" if duck else f"element_at(array({listed}), {place})"


def laptop_columns(duck: bool) -> list[str]:
    """``id, title`` with four fifths of all specifications repeated by many parts."""
    k = "(p_partkey % 40)"
    title = (
        f"concat_ws(' ', {_pick(_MAKERS, f'{k} * 3', duck)}, {_pick(_SERIES, f'{k} * 5 + 1', duck)}, p_name, "
        f"'Laptop,', {_pick(_CHIPS, f'{k} * 7 + 2', duck)}, CAST(10 + {k} % 6 AS STRING), 'inches (new)', "
        "lower(p_type) || '!')"
    )
    return ["p_partkey AS id", f"CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE {title} END AS title"]


def storage_columns(duck: bool) -> list[str]:
    """``id, name, price, brand, description`` with missing values in every field but the id."""
    k = "(p_partkey % 30)"
    name = (
        f"concat_ws(' ', {_pick(_BRANDS, k, duck)}, {_pick(_LINES, f'{k} * 5', duck)}, p_name, "
        f"{_pick(_SIZES, f'{k} * 3 + 1', duck)})"
    )
    return [
        "p_partkey AS id",
        f"CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE {name} END AS name",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS price",
        f"CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE {_pick(_BRANDS, k, duck)} END AS brand",
        f"CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE {_pick(_PHRASES, f'{k} * 7 + 3', duck)} END AS description",
    ]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A driver table, narrowed to the given columns before anything moves."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return scan.select(*columns) if columns else scan


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as it is, under product column names."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_retailprice AS price", "p_brand AS brand", "p_type AS description"
    )


def laptops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type").selectExpr(*laptop_columns(False))


def storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("p_partkey", "p_name", "p_retailprice")
    return table(spark, sf_dir, "part", *columns).selectExpr(*storage_columns(False))


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``documents`` as ``id, title`` plus the columns asked for."""
    chosen = table(spark, sf_dir, "documents", "doc_id", "text", *extra)
    return chosen.select(F.col("doc_id").alias("id"), F.col("text").alias("title"), *extra)


def star_pairs(rows: DataFrame, *group: str) -> DataFrame:
    """One pair ``(id, smallest id)`` per further member of each group: linear, not all pairs."""
    first = rows.groupBy(*group).agg(F.min("id").alias("rid"))
    return rows.join(first, list(group)).where("id <> rid").select(F.col("id").alias("lid"), "rid")


def known_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents equal but for case and whitespace; grouped by a digest, not by whole texts.

    The digests are written, so that grouping and joining read the texts once.
    """
    text = F.trim(F.regexp_replace(F.lower("title"), r"\s+", " "))
    keyed = documents(spark, sf_dir).select("id", F.sha2(text, 256).alias("digest"))
    return star_pairs(materialize(keyed), "digest")


def reported_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crude matcher to be evaluated: documents of one language and length."""
    rows = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars").withColumnRenamed("doc_id", "id")
    return star_pairs(rows, "lang", "n_chars")


LAPTOPS_SQL = f"SELECT {', '.join(laptop_columns(True))} FROM part"
STORAGE_SQL = f"SELECT {', '.join(storage_columns(True))} FROM part"
PART_SQL = (
    "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, p_brand AS brand, "
    "p_type AS description FROM part"
)
KNOWN_SQL = r"""
SELECT id AS lid, rid FROM (
  SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS rid
  FROM documents) WHERE id <> rid"""
REPORTED_SQL = """
SELECT id AS lid, rid FROM (
  SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY lang, n_chars) AS rid FROM documents) WHERE id <> rid"""
