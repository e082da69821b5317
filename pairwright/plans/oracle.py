"""Pieces of oracle SQL.

The oracle's regular expressions know neither lookarounds nor Unicode word
classes, so whole-word rules are rewritten as checks on maximal character runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from .. import fixed_values as fixed
from ..rules import StopGroup

SPACE = r"[\s\x{0B}\x{85}\p{Z}]"
NOT_SPACE = r"[^\s\x{0B}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}\p{M}_]"
NOT_WORD = r"[^\p{L}\p{N}\p{M}_]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words: Iterable[str]) -> str:
    return ", ".join(quoted(w) for w in words)


def replace_all(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, {quoted(pattern)}, {quoted(to)}, 'g')"


def collapse(c: str) -> str:
    return replace_all(c, SPACE + "+", " ")


def without_words(c: str, words: Iterable[str], unicode_edges: bool = False) -> str:
    run = rf"[\p{{L}}\p{{N}}\p{{M}}_-]" if unicode_edges else "[A-Za-z0-9-]"
    rest = "[^" + run[1:]
    pieces = f"regexp_extract_all({c}, {quoted(f'{run}+|{rest}+')})"
    return (
        f"array_to_string(list_transform({pieces}, lambda z: CASE WHEN lower(z) IN "
        f"({listed(sorted(set(words)))}) THEN ' ' ELSE z END), '')"
    )


def without_stop_groups(c: str, groups: Iterable[StopGroup], unicode_edges: bool = False) -> str:
    for group in groups:
        words = [*group.words, *(w for p in group.patterns for w in p.split("|"))]
        c = without_words(c, words, unicode_edges)
    return c


def clean_symbols(c: str) -> str:
    return replace_all(c, r"[^\p{L}\p{N}\p{M}\p{Pc}\s\x{0B}\x{85}\p{Z}\-,.*]", " ")


def normal_text(c: str, groups: Iterable[StopGroup]) -> str:
    return collapse(without_stop_groups(clean_symbols(f"coalesce({c}, 'nan')"), groups))


def joined_key(list_sql: str) -> str:
    return f"nullif(array_to_string(list_sort(list_distinct({list_sql})), ' '), '')"


def found_words(c: str, words: str) -> str:
    """Sorted distinct standalone words of an ``a|b|c d`` list."""
    terms = [w.lower() for w in words.split("|")]
    single = [w for w in terms if " " not in w]
    runs = f"regexp_extract_all(lower({c}), '[a-z0-9-]+')"
    pieces = [f"list_filter({runs}, lambda z: z IN ({listed(single)}))"]
    for phrase in (w for w in terms if " " in w):
        pattern = quoted(f"(?:^|[^a-z0-9-]){phrase}(?:$|[^a-z0-9-])")
        pieces.append(f"(CASE WHEN regexp_matches(lower({c}), {pattern}) THEN [{quoted(phrase)}] ELSE [] END)")
    sql = pieces[0]
    for piece in pieces[1:]:
        sql = f"list_concat({sql}, {piece})"
    return joined_key(sql)


def found_pattern(c: str, pattern: str, group: int = 0) -> str:
    return joined_key(f"regexp_extract_all(lower({c}), {quoted('(?i)' + pattern)}, {group})")


def mapped(c: str, mapping: Iterable[tuple[str, str]]) -> str:
    for pattern, to in mapping:
        c = replace_all(c, "(?i)" + pattern.replace("(?!it)", ""), f" {to} ")
    return f"trim({collapse(c)})"


def canonical(c: str, mapping: Iterable[tuple[str, str]], keep: str) -> str:
    return found_pattern(mapped(c, mapping), keep)


def translated(c: str, dictionary: Mapping[str, str]) -> str:
    terms = {k.lower(): v for k, v in dictionary.items()}
    phrases = sorted((k for k in terms if " " in k), key=len, reverse=True)
    # Whole phrases: the oracle's word boundary is ASCII, as are the phrases' edges.
    piece = "".join(rf"\b{p}\b|" for p in phrases) + f"{WORD}+|{NOT_WORD}+"
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in terms.items())
    pieces = f"regexp_extract_all({c}, {quoted('(?i)' + piece)})"
    return f"array_to_string(list_transform({pieces}, lambda z: CASE lower(z) {cases} ELSE z END), '')"


def token_set(c: str) -> str:
    tokens = f"regexp_extract_all({c}, {quoted(NOT_SPACE + '+')})"
    return f"array_to_string(list_sort(list_distinct({tokens})), ' ')"


def words(c: str) -> str:
    return f"regexp_extract_all(lower({c}), {quoted(WORD + '+')})"


# --- whole stages ---------------------------------------------------------------------


def unstructured_keys(source: str, groups: Iterable[StopGroup]) -> str:
    """Normalised laptops with their keys."""
    intel = r"(?:^|[^a-z0-9])((?:intel\s+core\s+)?i[\s\-]*[3579](?:[\s\-]*\d{4,5}[a-z]*)?)(?:$|[^a-z0-9])"
    numbers = (
        "list_transform(list_filter(regexp_extract_all(lower(title), '[a-z0-9]+'), lambda z: "
        "regexp_matches(z, '^(?:gtx|gts|gt|gx|gs)?[1-9][0-9]?[0-9]?(?:ti)?$')), lambda z: "
        "regexp_extract(z, '[1-9][0-9]*'))"
    )
    chips = canonical("chips", fixed.CHIP_MAPPING, fixed.CHIP_WORDS)
    return f"""
SELECT id, companies, product_series, {chips} AS cpu_gpu_companies, intel_cpu, nvidia_gpu, title
FROM (SELECT id, {found_words('title', fixed.LAPTOP_MAKERS)} AS companies,
             {found_words('title', fixed.LAPTOP_SERIES)} AS product_series,
             {found_words('title', fixed.CHIP_WORDS)} AS chips,
             {found_pattern('title', intel, 1)} AS intel_cpu,
             {joined_key(numbers)} AS nvidia_gpu, title
      FROM (SELECT id, {normal_text('title', groups)} AS title FROM ({source})))"""


def structured_products(source: str, dictionary: Mapping[str, str], groups: Iterable[StopGroup]) -> str:
    groups = tuple(groups)

    def tidy(c: str) -> str:
        return token_set(translated(f"coalesce({c}, '')", dictionary))

    units = mapped(mapped(tidy("description"), fixed.SPEED_MAPPING), fixed.SPEED_MAPPING)
    return f"""
SELECT *, name || ' ' || description AS title FROM (
  SELECT id, {collapse(without_stop_groups(tidy('name'), groups, True))} AS name, price, brand AS companies,
         {collapse(without_stop_groups(units, groups, True))} AS description FROM ({source}))"""


def structured_keys(source: str, dictionary: Mapping[str, str], groups: Iterable[StopGroup]) -> str:
    def bounded(pattern: str) -> str:
        return found_pattern("title", rf"\b({pattern})\b", 1)

    makers = f"coalesce(companies, '') || ' ' || coalesce({bounded(fixed.STORAGE_MAKER_WORDS)}, '')"
    once = canonical(bounded(fixed.FORMAT_WORDS), fixed.FORMAT_MAPPING, fixed.FORMAT_WORDS)
    return f"""
SELECT id, {canonical(makers, fixed.STORAGE_MAKER_MAPPING, fixed.STORAGE_MAKER_WORDS)} AS companies,
       {canonical(once, fixed.FORMAT_MAPPING, fixed.FORMAT_WORDS)} AS format,
       {canonical(bounded(fixed.CAPACITY), fixed.CAPACITY_MAPPING, fixed.CAPACITY)} AS capacity,
       {bounded(fixed.STORAGE_SERIES)} AS product_series, name, price, description, title
FROM ({structured_products(source, dictionary, groups)})"""


def matches(source: str, keys: Iterable[str], text: str, min_score: str) -> str:
    """CTEs up to ``edges(lid, rid, score)``: copies to their first record, then similar representatives.

    ``min_score`` may use ``block_rows``. Every pair of a block is compared.
    """
    block = ", ".join(keys)
    same_block = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return f"""
rows_in AS MATERIALIZED (SELECT id, {block}, coalesce({text}, '') AS txt FROM ({source})),
chars AS MATERIALIZED (SELECT id, c, count(*) AS n FROM (
            SELECT id, unnest(string_split(lower(txt), '')) AS c FROM rows_in) WHERE c <> '' GROUP BY id, c),
hists AS (SELECT id, string_agg(c || n, ',' ORDER BY c) AS hist, sum(n) AS len FROM chars GROUP BY id),
blocked AS (SELECT r.id, {block}, coalesce(hist, '') AS hist, coalesce(len, 0) AS len,
                   count(*) OVER (PARTITION BY {block}) AS block_rows
            FROM rows_in r LEFT JOIN hists h ON r.id = h.id),
named AS MATERIALIZED (SELECT *, min(id) OVER (PARTITION BY {block}, hist) AS rep FROM blocked),
near AS MATERIALIZED (
  SELECT a.id AS lid, b.id AS rid, a.len + b.len AS total, a.block_rows AS block_rows
  FROM named a JOIN named b ON {same_block} AND a.id < b.id
  WHERE a.id = a.rep AND b.id = b.rep AND least(a.len, b.len) >= 0.8 * greatest(a.len, b.len)),
shared AS (SELECT lid, rid, sum(least(x.n, y.n)) AS common, any_value(total) AS total,
                  any_value(block_rows) AS block_rows
           FROM near JOIN chars x ON x.id = lid JOIN chars y ON y.id = rid AND y.c = x.c GROUP BY lid, rid),
edges AS (SELECT rep AS lid, id AS rid, CAST(1.0 AS DOUBLE) AS score FROM named WHERE rep <> id
          UNION ALL
          SELECT lid, rid, CAST(common AS DOUBLE) / (total - common) FROM shared
          WHERE CAST(common AS DOUBLE) / (total - common) >= {min_score})"""


def closed(edges: str, name: str) -> str:
    """CTE ``name(id, cluster_id)``: smallest reachable id. Needs WITH RECURSIVE."""
    return f"""
{name}_both AS (SELECT lid AS a, rid AS b FROM {edges} WHERE lid <> rid
                UNION SELECT rid, lid FROM {edges} WHERE lid <> rid),
{name}_walk AS (SELECT a AS id, a AS seen FROM {name}_both
                UNION SELECT w.id, e.b FROM {name}_walk w JOIN {name}_both e ON e.a = w.seen),
{name} AS (SELECT id, min(seen) AS cluster_id FROM {name}_walk GROUP BY id)"""
