"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

Everything is a column expression, so the work stays in the scan of the texts.

Defined results: a missing or empty text has no spans; equal rows get equal spans;
spans of different kinds may overlap; a span is given in code points, end
exclusive. Columns of the input are untouched (``redact`` replaces the text).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import whole

# The patterns decide what a span is. Where the same matches can be found without trying
# every place of a long run, the run is consumed at once: `++` never gives back, and a
# match begins at the start of a run or where the previous match ended (`\G`).
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# Runs of fewer than 14 digits would be dropped by the check; longer ones are taken whole.
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
# Hexadecimal digests of one case, and access key ids.
SECRET = r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}+|[0-9A-F]{32,64}+|AKIA[0-9A-Z]{16}+)(?![A-Za-z0-9])"

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IBAN_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(place % 2 == 1, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(places, F.lit(0), lambda acc, place: acc + value(place))
    return (F.length(digits) > 0) & (total % 10 == 0)


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes the mod-97 check (letters count from 10)."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def value(acc: Column, place: Column) -> Column:
        sign = F.substring(turned, place, F.lit(1))
        letter = F.instr(F.lit(_IBAN_LETTERS), sign)
        return F.when(letter > 0, (acc * 100 + letter + 9) % 97).otherwise((acc * 10 + sign.cast("int")) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), value)
    return F.length(account).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: pattern, validator, words that make it likelier nearby, base score.

    ``hint`` is a cheap necessary condition; texts without it are not searched.
    """

    name: str
    pattern: str
    valid: object
    words: str
    base: float
    hint: str


def _ip_valid(match: Column) -> Column:
    return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def _card_valid(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(14, 19) & luhn(digits)


def _phone_valid(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _iban_valid(match: Column) -> Column:
    return mod97(F.regexp_replace(match, "\\x20", ""))


def _secret_valid(match: Column) -> Column:
    """Digits and letters both; hexadecimal words and plain numbers are no secrets."""
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]")


# Kinds in the order in which spans with the same start are listed.
BASE_KINDS = (
    Kind("email", EMAIL, lambda m: F.lit(True), "mail|contact|write|address|kontakt|correo", 0.9, "@"),
    Kind("ip", IP, _ip_valid, "ip|host|server|address|login|client", 0.6, "."),
    Kind("card", CARD, _card_valid, "card|visa|credit|payment|karte|tarjeta|carte", 0.8, ""),
    Kind("phone", PHONE, _phone_valid, "call|phone|tel|mobile|fax|telefon", 0.7, "+"),
)
KINDS = (
    *BASE_KINDS,
    Kind("iban", IBAN, _iban_valid, "iban|account|bank|konto|cuenta|compte", 0.9, ""),
    Kind("secret", SECRET, _secret_valid, "token|secret|key|password|passwort|auth", 0.5, ""),
)
CONTEXT_CHARS = 40
LIKELY = 0.75


def _spans(text: str, rank: int, kind: Kind) -> Column:
    """Validated matches of one kind: the text is cut at the matches and lengths are added up."""
    column = F.col(text)
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(column, pattern, F.lit(0))
    between = F.split(column, kind.pattern, -1)
    span = "struct<rank:int,start:int,end:int,score:double>"

    def context(start: Column) -> Column:
        before = F.substring(column, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS)))
        return F.when(before.rlike(rf"(?i)\b(?:{kind.words})"), (F.lit(1.0) + kind.base) / 2).otherwise(F.lit(kind.base))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["place"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        score = F.when(kind.valid(pair["match"]), context(start))
        return F.struct(
            end.alias("place"),
            F.when(
                score.isNotNull(),
                F.concat(
                    acc["spans"],
                    F.array(F.struct(F.lit(rank).alias("rank"), start.alias("start"), end.alias("end"), score.alias("score"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    pairs = F.zip_with(
        found, F.slice(between, 1, F.size(found)), lambda match, gap: F.struct(match.alias("match"), gap.alias("gap"))
    )
    none = F.array().cast(f"array<{span}>")
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("place"), none.alias("spans")), step, lambda acc: acc["spans"])
    hinted = F.contains(column, F.lit(kind.hint)) if kind.hint else F.lit(True)
    return F.when(hinted & column.rlike(kind.pattern), walked).otherwise(none)


def find_spans(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS, into: str = "spans") -> DataFrame:
    """Add ``array<struct<rank, start, end, score>>``: validated spans by start, then kind as listed."""
    work = "_pii_text"
    found = [_spans(work, rank, kind) for rank, kind in enumerate(kinds)]
    names = [f"_pii_{kind.name}" for kind in kinds]
    joined = F.concat(*names)
    ordered = F.when(
        F.size(joined) > 1,
        F.transform(
            F.array_sort(F.transform(joined, lambda s: F.struct(s["start"], s["rank"], s["end"], s["score"]))),
            lambda s: F.struct(s["rank"], s["start"], s["end"], s["score"]),
        ),
    ).otherwise(joined)
    staged = docs.withColumn(work, whole(text)).withColumns(dict(zip(names, found)))
    return staged.withColumn(into, ordered).drop(work, *names)


def spans_text(spans: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(kind.name) for kind in kinds])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS, min_score: float = 0.0) -> DataFrame:
    """Replace every span of at least ``min_score`` by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first. All
    columns keep their names; a missing text stays missing.
    """
    names = F.array(*[F.lit(f"<{kind.name.upper()}>") for kind in kinds])
    column = F.col(text)

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(column, acc["place"] + 1, F.greatest(s["start"] - acc["place"], F.lit(0)))
        fresh = s["start"] >= acc["place"]
        return F.struct(
            F.greatest(acc["place"], s["end"]).alias("place"),
            F.when(fresh, F.concat(acc["parts"], F.array(kept, F.element_at(names, s["rank"] + 1))))
            .otherwise(acc["parts"])
            .alias("parts"),
        )

    start = F.struct(F.lit(0).alias("place"), F.array().cast("array<string>").alias("parts"))
    pieces = F.aggregate(
        F.filter("_redact_spans", lambda s: s["score"] >= min_score),
        start,
        step,
        lambda acc: F.concat(
            F.array_join(acc["parts"], ""), F.substring(column, acc["place"] + 1, F.length(column))
        ),
    )
    replaced = F.when(F.size("_redact_spans") > 0, pieces).otherwise(column)
    return find_spans(docs, text, kinds, "_redact_spans").withColumn(text, replaced).drop("_redact_spans")


def digest(docs: DataFrame) -> DataFrame:
    """Counts, joined spans and their scores per document, as the registered query reports them.

    ``n_spans`` counts spans of all kinds, ``n_likely`` those whose context makes them
    at least as likely as ``LIKELY``; ``scores`` stand in the order of ``spans``.
    """
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))

    def number(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [number(rank).alias(f"n_{kind.name}") for rank, kind in enumerate(BASE_KINDS)]
    likely = F.size(F.filter("spans", lambda s: s["score"] >= LIKELY)).cast("long")
    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",")
    return find_spans(docs).select(
        "doc_id",
        *counts,
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        likely.alias("n_likely"),
        scores.alias("scores"),
    )
