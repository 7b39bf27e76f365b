"""Content fingerprints of records and dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_CELL = "<MISSING>"
ZERO_HASH = "0" * 64
MOST_BYTES = 2**31 - 1


def sha256_upper(text: Column) -> Column:
    return F.upper(F.sha2(text, 256))


def packed(text: Column) -> Column:
    """Text as bytes, one to one: upper-case hex, such as a hash, in half its length, any other text as it is."""
    raw = F.unhex(text)
    return F.when(F.hex(raw) == text, F.concat(F.expr("X'01'"), raw)).otherwise(F.concat(F.expr("X'00'"), text.cast("binary")))


def unpacked(data: Column) -> Column:
    """The text that ``packed`` was given."""
    rest = F.substring(data, 2, MOST_BYTES)
    return F.when(F.substring(data, 1, 1) == F.expr("X'01'"), F.hex(rest)).otherwise(rest.cast("string"))


def text_record_hash(cells: Sequence[Column]) -> Column:
    """SHA-256 of the source cells in order, joined with NUL."""
    return sha256_upper(F.concat_ws("\0", *[F.coalesce(c, F.lit(MISSING_CELL)) for c in cells]))


def _json_text(value: Column) -> Column:
    quoted = F.to_json(F.array(value))
    escaped = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    plain = F.concat(F.lit('"'), value, F.lit('"'))
    return F.when(value.rlike(r'["\\\x00-\x1f]'), escaped).otherwise(plain)


def typed_record_hash(fields: Sequence[tuple[str, str, Column]]) -> Column:
    """SHA-256 of a compact JSON list of ``[name, value]``.

    Each field is ``(name, kind, column)``; kind is ``text``, ``int`` or
    ``decimal`` (source text in plain notation, hashed as a string).
    """
    pieces = []
    for name, kind, column in fields:
        if kind == "text":
            body = _json_text(column)
        elif kind == "int":
            body = column.cast("string")
        else:
            body = F.concat(F.lit('"'), column, F.lit('"'))
        pieces.append(F.concat(F.lit(f'["{name}",'), F.coalesce(body, F.lit("null")), F.lit("]")))
    return sha256_upper(F.concat(F.lit("["), F.concat_ws(",", *pieces), F.lit("]")))


def natural_hash(kind: str, attributes: Sequence[Column]) -> Column:
    """Null-safe member hash: every attribute is tagged and length-prefixed."""
    pieces = []
    for column in attributes:
        text = column.cast("string")
        tagged = F.concat(F.lit("V"), F.octet_length(text).cast("string"), F.lit(":"), text)
        pieces.append(F.when(text.isNull(), F.lit("N;")).otherwise(tagged))
    return sha256_upper(F.concat_ws("|", F.lit(kind), *pieces))
