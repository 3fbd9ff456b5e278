"""JSON kept as text: reading, listing, promoting, re-spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
NEEDS_ESCAPE = r"[^\x00-\x7F]|\\u"
# double backslash | unicode escape | one non-ASCII character | ASCII run | lone backslash
JSON_TEXT_PIECES = r"\\\\|\\u[0-9A-Fa-f]{4}|[^\x00-\x7F]|[\x00-\x5B\x5D-\x7F]+|\\"
OBJECT_START = r"^\s*\{"
INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
# --- end of fixed values ----------------------------------------------------------


def kind(variant: Column, path: str = "$") -> Column:
    """Type name of a JSON value: STRING, BIGINT, OBJECT<..>, VOID for null, NULL if absent."""
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object. What begins like one needs no more than to be JSON; spelling
    out its kind would cost more than reading it."""
    parsed = F.try_parse_json(text)
    like_one = F.when(text.rlike(OBJECT_START), parsed.isNotNull()).otherwise(kind(parsed).startswith("OBJECT"))
    return F.coalesce(like_one, F.lit(False))


def ascii_json(text: Column) -> Column:
    """The same JSON with every non-ASCII character as a lower-case \\uXXXX escape.

    Rows that are plain ASCII already, nearly all of them, skip the work.
    """

    def piece(p: Column) -> Column:
        units = F.lower(F.hex(F.encode(p, "UTF-16BE")))
        return (
            F.when(p.rlike(r"^\\u"), F.lower(p))
            .when(F.ascii(p) < 128, p)
            .otherwise(F.regexp_replace(units, "(....)", r"\\u$1"))
        )

    pieces = F.regexp_extract_all(text, F.lit(JSON_TEXT_PIECES), F.lit(0))
    return F.when(
        text.rlike(NEEDS_ESCAPE), F.array_join(F.transform(pieces, piece), "")
    ).otherwise(text)


def compact_json(value: Column) -> Column:
    """Compact ASCII JSON text; an absent or null value becomes an empty object."""
    return F.coalesce(ascii_json(value), F.lit("{}"))


def variant_value(parsed: Column, path: str) -> Column:
    """A scalar of a parsed JSON value as text; objects, arrays and null give NULL."""
    nested = kind(parsed, path).rlike("^(OBJECT|ARRAY)")
    return F.when(~nested, F.try_variant_get(parsed, path, "string"))


def json_value(text: Column, path: str) -> Column:
    """A scalar at `path` as text; objects, arrays, null and bad JSON give NULL."""
    return variant_value(F.try_parse_json(text), path)


def json_keys(text: Column) -> Column:
    """Top-level keys of an object, null-valued ones included; NULL for anything else."""
    return F.json_object_keys(text)


def int_or_zero(text: Column) -> Column:
    """Whole number within 64 bits, else 0 (NULL, true/false, fractions, overflow)."""
    return F.coalesce(
        F.when(text.rlike(INTEGER_TEXT), F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )


def uint_or_zero(text: Column) -> Column:
    """Unsigned reading of the same text: negatives count as 0 too."""
    return F.greatest(int_or_zero(text), F.lit(0).cast("bigint"))


def safe_bool(text: Column) -> Column:
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def safe_int(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))


def safe_cast(text: Column, type_name: str | None) -> Column:
    if type_name is None:
        return text
    if type_name == "boolean":
        return safe_bool(text)
    if type_name == "bigint":
        return safe_int(text)
    return text.try_cast(type_name)
