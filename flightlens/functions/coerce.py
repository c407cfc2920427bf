"""Tolerant conversion of one JSON element to a typed value.

A value that cannot be read becomes NULL; it never fails the row.  An element is read
from its ``VARIANT`` once, as its kind and its text (:func:`parts`); the rules below are
plain casts of those.  The kind keeps the difference between the number ``12.7`` and the text
``"12.7"``, which they depend on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts read as true and false.
SPI_TRUE = ("true", "1", "yes")
FLAG_TRUE = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FLAG_FALSE = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")

# Texts read as numbers.  Casts alone would also take "12.5d" and "0x1p3".
_WHOLE = r"^\s*[+-]?\d+\s*$"
_REAL = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*$"


def parts(element: Column) -> Column:
    """A ``VARIANT`` as (kind, text): STRING, BOOLEAN, VOID, BIGINT, DOUBLE, DECIMAL(p,s),
    ARRAY<...> or OBJECT<...>, and its value as text."""
    return F.struct(
        F.schema_of_variant(element).alias("kind"), F.try_variant_get(element, "$", "string").alias("text")
    )


def _is_decimal(read: Column) -> Column:
    return read["kind"].startswith("DECIMAL")


def _is_number(read: Column) -> Column:
    return read["kind"].isin("BIGINT", "DOUBLE", "FLOAT") | _is_decimal(read)


def _truth(read: Column) -> Column:
    return F.when(read["kind"] == "BOOLEAN", read["text"] == "true")


def _digits(read: Column) -> Column:
    """Text of a number, without the underscores that may group its digits."""
    text = read["text"]
    grouped = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return F.when(text.contains("_"), grouped).otherwise(text)


def _from_text(read: Column, pattern: str, as_type: str) -> Column:
    digits = _digits(read)
    return F.when(digits.rlike(pattern), F.trim(digits).try_cast(as_type))


def to_double(read: Column) -> Column:
    return (
        F.when(read["kind"] == "STRING", _from_text(read, _REAL, "double"))
        .when(_is_number(read), read["text"].try_cast("double"))
        .otherwise(_truth(read).cast("double"))
    )


def to_long(read: Column) -> Column:
    """Fractions are cut toward zero, but only for numbers: ``"12.7"`` is NULL."""
    text = read["text"]
    return (
        F.when(read["kind"] == "STRING", _from_text(read, _WHOLE, "bigint"))
        .when(read["kind"] == "BIGINT", text.try_cast("bigint"))
        .when(_is_decimal(read), F.substring_index(text, ".", 1).try_cast("bigint"))
        .when(_is_number(read), text.try_cast("double").try_cast("bigint"))
        .otherwise(_truth(read).cast("bigint"))
    )


def is_whole(read: Column) -> Column:
    """Something that :func:`to_long` reads unless it has too many digits."""
    text = (read["kind"] == "STRING") & _digits(read).rlike(_WHOLE)
    return F.coalesce(text | _is_number(read), F.lit(False))


def to_text(read: Column) -> Column:
    """Anything as text; booleans are capitalised."""
    return F.when(read["kind"] == "BOOLEAN", F.initcap(read["text"])).otherwise(read["text"])


def to_spi(read: Column) -> Column:
    """Numbers count when nonzero, texts when in :data:`SPI_TRUE`, anything else is false."""
    kind, text = read["kind"], read["text"]
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(_is_number(read), text.try_cast("double") != 0)
        .when(kind == "STRING", F.lower(text).isin(*SPI_TRUE))
        .when(kind != "VOID", F.lit(False))
    )


def to_flag(read: Column) -> Column:
    """Boolean column fed with text: :data:`FLAG_TRUE`, :data:`FLAG_FALSE`, else NULL."""
    text = F.lower(F.regexp_replace(read["text"], r"^\s+|\s+$", ""))
    found = F.when(text.isin(*FLAG_TRUE), True).when(text.isin(*FLAG_FALSE), False)
    return F.when(read["kind"] == "BOOLEAN", read["text"] == "true").otherwise(found)
