"""Poll payloads (JSON text) to typed raw reports.

A payload is an object with a list ``states``; each element is a list whose
positions have fixed meanings.  One Spark plan parses, explodes and converts.
Nothing vanishes: a payload that cannot be read is one rejected row with its
text, and so is every bad record and every record over a given cap.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.functions import coerce
from flightlens.operators import quality
from flightlens.schema import RAW_FLIGHTS
from flightlens.settings import FIELD_POSITIONS
from flightlens.sources.raw import instant

OK, EMPTY, MALFORMED, NO_STATES = "ok", "empty_body", "malformed_json", "no_states"

_READERS = {
    "string": coerce.to_text,
    "double": coerce.to_double,
    "bigint": coerce.to_long,
    "int": coerce.to_long,
    "boolean": coerce.to_flag,
}


def read_payload_files(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Landed payload files: one payload per file, or one per line.

    Many polls packed line by line into large files scan far better than one
    small file per poll.
    """
    return (
        spark.read.format("text")
        .option("wholetext", not one_per_line)
        .load(path)
        .select("value", "_metadata.file_path", "_metadata.file_modification_time")
    )


def readable(text: Column) -> Column:
    """Bare NaN and Infinity, which some writers emit as numbers, as the texts of numbers.

    Only where such a word stands between a separator and another one outside of
    a quoted text; everything else is left as it is.  So is a text with the characters
    that mark such words meanwhile: JSON does not allow them, and it stays malformed.
    """
    bare = r'("(?:[^"\\]|\\.)*+")|(?<![\w"])(-?Infinity|NaN)(?![\w"])'
    odd = F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity"))
    return F.when(odd & ~text.rlike("[\u0001\u0002]"), _quoted(text, bare)).otherwise(text)


def _quoted(text: Column, bare: str) -> Column:
    # A quoted text is put back as it was; a bare word comes out in quotes.
    marked = F.regexp_replace(text, bare, "$1\u0001$2\u0002")
    marked = F.regexp_replace(marked, "\u0001\u0002", "")
    return F.translate(marked, "\u0001\u0002", '""')


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row.

    A filter on a plain column gets a copy of its expression for each use and is pushed down
    with it.  No filter on what a generator gives is moved below the generator.
    """
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def parse_payloads(payloads: DataFrame, text: str = "value") -> DataFrame:
    """Add ``states`` (NULL when there is nothing to load) and ``payload_status``."""
    read = with_once(payloads, "_json", F.try_parse_json(readable(F.col(text))))
    parsed = with_once(read, "states", F.try_variant_get("_json", "$.states", "array<variant>"))
    status = (
        F.when(F.coalesce(F.trim(text), F.lit("")).rlike(r"^\s*$"), EMPTY)
        .when(F.col("_json").isNull(), MALFORMED)
        .when(F.coalesce(F.size("states"), F.lit(0)) <= 0, NO_STATES)
        .otherwise(OK)
    )
    return parsed.withColumn("payload_status", status).drop("_json")


def explode_states(parsed: DataFrame, cap: int | None = None, text: str = "value") -> DataFrame:
    """One row per record (``position``, ``state``), and one per unreadable payload.

    ``payload_reason`` names what is wrong with the row before its fields are
    looked at: the payload's status (then ``record`` has its text), or
    ``over_cap`` for a record at or past ``cap``.  Empty bodies and payloads
    without records have nothing to load and give no row.

    The payload text stays behind: it would be copied onto each of its records.
    """
    others = [c for c in parsed.columns if c not in (text, "states", "payload_status")]
    unread, ok = F.col("payload_status") == MALFORMED, F.col("payload_status") == OK
    one = F.array(F.lit(None).cast("variant"))
    # Nulls in the place of the text for readable payloads, before there is a row per record.
    rows = parsed.select(
        *others,
        "states",
        "payload_status",
        F.when(unread, F.col(text)).alias("record"),
        F.when(unread, F.lit(MALFORMED)).alias("payload_reason"),
    )
    # A NULL list gives no row.
    listed = F.when(unread, one).when(ok, F.col("states"))
    kept = rows.select(*others, "record", "payload_reason", F.posexplode(listed).alias("position", "state"))
    if cap is None:
        return kept
    over = F.col("payload_reason").isNull() & (F.col("position") >= cap)
    return kept.withColumn("payload_reason", F.when(over, "over_cap").otherwise(F.col("payload_reason")))


def type_states(
    records: DataFrame, fetch_time: Column, positions: Mapping[str, int] = FIELD_POSITIONS
) -> DataFrame:
    """Raw columns plus ``reject_reasons`` (empty for a good record).

    A field that is absent, null or unreadable becomes NULL.  A record is
    rejected only when the raw table could not take it.
    """
    # Every element is read once, into its kind and text.
    read = F.transform(F.try_variant_get("state", "$", "array<variant>"), coerce.parts)
    listed = with_once(records, "_fields", read)
    elements = {name: F.get("_fields", F.lit(i)) for name, i in positions.items()}

    typed: dict[str, Column] = {}
    # Each looks at the element again only where the typed value came out NULL.
    whole_payload = F.col("payload_reason").isNotNull() if "payload_reason" in records.columns else F.lit(False)
    checks: dict[str, Column] = {"not_a_list": F.col("_fields").isNull() & ~whole_payload}
    for field in RAW_FLIGHTS:
        name, kind = field.name, field.dataType.simpleString()
        if name not in elements:
            typed[name] = F.lit(None).cast(field.dataType)
        elif name == "spi":
            typed[name] = coerce.to_spi(elements[name])
        else:
            typed[name] = _READERS[kind](elements[name]).try_cast(field.dataType)
            if kind == "boolean":
                present = coerce.to_text(elements[name]).isNotNull()
                checks[f"{name}_unreadable"] = F.col(name).isNull() & present
            elif kind in ("bigint", "int"):
                whole = coerce.is_whole(elements[name])
                checks[f"{name}_out_of_range"] = F.col(name).isNull() & whole
    rows = listed.withColumns({**typed, "fetch_time": fetch_time})
    found = quality.reasons({**checks, **quality.text_length_checks()})
    if "payload_reason" in records.columns:
        found = F.concat(F.array_compact(F.array("payload_reason")), found)
    return with_once(rows, quality.REASONS, found).drop("_fields")


def raw_from_payloads(
    payloads: DataFrame,
    fetch_time: datetime | Column,
    cap: int | None = None,
    positions: Mapping[str, int] = FIELD_POSITIONS,
) -> DataFrame:
    """Typed records of all payloads, good and bad.

    Good rows: ``accepted_rows``.  Bad ones: ``rejected_rows``.
    """
    stamp = fetch_time if isinstance(fetch_time, Column) else instant(fetch_time)
    return type_states(explode_states(parse_payloads(payloads), cap), stamp, positions)


def accepted_rows(typed: DataFrame) -> DataFrame:
    return quality.accepted(typed).select(*RAW_FLIGHTS.names)


def rejected_rows(typed: DataFrame) -> DataFrame:
    """Bad records and unreadable payloads as text, with their reasons, place and arrival."""
    place = [c for c in ("file_path", "position") if c in typed.columns]
    record = F.coalesce("record", F.to_json("state")) if "record" in typed.columns else F.to_json("state")
    return quality.rejected(typed).select("fetch_time", *place, record.alias("record"), quality.REASONS)
