"""Reaction-count columns: SQLite integer casting and the PTT repair rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SQLite's CAST(x AS INTEGER) on text: skip leading ASCII white space, read
# an optional sign and the digits that follow; text without such a prefix
# becomes 0, NULL stays NULL.
_LEADING_INT = r"^[ \t\n\x0B\f\r]*([+-]?[0-9]+)"


def sqlite_integer(c: Column) -> Column:
    """``CAST(c AS INTEGER)`` with SQLite semantics: text -> its leading
    integer (clamped to the 64-bit range, as SQLite does) or 0."""
    s = c.cast("string")
    lead = F.regexp_extract(s, _LEADING_INT, 1)
    clamped = (F.when(lead == "", F.lit(0))
               .when(lead.startswith("-"), F.lit(-(1 << 63)))
               .otherwise(F.lit((1 << 63) - 1))).cast("bigint")
    return F.when(s.isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce(lead.try_cast("bigint"), clamped))


def vote_total(like: Column, unlike: Column) -> Column:
    """``like - unlike`` with an absent side counted as 0."""
    return F.coalesce(like, F.lit(0)).cast("bigint") - F.coalesce(unlike, F.lit(0)).cast("bigint")


def repair_total_reac(raw: Column, like: Column, unlike: Column,
                      raw_is_string: Column | None = None) -> Column:
    """PTT ``total_reac`` repair, returned as a string column.

    Empty / NULL -> 0; the strings ``爆``, ``X...`` and ``-*digits`` -> like -
    unlike (absent counts as 0); integers and any other string unchanged.
    ``raw_is_string`` tells a JSON string from a JSON number (``"12"`` is
    repaired, ``12`` is kept); by default every value counts as a string.
    """
    s = raw.cast("string")
    is_str = F.lit(True) if raw_is_string is None else raw_is_string
    repaired = vote_total(like, unlike).cast("string")
    return (F.when(s.isNull() | (is_str & (s == "")), F.lit("0"))
            .when(is_str & ((s == "爆") | s.startswith("X") | s.rlike(r"^-*[0-9]+$")), repaired)
            .otherwise(s))
