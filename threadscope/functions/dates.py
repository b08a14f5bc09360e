"""Lenient post-date parsing (survey §2.C3) as one native expression.

Accepted shapes (the ones the lenient parser of the reference accepts on
crawled data): ``y-M-d`` with ``-``, ``/`` or ``.`` and an optional time or
offset after ``T`` / space (the date part is taken in its own offset),
``yyyyMMdd``, ``yyyy`` (Jan 1), ``yyyy-M`` (day 1), ``M/d/yyyy`` with a
day-first fallback, and ``EEE MMM d HH:mm:ss yyyy``. ``年``/``月``/``日``
are rewritten first when both 年 and 月 occur. Anything else -> NULL
(relative words such as "now" are not resolved: the result must not depend
on the run date).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() white space (Unicode White_Space plus U+001C..U+001F).
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _d(s: Column, fmt: str) -> Column:
    return F.try_to_date(s, fmt)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body
    names it (the generated code of copied expressions would pass the JVM's
    64 KB method limit)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_date(c: Column) -> Column:
    """Return ``YYYY-MM-DD`` or NULL."""
    trimmed = F.regexp_replace(c.cast("string"), _STRIP, "")
    return _let(trimmed, lambda t0: _let(_normalised(t0), lambda t: _let(_parsed(t), _formatted)))


def _normalised(t0: Column) -> Column:
    cjk = t0.contains("年") & t0.contains("月")
    t = F.when(cjk, F.regexp_replace(F.regexp_replace(F.regexp_replace(t0, "年", "-"), "月", "-"), "日", "")) \
         .otherwise(t0)
    return F.regexp_replace(t, _STRIP, "")


def _parsed(t: Column) -> Column:
    ymd = F.translate(F.regexp_extract(t, r"^[0-9]{4}.[0-9]{1,2}.[0-9]{1,2}", 0), "/.", "--")
    return (
        F.when(t.rlike(r"^[0-9]{4}$"), _d(F.concat(t, F.lit("-1-1")), "y-M-d"))
        .when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}$"), _d(F.concat(t, F.lit("-1")), "y-M-d"))
        .when(t.rlike(r"^[0-9]{8}$"), _d(t, "yyyyMMdd"))
        .when(t.rlike(r"^[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}([ T].*)?$"), _d(ymd, "y-M-d"))
        .when(t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
              F.coalesce(_d(t, "M/d/y"), _d(t, "d/M/y")))
        .when(t.rlike(r"^[A-Z][a-z]{2} [A-Z][a-z]{2} +[0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2} [0-9]{4}$"),
              _d(F.regexp_replace(F.regexp_replace(t, "^.{4}", ""), " +", " "), "MMM d HH:mm:ss yyyy"))
    )


def _formatted(parsed: Column) -> Column:
    # The reference's parser yields nanosecond timestamps, which exist only
    # from 1677-09-21 00:12:43 to 2262-04-11 23:47:16; a date outside that
    # span does not parse there. (A time on one of those two days is
    # judged by the day alone.)
    in_range = (parsed >= F.lit("1677-09-22").cast("date")) & (parsed <= F.lit("2262-04-11").cast("date"))
    return F.when(in_range, F.date_format(parsed, "yyyy-MM-dd"))
