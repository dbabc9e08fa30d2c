"""Date normalization to ISO text.

The output keeps the source's offset, so it stays a string; a timestamp would lose it.
The usual numeric and English shapes are recognised by JVM expressions. What they leave
open goes, Arrow-batched, to a flexible parser; all other rows cross as null.
"""

from __future__ import annotations

import re
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from recordmill.functions.strings import let, or_blank, stripped

# English month names as date prose writes them.
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3,
    "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6, "jul": 7, "july": 7,
    "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
TIME_HINT = r"[0-9]{1,2}:[0-9]{2}"
# A full date has two numbers or one of six digits and more; anything less stays partial.
_MAY_BE_FULL = r"[0-9][^0-9]+[0-9]|[0-9]{6}"

# Parts the pieces of a recognised date; no date text holds it.
_MARK = "\x01"
_YEAR = r"([1-9][0-9]{3})"
_MONTH, _DAY = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12][0-9]|3[01])"
_CLOCK = (
    r"([0-9]|[01][0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9])(?:\.([0-9]+))?)?"
    r"(?: ?(Z|[+-](?:0[0-9]|1[0-4]):?[0-5][0-9]))?"
)
_MAYBE_CLOCK = rf"(?: {_CLOCK})?\z"
# Each shape, and the groups that hold year, month and day; the clock's five groups follow
# the date's. Month comes first unless the first number cannot be a month.
_SHAPES = [
    (rf"^{_YEAR}([-/]){_MONTH}\2{_DAY}(?:[T ]{_CLOCK})?\z", (1, 3, 4), 5),
    (rf"^{_MONTH}([-/.]){_DAY}\2{_YEAR}{_MAYBE_CLOCK}", (4, 1, 3), 5),
    (rf"^(1[3-9]|2[0-9]|3[01])([-/.]){_MONTH}\2{_YEAR}{_MAYBE_CLOCK}", (4, 3, 1), 5),
    (rf"^{_YEAR}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])()()()()()\z", (1, 2, 3), 4),
    (rf"^{_DAY} ([A-Za-z]+)\.? {_YEAR}{_MAYBE_CLOCK}", (3, 2, 1), 4),
    (rf"^([A-Za-z]+)\.? {_DAY},? {_YEAR}{_MAYBE_CLOCK}", (3, 1, 2), 4),
]

_DATE_TYPE = pa.struct([("value", pa.string()), ("error", pa.string())])


def date_pieces(c: Column) -> Column:
    """Year, month, day and clock parts with marks between; other text only stripped."""
    s = stripped(c)
    for pattern, date_groups, clock in _SHAPES:
        groups = (*date_groups, *range(clock, clock + 5))
        # No shape matches text that already holds marks, so at most one applies.
        s = F.regexp_replace(s, pattern, _MARK.join(f"${g}" for g in groups))
    return s


def _two(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _clock_text(hour: Column, minute: Column, second: Column, fraction: Column, zone: Column) -> Column:
    """``THH:MM:SS[.ffffff][offset]``, blank without a clock."""
    micros = F.rpad(F.substring(fraction, 1, 6), 6, "0")
    offset = F.when(zone.isin("Z", "-00:00", "-0000"), F.lit("+00:00")).otherwise(
        F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, -2, 2))
    )
    # Fractions survive only next to an offset.
    tail = (
        F.when(zone == "", F.lit(""))
        .when(micros == "000000", offset)
        .otherwise(F.concat(F.lit("."), micros, offset))
    )
    return F.when(hour == "", F.lit("")).otherwise(
        F.concat(F.lit("T"), _two(hour), F.lit(":"), minute, F.lit(":"), F.rpad(second, 2, "0"), tail)
    )


def date_parts(pieces: Column) -> Column:
    """Year, month, day and the clock's five parts of a usual shape; one piece for other text."""
    return F.split(pieces, _MARK, -1)


def iso_from_parts(parts: Column) -> Column:
    """ISO text of ``date_parts``; null when they form no calendar date."""
    part = lambda i: F.get(parts, i)  # noqa: E731  null where there is none, whatever is evaluated first
    names = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    named = F.try_element_at(names, F.lower(part(1)))
    month = F.coalesce(part(1).try_cast("int"), named)
    first = F.make_date(part(0).try_cast("int"), month, F.lit(1))
    return F.when(
        (F.size(parts) == 8) & (part(2).try_cast("int") <= F.dayofmonth(F.last_day(first))),
        F.concat(
            F.date_format(first, "yyyy-MM-"), _two(part(2)),
            _clock_text(*[part(i) for i in range(3, 8)]),
        ),
    )


def native_date(pieces: Column) -> Column:
    """ISO text of a usual shape, null for blank, impossible or any other input."""
    return let(date_parts(pieces), iso_from_parts)


def _own_offsets_only(name, offset):
    """Numeric offsets and UTC count; other zone names depend on the host, so they do not."""
    from dateutil import tz

    return None if offset is None else tz.tzoffset(None, offset)


def _parse_flexible(text: str) -> dict[str, str | None]:
    from dateutil import parser

    # Two defaults that differ in year, month and day: a value that leaves one of them
    # open gives two results and is no full date.
    defaults = (datetime(2001, 2, 3), datetime(2004, 5, 6))
    try:
        first, second = (
            parser.parse(text, default=d, tzinfos=_own_offsets_only) for d in defaults
        )
        if first != second:
            return {"value": "", "error": None}
        if not re.search(TIME_HINT, text):
            value = f"{first.year:04d}-{first.month:02d}-{first.day:02d}"
        elif first.tzinfo is not None:
            value = first.isoformat()
        else:
            value = first.replace(microsecond=0).isoformat()
        return {"value": value, "error": None}
    except (ValueError, OverflowError):
        return {"value": "", "error": None}
    except Exception as exc:  # the row is rejected, the task goes on
        return {"value": None, "error": f"{type(exc).__name__}: {exc}"}


@F.arrow_udf(from_arrow_type(_DATE_TYPE))
def flexible_date(text: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else _parse_flexible(v) for v in text.to_pylist()], type=_DATE_TYPE
    )


def parse_other_date(pieces: Column) -> Column:
    """``struct<value,error>`` for possible dates of other shapes, else null.

    A usual shape with an impossible date is no date in any reading, so it stays out.
    """
    return flexible_date(
        F.when(~F.contains(pieces, F.lit(_MARK)) & pieces.rlike(_MAY_BE_FULL), pieces)
    )


def finish_date(native: Column, parsed: Column) -> Column:
    return or_blank(F.coalesce(native, parsed["value"]))


def normalize_date(c: Column) -> Column:
    pieces = date_pieces(c)
    return finish_date(native_date(pieces), parse_other_date(pieces))
