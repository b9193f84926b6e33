"""Calendar-date composition from integer parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATTERN = "yyyy-MM-dd"


def _parts(year, month, day) -> tuple[Column, Column, Column]:
    return tuple(F.col(c) if isinstance(c, str) else c for c in (year, month, day))


def date_text(y: Column, m: Column, d: Column) -> Column:
    """``year-MM-dd``; ``lpad`` also truncates and ``concat_ws`` skips nulls."""
    return F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))


def compose_date_by_pattern(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """The definition: the padded text parsed with ``yyyy-MM-dd``, null when it does not parse."""
    return F.try_to_date(date_text(*_parts(year, month, day)), PATTERN)


def compose_date(year: str | Column, month: str | Column, day: str | Column, strict: bool = False) -> Column:
    """DATE from year, month and day parts; any invalid combination gives null.

    Same result as ``compose_date_by_pattern`` under the default parser policy
    for every year from 0 up: as in the source job, ``lpad`` *truncates*
    (month 123 reads as 12) and a null part makes the text unparsable.

    Pattern parsing costs about a microsecond per row and depends on the
    session's ``timeParserPolicy`` (EXCEPTION raises on short years, LEGACY
    reads ``15`` as year 15).  So the text goes through the plain DATE cast,
    guarded to accept exactly what the pattern accepts: a four-digit year
    (1000-9999) and all three parts present (the cast alone would read
    ``2015-01`` as a date).  Any other year is invalid and gives null, under
    every policy; that includes negative years, which the pattern would turn
    into dates before the common era.  The tests check the equivalence by
    brute force.

    With ``strict`` a month outside 1-12 or a day outside 1-31 is null before
    padding, so truncation cannot turn it into a valid date.
    """
    y, m, d = _parts(year, month, day)
    if strict:
        m = F.when(m.between(1, 12), m)
        d = F.when(d.between(1, 31), d)
    ok = y.between(1000, 9999) & m.isNotNull() & d.isNotNull()
    return F.when(ok, date_text(y, m, d).try_cast("date"))
