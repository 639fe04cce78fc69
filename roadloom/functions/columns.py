"""Generic column helpers used by several operators.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen.  Nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: str | Column, scale: int | None = None) -> Column:
    """SUM, optionally rounded to ``scale`` decimals.

    Floating sums depend on addition order, which differs between tasks and
    engines.  Rounding to a scale well below the data's noise makes the result
    a stable function of the input values.
    """
    s = F.sum(col(c))
    return F.round(s, scale) if scale is not None else s


def mean(c: str | Column, scale: int | None = None) -> Column:
    """AVG; with ``scale`` it is the rounded sum divided by the non-null count.

    One rounded sum followed by one IEEE division gives the same double in
    every engine and on every partitioning.
    """
    if scale is None:
        return F.avg(col(c))
    return F.try_divide(F.round(F.sum(col(c)), scale), F.count(col(c)).cast("double"))


def fraction(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """ROUND(numerator / denominator, digits) for non-negative counts, exactly.

    Half-up rounding on the exact rational ``n / m`` using integer arithmetic:
    ``floor((2 * n * 10^d + m) / (2 * m)) / 10^d``.  Rounding the floating
    quotient instead can go either way when the exact value ends in 5
    (e.g. 29/200 = 0.145 is stored as 0.14499999...).  NULL when m is 0.
    """
    scale = 10 ** digits
    n = numerator.cast("long")
    m = denominator.cast("long")
    q = F.floor(F.try_divide((n * F.lit(2 * scale) + m).cast("double"), (m * F.lit(2)).cast("double")))
    return q / F.lit(float(scale))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """ROUND(numerator / denominator * 100, digits) for counts, exactly."""
    return fraction(numerator.cast("long") * F.lit(100), denominator, digits)


def order_columns(ts: str, tiebreak: str | list[str] | None) -> list[str]:
    """``[ts, *tiebreak]``: the time column plus the columns that make it total."""
    if tiebreak is None:
        return [ts]
    return [ts, tiebreak] if isinstance(tiebreak, str) else [ts, *tiebreak]


def epoch_micros_ntz(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, without any time zone.

    (Spark converts NTZ to the session zone inside ``timestampdiff`` and
    ``unix_micros``; across a DST change that shifts the result by an hour.)
    """
    t = col(c)
    day = F.unix_date(t.cast("date")).cast("long") * F.lit(86_400_000_000)
    clock = (F.hour(t).cast("long") * F.lit(3_600_000_000) + F.minute(t).cast("long") * F.lit(60_000_000)
             + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long"))
    return day + clock


def micros_between(start: str | Column, end: str | Column, ntz: bool = False) -> Column:
    """Exact microseconds from ``start`` to ``end``.

    ``ntz=True`` for TIMESTAMP_NTZ columns: zone-free arithmetic.  Otherwise
    ``timestampdiff`` (TIMESTAMP columns; NTZ would be read in the session zone).
    """
    if ntz:
        return epoch_micros_ntz(end) - epoch_micros_ntz(start)
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Seconds with microsecond fraction (not truncated to whole seconds)."""
    return micros_between(start, end) / F.lit(1_000_000.0)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Number of midnights crossed from ``start`` to ``end`` (calendar days)."""
    return F.datediff(col(end), col(start))


def age_in_years(start: str | Column, as_of: Column, digits: int = 2) -> Column:
    """ROUND(days / 365.25, digits): the reference's age formula."""
    return F.round(F.datediff(as_of, col(start)) / F.lit(365.25), digits)


def lit_ts(value: str | _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (no session-zone shift)."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def lit_date(value: str | _dt.date) -> Column:
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def month_start(c: str | Column) -> Column:
    """DATE_TRUNC('month', c) as TIMESTAMP_NTZ (date arithmetic, no time zone)."""
    return F.trunc(col(c).cast("date"), "month").cast("timestamp_ntz")


def year_start(c: str | Column) -> Column:
    """DATE_TRUNC('year', c) as TIMESTAMP_NTZ (date arithmetic, no time zone)."""
    return F.trunc(col(c).cast("date"), "year").cast("timestamp_ntz")


def instant_to_utc_ntz(c: str | Column) -> Column:
    """A TIMESTAMP (instant) as its UTC wall time, TIMESTAMP_NTZ.

    Goes through exact epoch microseconds, so the session zone plays no part
    (a plain cast would give the wall time in the session zone).
    """
    secs = (F.unix_micros(col(c)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def utc_ntz_to_instant(c: str | Column) -> Column:
    """A TIMESTAMP_NTZ read as UTC wall time -> TIMESTAMP (instant)."""
    return F.timestamp_micros(epoch_micros_ntz(c))


def parse_iso_utc(c: str | Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ssX") -> Column:
    """ISO-8601 text with an offset -> UTC wall time as TIMESTAMP_NTZ; NULL if unparsable."""
    return instant_to_utc_ntz(F.try_to_timestamp(col(c), F.lit(fmt)))
