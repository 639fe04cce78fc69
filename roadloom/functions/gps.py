"""GPS text -> decimal degrees, as column expressions (no Python per row).

Each notation is one regular expression with capture groups; the value is
arithmetic on the captured numbers.  A string that matches no notation gives
a NULL position and the format ``NULL`` (the operator turns it into a reject
with a reason instead of failing the job).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadloom.functions.columns import col

_D = r"(-?\d{1,3}(?:\.\d+)?)"          # signed degrees, optional fraction
_I = r"(-?\d{1,3})"                    # signed whole degrees
_M = r"([0-5]?\d(?:\.\d+)?)"           # minutes or seconds below 60 with optional fraction
_NS = r"([NSns])"
_EW = r"([EWew])"
_SEP = r"\s*,\s*"

# Notation name -> (pattern, number of groups per half).  Our own patterns:
# they accept the notations of the reference's code and tests, with optional
# spaces between the parts.
NOTATIONS: dict[str, str] = {
    "decimal": rf"^\s*{_D}{_SEP}{_D}\s*$",
    "hemisphere": rf"^\s*{_D}\s*{_NS}{_SEP}{_D}\s*{_EW}\s*$",
    "dms": rf"^\s*{_I}\s*°\s*{_M}\s*'\s*{_M}\s*(?:\"|'')\s*{_NS}{_SEP}{_I}\s*°\s*{_M}\s*'\s*{_M}\s*(?:\"|'')\s*{_EW}\s*$",
    "dm": rf"^\s*{_I}\s*°\s*{_M}\s*'\s*{_NS}{_SEP}{_I}\s*°\s*{_M}\s*'\s*{_EW}\s*$",
    "worded": rf"^\s*{_I}\s*degrees?\s*{_M}\s*minutes?\s*{_M}\s*seconds?\s*{_NS}{_SEP}"
              rf"{_I}\s*degrees?\s*{_M}\s*minutes?\s*{_M}\s*seconds?\s*{_EW}\s*$",
}


# Numbers and hemisphere letters of a text that matches a notation, in order.
_NUMBER = r"-?\d+(?:\.\d+)?"
_HEMISPHERE = r"(?<![A-Za-z])[NSEWnsew](?![A-Za-z])"
# Numbers per half of each notation (degrees, minutes, seconds).
_PARTS = {"decimal": 1, "hemisphere": 1, "dms": 3, "dm": 2, "worded": 3}


def _half(numbers: Column, hemispheres: Column, first: int, count: int, side: int, negative: str) -> Column:
    """Degrees of one half: numbers ``first`` to ``first + count - 1``, letter ``side`` if there is one."""
    n = lambda i: F.get(numbers, F.lit(first + i)).cast("double")
    up = down = n(0)
    for k in range(1, count):  # minutes and seconds lead away from zero, whatever the sign of the degrees
        up, down = up + n(k) / F.lit(60.0**k), down - n(k) / F.lit(60.0**k)
    value = up if count == 1 else F.when(F.get(numbers, F.lit(first)).startswith("-"), down).otherwise(up)
    return F.when(F.upper(F.get(hemispheres, F.lit(side))) == F.lit(negative), -value).otherwise(value)


def gps_format(text: str | Column) -> Column:
    """Name of the first notation the text matches, else NULL."""
    t = col(text)
    out = F.lit(None).cast("string")
    for name in reversed(list(NOTATIONS)):
        out = F.when(t.rlike(NOTATIONS[name]), F.lit(name)).otherwise(out)
    return out


def to_decimal_degrees(text: str | Column) -> Column:
    """struct(latitude, longitude, format) in decimal degrees.

    S and W negate the value (a negative number with N/E keeps its sign,
    as in the reference); DMS is d + m/60 + s/3600.
    """
    t = col(text)

    def position(p: Column) -> Column:
        lat, lon = F.lit(None).cast("double"), F.lit(None).cast("double")
        for name, count in _PARTS.items():
            same = p["format"] == F.lit(name)
            lat = F.when(same, _half(p["numbers"], p["hemispheres"], 0, count, 0, "S")).otherwise(lat)
            lon = F.when(same, _half(p["numbers"], p["hemispheres"], count, count, 1, "W")).otherwise(lon)
        return F.struct(lat.alias("latitude"), lon.alias("longitude"), p["format"].alias("format"))

    # the notation is decided once and the numbers are read once per row
    parts = F.struct(gps_format(t).alias("format"), F.regexp_extract_all(t, F.lit(_NUMBER), F.lit(0)).alias("numbers"),
                     F.regexp_extract_all(t, F.lit(_HEMISPHERE), F.lit(0)).alias("hemispheres"))
    return F.get(F.transform(F.array(parts), position), F.lit(0))


def component(position: Column, coord_type: str) -> Column:
    """Select ``latitude`` or ``longitude`` from a position struct."""
    if coord_type not in ("latitude", "longitude"):
        raise ValueError("Invalid coord_type")
    return position.getField(coord_type)


# The three notations the reference's cleaning step accepts as
# valid, in its order (plain decimal; decimal with hemispheres; decimal with
# hemispheres followed by minutes and seconds).
VALID_PATTERNS = [
    r"^-?\d{1,3}\.\d+,-?\d{1,3}\.\d+$",
    r"^-?\d{1,3}\.\d+\s[NS],\s-?\d{1,3}\.\d+\s[EW]$",
    r"^-?\d{1,3}\.\d+\s[NS],\s-?\d{1,3}\.\d+\s[EW]\s-?\d{1,2}\.\d+'\s-?\d{1,2}\.\d+\"$",
]


def matches_valid_pattern(text: str | Column) -> Column:
    t = col(text)
    out = F.lit(False)
    for p in VALID_PATTERNS:
        out = out | t.rlike(p)
    return out


def leading_numbers(text: str | Column) -> tuple[Column, Column]:
    """Numeric value at the start of each comma-separated half."""
    t = col(text)
    first = F.regexp_extract(F.trim(F.get(F.split(t, ","), 0)), r"^(-?\d+(?:\.\d+)?)", 1)
    second = F.regexp_extract(F.trim(F.get(F.split(t, ","), 1)), r"^(-?\d+(?:\.\d+)?)", 1)
    return first.try_cast("double"), second.try_cast("double")
