"""Conversions that never fail, guarded ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the cast to double reads and a number in a file is not: type suffixes, hexadecimal.
NOT_A_NUMBER = r"[xX]|[0-9.]\s*[dDfF]\s*$"

MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)
MONTH = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + r"|sept)\.?"
TIME = r"(?:[\sT,]+([0-9:.]+(?:\s*(?:Z|[+-][0-9:]{2,5}))?))?$"
# Shapes of a date other than ISO: which group holds year, month, day and time.
NUMERIC = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4}|[0-9]{2})" + TIME
YEAR_FIRST = r"^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})" + TIME
DAY_NAME = rf"(?i)^([0-9]{{1,2}})(?:st|nd|rd|th)?[\s/.-]+{MONTH}[\s,/.-]+([0-9]{{4}}|[0-9]{{2}})" + TIME
NAME_DAY = rf"(?i)^{MONTH}[\s-]+([0-9]{{1,2}})(?:st|nd|rd|th)?,?[\s,-]+([0-9]{{4}}|[0-9]{{2}})" + TIME


def number(c: Column) -> Column:
    """Text to double; junk and NaN become null."""
    value = F.when(~c.cast("string").rlike(NOT_A_NUMBER), c.try_cast("double"))
    return F.when(~F.isnan(value), value)


def finite(c: Column) -> Column:
    """A numeric column as double, NaN as null."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def number_or_zero(c: Column) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def nonzero(c: Column) -> Column:
    """Numeric flag to boolean, null is false."""
    return F.coalesce(c.try_cast("double") != 0, F.lit(False))


def timestamp(c: Column) -> Column:
    """ISO text to a zone-free timestamp; junk becomes null."""
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def date_text(c: Column, day_first: bool = True) -> Column:
    """Date text to a zone-free timestamp; junk becomes null.

    ISO dates; three numbers, the year last (day or month first, as told) or
    first; and month names, whole or by three letters. Years of two digits lie
    between 1969 and 2068. A time may follow. The shape of the text picks the
    one reading, because a failed parse costs far more than a test of the shape.
    """
    c = F.trim(c)
    orders = {
        NUMERIC: (3, 2, 1) if day_first else (3, 1, 2),
        YEAR_FIRST: (1, 2, 3),
        DAY_NAME: (3, 2, 1),
        NAME_DAY: (3, 1, 2),
    }
    parsed = F.when(F.substr(c, F.lit(5), F.lit(1)) == "-", F.try_to_timestamp(c))
    for shape, (year, month, day) in orders.items():

        def part(n: int, shape: str = shape) -> Column:
            return F.regexp_extract(c, shape, n)

        y, m, time = part(year), part(month), part(4)
        century = F.when(F.length(y) == 2, F.when(y < "69", F.lit("20")).otherwise(F.lit("19")))
        if shape in (DAY_NAME, NAME_DAY):
            names = F.array(*[F.lit(name[:3]) for name in MONTHS])
            m = F.array_position(names, F.lower(F.left(m, F.lit(3)))).cast("string")
        iso = F.concat_ws("-", F.concat(F.coalesce(century, F.lit("")), y), F.lpad(m, 2, "0"), F.lpad(part(day), 2, "0"))
        clock = F.when(time.rlike("^[0-9]+:[0-9]+$"), F.concat(time, F.lit(":00"))).otherwise(time)
        whole = F.when(time == "", iso).otherwise(F.concat_ws(" ", iso, clock))
        parsed = parsed.when(c.rlike(shape), F.try_to_timestamp(whole))
    return parsed.cast("timestamp_ntz")


def ratio(n: Column, d: Column) -> Column:
    """``n / d`` as double, null where ``d`` is zero."""
    return n.cast("double") / F.nullif(d.cast("double"), F.lit(0.0))


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounded value; null stays null (``least`` and ``greatest`` alone skip nulls)."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(c.isNotNull(), out)


def percent(n: Column, d: Column) -> Column:
    """``100 n / d`` of two counts, rounded half up to 2 places in decimal arithmetic."""
    whole = "decimal(20,0)"
    return F.round(n.cast(whole) * 100 / F.nullif(d.cast(whole), F.lit(0).cast(whole)), 2)


def float_round(c: Column, places: int) -> Column:
    """Round a double by its exact binary value, exact ties to even.

    ``round`` works on the shortest decimal text of the double, so it differs
    at ties (12.25) and near-ties (2.675). The product with ``10**places`` is
    split into its double result and the exact error, which decides ties.
    """
    scale = F.lit(float(10**places))
    c = c.cast("double")
    wide = c * F.lit(134217729.0)
    high = wide - (wide - c)
    product = c * scale
    error = (high * scale - product) + (c - high) * scale
    floor = F.floor(product).cast("double")
    beyond = (product - floor) - F.lit(0.5)
    up = (
        F.when((beyond > 0) | ((beyond == 0) & (error > 0)), F.lit(1.0))
        .when((beyond < 0) | (error < 0), F.lit(0.0))
        .otherwise(F.abs(floor % 2))
    )
    # From 2**52 on a double has no fraction; NaN also stays as it is.
    return F.when(F.abs(product) < 4503599627370496.0, (floor + up) / scale).otherwise(c)


def kilobytes(size: Column) -> Column:
    return float_round(size / F.lit(1024.0), 2)


def whole_days(start: Column, end: Column, clipped: bool = True) -> Column:
    """Days between two timestamps.

    ``clipped``: never below zero (floor and truncation then agree). Otherwise
    the signed day field of the interval, which truncates toward zero.
    """
    days = F.extract(F.lit("DAY"), end - start).cast("int")
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0))) if clipped else days
