"""Rounding and ratios.

NUMERIC results are rounded half away from zero, floats half to even. A ratio of whole numbers or DECIMALs is divided
in whole numbers and rounded once (`exact_ratio`, `exact_percent`). Spark's ``round`` on a double works on the binary value, so what is a
double by nature (a mean of probabilities, a health score) is brought to six decimals and rounded from there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom`` in double; NULL when ``bottom`` is zero (ANSI would raise)."""
    return _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def percent(top: Column | str, bottom: Column | str) -> Column:
    """``100 * top / bottom`` in double; NULL when ``bottom`` is zero."""
    return F.lit(100.0) * _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def exact_ratio(top: Column | str, bottom: Column | str, places: int, times: int = 1) -> Column:
    """``times * top / bottom`` of whole numbers or DECIMALs with at most six decimals, rounded half away from zero
    once, as a double; NULL when ``bottom`` is zero.

    The quotient of twice the wanted unit, plus a half, is a whole number: no double and no intermediate length is involved.
    """
    t, b = (_col(x).cast("decimal(30,6)") for x in (top, bottom))
    whole = F.lit(2 * times * 10**places).cast("decimal(8,0)")
    two = F.lit(2).cast("decimal(1,0)")
    units = F.call_function("div", F.abs(t) * whole + F.abs(b), two * F.nullif(F.abs(b), F.lit(0)))
    signed = F.when((t < 0) != (b < 0), -units).otherwise(units)
    return signed.cast("double") / F.lit(float(10**places))


def exact_percent(top: Column | str, bottom: Column | str, places: int) -> Column:
    """``100 * top / bottom``, rounded as `exact_ratio`."""
    return exact_ratio(top, bottom, places, 100)


def round_half_up(c: Column | str, places: int) -> Column:
    """Half away from zero, as a double."""
    return F.round(_col(c).cast(EXACT), places).cast("double")


def round_half_even(c: Column | str, places: int) -> Column:
    """Half to even, as a double."""
    return F.bround(_col(c).cast(EXACT), places).cast("double")


def round_money(c: Column | str, places: int = 2) -> Column:
    """Half away from zero straight on a DECIMAL sum, as a double."""
    return F.round(_col(c), places).cast("double")


def flag(c: Column | str) -> Column:
    """Boolean as 0/1, NULL counting as 0."""
    return F.when(_col(c), F.lit(1)).otherwise(F.lit(0))
