"""Price comparisons, and prices as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _number(x: Column) -> Column:
    value = x.try_cast("double")
    return F.when(~F.isnan(value), value)


def meaningful_drop(now: Column, then: Column) -> Column:
    """Whether a price fell by ten percent and by three dollars at least; false if either isn't a number."""
    now, then = _number(now), _number(then)
    off = then - now
    # A price before of 0 or less can't be divided by; with now < then it is no drop that counts.
    enough = F.when(then != 0, off / then * 100 >= rules.DROP_MIN_PERCENT)
    return F.coalesce((now < then) & enough & (off >= rules.DROP_MIN_ABS), F.lit(False))


def sale_percent(now: Column, then: Column) -> Column:
    """Percent off, cut to a whole number."""
    now, then = _number(now), _number(then)
    return F.coalesce(F.when((now < then) & (then > 0), ((then - now) / then * 100).cast("int")), F.lit(0))


def _rounded(x: Column, digits: int) -> Column:
    """``x`` to so many places, by its binary value, as formatting in C does.

    Spark rounds the shortest decimal of a double. Where that ends in a 5 just
    behind the last place, the double itself may be above or below it: the rest
    is taken exactly, from a part of 24 bits and what it leaves.
    """
    m = 2 * 10**digits
    size = F.abs(x)
    at = size.cast("decimal(20,9)") * F.lit(m).cast("decimal(12,0)")
    tie = (at == F.floor(at)) & (at % 2 == 1)
    n = F.rint(size * m)
    high = size.cast("float").cast("double")
    rest = (high * m - n) + (size - high) * m
    nearer = (n + F.when(rest > 0, 1).otherwise(-1)) / m * F.signum(x)
    return F.when(tie & (rest != 0), nearer).otherwise(F.bround(x, digits))


def price_text(x: Column) -> Column:
    """A number with six significant digits at most, and no zeros at its end."""
    value = _number(x)
    size = F.abs(value)
    rounded = _rounded(value, 0)
    for digits, below in ((1, 1e5), (2, 1e4), (3, 1e3), (4, 1e2), (5, 10.0), (6, 1.0), (7, 0.1), (8, 0.01)):
        rounded = F.when(size < below, _rounded(value, digits)).otherwise(rounded)
    plain = F.regexp_replace(rounded.cast("decimal(24,9)").cast("string"), r"\.?0+$", "")
    power = F.floor(F.log10(size)).cast("int")
    first = F.bround(value / F.pow(F.lit(10.0), power), 5)
    carried = F.abs(first) >= 10
    mantissa = F.regexp_replace(F.when(carried, first / 10).otherwise(first).cast("string"), r"\.0$", "")
    large = F.concat(mantissa, F.lit("e+"), F.lpad((power + F.when(carried, 1).otherwise(0)).cast("string"), 2, "0"))
    return F.when(value.isNull(), x.cast("string")).when(value == 0, "0").when(size >= 999999.5, large).otherwise(plain)
