"""Numeric column helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(col: Column, digits: int = 0) -> Column:
    """ROUND(double, n) as the DuckDB reference computes it: ``round(x * 10^n) / 10^n``.

    Spark's ``F.round`` rounds the decimal text of the double (1.005 -> 1.01);
    the reference rounds the binary value (1.005 -> 1.0). Scaling first and
    rounding to an integer gives the reference's result on every value.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(col * scale, 0) / scale


#: Bits after the point that a sum keeps of each value: all of them for values of 2**-8 or more.
FRACTION_BITS = 60


def exact_parts(col: Column) -> tuple[Column, Column]:
    """A finite double as whole number and 2**-60ths (both integers), so that sums do not depend on their terms' order.

    A double's fraction and its multiple by a power of two are exact, so nothing is rounded but bits below 2**-60.
    """
    x = col.cast("double")
    whole = F.floor(x)
    return whole, F.floor((x - whole) * F.lit(float(1 << FRACTION_BITS))).cast("decimal(19,0)")


def exact_total(whole: Column, fraction: Column) -> Column:
    """The double nearest to the sum, from the sums of both parts."""
    scale = F.lit(Decimal(1 << FRACTION_BITS))
    return (whole.cast("decimal(19,0)") * scale + fraction).cast("double") / F.lit(float(1 << FRACTION_BITS))


def exact_average(col: Column) -> Column:
    """Aggregate: mean of a column of finite numbers over an exact sum of its doubles; NULL without values.

    A plain sum of doubles differs in its last bits with the order in which partitions are added, and an average on a
    rounding boundary would then round either way.
    """
    whole, fraction = exact_parts(col)
    return safe_div(exact_total(F.sum(whole), F.sum(fraction)), F.count(col))


def safe_div(numerator: Column, denominator: Column) -> Column:
    """``numerator / NULLIF(denominator, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return numerator / F.nullif(denominator, F.lit(0))
