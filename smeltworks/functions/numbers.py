"""Exact decimal arithmetic and guarded numeric casts."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unsigned decimals and unsigned integers, whole text.
DECIMAL_PATTERN = r"\A[0-9]+\.?[0-9]*\z"
INTEGER_PATTERN = r"\A[0-9]+\z"

_WIDE = "decimal(38,0)"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_decimal(c, precision: int, scale: int, default: int = 0) -> Column:
    """Cast text that looks like an unsigned decimal; anything else, NULL included, is ``default``.

    Text that matches but does not fit the type becomes NULL, for the NOT NULL check to catch.
    """
    c = _column(c)
    to = f"decimal({precision},{scale})"
    return F.when(c.rlike(DECIMAL_PATTERN), c.try_cast(to)).otherwise(F.lit(default).cast(to))


def safe_int(c, default: int = 0) -> Column:
    """Cast text that looks like an unsigned integer; anything else, NULL included, is ``default``."""
    c = _column(c)
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("int")).otherwise(F.lit(default))


def div_round(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half away from zero to a bigint, in integer arithmetic.

    Decimal division would round once at its own scale and a second time at ours.
    """
    n, d = numerator.cast(_WIDE), denominator.cast(_WIDE)
    quotient = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -quotient).otherwise(quotient)


def _rescale(value: Column, scale: int, to: str) -> Column:
    return (value.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(to)


def exact_avg(total: Column, count: Column, to: str = "decimal(10,2)") -> Column:
    """Average with two decimals of a sum of two-decimal values; NULL when ``count`` is 0."""
    cents = (total * 100).cast(_WIDE)
    return F.when(count > 0, _rescale(div_round(cents, count), 2, to))


def pct_change(current: Column, previous: Column, scale: int, to: str) -> Column:
    """Growth in percent over a positive previous value, else NULL."""
    change = ((current - previous) * 100).cast(_WIDE) * (100 * 10**scale)
    base = (previous * 100).cast(_WIDE)
    return F.when(previous > 0, _rescale(div_round(change, base), scale, to))


def ratio(part: Column, whole: Column, scale: int, to: str) -> Column:
    """``part / whole`` of two counts with ``scale`` decimals; NULL when ``whole`` is 0."""
    return F.when(whole > 0, _rescale(div_round(part.cast(_WIDE) * 10**scale, whole), scale, to))
