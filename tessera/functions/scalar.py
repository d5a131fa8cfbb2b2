"""Scalar functions as column expressions: safe arithmetic, month numbers, normal tails, bond returns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rational approximation of the normal quantile (centre: A over B, tails: C over D) and its border.
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
TAIL = 0.0485

# The polynomial of the complementary error function's approximation, from the highest power down.
ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def safe_div(x: Column, y: Column) -> Column:
    """x / y, null where y is 0 or either is null."""
    return F.try_divide(x, y)


def known(x: Column) -> Column:
    """A double with NaN and infinities as null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def half_away(x: Column, digits: int) -> Column:
    """x rounded as SQL engines round doubles: scaled, to the nearest integer (halves away from 0), scaled back.

    ``F.round`` rounds the shortest decimal of x instead, which differs where that ends in a 5 and the scaled double does not.
    """
    scale = 10.0**digits
    return F.round(x * scale, 0) / scale


def as_printed(x: Column, digits: int) -> Column:
    """x rounded as C's printf does it: by the double's exact value, ties to even. For digits of 0 to 7.

    ``F.format_string`` rounds the shortest decimal of x, halves up; given this value it only writes what is there. The
    scaled value and its rounding error are exact together, so a scaled value that looks like a tie shows its side.
    """
    scale = 10.0**digits
    scaled, spread = x * scale, x * 134217729.0
    high = spread - (spread - x)
    error = (high * scale - scaled) + (x - high) * scale
    tie = scaled - F.floor(scaled) == 0.5
    return F.rint(F.when(tie, scaled + 0.25 * F.signum(error)).otherwise(scaled)) / scale


def month_number(date: Column) -> Column:
    """Months since year 0, so that neighbouring calendar months differ by 1."""
    return F.year(date) * 12 + F.month(date)


def horner(coefficients: Sequence[float], x: Column) -> Column:
    """A polynomial, coefficients from the highest power down."""
    return reduce(lambda total, c: total * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def two_sided_z(q: Column) -> Column:
    """The z that a standard normal exceeds in absolute value with probability q, 0 < q <= 1."""
    tail = F.sqrt(-2 * F.ln(q / 2))
    centre = q / 2 - 0.5
    square = centre * centre
    return F.when(q < TAIL, -(horner(C, tail) / horner(D, tail))).otherwise(-(horner(A, square) * centre / horner(B, square)))


def normal_p(t: Column) -> Column:
    """The two-sided p-value of a t under the normal distribution."""
    z = F.abs(t) / F.sqrt(F.lit(2.0))
    k = 1 / (1 + 0.5 * z)
    return F.least(F.lit(1.0), k * F.exp(-z * z + horner(ERFC, k)))


def par_bond_return(before: Column, now: Column, years: float) -> Column:
    """One month's return of a par bond with half-yearly coupons, from the yields a month ago and now (decimals)."""
    left = years - 1.0 / 12
    price = before / now + (1 - before / now) * F.pow(1 + now / 2, F.lit(-2 * left))
    return F.when(F.abs(now) < 1e-9, 1 + before * left).otherwise(price) - 1 + before / 12
