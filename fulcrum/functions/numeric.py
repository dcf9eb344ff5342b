"""Numeric column helpers.

Determinism rules used across the library:

* Money stays ``DECIMAL`` through every sum and is turned into ``DOUBLE`` once, at the
  output.  Decimal addition is exact, so a total does not depend on how the rows were
  partitioned or in which order partial aggregates were merged.
* Rounding is written as ``floor(|x| * 10^d + 0.5) / 10^d``.  Spark's ``round``
  on doubles rounds the shortest decimal string half-up, which differs from rounding the
  binary value (``round(1.005, 2)``); the explicit form is the same IEEE arithmetic in any
  engine.
* Ratios of aggregates go through ``ratio`` which yields NULL (not an error under ANSI
  mode, not infinity) when the denominator is zero or NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator in double precision; NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def round_half_up(c: Column, digits: int) -> Column:
    """ROUND(c, digits) on the binary value, half away from zero."""
    scale = float(10 ** digits)
    up = lambda x: F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(c < 0, -up(-c)).otherwise(up(c))


def exact_mean(c: Column) -> Column:
    """Mean of a double that doesn't depend on the order of the sum.

    Each value is cut to a multiple of 2^-60 and summed in two exact integer parts (30 bits
    each side of 2^-30; multiplying by a power of two is exact).  The error is at most 2^-60 per
    value plus the two roundings of the final division, whatever the number of rows.  Values
    must stay below 2^33."""
    unit = float(1 << 30)
    high = F.floor(c * F.lit(unit))
    low = F.floor((c * F.lit(unit) - high) * F.lit(unit))
    total = lambda x: F.sum(x.cast("decimal(20,0)")).cast("double")
    return F.try_divide((total(high) + total(low) / F.lit(unit)) / F.lit(unit), F.count(c).cast("double"))


def round_half_even(c: Column, digits: int) -> Column:
    """Banker's rounding, as pandas/Python ``round`` does on a float."""
    return F.bround(c, digits)


def coefficient_of_variation(k: Column, s1: Column, s2: Column) -> Column:
    """STDDEV_SAMP(n) / AVG(n) from exact integer moments.

    k = number of observations, s1 = sum(n), s2 = sum(n^2).  The sample variance is
    (k*s2 - s1^2) / (k*(k-1)); both parts are exact integers, so the result is the same
    correctly-rounded double whatever the aggregation order.  NULL for k < 2 (as
    STDDEV_SAMP) and when the mean is not positive.
    """
    k_ = k.cast("decimal(38,0)")
    num = k_ * s2.cast("decimal(38,0)") - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)")
    den = k_ * (k_ - F.lit(1))
    variance = F.try_divide(num.cast("double"), den.cast("double"))
    mean = F.try_divide(s1.cast("double"), k.cast("double"))
    return F.when((k > 1) & (mean > 0), F.sqrt(variance) / mean)


_VELTKAMP = 134217729.0  # 2**27 + 1: splits a double into two 26-bit halves


def _split_const(a: float) -> tuple[float, float]:
    c = _VELTKAMP * a
    hi = c - (c - a)
    return hi, a - hi


def round_binary_half_even(x: Column, digits: int) -> Column:
    """Round the exact binary value of a double to ``digits`` decimals, ties to even —
    what C ``printf`` and Python ``format`` do before printing.

    ``x * 10^d`` is rounded once in double arithmetic; its exact rounding error comes from
    Dekker's two-product (Veltkamp splits, plain IEEE operations), so a value printed as
    ``94.25`` is a true tie (-> 94.2) while ``0.155`` (binary 0.15499...) rounds down to
    0.15.  Returns a double whose shortest decimal form has at most ``digits`` decimals."""
    scale = float(10 ** digits)
    s_hi, s_lo = _split_const(scale)
    p = x * F.lit(scale)
    c = F.lit(_VELTKAMP) * x
    x_hi = c - (c - x)
    x_lo = x - x_hi
    err = ((x_hi * F.lit(s_hi) - p) + x_hi * F.lit(s_lo) + x_lo * F.lit(s_hi)) + x_lo * F.lit(s_lo)
    n = F.floor(p)
    frac = p - n
    odd = F.pmod(n, F.lit(2)) == 1
    up = (frac > 0.5) | ((frac == 0.5) & ((err > 0) | ((err == 0) & odd)))
    return (n + F.when(up, F.lit(1)).otherwise(F.lit(0))) / F.lit(scale)


def format_fixed(x: Column, digits: int, thousands: bool = False) -> Column:
    """``'{:.Nf}'`` / ``'{:,.Nf}'`` of a double, rounding as Python/C formatting does;
    NULL stays NULL."""
    r = round_binary_half_even(x, digits)
    text = F.format_number(r, digits) if thousands else F.format_string(f"%.{digits}f", r)
    return F.when(x.isNotNull(), text)
