"""SF7: rounding of binary doubles as Python's ``round(x, n)`` does it.

A double is a 53-bit integer times a power of two, so its exact value is known.
``F.round`` and ``F.bround`` go by the shortest decimal text of the double
instead: 2.675 lies below 2.675 (2.67499...), yet they see a tie.  Here the
exact value decides, half to even, in SQL expressions on longs.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DIGITS = 3  # 2**53 * 10**3 still fits a long
_TINY = 2.0**-10  # below it a mantissa needs a shift of more than 62 bits


def _first_rounding_up(n: int) -> float:
    """The smallest double that rounds to 10**-n and not to zero."""
    half = Fraction(1, 2 * 10**n)
    x = float(half)
    return x if Fraction(x) > half else math.nextafter(x, math.inf)


def py_round(c: Column | str, n: int = 0) -> Column:
    """``round(x, n)`` of a double column, for n from 0 to 3; NULL, NaN and
    the infinities stay what they are."""
    if not 0 <= n <= MAX_DIGITS:
        raise ValueError(f"0 to {MAX_DIGITS} digits, not {n}")
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    size = F.abs(x)
    # size = m * 2**-k with m in [2**52, 2**53); the logarithm may be one off.
    # Only 2**-10 <= size < 2**52 comes here: k lies in 0..62.
    guess = F.least(F.greatest(F.lit(52) - F.floor(F.log2(size)).cast("int"), F.lit(0)), F.lit(62))
    # (a power of two, so the products are exact)
    power = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k).cast("double")
    first = size * power(guess)
    k = F.when(first >= 2.0**53, guess - 1).when(first < 2.0**52, guess + 1).otherwise(guess)
    k = F.least(F.greatest(k, F.lit(0)), F.lit(62))
    m = (size * power(k)).cast("long") * F.lit(10**n)
    q = F.call_function("shiftright", m, k)
    rest = m - F.call_function("shiftleft", q, k)
    half = F.when(k > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(k - 1, F.lit(0)))).otherwise(F.lit(1))
    up = (rest > half) | ((rest == half) & (q % 2 == 1))
    whole = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    # the nearest double of a short decimal is exact division of exact doubles, or the decimal's own cast
    value = (whole.cast("decimal(20,0)") / F.lit(10**n).cast("decimal(5,0)")).cast("double")
    small = F.when(size >= F.lit(_first_rounding_up(n)), F.lit(float(Fraction(1, 10**n)))).otherwise(F.lit(0.0))
    plain = F.isnan(x) | (size >= 2.0**52)
    rounded = F.when(size < _TINY, small).otherwise(value)
    signed = F.when(x < 0, -rounded).otherwise(rounded)
    return F.when(x.isNull() | plain, x).otherwise(signed)
