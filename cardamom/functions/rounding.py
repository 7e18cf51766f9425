"""Rounding of doubles by their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_round(c: Column | str, scale: int) -> Column:
    """A double rounded as Python's ``round`` does: by its exact binary value, halves to even.

    ``bround`` looks at the shortest decimal text instead, where 0.6375 seems a
    tie although the double is a little less.  Here the product with the power
    of ten is split into a double and its exact error (Dekker's product), and
    the two decide together on which side of the half it lies.
    """
    if not 0 <= scale <= 15:
        raise ValueError("scale must be 0 to 15")
    power = float(10**scale)
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    size = F.abs(x)
    product = size * power

    def halves(value):
        high = value * 134217729.0
        high = high - (high - value)
        return high, value - high

    (xh, xl), (ph, pl) = halves(size), halves(F.lit(power))
    error = ((xh * ph - product) + xh * pl + xl * ph) + xl * pl
    down = F.floor(product).cast("double")
    rest = product - down
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (down % 2 == 1))))
    rounded = (down + up.cast("int")) / power
    # From 2^52 on there are no decimals left to round.
    return F.when(product < 2.0**52, F.when(x < 0, -rounded).otherwise(rounded)).otherwise(x)
