"""Numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.text import ColumnLike, _c


def round_exact(x: ColumnLike, digits: int) -> Column:
    """Correctly rounded to ``digits`` (0 to 4) places by the exact binary value of a double, ties to even.

    ``round`` and ``bround`` round the shortest decimal form, so 0.35 gives 0.4 there and 0.3 here. A double is a whole number n over a
    power of two; only where it lies next to the middle of two results do whole numbers decide: n * 2 * 10^digits against (2k + 1) * 2^s.
    Doubles of 2^52 and more are whole; nulls, infinities and NaN stay.
    """
    x = _c(x).cast("double")
    size, power = F.abs(x), 10**digits
    wide = lambda c: c.cast("decimal(38,0)")
    k = F.floor(size * power)  # may be one too high or low, which the comparisons below mend
    s = F.least(F.lit(61) - F.ceil(F.log2(F.greatest(size, F.lit(1e-9)))), F.lit(80)).cast("int")
    n = wide((size * F.pow(F.lit(2.0), s.cast("double"))).cast("bigint"))
    two = lambda e: wide(F.call_function("shiftleft", F.lit(1).cast("bigint"), e.cast("int")))
    scale = two(F.floor(s / 2)) * two(F.ceil(s / 2))
    twice = n * F.lit(2 * power).cast("decimal(6,0)")
    middle = lambda j: (wide(2 * j + 1)) * scale
    above = lambda j: (twice > middle(j)) | ((twice == middle(j)) & (j % 2 == 1))
    whole = F.when(above(k), k + 1).when(above(k - 1), k).otherwise(k - 1)
    rounded = F.signum(x) * whole / F.lit(float(power))
    # below the least middle nothing is left
    out = F.when(size < 1e-6, F.signum(x) * 0.0).otherwise(rounded)
    return F.when(x.isNull() | F.isnan(x) | (size >= float(1 << 45)), x).otherwise(out)
