"""Numbers: half-even minutes, bands, bit masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_minutes(words: Column, per_minute: int = 220) -> Column:
    """Minutes to read, rounded half to even in whole numbers, 1 at least."""
    q, r = F.expr("0") + F.floor(words / per_minute), F.pmod(words, F.lit(per_minute))
    up = (2 * r > per_minute) | ((2 * r == per_minute) & (F.pmod(q, F.lit(2)) == 1))
    return F.greatest(F.lit(1), q + up.cast("long")).cast("long")


def rounded(x: Column, digits: int) -> Column:
    """x rounded to digits by its exact binary value, ties to even; for |x| * 10 ** digits below 2 ** 52. Spark's own rounding goes by the shortest decimal spelling.

    The product's own rounding error is found exactly, from halves of both factors, and decides near ties.
    """
    scale = float(10**digits)
    half = lambda c: c * 134217729.0 - (c * 134217729.0 - c)
    x = x.cast("double")
    s_hi = 134217729.0 * scale - (134217729.0 * scale - scale)
    x_hi, s_lo = half(x), scale - s_hi
    x_lo, t = x - x_hi, x * scale
    error = ((x_hi * s_hi - t) + x_hi * s_lo + x_lo * s_hi) + x_lo * s_lo
    low = F.floor(t)
    over = (t - low - 0.5) + error
    up = (over > 0) | ((over == 0) & (F.pmod(low, F.lit(2)) == 1))
    return (low + up.cast("long")).cast("double") / scale


def band(value: Column, lower: Column, upper: Column) -> Column:
    return F.when(value <= lower, "low").when(value > upper, "high").otherwise("mid")


def pack(flags: list[Column]) -> Column:
    """Bit i is set where flag i holds; null flags don't."""
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)), F.lit(0))


def unpack(mask: Column, n: int) -> list[Column]:
    return [F.getbit(mask.cast("int"), F.lit(i)) == 1 for i in range(n)]
