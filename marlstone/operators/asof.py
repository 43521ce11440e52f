"""As-of joins and bands of time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import band
from .rows import ranges, ranked


def asof_backward(left: DataFrame, right: DataFrame, on: str, by: Sequence[str] = (), values: Sequence[str] = ()) -> DataFrame:
    """left with the right values of the latest `on` at or before its own, null before the first; right's `on` comes as as_of.

    Both sides go through one sort per key; no pairs are formed. Without keys the time line is cut into ranges that are sorted each
    by itself, and what a range's first rows lack is the last value of the ranges before it: one row a range.
    """
    values = list(values) or [c for c in right.columns if c != on and c not in by]
    both = _sides(left, right, on, by, values)
    if not by:
        both, _ = ranges(both, [on], "__range")
        last = both.where("__side = 0").groupBy("__range").agg(F.max_by("__r", on).alias("__last"))
        ends = last.groupBy().agg(F.sort_array(F.collect_list(F.struct("__range", "__last"))).alias("__ends"))
        w = Window.partitionBy("__range").orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
        carried = F.try_element_at(F.filter("__ends", lambda e: e["__range"] < F.col("__range")), F.lit(-1))["__last"]
        both = both.join(F.broadcast(ends), F.lit(True)).withColumn("__r", F.coalesce(F.last("__r", ignorenulls=True).over(w), carried))
        return both.where("__side = 1").select("__l.*", "__r.*")
    w = Window.partitionBy(*by).orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("__r", F.last("__r", ignorenulls=True).over(w)).where("__side = 1").select("__l.*", "__r.*")


def _sides(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of both sides in one table: those of right (__side 0) carry __r, those of left (1) carry __l."""
    own = right.where(F.col(on).isNotNull()).select(*by, F.col(on), F.struct(F.col(on).alias("as_of"), *values).alias("__r"), F.lit(0).alias("__side"), F.lit(None).alias("__l"))
    asked = left.select(*by, F.col(on), F.lit(None).alias("__r"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"))
    return own.unionByName(asked)


def tercile_cuts(df: DataFrame, *values: str) -> dict[str, tuple[float | None, float | None]]:
    """(lower, upper) of each column: its sorted values at (n - 1) div 3 and 2 (n - 1) div 3; nulls without values."""
    found = ranked(df, values, lambda n: ((n - 1) // 3, 2 * (n - 1) // 3))
    return {v: tuple(cuts) or (None, None) for v, cuts in found.items()}


def banded(df: DataFrame, bands: Mapping[str, str]) -> DataFrame:
    """df with a band of each value (column: name of the band) by its own terciles; all cuts are found together."""
    cuts = tercile_cuts(df, *bands)
    made = {name: F.when(F.col(v).isNotNull(), band(F.col(v), *(F.lit(c).cast("double") for c in cuts[v]))) for v, name in bands.items()}
    return df.withColumns(made)


def slope(long: Column, short: Column) -> Column:
    return F.round(long - short, 2)


def rate_context(days: DataFrame, curve: DataFrame) -> DataFrame:
    """(day, as_of, y2, y10, y30, slope_band, level_band) for distinct days that the curve covers."""
    covered = asof_backward(days.select("day").distinct(), curve, "day", (), ["y2", "y10", "y30"]).where("as_of is not null")
    return banded(covered.withColumn("slope", slope(F.col("y10"), F.col("y2"))), {"slope": "slope_band", "y10": "level_band"}).drop("slope")
