"""Log-linear histogram with a fixed number of significant figures, as a (value range, count) relation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    lowest: int = 1
    highest: int = 3_600_000_000_000
    figures: int = 3

    @property
    def unit(self) -> int:
        return int(math.floor(math.log2(self.lowest)))

    @property
    def half_magnitude(self) -> int:
        return max(math.ceil(math.log2(2 * 10**self.figures)), 1) - 1

    @property
    def sub_count(self) -> int:
        return 1 << (self.half_magnitude + 1)

    @property
    def mask(self) -> int:
        return (self.sub_count - 1) << self.unit


def bucket(v: Column, layout: Layout = Layout()) -> Column:
    return F.length(F.bin(v.bitwiseOR(F.lit(layout.mask).cast("bigint")))) - (layout.unit + layout.half_magnitude + 1)


def _shift(v: Column, by: Column, left: bool) -> Column:
    return F.call_function("shiftleft" if left else "shiftright", v.cast("bigint"), by.cast("int"))


def index(v: Column, layout: Layout = Layout()) -> Column:
    b = bucket(v, layout)
    sub = _shift(v, b + layout.unit, left=False)
    return (_shift(F.lit(1), F.lit(layout.half_magnitude), True) * (b + 1) + sub - layout.sub_count // 2).cast("bigint")


def lowest_equivalent(v: Column, layout: Layout = Layout()) -> Column:
    by = bucket(v, layout) + layout.unit
    return _shift(_shift(v, by, False), by, True)


def range_size(v: Column, layout: Layout = Layout()) -> Column:
    b = bucket(v, layout)
    sub = _shift(v, b + layout.unit, False)
    return _shift(F.lit(1), b + F.when(sub >= layout.sub_count, 1).otherwise(0) + layout.unit, True)


def highest_equivalent(v: Column, layout: Layout = Layout()) -> Column:
    return lowest_equivalent(v, layout) + range_size(v, layout) - 1


def histogram(df: DataFrame, value: str, keys: list[str] | None = None, layout: Layout = Layout()) -> DataFrame:
    """Counts by value range: keys, lowest, highest, n; values must lie in [0, layout.highest]. Partial counts before the shuffle."""
    v = F.col(value)
    inside = df.where(v.between(0, layout.highest))
    return inside.groupBy(*(keys or []), lowest_equivalent(v, layout).alias("lowest"), highest_equivalent(v, layout).alias("highest")).agg(F.count(F.lit(1)).alias("n"))


def percentiles(hist: DataFrame, wanted: list[float], keys: list[str] | None = None) -> DataFrame:
    """keys, percentile, value: the upper end of the first range that reaches rank max(1, floor(p / 100 * n + 0.5)); p = 0: its lower end."""
    keys = keys or []
    one = Window.partitionBy(*(keys or [F.lit(1)]))
    ranked = hist.withColumn("reached", F.sum("n").over(one.orderBy("lowest"))).withColumn("total", F.sum("n").over(one))
    asked = ranked.withColumn("percentile", F.explode(F.array(*(F.lit(float(p)) for p in wanted))))
    rank = F.greatest(F.floor(F.col("percentile") / 100 * F.col("total") + 0.5), F.lit(1))
    hit = asked.where(F.col("reached") >= rank).groupBy(*keys, "percentile").agg(F.min("lowest").alias("lowest"), F.min("highest").alias("highest"))
    return hit.select(*keys, "percentile", F.when(F.col("percentile") == 0, F.col("lowest")).otherwise(F.col("highest")).alias("value"))


def moments(hist: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, n, mean, stddev over the middles of the ranges, min (lower end of the first range) and max (upper end of the last)."""
    mid = F.col("lowest") + F.call_function("shiftright", F.col("highest") - F.col("lowest") + 1, F.lit(1))
    weighted = hist.withColumn("mid", mid.cast("double"))
    sums = weighted.groupBy(*(keys or [])).agg(F.sum("n").alias("n"), F.sum(F.col("mid") * F.col("n")).alias("s"), F.sum(F.col("mid") * F.col("mid") * F.col("n")).alias("q"), F.min("lowest").alias("min"), F.max("highest").alias("max"))
    mean = F.col("s") / F.col("n")
    return sums.select(*(keys or []), "n", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))).alias("stddev"), "min", "max")
