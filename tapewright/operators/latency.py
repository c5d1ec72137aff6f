"""Latency analytics: clock offset, one-way delay, inter-arrival times, three percentile rules, rates and slopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import carried, haloed, row_halo


def clock_offset(server: Column, sent: Column, rtt: Column) -> Column:
    """Server time minus local time, half the round trip after sending."""
    return server - sent - rtt / 2


def one_way_delay(local: Column, event: Column, offset: Column, convention: str = "corrected") -> Column:
    """Local arrival minus the event's time in the local clock (event - offset). 'reference' adds the offset instead, which biases delays by 2 * offset."""
    return local - (event - offset) if convention == "corrected" else local - (event + offset)


def median(df: DataFrame, keys: list[str], *values: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.median(v).alias(f"median_{v}") for v in values))


def inter_arrival(df: DataFrame, keys: list[str], stamp: str, order: str | None = None, width: int | None = None) -> DataFrame:
    """Adds gap: time since the previous row of the key, null for the first. width: see ordered.carried."""
    return carried(df, keys, order or stamp, width, prev={"_was": F.col(stamp)}).withColumn("gap", F.col(stamp) - F.col("_was")).drop("_was")


def _ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with counts, running counts and totals, so that windows hold distinct values and not all rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    one = Window.partitionBy(*(keys or [F.lit(1)]))
    return counts.withColumn("_upto", F.sum("_n").over(one.orderBy(value))).withColumn("_total", F.sum("_n").over(one))


def _at_rank(df: DataFrame, keys: list[str], value: str, ranks: dict[float, Column]) -> DataFrame:
    rows = _ranked(df, keys, value)
    wanted = rows.withColumn("_r", F.explode(F.array(*(F.struct(F.lit(p).alias("p"), r.cast("bigint").alias("rank")) for p, r in ranks.items()))))
    return wanted.where(F.col("_upto") >= F.col("_r.rank")).groupBy(*keys, F.col("_r.p").alias("p")).agg(F.min(value).alias("value"))


def percentile_nearest(df: DataFrame, keys: list[str], value: str, ps: list[float]) -> DataFrame:
    """keys, p, value: the value at index int(p * (n - 1) + 0.5) in order."""
    total = F.col("_total")
    return _at_rank(df, keys, value, {p: F.floor(F.lit(p) * (total - 1) + 0.5) + 1 for p in ps})


def percentile_ceil(df: DataFrame, keys: list[str], value: str, ps: list[float]) -> DataFrame:
    """keys, p, value: the value of rank ceil(p * n), 1 at least."""
    return _at_rank(df, keys, value, {p: F.greatest(F.ceil(F.lit(p) * F.col("_total")), F.lit(1)) for p in ps})


def latency_report(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, p50, p99, mean, max."""
    ps = percentile_nearest(df, keys, value, [0.5, 0.99])
    wide = ps.groupBy(*keys).agg(F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50"), F.max(F.when(F.col("p") == 0.99, F.col("value"))).alias("p99"))
    rest = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    return rest.join(wide, keys) if keys else rest.crossJoin(wide)


def sliding_rate(df: DataFrame, keys: list[str], stamp: str, window: int, width: int | None = None) -> DataFrame:
    """Adds in_window: rows of the key in the window that ends at the row; its rate is in_window / window at any time."""
    rows, by = haloed(df, keys, stamp, window, width)
    w = Window.partitionBy(*by).orderBy(stamp).rangeBetween(-window, 0)
    return rows.withColumn("in_window", F.count(F.lit(1)).over(w)).where(~F.col("_halo")).select(*df.columns, "in_window")


def sample_slope(df: DataFrame, keys: list[str], stamp: str, value: str, samples: int = 32, ties: str | None = None, width: int | None = None) -> DataFrame:
    """Adds slope: (last - first value) / (last - first time) over the latest samples, null where time stands still; ties orders equal times."""
    order = [stamp, *([ties] if ties else [])]
    rows, by = row_halo(df, keys, order, samples - 1, width)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(samples - 1), 0)
    rise, run = F.col(value) - F.first(value).over(w), F.col(stamp) - F.first(stamp).over(w)
    out = rows.withColumn("slope", F.when(run > 0, rise.cast("double") / run)).where(~F.col("_halo"))
    return out.select(*df.columns, "slope")


def anticipation(df: DataFrame, keys: list[str], stamp: str, rtt: str, connected: str, window: int, expected: int, slope_limit: float, rotate_after: int) -> DataFrame:
    """Rows with signals: rate_deviation, rtt_rising and preventive_rotation."""
    rows = sample_slope(sliding_rate(df, keys, stamp, window), keys, stamp, rtt)
    return rows.withColumn("rate_deviation", (F.col("in_window") - expected).cast("double") / expected).withColumn("rtt_rising", F.coalesce(F.col("slope") > slope_limit, F.lit(False))).withColumn("preventive_rotation", F.col(stamp) - F.col(connected) >= rotate_after)
