"""Ordered looks and running values that split a hot key: blocks of the order are worked on apart, and a small table of edges stitches them.

A window by key alone sorts a whole key in one task. Here rows are dealt by (key, block), where a block spans `width` units of the first order column. Each
block computes its own lags and running values; one row a block (its last and first row, its sums) goes through a window over blocks; and what came
before a block is joined back to its rows. All carried values are associative, so any split gives the same result. No task holds more than a
block, and the edges of a key number its span divided by width.

Defined cases. Null keys form a group, as in a window. Rows whose first order column is null come first, in one block. An order column that is no whole
number, or width None (for keys known to be small), makes one block of a key. Ties in the order are as arbitrary as in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Units of the order column in one block, for ids and positions that run without large holes.
WIDTH = 65_536

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}
_JOIN = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least, "xor": lambda a, b: a.bitwiseXOR(b), "last": lambda a, b: a}


def block_of(order: str, width: int) -> Column:
    return F.coalesce(F.floor(F.col(order) / F.lit(width)).cast("bigint"), F.lit(-(2**62)).cast("bigint"))


def carried(
    df: DataFrame, keys: list[str], order: str | list[str], width: int | None = WIDTH, prev: dict[str, Column] | None = None, nxt: dict[str, Column] | None = None,
    before: dict[str, tuple[str, Column]] | None = None, upto: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """df with further columns, by key and order.

    prev and nxt: an expression's value in the row before or after. before and upto: a running value (sum, max, min, xor, or last, which takes the last one that is not
    null) of all rows before a row, without or with itself.
    """
    prev, nxt, before, upto = prev or {}, nxt or {}, before or {}, upto or {}
    orders = [order] if isinstance(order, str) else list(order)
    split = width is not None and isinstance(df.schema[orders[0]].dataType, IntegralType)
    running = {n: (kind, c, -1) for n, (kind, c) in before.items()} | {n: (kind, c, 0) for n, (kind, c) in upto.items()}
    given = {f"_p_{n}": c for n, c in prev.items()} | {f"_n_{n}": c for n, c in nxt.items()} | {f"_r_{n}": c for n, (_, c, _) in running.items()}
    block = block_of(orders[0], width) if split else F.lit(0).cast("bigint")
    base = df.withColumns({**given, "_key": F.struct(*keys) if keys else F.struct(F.lit(1).alias("one")), "_block": block})

    w = Window.partitionBy("_key", "_block").orderBy(*orders)
    local = {f"_pl_{n}": F.lag(f"_p_{n}").over(w) for n in prev} | {f"_nl_{n}": F.lead(f"_n_{n}").over(w) for n in nxt}
    for n, (kind, _, end) in running.items():
        frame = w.rowsBetween(Window.unboundedPreceding, end)
        local[f"_rl_{n}"] = (F.last(f"_r_{n}", ignorenulls=True) if kind == "last" else _AGG[kind](f"_r_{n}")).over(frame)
    if prev:
        local["_is_first"] = F.lag(F.lit(1)).over(w).isNull()
    if nxt:
        local["_is_last"] = F.lead(F.lit(1)).over(w).isNull()
    rows = base.withColumns(local)
    if not split:
        done = {n: F.col(f"_pl_{n}") for n in prev} | {n: F.col(f"_nl_{n}") for n in nxt} | {n: F.col(f"_rl_{n}") for n in running}
        return rows.select(*(F.col(c) for c in df.columns if c not in done), *(c.alias(n) for n, c in done.items()))

    at = F.struct(*orders)
    edges = []
    if prev:
        edges.append(F.max_by(F.struct(*(f"_p_{n}" for n in prev)), at).alias("_tail"))
    if nxt:
        edges.append(F.min_by(F.struct(*(f"_n_{n}" for n in nxt)), at).alias("_head"))
    for n, (kind, _, _) in running.items():
        c = F.col(f"_r_{n}")
        edges.append((F.max_by(c, F.when(c.isNotNull(), at)) if kind == "last" else _AGG[kind](c)).alias(f"_e_{n}"))
    e = Window.partitionBy("_key").orderBy("_block")
    earlier = e.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.lag("_tail").over(e).alias("_tail")] if prev else []
    carry += [F.lead("_head").over(e).alias("_head")] if nxt else []
    carry += [(F.last(f"_e_{n}", ignorenulls=True) if kind == "last" else _AGG[kind](f"_e_{n}")).over(earlier).alias(f"_e_{n}") for n, (kind, _, _) in running.items()]
    stitched = rows.join(base.groupBy("_key", "_block").agg(*edges).select("_key", "_block", *carry), ["_key", "_block"], "left")

    done = {n: F.when(F.col("_is_first"), F.col(f"_tail._p_{n}")).otherwise(F.col(f"_pl_{n}")) for n in prev}
    done |= {n: F.when(F.col("_is_last"), F.col(f"_head._n_{n}")).otherwise(F.col(f"_nl_{n}")) for n in nxt}
    for n, (kind, _, _) in running.items():
        own, earlier_ = F.col(f"_rl_{n}"), F.col(f"_e_{n}")
        done[n] = F.when(own.isNull(), earlier_).when(earlier_.isNull(), own).otherwise(_JOIN[kind](own, earlier_))
    return stitched.select(*(F.col(c) for c in df.columns if c not in done), *(c.alias(n) for n, c in done.items()))


def haloed(df: DataFrame, keys: list[str], order: str, reach: int, width: int | None) -> tuple[DataFrame, list[str]]:
    """df and the columns to partition a window by that looks back at most `reach` units of the order; rows near a block's end go to the next block as well.

    Copies have _halo true and are to be filtered out after the window. A block is at least as wide as the reach, so a row has one copy at most.
    """
    if width is None or not isinstance(df.schema[order].dataType, IntegralType):
        return df.withColumn("_halo", F.lit(False)), keys
    span = max(width, reach)
    own = block_of(order, span)
    next_start = (F.col("_at") + 1) * F.lit(span)
    rows = df.withColumn("_at", own)
    copies = F.when(F.col(order) >= next_start - reach, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_copy", F.explode(copies)).withColumn("_halo", F.col("_copy") == 1).withColumn("_block", F.col("_at") + F.col("_copy"))
    return rows.drop("_at", "_copy"), [*keys, "_block"]


def positions(df: DataFrame, keys: list[str], order: str | list[str], width: int | None = WIDTH, name: str = "position") -> DataFrame:
    """df with a row's place in its key, from 0."""
    return carried(df, keys, order, width, before={name: ("sum", F.lit(1).cast("bigint"))}).withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def row_halo(df: DataFrame, keys: list[str], order: str | list[str], reach: int, width: int | None = WIDTH, block_rows: int = 100_000) -> tuple[DataFrame, list[str]]:
    """As haloed, for windows that look back at most `reach` rows: blocks of block_rows rows by position."""
    if width is None:
        return df.withColumn("_halo", F.lit(False)), keys
    return haloed(positions(df, keys, order, width, "_position"), keys, "_position", reach, block_rows)
