"""Sequence operators over ordered event rows: duplicates, jumps, chains, prefixes, islands.

Windows are by the caller's keys (symbol, stream, epoch, file ...) and split within a key by `ordered.carried`, so that a hot key is no task of its own; width is
the span of the order column in one block, None where keys are known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.digests import ZERO_DIGEST
from .ordered import WIDTH, carried, positions


def by(keys: list[str], order: str | list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))


def arrival_steps(df: DataFrame, keys: list[str], id_col: str, order: str, width: int | None = WIDTH) -> DataFrame:
    """Adds prev_id and step: first, duplicate, out_of_order, jump or next, against the previous row in arrival order."""
    rows = carried(df, keys, order, width, prev={"prev_id": F.col(id_col)})
    v, prev = F.col(id_col), F.col("prev_id")
    step = F.when(prev.isNull(), "first").when(v == prev, "duplicate").when(v < prev, "out_of_order").when(v > prev + 1, "jump").otherwise("next")
    return rows.withColumn("step", step)


def identity_report(df: DataFrame, keys: list[str], id_col: str, order: str) -> DataFrame:
    """Records, first and last id, duplicates, out-of-order rows, jumps, and the ids that jumps leave out; no claim of loss."""
    steps = arrival_steps(df, keys, id_col, order)
    of = lambda what: F.count_if(F.col("step") == what)
    missing = F.sum(F.when(F.col("step") == "jump", F.col(id_col) - F.col("prev_id") - 1).otherwise(0))
    return steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.min_by(id_col, order).alias("first_id"), F.max_by(id_col, order).alias("last_id"),
        of("duplicate").alias("duplicates"), of("out_of_order").alias("out_of_order"), of("jump").alias("jumps"), missing.alias("missing_sum"),
    )


def strict_violations(df: DataFrame, keys: list[str], id_col: str, order: str) -> DataFrame:
    """Rows whose id is not above the previous one."""
    return arrival_steps(df, keys, id_col, order).where("step in ('duplicate', 'out_of_order')")


def bridge_status(df: DataFrame, keys: list[str], first: str, final: str, order: str, width: int | None = WIDTH) -> DataFrame:
    """Adds bridged: first <= previous final + 1 <= final (the first row of a key is bridged)."""
    prev = F.col("prev_final")
    return carried(df, keys, order, width, prev={"prev_final": F.col(final)}).withColumn("bridged", prev.isNull() | ((F.col(first) <= prev + 1) & (prev + 1 <= F.col(final))))


def contiguity_status(df: DataFrame, keys: list[str], id_col: str, order: str, width: int | None = WIDTH) -> DataFrame:
    """Adds contiguous: id = previous id + 1."""
    prev = F.col("prev_id")
    return carried(df, keys, order, width, prev={"prev_id": F.col(id_col)}).withColumn("contiguous", prev.isNull() | (F.col(id_col) == prev + 1))


def frontier_class(df: DataFrame, keys: list[str], first: str, final: str, order: str, width: int | None = WIDTH) -> DataFrame:
    """Adds expected (one above the highest final so far) and frontier: START, CONTIGUOUS, MISSING, STRADDLE or COVERED."""
    rows = carried(df, keys, order, width, before={"expected": ("max", F.col(final) + 1)})
    a, b, expected = F.col(first), F.col(final), F.col("expected")
    kind = F.when(expected.isNull(), "START").when(b < expected, "COVERED").when(a == expected, "CONTIGUOUS").when(a > expected, "MISSING").otherwise("STRADDLE")
    return rows.withColumn("frontier", kind)


def hash_chain(df: DataFrame, keys: list[str], order: str, digest: str = "record_sha256", previous: str = "previous_record_sha256", genesis: str = ZERO_DIGEST, width: int | None = WIDTH) -> DataFrame:
    """Adds chained: the stored previous digest equals the digest of the row before (genesis for the first)."""
    rows = carried(df, keys, order, width, prev={"_want": F.col(digest)})
    return rows.withColumn("chained", F.col(previous).eqNullSafe(F.coalesce("_want", F.lit(genesis)))).drop("_want")


def valid_prefix(df: DataFrame, keys: list[str], order: str, good: Column, width: int | None = WIDTH) -> DataFrame:
    """Rows before the first one that is not good; everything after it is cut, good or not."""
    bad = F.when(F.coalesce(good, F.lit(False)), 0).otherwise(1)
    return carried(df, keys, order, width, upto={"_bad": ("max", bad)}).where("_bad = 0").drop("_bad")


def trusted_prefix(df: DataFrame, keys: list[str], first: str, final: str, order: str, start: str, width: int | None = WIDTH) -> DataFrame:
    """Rows that bridge without a break from the snapshot id in column start; the first jump ends trust."""
    rows = carried(df, keys, order, width, prev={"_prev": F.col(final)}).withColumn("_prev", F.coalesce("_prev", F.col(start)))
    ok = (F.col(first) <= F.col("_prev") + 1) & (F.col("_prev") + 1 <= F.col(final))
    return valid_prefix(rows, keys, order, ok, width).drop("_prev")


def frame_contiguity(df: DataFrame, keys: list[str], frame: str, order: str | list[str] | None = None, start: int = 0, width: int | None = WIDTH) -> DataFrame:
    """Rows whose frame index is not their position counted from start."""
    rows = positions(df, keys, order or frame, width, "expected_frame").withColumn("expected_frame", F.col("expected_frame") + start)
    return rows.where(F.col(frame) != F.col("expected_frame"))


def segment_transitions(df: DataFrame, keys: list[str], order: str = "segment_index") -> DataFrame:
    """Rows (segment_index, first_frame, last_frame, start_digest, terminal_digest) that do not continue the one before, with the reason."""
    w = by(keys, order)
    last = lambda c: F.lag(c).over(w)
    reason = (
        F.when(last(order).isNull(), None).when(F.col("segment_index") != last("segment_index") + 1, "segment index").when(F.col("first_frame") != last("last_frame") + 1, "frame index")
        .when(~F.col("start_digest").eqNullSafe(last("terminal_digest")), "terminal digest")
    )
    return df.withColumn("reason", reason).where("reason is not null")


def monotone_violations(df: DataFrame, keys: list[str], order: str, counters: list[str], not_above: list[tuple[str, str]] | None = None, width: int | None = WIDTH) -> DataFrame:
    """Rows in which a counter falls, or a counter is above one that bounds it (pairs low, high), with the names of those that do: `low>high` for the latter."""
    rows = carried(df, keys, order, width, prev={f"_was_{c}": F.col(c) for c in counters})
    fallen = [F.when(F.col(c) < F.col(f"_was_{c}"), F.lit(c)) for c in counters] + [F.when(F.col(a) > F.col(b), F.lit(f"{a}>{b}")) for a, b in not_above or []]
    return rows.withColumn("fallen", F.array_compact(F.array(*fallen))).where(F.size("fallen") > 0).drop(*(f"_was_{c}" for c in counters))


def gap_islands(df: DataFrame, keys: list[str], id_col: str, low: int | None = None, high: Column | None = None, width: int | None = WIDTH) -> DataFrame:
    """Missing ids as ranges: keys, first_missing, last_missing, n_missing. Ranges come from neighbours, ids are never listed.

    low and high (an expression constant within a key) add the ranges before the first and after the last id.
    """
    seen = df.groupBy(*keys, id_col).agg(F.first(high if high is not None else F.lit(None).cast("bigint")).alias("_high"))
    rows = carried(seen, keys, id_col, width, prev={"_prev": F.col(id_col)}, nxt={"_next": F.col(id_col)})
    v = F.col(id_col)
    inner = F.struct((v + 1).alias("a"), (F.col("_next") - 1).alias("b"))
    parts = [F.when(F.col("_next") > v + 1, inner)]
    if low is not None:
        parts.append(F.when(F.col("_prev").isNull() & (v > low), F.struct(F.lit(low).cast("bigint").alias("a"), (v - 1).alias("b"))))
    if high is not None:
        parts.append(F.when(F.col("_next").isNull() & (v < F.col("_high")), F.struct((v + 1).alias("a"), F.col("_high").cast("bigint").alias("b"))))
    out = rows.select(*keys, F.explode(F.array_compact(F.array(*parts))).alias("g"))
    return out.select(*keys, F.col("g.a").alias("first_missing"), F.col("g.b").alias("last_missing"), (F.col("g.b") - F.col("g.a") + 1).alias("n_missing"))


def intersect_ranges(a: DataFrame, b: DataFrame, keys: list[str], width: int | None = WIDTH) -> DataFrame:
    """Common parts of two relations of disjoint ranges [first_missing, last_missing], by one ordered pass over the edges of both.

    The edges of all ranges are put in order; between two neighbouring edges a stretch is common where both relations are open. Nothing is listed id by id or
    block by block, so ranges may be of any length.
    """

    def edges(df: DataFrame, side: int) -> DataFrame:
        ends = F.array(F.struct(F.col("first_missing").alias("at"), F.lit(1).alias("d")), F.struct((F.col("last_missing") + 1).alias("at"), F.lit(-1).alias("d")))
        out = df.select(*keys, F.explode(ends).alias("e"))
        return out.select(*keys, "e.at", *(F.when(F.lit(side == i), F.col("e.d")).otherwise(0).cast("bigint").alias(f"d{i}") for i in (0, 1)))

    steps = edges(a, 0).unionByName(edges(b, 1)).groupBy(*keys, "at").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    rows = carried(steps, keys, "at", width, nxt={"until": F.col("at")}, upto={"open0": ("sum", F.col("d0")), "open1": ("sum", F.col("d1"))})
    both = rows.where("open0 > 0 and open1 > 0").select(*keys, F.col("at").alias("first_missing"), (F.col("until") - 1).alias("last_missing"))
    return both.withColumn("n_missing", F.col("last_missing") - F.col("first_missing") + 1)


def runs(df: DataFrame, keys: list[str], order: str, value: str, stamp: str, width: int | None = WIDTH) -> DataFrame:
    """Runs of equal neighbours: keys, value, first and last order, first and last stamp, n."""
    was = carried(df, keys, order, width, prev={"_was": F.struct(F.col(value).alias("v"))})
    change = F.when(F.col("_was").isNotNull() & F.col(value).eqNullSafe(F.col("_was.v")), 0).otherwise(1)
    marked = carried(was, keys, order, width, upto={"_run": ("sum", change)})
    out = marked.groupBy(*keys, "_run", value).agg(F.min(order).alias(f"first_{order}"), F.max(order).alias(f"last_{order}"), F.min(stamp).alias(f"first_{stamp}"), F.max(stamp).alias(f"last_{stamp}"), F.count(F.lit(1)).alias("n"))
    return out.drop("_run")


def published_duplicates(df: DataFrame, keys: list[str], id_col: str, digest: str, order: str, width: int | None = WIDTH) -> DataFrame:
    """Adds disposition against the row before: NEW, DUPLICATE (equal id and digest), CONFLICT (equal id) or STALE (smaller id)."""
    rows = carried(df, keys, order, width, prev={"_pid": F.col(id_col), "_pd": F.col(digest)})
    v, pid = F.col(id_col), F.col("_pid")
    kind = F.when(pid.isNull() | (v > pid), "NEW").when(v < pid, "STALE").when(F.col(digest) == F.col("_pd"), "DUPLICATE").otherwise("CONFLICT")
    return rows.withColumn("disposition", kind).drop("_pid", "_pd")


def floor_chain(segments: DataFrame, keys: list[str], order: str = "segment_index") -> DataFrame:
    """Adds expected_floor (the larger of the previous floor and previous last trade) and floor_ok to rows (floor, last_trade)."""
    w = by(keys, order)
    expected = F.greatest(F.lag("floor").over(w), F.lag("last_trade").over(w))
    return segments.withColumn("expected_floor", expected).withColumn("floor_ok", expected.isNull() | (F.col("floor") == expected))


def homogeneous(df: DataFrame, keys: list[str], identity: list[str]) -> DataFrame:
    """keys, n_identities, homogeneous: one combination of the identity columns only."""
    n = F.count_distinct(F.struct(*identity))
    return df.groupBy(*keys).agg(n.alias("n_identities")).withColumn("homogeneous", F.col("n_identities") == 1)


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def last_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.col(order).desc()).limit(n)
