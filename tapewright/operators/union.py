"""Two-lane and layered unions: distinct publication by id, watermark, late corrections, conflicts, lane switches.

The batch form of the watermark union is relational. A lane's cursor is its highest id + 1 so far; the watermark is the smaller of the lanes'
cursors, 0 until all lanes were seen; a lane that was excluded no longer counts. It never falls, so the arrival at which it passes an id is a running value over
ids and watermark steps in one order, and the last id published before an arrival is one more. Each is split within a hot key by `ordered.carried`; the
three steps are written to the shared folder, so that none is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle
from .ordered import WIDTH, carried


def distinct_union(rows: DataFrame, keys: list[str], id_col: str, lane: str, arrival: str, digest: str, floor: int | None = None) -> DataFrame:
    """One row an id above the floor: keys, id, first_lane, first_arrival, digest of the first arrival, copies, conflict."""
    kept = rows if floor is None else rows.where(F.col(id_col) > floor)
    out = kept.groupBy(*keys, id_col).agg(
        F.min_by(lane, arrival).alias("first_lane"), F.min(arrival).alias("first_arrival"), F.min_by(digest, arrival).alias("digest"),
        F.count(F.lit(1)).alias("copies"), (F.min(digest) != F.max(digest)).alias("conflict"),
    )
    return out


def conflicts(rows: DataFrame, keys: list[str], id_col: str, digest: str) -> DataFrame:
    """Ids that arrived with more than one digest: keys, id, digests, copies."""
    out = rows.groupBy(*keys, id_col).agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"), F.count_distinct(digest).alias("digests"), F.count(F.lit(1)).alias("copies"))
    return out.where("_lo <> _hi").drop("_lo", "_hi")


def watermark(
    rows: DataFrame, keys: list[str], id_col: str, lane: str, arrival: str, lanes: list[str], clamps: dict[str, int] | None = None, excluded: DataFrame | None = None, width: int | None = WIDTH
) -> DataFrame:
    """Adds watermark: the smallest cursor of all lanes after the row, 0 while a lane has not been seen; clamps bound lanes from above.

    excluded: (keys, lane, excluded_at), one row a lane at most; from that arrival on the lane does not hold the watermark back (all lanes excluded: it stays 0).
    """
    names = {f"_c{i}": ("max", F.when(F.col(lane) == name, F.col(id_col) + 1)) for i, name in enumerate(lanes)}
    out = carried(rows, keys, arrival, width, upto=names)
    if excluded is not None:
        per = excluded.groupBy(*keys).agg(*(F.min(F.when(F.col(lane) == name, F.col("excluded_at"))).alias(f"_x{i}") for i, name in enumerate(lanes)))
        out = out.join(per, keys, "left")
    cursors = []
    for i, name in enumerate(lanes):
        seen = F.least(F.col(f"_c{i}"), F.lit(clamps[name])) if clamps and name in clamps else F.col(f"_c{i}")
        held = F.coalesce(seen, F.lit(0)).cast("bigint")
        cursors.append(held if excluded is None else F.when(F.coalesce(F.col(arrival) >= F.col(f"_x{i}"), F.lit(False)), F.lit(None).cast("bigint")).otherwise(held))
    mark = F.least(*cursors) if len(cursors) > 1 else cursors[0]
    out = out.withColumn("watermark", F.coalesce(mark, F.lit(0).cast("bigint")))
    return out.select(*rows.columns, "watermark")


def watermark_union(
    rows: DataFrame, keys: list[str], id_col: str, lane: str, arrival: str, digest: str, lanes: list[str], floor: int | None = None, clamps: dict[str, int] | None = None, excluded: DataFrame | None = None, width: int | None = WIDTH
) -> DataFrame:
    """Every arrival with its disposition and, for the first arrival of a published id, the arrival that released it.

    disposition: IGNORED (id at or below the floor), BUFFERED (first arrival, later published), DUPLICATE, CONFLICT, LATE_DUPLICATE, LATE_CONFLICT,
    LATE_UNKNOWN (below what is published and never published). emitted_at is null where only the end of the stream releases an id.
    """
    above = rows if floor is None else rows.where(F.col(id_col) > floor)
    marked = watermark(above, keys, id_col, lane, arrival, lanes, clamps, excluded, width)
    own = Window.partitionBy(*keys, id_col)
    out = settle(marked.withColumns({"_fa": F.min(arrival).over(own), "_fd": F.first(digest).over(own.orderBy(arrival))}), "union-marked")

    # When the watermark passes an id: ids and watermark steps in one order by value, the largest first.
    ids = F.struct((-F.col(id_col)).cast("bigint").alias("v"), F.lit(0).alias("kind"))
    steps = F.struct((-F.col("watermark")).alias("v"), F.lit(1).alias("kind"))
    both = out.withColumn("_e", F.explode(F.array(ids, steps))).select("*", F.col("_e.v").alias("_v"), F.col("_e.kind").alias("_kind")).drop("_e")
    both = carried(both, keys, ["_v", "_kind"], width, upto={"_pass": ("min", F.when(F.col("_kind") == 1, F.col(arrival)))}).where("_kind = 0")
    # Without a watermark above it, an id waits for the end.
    out = settle(both.withColumn("_ea", F.when(F.col("_pass").isNotNull(), F.greatest("_fa", "_pass"))).drop("_v", "_kind", "_pass"), "union-passed")

    # What was published before an arrival: arrivals and releases in one order, arrivals first.
    first = F.col(arrival) == F.col("_fa")
    here = F.struct(F.col(arrival).cast("bigint").alias("p"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"))
    release = F.struct(F.col("_ea").cast("bigint").alias("p"), F.lit(1).alias("kind"), F.col(id_col).cast("bigint").alias("id"))
    both = out.withColumn("_r", F.explode(F.array_compact(F.array(here, F.when(first & F.col("_ea").isNotNull(), release)))))
    both = both.select("*", F.col("_r.p").alias("_p"), F.col("_r.kind").alias("_kind"), F.col("_r.id").alias("_rid")).drop("_r")
    out = carried(both, keys, ["_p", "_kind"], width, upto={"_last": ("max", F.col("_rid"))}).where("_kind = 0").withColumn("_late", F.coalesce(F.col(id_col) <= F.col("_last"), F.lit(False)))

    # An id counts as published if its first arrival was not late.
    out = out.withColumn("_known", F.max(F.when(first & ~F.col("_late"), 1).otherwise(0)).over(own) == 1)
    same = F.col(digest) == F.col("_fd")
    kind = (
        F.when(F.col("_late") & ~F.col("_known") & first, "LATE_UNKNOWN").when(F.col("_late") & same, "LATE_DUPLICATE").when(F.col("_late"), "LATE_CONFLICT")
        .when(first, "BUFFERED").when(same, "DUPLICATE").otherwise("CONFLICT")
    )
    out = out.select(*rows.columns, kind.alias("disposition"), F.when(kind == "BUFFERED", F.col("_ea")).alias("emitted_at"))
    if floor is None:
        return out
    below = rows.where(F.col(id_col) <= floor).withColumn("disposition", F.lit("IGNORED")).withColumn("emitted_at", F.lit(None).cast(out.schema["emitted_at"].dataType))
    return out.unionByName(below)


def published(dispositions: DataFrame) -> DataFrame:
    """The rows of watermark_union that are published, once an id."""
    return dispositions.where("disposition = 'BUFFERED'")


def layered(sources: list[tuple[str, DataFrame]], keys: list[str], id_col: str) -> DataFrame:
    """Rows of several sources, one an id; the first source that has it gives its provenance. All sources have the same columns."""
    rows = None
    for rank, (name, df) in enumerate(sources):
        tagged = df.withColumn("provenance", F.lit(name)).withColumn("_rank", F.lit(rank))
        rows = tagged if rows is None else rows.unionByName(tagged)
    w = Window.partitionBy(*keys, id_col).orderBy("_rank")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_rank")


def depth_switches(frames: DataFrame, keys: list[str], expected: str = "expected") -> DataFrame:
    """How a depth lane may go on in its sibling: keys, verdict.

    frames: keys, expected (next id wanted), converged (books equal at the boundary), first_id and final_id of the sibling's rows that cover or
    follow expected, in order by final_id. Verdict: switch, dual_loss (none, not contiguous or not reaching), unprovable_continuation (not starting
    exactly) or sibling_book_diverges.
    """
    w = Window.partitionBy(*keys).orderBy("final_id")
    broken = F.lag("final_id").over(w).isNotNull() & (F.col("first_id") != F.lag("final_id").over(w) + 1)
    rows = frames.withColumn("_broken", broken & F.col("first_id").isNotNull())
    sums = rows.groupBy(*keys).agg(
        F.count("first_id").alias("_n"), F.bool_or("_broken").alias("_broken"), F.min("first_id").alias("_first"), F.max("final_id").alias("_reach"),
        F.max(expected).alias("_want"), F.max(F.coalesce(F.col("wanted_to"), F.col(expected))).alias("_to"), F.bool_and("converged").alias("_same"),
    )
    verdict = (
        F.when((F.col("_n") == 0) | F.col("_broken") | (F.col("_reach") < F.col("_to")), "dual_loss").when(F.col("_first") != F.col("_want"), "unprovable_continuation")
        .when(~F.coalesce(F.col("_same"), F.lit(False)), "sibling_book_diverges").otherwise("switch")
    )
    return sums.select(*keys, verdict.alias("verdict"))


def lag_exclusion(rows: DataFrame, keys: list[str], lane: str, arrival: str, mono_ns: str, lanes: list[str], horizon_ns: int = 60_000_000_000, cap: int = 65_536, width: int | None = WIDTH) -> DataFrame:
    """keys, lane, excluded_at (arrival), reason: the first arrival of any lane at which a lane is to be excluded, for watermark's `excluded`.

    A lane is judged by the other lanes' clock: no row of its own for the horizon ('no durable advance'), or more than `cap` rows of the others since its last one
    ('buffer cap'). A lane that has not been seen is judged from the first row of the key.
    """
    numbered = carried(rows, keys, arrival, width, upto={"_n": ("sum", F.lit(1).cast("bigint")), "_start": ("min", F.col(mono_ns))})
    now, upto = F.col(mono_ns), {}
    for i, name in enumerate(lanes):
        own = F.col(lane) == name
        upto |= {f"_t{i}": ("max", F.when(own, now)), f"_k{i}": ("max", F.when(own, F.col("_n")))}
    seen = carried(numbered, keys, arrival, width, upto=upto)
    out = None
    for i, name in enumerate(lanes):
        idle = now - F.coalesce(F.col(f"_t{i}"), F.col("_start"))
        reason = F.when(idle >= horizon_ns, "no durable advance").when(F.col("_n") - F.coalesce(F.col(f"_k{i}"), F.lit(0)) > cap, "buffer cap")
        late = seen.withColumn("_why", reason).where("_why is not null").groupBy(*keys).agg(F.min(F.struct(F.col(arrival).alias("at"), F.col("_why").alias("why"))).alias("x"))
        late = late.select(*keys, F.lit(name).alias(lane), F.col("x.at").alias("excluded_at"), F.col("x.why").alias("reason"))
        out = late if out is None else out.unionByName(late)
    return out


def newest_ids(df: DataFrame, id_col: str, n: int = 65_536) -> DataFrame:
    """The newest n identities: a bounded retention."""
    return df.orderBy(F.col(id_col).desc()).limit(n)


def identity_log(old: DataFrame | None, batch: DataFrame, keys: list[str], id_col: str, digest: str) -> DataFrame:
    """The log of identities (keys, id, digest) after a batch, with disposition of the batch's ids: NEW, KNOWN (equal digest) or CONFLICT; old ids are LOGGED.

    An identity keeps the digest it was first logged with. Both sides meet on keys and id; the log itself needs no order, as the engine looks identities up by join.
    """
    new = batch.groupBy(*keys, id_col).agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"))
    if old is None:
        kind = F.when(F.col("_lo") == F.col("_hi"), "NEW").otherwise("CONFLICT")
        return new.select(*keys, id_col, F.col("_lo").alias(digest), kind.alias("disposition"))
    both = old.select(*keys, id_col, F.col(digest).alias("_old")).join(new, [*keys, id_col], "full_outer")
    kind = (
        F.when(F.col("_lo").isNull(), "LOGGED").when(F.col("_lo") != F.col("_hi"), "CONFLICT").when(F.col("_old").isNull(), "NEW").when(F.col("_old") == F.col("_lo"), "KNOWN").otherwise("CONFLICT")
    )
    return both.select(*keys, id_col, F.coalesce("_old", "_lo").alias(digest), kind.alias("disposition"))


def generation_order(generations: DataFrame, keys: list[str], start: str, lane: str, lanes: list[str], sequence: str) -> DataFrame:
    """generations with position: their order by start time over all lanes; of equal starts the lane that is listed first, then the smaller sequence."""
    rank = F.array_position(F.array(*(F.lit(x) for x in lanes)), F.col(lane))
    return generations.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(start, rank, sequence)) - 1)
