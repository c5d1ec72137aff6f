"""Set-equality oracles: what was published against raw evidence, and journals against their rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.digests import ZERO_DIGEST
from .ordered import WIDTH, carried


def proven(published: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """Published rows that exist in the evidence."""
    return published.join(evidence.select(*on), on, "left_semi")


def missing(published: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """Evidence that was not published."""
    return evidence.select(*on).distinct().join(published.select(*on), on, "left_anti")


def invented(published: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """Published rows without evidence; several variants of one id in the evidence all count."""
    return published.select(*on).join(evidence.select(*on), on, "left_anti")


def equal_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: only_a, only_b, equal; repeated rows count."""
    cols = a.columns
    left = a.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    right = b.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    cond = [left[c].eqNullSafe(right[c]) for c in cols]
    both = left.join(right, cond, "full_outer").select(F.coalesce("_n", F.lit(0)).alias("n"), F.coalesce("_m", F.lit(0)).alias("m"))
    out = both.agg(F.coalesce(F.sum(F.greatest(F.col("n") - F.col("m"), F.lit(0))), F.lit(0)).alias("only_a"), F.coalesce(F.sum(F.greatest(F.col("m") - F.col("n"), F.lit(0))), F.lit(0)).alias("only_b"))
    return out.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def evidence_map(rows: DataFrame, keys: list[str], id_col: str, digest: str) -> DataFrame:
    """keys, id, evidence (distinct digests, sorted), copies."""
    return rows.groupBy(*keys, id_col).agg(F.sort_array(F.collect_set(digest)).alias("evidence"), F.count(F.lit(1)).alias("copies"))


def covers(frames: DataFrame, points: DataFrame, keys: list[str], point: str, first: str = "first_sequence", final: str = "final_sequence", width: int | None = WIDTH) -> DataFrame:
    """Points with covered: some frame has first <= point <= final.

    Frames and points are put in one order by first id and point; a point is covered if the highest final id of all frames that start at or before it
    reaches it. One running maximum: frames of any length cost one row each.
    """
    kind = dict(points.dtypes)[point]
    f = frames.select(*keys, F.col(first).cast(kind).alias("_at"), F.lit(0).alias("_kind"), F.col(final).cast(kind).alias("_final"))
    p = points.select(*points.columns, F.col(point).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_final"))
    both = carried(p.unionByName(f, allowMissingColumns=True), keys, ["_at", "_kind"], width, upto={"_reach": ("max", F.col("_final"))})
    return both.where("_kind = 1").select(*points.columns, F.coalesce(F.col("_reach") >= F.col(point), F.lit(False)).alias("covered"))


def foreign_keys(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child key values with their number of parents; each should have exactly one."""
    right = parent.groupBy(*(p for _, p in on)).agg(F.count(F.lit(1)).alias("_parents"))
    left = child.groupBy(*(c for c, _ in on)).agg(F.count(F.lit(1)).alias("children"))
    cond = [left[c] == right[p] for c, p in on]
    return left.join(right, cond, "left").select(*(left[c] for c, _ in on), "children", F.coalesce("_parents", F.lit(0)).alias("parents"))


#: The event names of an arbitration journal.
EVENTS = ("ARBITRATION_STARTED", "ARBITRATION_RESUMED", "TRADE_OBSERVATION", "TRADE_LATE_CORRECTION", "TRADE_LAG", "TRADE_CONFLICT", "DEPTH_OBSERVATION", "GAP", "DEPTH_REBOOTSTRAP", "DEPTH_SWITCH_PROVEN", "ARBITRATION_TERMINAL")

#: All payload columns of journal events.
PAYLOAD = (
    "event string, symbol string, trade_floor bigint, previous_journal_sha256 string, mode string, previous_tail_bytes bigint, trade_id bigint, lane string, record_sha256 string, observation_sha256 string, "
    "kind string, buffered bigint, first_sequence bigint, final_sequence bigint, canonical_last_sequence bigint, reason string, generation bigint, snapshot_record_sha256 string, snapshot_last_update_id bigint, "
    "from_lane string, to_lane string, status string, trades bigint, depth_frames bigint, gaps bigint, late_corrections bigint"
)


def journal_context(journal: DataFrame, keys: list[str]) -> DataFrame:
    """What an audit of a later part of a journal needs to know of this part, a row for each key."""
    at = F.col("record_index")
    is_ = lambda name: F.col("event") == name
    depth = is_("DEPTH_OBSERVATION") | is_("GAP") | is_("DEPTH_REBOOTSTRAP")
    state = F.struct(F.col("event").alias("event"), F.col("final_sequence").alias("final"), F.col("lane").alias("lane"), F.col("snapshot_last_update_id").alias("snap"))
    return journal.groupBy(*keys).agg(
        (F.max(at) + 1).alias("c_n"), F.max_by("record_sha256", at).alias("c_prev"), F.max(F.when(is_("ARBITRATION_STARTED") | is_("ARBITRATION_RESUMED"), F.col("trade_floor"))).alias("c_floor"),
        F.max(F.when(is_("TRADE_OBSERVATION"), F.col("trade_id"))).alias("c_last"), F.max_by(F.when(depth, state), F.when(depth, at)).alias("c_depth"),
        F.max_by("final_sequence", F.when(is_("DEPTH_OBSERVATION"), at)).alias("c_cursor"), F.bool_or(is_("ARBITRATION_TERMINAL")).alias("c_ended"),
        F.count_if(is_("TRADE_OBSERVATION")).alias("c_t"), F.count_if(is_("DEPTH_OBSERVATION")).alias("c_d"), F.count_if(is_("GAP")).alias("c_g"), F.count_if(is_("TRADE_LATE_CORRECTION")).alias("c_c"),
    )


def journal_violations(journal: DataFrame, keys: list[str], context: DataFrame | None = None, width: int | None = WIDTH) -> DataFrame:
    """All rule breaks of arbitration journals: keys, record_index, rule, in order by record_index.

    context: journal_context of the part before, if journal holds later records only; the result is the same as of an audit of the whole.

    journal: keys, record_index, previous_record_sha256, record_sha256 and payload columns (see PAYLOAD). Rules: known event; record index from 0 without
    gaps; hash chain; starts with a start event; nothing after the terminal; published trades rise; depth continues exactly, except after GAP or start; GAP
    states the current cursor; REBOOTSTRAP follows GAP; the next frame's lane and first id fit the rebootstrap; terminal counters equal the events seen.
    """
    if context is not None:
        journal = journal.join(context, keys, "left")
    known = lambda name, otherwise: F.coalesce(F.col(name), otherwise) if context is not None else otherwise
    ev = F.col("event")
    is_ = lambda name: ev == name
    depth_event = F.when(is_("DEPTH_OBSERVATION") | is_("GAP") | is_("DEPTH_REBOOTSTRAP"), F.struct(ev.alias("event"), F.col("final_sequence").alias("final"), F.col("lane").alias("lane"), F.col("snapshot_last_update_id").alias("snap")))
    one = lambda cond: ("sum", F.when(cond, 1).otherwise(0).cast("bigint"))
    before = {
        "_n": ("sum", F.lit(1).cast("bigint")), "_floor": ("max", F.when(is_("ARBITRATION_STARTED") | is_("ARBITRATION_RESUMED"), F.col("trade_floor"))),
        "_last": ("max", F.when(is_("TRADE_OBSERVATION"), F.col("trade_id"))), "_depth": ("last", depth_event), "_cursor": ("last", F.when(is_("DEPTH_OBSERVATION"), F.col("final_sequence"))),
        "_ends": ("max", F.when(is_("ARBITRATION_TERMINAL"), 1).otherwise(0)), "_t": one(is_("TRADE_OBSERVATION")), "_d": one(is_("DEPTH_OBSERVATION")), "_g": one(is_("GAP")), "_c": one(is_("TRADE_LATE_CORRECTION")),
    }
    rows = carried(journal, keys, "record_index", width, prev={"_prev": F.col("record_sha256")}, before=before)
    zero = F.lit(0).cast("bigint")
    plus = {"_n": "c_n", "_t": "c_t", "_d": "c_d", "_g": "c_g", "_c": "c_c"}
    rows = rows.withColumns({n: F.coalesce(F.col(n), zero) + known(c, zero) for n, c in plus.items()})
    rows = rows.withColumn("_prev", F.coalesce("_prev", known("c_prev", F.lit(ZERO_DIGEST)))).withColumn("_ended", F.coalesce(F.col("_ends") == 1, F.lit(False)) | known("c_ended", F.lit(False)))
    if context is not None:
        rows = rows.withColumns({"_floor": F.greatest("_floor", "c_floor"), "_last": F.greatest("_last", "c_last"), "_depth": F.coalesce("_depth", "c_depth"), "_cursor": F.coalesce("_cursor", "c_cursor")})
    d = F.col("_depth")
    rules = {
        "unknown event": ~ev.isin(*EVENTS),
        "record index": F.col("record_index") != F.col("_n"),
        "hash chain": ~F.col("previous_record_sha256").eqNullSafe(F.col("_prev")),
        "no start": (F.col("_n") == 0) & ~ev.isin("ARBITRATION_STARTED", "ARBITRATION_RESUMED"),
        "second start": (F.col("_n") > 0) & (ev == "ARBITRATION_STARTED"),
        "after terminal": F.col("_ended"),
        "trade order": is_("TRADE_OBSERVATION") & (F.col("trade_id") <= F.coalesce("_last", F.lit(-1))),
        "trade below floor": is_("TRADE_OBSERVATION") & (F.col("trade_id") <= F.col("_floor")),
        "correction above published": is_("TRADE_LATE_CORRECTION") & (F.col("trade_id") > F.coalesce("_last", F.lit(-1))),
        "unknown correction below floor": is_("TRADE_LATE_CORRECTION") & (F.col("kind") == "unknown") & (F.col("trade_id") <= F.col("_floor")),
        "depth continuity": is_("DEPTH_OBSERVATION") & (d["event"] == "DEPTH_OBSERVATION") & (F.col("first_sequence") != d["final"] + 1),
        "depth after gap without rebootstrap": is_("DEPTH_OBSERVATION") & (d["event"] == "GAP"),
        "rebootstrap lane": is_("DEPTH_OBSERVATION") & (d["event"] == "DEPTH_REBOOTSTRAP") & (F.col("lane") != d["lane"]),
        "rebootstrap bridge": is_("DEPTH_OBSERVATION") & (d["event"] == "DEPTH_REBOOTSTRAP") & (F.col("final_sequence") <= d["snap"]),
        "gap cursor": is_("GAP") & ~F.col("canonical_last_sequence").eqNullSafe(F.col("_cursor")),
        "rebootstrap without gap": is_("DEPTH_REBOOTSTRAP") & ~F.coalesce(d["event"] == "GAP", F.lit(False)),
        "terminal counters": is_("ARBITRATION_TERMINAL") & ((F.col("trades") != F.col("_t")) | (F.col("depth_frames") != F.col("_d")) | (F.col("gaps") != F.col("_g")) | (F.col("late_corrections") != F.col("_c"))),
    }
    broken = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items())))
    return rows.select(*keys, "record_index", F.explode(broken).alias("rule"))


def strict(violations: DataFrame, order: list[str]) -> None:
    """Raise on the first violation in order; used where a caller wants to stop instead of listing."""
    first = violations.orderBy(*order).first()
    if first is not None:
        raise ValueError(f"verification failed: {first.asDict()}")


def verify_depth(journal: DataFrame, raw_frames: DataFrame, keys: list[str]) -> DataFrame:
    """keys, unproven, omitted: published depth against raw frames (keys, lane, first_sequence, final_sequence, observation_sha256).

    unproven: published frames that no raw variant of the same lane, ids and digest proves. omitted: final ids of raw frames, above the first published one and up to
    the last, that no published frame covers and that no recorded gap (reason with canonical_last_sequence, up to the next published first id) explains.
    """
    on = [*keys, "lane", "final_sequence", "first_sequence", "observation_sha256"]
    shown = journal.where("event = 'DEPTH_OBSERVATION'").select(*on)
    unproven = invented(shown, raw_frames, on).groupBy(*keys).agg(F.count(F.lit(1)).alias("unproven"))
    ends = shown.groupBy(*keys).agg(F.min("first_sequence").alias("_low"), F.max("final_sequence").alias("_high"))
    opened = carried(journal.where("event in ('DEPTH_OBSERVATION', 'GAP')"), keys, "record_index", nxt={"_next": F.when(F.col("event") == "DEPTH_OBSERVATION", F.col("first_sequence"))})
    gaps = opened.where("event = 'GAP'").select(*keys, (F.col("canonical_last_sequence") + 1).alias("first_sequence"), (F.coalesce("_next", F.lit(2**62)) - 1).alias("final_sequence"))
    points = raw_frames.select(*keys, "final_sequence").distinct().join(ends, keys).where("final_sequence > _low and final_sequence <= _high").select(*keys, F.col("final_sequence").alias("point"))
    left = covers(shown.select(*keys, "first_sequence", "final_sequence").unionByName(gaps), points, keys, "point").where("not covered")
    omitted = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("omitted"))
    out = ends.select(*keys).join(unproven, keys, "left").join(omitted, keys, "left")
    return out.select(*keys, F.coalesce("unproven", F.lit(0)).cast("bigint").alias("unproven"), F.coalesce("omitted", F.lit(0)).cast("bigint").alias("omitted"))


def verify_union(journal: DataFrame, raw_trades: DataFrame, keys: list[str]) -> DataFrame:
    """keys, missing, invented: published trades and unknown corrections against the distinct raw union above the floor."""
    floors = journal.where("event in ('ARBITRATION_STARTED', 'ARBITRATION_RESUMED')").groupBy(*keys).agg(F.min("trade_floor").alias("_floor"))
    shown = journal.where("event = 'TRADE_OBSERVATION' or (event = 'TRADE_LATE_CORRECTION' and kind = 'unknown')").select(*keys, "trade_id", "observation_sha256").distinct()
    raw = raw_trades.join(floors, keys).where(F.col("_floor").isNull() | (F.col("trade_id") > F.col("_floor"))).select(*keys, "trade_id", "observation_sha256").distinct()
    tag = raw.withColumn("_r", F.lit(1)).join(shown.withColumn("_s", F.lit(1)), [*keys, "trade_id", "observation_sha256"], "full_outer")
    return tag.groupBy(*keys).agg(F.count_if(F.col("_s").isNull()).alias("missing"), F.count_if(F.col("_r").isNull()).alias("invented"))
