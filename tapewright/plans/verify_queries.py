"""Queries of the verifiers: artifacts made from the events, one fault each by their number, against the rules that must break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import oracle, verify
from ..operators.ordered import carried
from .feed import FEED, feed
from .queries import query

KEYS = ["sym", "block"]
#: Ids of a symbol that make one artifact.
SPAN = 64
GROUPS = f"{FEED}, g as (select distinct sym, id // {SPAN} as block from feed)"


def groups(spark, d, kinds: int) -> DataFrame:
    """sym, block and the number of the fault of every artifact."""
    return feed(spark, d).select("sym", F.expr(f"id div {SPAN}").alias("block")).distinct().withColumn("fault", (F.col("sym") * 5 + F.col("block") * 3) % kinds)


def expected(kinds: int, rules: list[tuple[int, str]]) -> str:
    """SQL: the rules that the faults break."""
    values = ", ".join(f"({n}, '{rule}')" for n, rule in rules)
    return f"with {GROUPS}, f(fault, rule) as (values {values}) select sym, block, rule from g join f on f.fault = (sym * 5 + block * 3) % {kinds}"


def on(fault: int, wrong, right) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(F.col("fault") == fault, lit(wrong)).otherwise(lit(right))


def each(df: DataFrame, name: str, values) -> DataFrame:
    return df.withColumn(name, F.explode(F.array(*(F.lit(v) for v in values))))


def text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def chain(rows: DataFrame, order: str = "record_index", fault: int | None = None) -> DataFrame:
    """rows with digests of their place, chained; the fault spoils the link of the third record."""
    rows = rows.withColumn("record_sha256", F.sha2(text("r", F.col("sym"), ":", F.col("block"), ":", F.col(order)), 256))
    rows = carried(rows, KEYS, order, None, prev={"_before": F.col("record_sha256")})
    link = F.coalesce("_before", F.repeat(F.lit("0"), 64))
    wrong = (F.col("fault") == fault) & (F.col(order) == 2) if fault is not None else F.lit(False)
    return rows.withColumn("previous_record_sha256", F.when(wrong, F.repeat(F.lit("f"), 64)).otherwise(link)).drop("_before")


@query(expected(15, [
    (1, "generation status is not COMPLETE"), (2, "segment duration exceeds generation duration"), (3, "generation wall-clock bounds are invalid"), (4, "generation must contain exactly depth and trade streams"),
    (5, "generation stream connection epochs are not unique"), (6, "terminal counts are inconsistent"), (7, "terminal transport status is not clean"), (8, "segment records differ from its frames"),
    (8, "sealed segments differ from the stream''s records"), (9, "segment chain: terminal digest"), (10, "segment has no durability ACK"), (11, "durability ACK does not match the exact file"),
    (12, "telemetry record index is not contiguous"), (12, "telemetry monotonic lineage regressed"), (13, "telemetry monotonic lineage regressed"), (14, "telemetry record counters are invalid"),
]))
def generation_verification(spark, d):
    g = groups(spark, d, 15)
    c = F.col
    generations = g.select(*KEYS, on(1, "FAILED", "COMPLETE").alias("status"), on(2, 1_000, 10).alias("segment_ns"), F.lit(100).alias("duration_ns"), (c("block") * 100).alias("started_ns"), (c("block") * 100 + on(3, 50, 100)).alias("finished_ns"))
    both = each(g, "stream", ["depth", "trade"])
    streams = both.where("not (fault = 4 and stream = 'trade')").select(*KEYS, "stream", on(5, F.lit("c"), c("stream")).alias("connection_epoch"), F.lit(32).alias("records"), on(6, 33, 32).alias("received"), on(7, "FAILED", "STOPPED").alias("transport_status"))
    parts = each(both, "segment_index", range(4))
    i = c("segment_index")
    short = (c("fault") == 8) & (i == 2) & (c("stream") == "depth")
    segments = parts.select(*KEYS, "stream", "segment_index", (i * 8).alias("first_frame"), (i * 8 + 7).alias("last_frame"), F.when(short, 7).otherwise(8).alias("records"), F.when((c("fault") == 9) & (i == 1), "x").otherwise(text("d", i)).alias("start_digest"), text("d", i + 1).alias("terminal_digest"))
    acks = parts.where("not (fault = 10 and segment_index = 3)").select(*KEYS, "stream", "segment_index", F.lit(100).alias("ack_offset"), F.lit(100).alias("file_bytes"), F.when((c("fault") == 11) & (i == 0), "y").otherwise("x").alias("ack_sha256"), F.lit("x").alias("file_sha256"))
    ticks = each(g, "t", range(5))
    t = c("t")
    frames = t * 10 - F.when((c("fault") == 13) & (t == 3), 25).otherwise(0)
    telemetry = ticks.select(*KEYS, F.when((c("fault") == 12) & (t == 3), 7).otherwise(t).cast("bigint").alias("tick"), frames.alias("frames"), (F.least(frames, t * 10) + F.when((c("fault") == 14) & (t == 4), 1).otherwise(0)).alias("acks"))
    return verify.generation(generations, streams, segments, acks, telemetry, KEYS, ["frames", "acks"], [("acks", "frames")])


@query(expected(9, [
    (1, "generation numbers are not contiguous"), (1, "no convergence can be derived"), (2, "generations do not overlap"), (3, "connection epoch was reused"), (4, "handover is missing"), (5, "handover without a successor"),
    (6, "handover boundary differs from its derivation"), (7, "common range differs"), (8, "no convergence can be derived"), (8, "common range differs"),
]))
def campaign_verification(spark, d):
    g = groups(spark, d, 9)
    c = F.col
    three = each(g, "k", range(3)).withColumn("generation", F.when((c("fault") == 1) & (c("k") == 2), 3).otherwise(c("k")).cast("bigint"))
    k = c("k")
    late = F.when((c("fault") == 2) & (k == 2), 50).otherwise(0)
    generations = three.select(*KEYS, "generation", (k * 100 + late).alias("started_ns"), (k * 100 + 130).alias("finished_ns"), F.when((c("fault") == 3) & (k > 0), F.lit("e")).otherwise(text("e", k)).alias("epoch"))
    handovers = three.where("k > 0 and not (fault = 4 and k = 2)").select(*KEYS, "generation", (k * 10 + 5 - on(6, 1, 0)).cast("bigint").alias("boundary"))
    extra = g.where("fault = 5").select(*KEYS, F.lit(7).cast("bigint").alias("generation"), F.lit(1).cast("bigint").alias("boundary"))
    seen = each(three, "j", range(16)).withColumn("n", (k * 10 + c("j")).cast("bigint"))
    other = ((c("fault") == 7) & (k == 1) & (c("n") == 12)) | ((c("fault") == 8) & (k == 2) & (c("j") < 6))
    observations = seen.select(*KEYS, "generation", c("n").alias("frame_index"), c("n").alias("first_sequence"), c("n").alias("final_sequence"), F.sha2(text(F.when(other, "x").otherwise("o"), c("n")), 256).alias("observation_sha256"))
    return verify.campaign(generations, handovers.unionByName(extra), observations, KEYS)


@query(expected(12, [
    (1, "startup and terminal contract is invalid"), (2, "hash chain is invalid"), (3, "opened gap is invalid"), (3, "terminal gaps differ from durable events"), (4, "closed gap is invalid"), (4, "terminal gaps differ from durable events"), (5, "terminal gaps differ from durable events"),
    (6, "terminal status contradicts gaps"), (7, "lane launch is invalid or duplicated"), (8, "lane readiness is invalid or duplicated"), (9, "lane outcome is invalid or duplicated"), (10, "lane run is invalid, reused, or unlaunched"),
    (11, "a launched run is omitted or a lane never completed"),
]))
def redundant_verification(spark, d):
    g = groups(spark, d, 12)
    c = F.col
    startups = g.select(*KEYS, F.lit("s").alias("supervisor_id"), F.lit(1_000).alias("total_s"), F.lit(60).alias("primary_rotation_s"), on(1, 60, 90).alias("shadow_rotation_s"), F.lit(30).alias("overlap_s"), F.lit(30).alias("segment_s"), F.lit(5).alias("started_ns"))
    terminals = g.select(*KEYS, F.lit("s").alias("supervisor_id"), F.lit(99).alias("finished_ns"), F.lit("TERMINAL").alias("final_coverage"), on(6, "COMPLETE_NO_DUAL_OUTAGE", "COMPLETE_WITH_EXPLICIT_GAPS").alias("status"), on(5, 2, 1).alias("gaps"), F.lit(7).alias("unavailable_ns"))
    events = [("LANE_LAUNCHED", "r1"), ("LANE_READY", "r1"), ("LANE_LAUNCHED", "r2"), ("LANE_READY", "r2"), ("GAP_OPENED", None), ("GAP_CLOSED", None), ("LANE_DONE", "r1"), ("LANE_DONE", "r2"), ("NOTE", None)]
    rows = g.withColumn("e", F.explode(F.array(*(F.struct(F.lit(i).alias("record_index"), F.lit(name).alias("event"), F.lit(run).cast("string").alias("run_id")) for i, (name, run) in enumerate(events)))))
    rows = rows.select(*KEYS, "fault", "e.*").withColumn("record_index", c("record_index").cast("bigint"))
    # What a fault makes of the last, free record, or takes away.
    last = c("record_index") == 8
    turned = {7: ("LANE_LAUNCHED", "r1"), 8: ("LANE_READY", "r2"), 9: ("LANE_DONE", "r1")}
    for fault, (event, run) in turned.items():
        hit = last & (c("fault") == fault)
        rows = rows.withColumn("event", F.when(hit, event).otherwise(c("event"))).withColumn("run_id", F.when(hit, run).otherwise(c("run_id")))
    rows = rows.withColumn("event", F.when((c("fault") == 3) & (c("event") == "GAP_OPENED"), "NOTE").when((c("fault") == 11) & (c("event") == "LANE_DONE") & (c("run_id") == "r2"), "NOTE").otherwise(c("event")))
    closed = F.when(c("fault") == 4, 33).otherwise(47)
    rows = rows.withColumn("mono_ns", F.when(c("event") == "GAP_OPENED", 40).when(c("event") == "GAP_CLOSED", closed).otherwise(c("record_index")).cast("bigint")).withColumn("gap_id", F.when(c("event").startswith("GAP"), "g"))
    runs = each(g, "run_id", ["r1", "r2"]).select(*KEYS, "run_id").unionByName(g.where("fault = 10").select(*KEYS, F.lit("r9").alias("run_id")))
    return verify.redundant(startups, terminals, chain(rows, fault=2), runs, KEYS)


@query(expected(12, [
    (1, "preflight and terminal identities disagree"), (2, "preflight and terminal mode/clock contracts disagree"), (3, "service journal chain/index/monotonic order is invalid"), (4, "service journal chain/index/monotonic order is invalid"),
    (5, "observer coverage has a gap or a window outside the required interval"), (6, "more than two observer windows overlap"), (7, "observer coverage lacks its exact required interval"), (8, "observer coverage ends before capture stopped"),
    (9, "observer window identity was reused"), (10, "raw artifact was admitted twice"), (11, "expected artifacts differ from independently journalled admissions"),
]))
def service_verification(spark, d):
    g = groups(spark, d, 12)
    c = F.col
    preflights = g.select(*KEYS, F.lit("bounded").alias("mode"), F.lit(100).alias("total_s"), F.lit("PASS").alias("status"))
    terminals = g.select(*KEYS, on(2, "continuous", "bounded").alias("mode"), on(1, 90, 100).alias("requested_s"), F.lit(10).alias("started_ns"), F.lit(100).alias("finished_ns"))
    rows = each(g, "i", range(6)).select(*KEYS, "fault", c("i").cast("bigint").alias("record_index"), (c("i") * 10 - F.when((c("fault") == 4) & (c("i") == 5), 30).otherwise(0)).cast("bigint").alias("mono_ns"))
    w = each(g, "i", range(4))
    i = c("i")
    ready = i * 25 + F.when((c("fault") == 5) & (i == 2), 8).when((c("fault") == 6) & (i == 2), -24).when((c("fault") == 7) & (i == 0), 12).otherwise(0)
    stop = i * 25 + 30 + F.when((c("fault") == 6) & (i == 1), -1).when((c("fault") == 8) & (i == 3), -10).otherwise(0)
    windows = w.select(*KEYS, F.when((c("fault") == 9) & (i == 3), F.lit("w0")).otherwise(text("w", i)).alias("window_id"), ready.cast("bigint").alias("ready_ns"), stop.cast("bigint").alias("stop_ns"))
    named = each(g, "i", range(3)).withColumn("artifact", text("a", i))
    admitted = named.select(*KEYS, "artifact", F.lit("x").alias("artifact_sha256")).unionByName(g.where("fault = 10").select(*KEYS, F.lit("a1").alias("artifact"), F.lit("x").alias("artifact_sha256")))
    wanted = named.select(*KEYS, "artifact", F.when((c("fault") == 11) & (i == 2), "y").otherwise("x").alias("artifact_sha256"))
    return verify.service(preflights, terminals, chain(rows, fault=3), windows, admitted, wanted, KEYS)


@query(expected(5, [(1, "report names no terminal"), (2, "report names several terminals"), (3, "terminal names no manifest"), (4, "terminal names several manifests")]))
def report_bindings(spark, d):
    g = groups(spark, d, 5)
    reports = g.select(*KEYS, on(1, "other", "t").alias("terminal_sha256"))
    terminals = g.select(*KEYS, F.lit("t").alias("terminal_sha256"), on(3, "none", "m").alias("manifest_sha256"))
    manifests = g.select(*KEYS, F.lit("m").alias("manifest_sha256"))
    return verify.bindings(reports, terminals.unionByName(terminals.join(g.where("fault = 2"), KEYS, "left_semi")), manifests.unionByName(manifests.join(g.where("fault = 4"), KEYS, "left_semi")), KEYS)


@query(f"with {GROUPS}, v as (select *, (sym * 5 + block * 3) % 4 as fault from g) select sym, block, case when fault in (1, 3) then 1 else 0 end::BIGINT as unproven, case when fault = 2 then 1 else 0 end::BIGINT as omitted from v")
def depth_oracle(spark, d):
    """Published depth against raw frames of two lanes: a frame that no variant proves, a final id left out, a gap that explains one."""
    g = groups(spark, d, 4)
    c = F.col
    ids = each(g, "n", range(12))
    digest = lambda lane: F.sha2(text(lane, c("n")), 256)
    frame = [(c("n") * 2 + 1).cast("bigint").alias("first_sequence"), (c("n") * 2 + 2).cast("bigint").alias("final_sequence")]
    raw = None
    for lane in ("P", "S"):
        one = ids.select(*KEYS, F.lit(lane).alias("lane"), *frame, digest(lane).alias("observation_sha256"))
        raw = one if raw is None else raw.unionByName(one)
    # Fault 1: a digest of the other lane. Fault 2: one frame is left out. Fault 3: a frame of the other lane's digest inside a gap's far side, and the gap explains the one left out.
    left_out = F.col("fault").isin(2, 3) & (c("n") == 5)
    shown = ids.where(~left_out).select(*KEYS, (c("n") * 2).cast("bigint").alias("record_index"), F.lit("DEPTH_OBSERVATION").alias("event"), F.lit("P").alias("lane"), *frame, F.when(c("fault").isin(1, 3) & (c("n") == 8), digest("S")).otherwise(digest("P")).alias("observation_sha256"), F.lit(None).cast("bigint").alias("canonical_last_sequence"))
    gap = g.where("fault = 3").select(*KEYS, F.lit(9).cast("bigint").alias("record_index"), F.lit("GAP").alias("event"), F.lit(None).cast("string").alias("lane"), F.lit(None).cast("bigint").alias("first_sequence"), F.lit(None).cast("bigint").alias("final_sequence"), F.lit(None).cast("string").alias("observation_sha256"), F.lit(10).cast("bigint").alias("canonical_last_sequence"))
    return oracle.verify_depth(shown.unionByName(gap), raw, KEYS)
