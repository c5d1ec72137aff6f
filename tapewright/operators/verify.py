"""Verifiers of whole artifacts: each is a union of rule tables over landed evidence, one row for each broken rule of an artifact.

Inputs are relations with one row for each generation, stream, segment, acknowledgement, tick, journal record and so on, keyed by the artifact; so all artifacts of a
store are verified by one plan. An artifact without a row in the result is verified. Rule names are stable; their order means nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import coverage, seq, splice
from .ordered import WIDTH, carried


def broken(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """keys, rule: the rules whose condition holds in some row; a condition that is null does not hold."""
    names = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items())))
    return rows.select(*keys, F.explode(names).alias("rule")).distinct()


def _all(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    out = None
    for p in parts:
        out = p.select(*keys, "rule") if out is None else out.unionByName(p.select(*keys, "rule"))
    return out.distinct()


def _named(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.select(*keys, F.lit(name).alias("rule"))


def generation(generations: DataFrame, streams: DataFrame, segments: DataFrame, acks: DataFrame, telemetry: DataFrame, keys: list[str], counters: list[str], bounds: list[tuple[str, str]], width: int | None = WIDTH) -> DataFrame:
    """A segmented generation: its manifest, its two streams, their sealed segments, durable acknowledgements and telemetry.

    generations: keys, status, segment_ns, duration_ns, started_ns, finished_ns. streams: keys, stream, connection_epoch, records, received, transport_status. segments:
    keys, stream, segment_index, first_frame, last_frame, records, start_digest, terminal_digest. acks: keys, stream, segment_index, ack_offset, ack_sha256, file_bytes,
    file_sha256. telemetry: keys, tick, counters; pairs of bounds never cross.
    """
    s = F.col
    parts = [
        broken(generations, keys, {
            "generation status is not COMPLETE": s("status") != "COMPLETE", "segment duration exceeds generation duration": s("segment_ns") > s("duration_ns"),
            "generation wall-clock bounds are invalid": s("finished_ns") < s("started_ns") + s("duration_ns"),
        }),
        broken(streams.groupBy(*keys).agg(F.sort_array(F.collect_set("stream")).alias("names"), F.count(F.lit(1)).alias("n"), F.count_distinct("connection_epoch").alias("epochs")), keys, {
            "generation must contain exactly depth and trade streams": (s("names") != F.array(F.lit("depth"), F.lit("trade"))) | (s("n") != 2),
            "generation stream connection epochs are not unique": s("epochs") < s("n"),
        }),
        broken(streams, keys, {"terminal counts are inconsistent": s("records") != s("received"), "terminal transport status is not clean": ~s("transport_status").eqNullSafe(F.lit("STOPPED"))}),
        broken(segments, keys, {"segment records differ from its frames": s("records") != s("last_frame") - s("first_frame") + 1}),
    ]
    sums = segments.groupBy(*keys, "stream").agg(F.sum("records").alias("sealed"))
    parts.append(broken(streams.join(sums, [*keys, "stream"], "left"), keys, {"sealed segments differ from the stream's records": ~s("sealed").eqNullSafe(s("records"))}))
    parts.append(seq.segment_transitions(segments, [*keys, "stream"]).withColumn("rule", F.concat(F.lit("segment chain: "), "reason")))
    held = segments.select(*keys, "stream", "segment_index").join(acks, [*keys, "stream", "segment_index"], "left")
    parts.append(broken(held, keys, {
        "segment has no durability ACK": s("ack_sha256").isNull(), "durability ACK does not match the exact file": (s("ack_offset") != s("file_bytes")) | (s("ack_sha256") != s("file_sha256")),
    }))
    parts.append(_named(seq.frame_contiguity(telemetry, keys, "tick", width=width), keys, "telemetry record index is not contiguous"))
    fallen = seq.monotone_violations(telemetry, keys, "tick", counters, bounds, width)
    parts.append(broken(fallen, keys, {"telemetry monotonic lineage regressed": F.exists("fallen", lambda x: ~x.contains(">")), "telemetry record counters are invalid": F.exists("fallen", lambda x: x.contains(">"))}))
    return _all(parts, keys)


def campaign(generations: DataFrame, handovers: DataFrame, observations: DataFrame, keys: list[str], width: int | None = WIDTH) -> DataFrame:
    """A campaign: generations that overlap, and handovers whose boundary is derived anew from the observations.

    generations: keys, generation (0, 1, ...), started_ns, finished_ns, epoch. handovers: keys, generation (the successor's), boundary. observations: keys,
    generation, frame_index, first_sequence, final_sequence, observation_sha256.
    """
    s = F.col
    steps = carried(generations, keys, "generation", None, prev={"_end": s("finished_ns"), "_number": s("generation")})
    parts = [broken(steps, keys, {"generation numbers are not contiguous": s("generation") != F.coalesce(s("_number") + 1, F.lit(0)), "generations do not overlap": s("started_ns") >= s("_end")})]
    epochs = generations.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("epoch").alias("e"))
    parts.append(broken(epochs, keys, {"connection epoch was reused": s("e") < s("n")}))
    wanted = generations.where("generation > 0").select(*keys, "generation")
    on = [*keys, "generation"]
    after = observations.join(wanted, on, "left_semi")
    before = observations.withColumn("generation", s("generation") + 1).join(wanted, on, "left_semi")
    derived = splice.convergence(before, after, on, width=width).select(*on, s("boundary").alias("derived"))
    rows = wanted.join(handovers.withColumn("_there", F.lit(True)), on, "full_outer").join(derived, on, "left")
    have = wanted.withColumn("_wanted", F.lit(True))
    rows = rows.join(have, on, "left")
    parts.append(broken(rows, keys, {
        "handover is missing": s("_there").isNull(), "handover without a successor": s("_wanted").isNull(), "no convergence can be derived": s("_there") & s("_wanted") & s("derived").isNull(),
        "handover boundary differs from its derivation": s("_there") & (s("boundary") != s("derived")),
    }))
    equal = splice.common_range_equality(before, after, on, "final_sequence", "observation_sha256")
    parts.append(broken(equal, keys, {"common range differs": s("mismatches") > 0}))
    return _all(parts, keys)


def redundant(startups: DataFrame, terminals: DataFrame, journal: DataFrame, runs: DataFrame, keys: list[str], width: int | None = WIDTH) -> DataFrame:
    """A two-lane artifact: startup and terminal contracts, the journal's chain, gaps against the journal, lane runs against their lifecycle.

    startups: keys, supervisor_id, total_s, primary_rotation_s, shadow_rotation_s, overlap_s, segment_s, started_ns. terminals: keys, supervisor_id, finished_ns, final_coverage,
    status, gaps, unavailable_ns. journal: keys, record_index, previous_record_sha256, record_sha256, event (GAP_OPENED, GAP_CLOSED, LANE_LAUNCHED, LANE_READY, LANE_DONE), gap_id, run_id,
    mono_ns. runs: keys, run_id.
    """
    s = F.col
    both = startups.join(terminals.withColumnRenamed("supervisor_id", "_other"), keys)
    contract = (
        (s("supervisor_id") != s("_other")) | (s("total_s") <= 0) | (s("total_s") > 365 * 86_400) | (s("primary_rotation_s") == s("shadow_rotation_s")) | (s("overlap_s") <= 0) | (s("overlap_s") != s("segment_s"))
        | (s("primary_rotation_s") % s("segment_s") != 0) | (s("shadow_rotation_s") % s("segment_s") != 0) | (s("finished_ns") < s("started_ns")) | (s("final_coverage") != "TERMINAL")
    )
    parts = [broken(both, keys, {"startup and terminal contract is invalid": contract})]
    parts.append(_named(seq.hash_chain(journal, keys, "record_index", width=width).where("not chained"), keys, "hash chain is invalid"))
    gaps = coverage.pair_gap_events(journal.where("event in ('GAP_OPENED', 'GAP_CLOSED')").withColumn("event", F.when(s("event") == "GAP_OPENED", "opened").otherwise("closed")), keys)
    parts.append(broken(gaps, keys, {"opened gap is invalid": s("opened_mono_ns").isNull(), "closed gap is invalid": s("closed_mono_ns") < s("opened_mono_ns")}))
    sums = coverage.outage(gaps, keys).select(*keys, s("gaps").alias("_gaps"), s("unavailable_ns").alias("_ns"), s("open_gap").alias("_open"))
    said = terminals.join(sums, keys, "left").withColumn("_gaps", F.coalesce("_gaps", F.lit(0))).withColumn("_ns", F.coalesce("_ns", F.lit(0)))
    parts.append(broken(said, keys, {
        "terminal gaps differ from durable events": (s("gaps") != s("_gaps")) | (s("unavailable_ns") != s("_ns")),
        "terminal status contradicts gaps": s("status") != coverage.outage_status(s("_gaps"), F.coalesce("_open", F.lit(False))),
    }))
    seen = lambda what: F.count_if(s("event") == what)
    first = lambda what: F.min(F.when(s("event") == what, s("record_index")))
    life = journal.where("run_id is not null").groupBy(*keys, "run_id").agg(*(seen(f"LANE_{w.upper()}").alias(f"n_{w}") for w in ("launched", "ready", "done")), *(first(f"LANE_{w.upper()}").alias(f"at_{w}") for w in ("launched", "ready", "done")))
    declared = runs.withColumn("_declared", F.lit(True)).join(life, [*keys, "run_id"], "full_outer")
    parts.append(broken(declared, keys, {
        "lane launch is invalid or duplicated": s("n_launched") > 1, "lane readiness is invalid or duplicated": (s("n_ready") > 1) | (s("at_ready") < F.coalesce("at_launched", s("at_ready") + 1)),
        "lane outcome is invalid or duplicated": (s("n_done") > 1) | (s("at_done") < F.coalesce("at_launched", s("at_done") + 1)), "lane run is invalid, reused, or unlaunched": s("_declared") & (F.coalesce("n_launched", F.lit(0)) == 0),
        "a launched run is omitted or a lane never completed": (s("n_launched") > 0) & (s("_declared").isNull() | (s("n_done") == 0)),
    }))
    return _all(parts, keys)


def service(preflights: DataFrame, terminals: DataFrame, journal: DataFrame, windows: DataFrame, admitted: DataFrame, expected: DataFrame, keys: list[str], width: int | None = WIDTH) -> DataFrame:
    """A service run: preflight against terminal, the journal's chain and clock, observer windows over the capture, admitted against expected artifacts.

    preflights: keys, mode, total_s, status. terminals: keys, mode, requested_s, started_ns, finished_ns. journal: keys, record_index, previous_record_sha256, record_sha256, mono_ns. windows: keys,
    window_id, ready_ns, stop_ns. admitted, expected: keys, artifact, artifact_sha256.
    """
    s = F.col
    both = preflights.join(terminals.withColumnRenamed("mode", "_mode"), keys)
    parts = [broken(both, keys, {
        "preflight and terminal identities disagree": (s("status") != "PASS") | (s("requested_s") != s("total_s")) | (s("finished_ns") < s("started_ns")), "preflight and terminal mode/clock contracts disagree": s("mode") != s("_mode"),
    })]
    chained = seq.hash_chain(journal, keys, "record_index", width=width)
    rows = carried(chained, keys, "record_index", width, prev={"_mono": s("mono_ns"), "_index": s("record_index")})
    parts.append(broken(rows, keys, {"service journal chain/index/monotonic order is invalid": ~s("chained") | (s("record_index") != F.coalesce(s("_index") + 1, F.lit(0))) | (s("mono_ns") < s("_mono"))}))
    chain = coverage.coverage_chain(windows, keys)
    parts.append(broken(chain, keys, {"observer coverage has a gap or a window outside the required interval": s("hole"), "more than two observer windows overlap": s("crowded")}))
    ends = windows.groupBy(*keys).agg(F.min("ready_ns").alias("_a"), F.max("stop_ns").alias("_b"), F.count(F.lit(1)).alias("n"), F.count_distinct("window_id").alias("ids"))
    lived = terminals.join(ends, keys, "left")
    parts.append(broken(lived, keys, {
        "observer window pairs are missing": s("n").isNull(), "observer coverage lacks its exact required interval": s("_a") > s("started_ns"), "observer coverage ends before capture stopped": s("_b") < s("finished_ns"),
        "observer window identity was reused": s("ids") < s("n"),
    }))
    twice = admitted.groupBy(*keys, "artifact").agg(F.count(F.lit(1)).alias("n"), F.max("artifact_sha256").alias("_sha"))
    parts.append(broken(twice, keys, {"raw artifact was admitted twice": s("n") > 1}))
    sides = expected.withColumn("_e", F.lit(True)).join(twice.withColumn("_a", F.lit(True)), [*keys, "artifact"], "full_outer")
    parts.append(broken(sides, keys, {"expected artifacts differ from independently journalled admissions": s("_e").isNull() | s("_a").isNull() | (s("artifact_sha256") != s("_sha"))}))
    return _all(parts, keys)


def bindings(reports: DataFrame, terminals: DataFrame, manifests: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule of reports that do not lead through exactly one terminal to exactly one manifest.

    reports: keys, terminal_sha256. terminals: keys, terminal_sha256, manifest_sha256. manifests: keys, manifest_sha256.
    """
    s = F.col
    t = terminals.groupBy(*keys, "terminal_sha256").agg(F.count(F.lit(1)).alias("n_terminals"), F.min("manifest_sha256").alias("manifest_sha256"))
    m = manifests.groupBy(*keys, "manifest_sha256").agg(F.count(F.lit(1)).alias("n_manifests"))
    rows = reports.join(t, [*keys, "terminal_sha256"], "left").join(m, [*keys, "manifest_sha256"], "left")
    return broken(rows, keys, {
        "report names no terminal": s("n_terminals").isNull(), "report names several terminals": s("n_terminals") > 1, "terminal names no manifest": s("n_terminals").isNotNull() & s("n_manifests").isNull(),
        "terminal names several manifests": s("n_manifests") > 1,
    })
