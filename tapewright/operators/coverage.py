"""Coverage over time: freshness, silence, gaps, intervals, correlation with faults, and classification of incidents.

Windows are split within a key by `ordered.carried` where the caller names the span of a block in units of the time column (width); without one a key is one
task's work, which suits keys that are known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import WIDTH, carried, haloed

SECOND = 1_000_000_000


def segment_of(mono_ns: Column, start_ns: Column | int, segment_ns: int) -> Column:
    """Index of the fixed-length segment that an instant lies in."""
    base = F.lit(start_ns) if isinstance(start_ns, int) else start_ns
    return F.call_function("div", mono_ns - base, F.lit(segment_ns).cast("bigint"))


def segment_membership(records: DataFrame, segment_ns: int, mono: str = "mono_ns", start: str = "start_ns", declared: str = "segment_index") -> DataFrame:
    """Records whose instant is not in the segment that declares them."""
    at = segment_of(F.col(mono), F.col(start), segment_ns)
    return records.withColumn("actual_segment", at).where(F.col("actual_segment") != F.col(declared))


def freshness(events: DataFrame, keys: list[str], mono: str, start: str, stop: str, startup_ns: int = 30 * SECOND, deadline_ns: int = 30 * SECOND, tail_ns: int | None = None, width: int | None = None) -> DataFrame:
    """Violations: keys, kind (startup, gap, tail), from_ns, to_ns. Control frames are to be filtered out before.

    start and stop are columns with the active window, constant within a key; tail_ns is deadline_ns unless given.
    """
    t = F.col(mono)
    hole = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("from_ns"), b.alias("to_ns"))
    rows = carried(events, keys, mono, width, prev={"_p": t}, nxt={"_n": t})
    found = F.array_compact(F.array(
        F.when(F.col("_p").isNull() & (t - F.col(start) > startup_ns), hole("startup", F.col(start), t)),
        F.when(F.col("_p").isNotNull() & (t - F.col("_p") > deadline_ns), hole("gap", F.col("_p"), t)),
        F.when(F.col("_n").isNull() & (F.col(stop) - t > (deadline_ns if tail_ns is None else tail_ns)), hole("tail", t, F.col(stop))),
    ))
    return rows.select(*keys, F.explode(found).alias("h")).select(*keys, "h.*")


def silences(events: DataFrame, keys: list[str], stamp: str, period: int, windows: int, width: int | None = None) -> DataFrame:
    """Pauses of at least period * windows: keys, silent_from, deadline_at, resumed_at."""
    rows = carried(events, keys, stamp, width, nxt={"resumed_at": F.col(stamp)})
    return rows.where(F.col("resumed_at") - F.col(stamp) >= period * windows).select(*keys, F.col(stamp).alias("silent_from"), (F.col(stamp) + period * windows).alias("deadline_at"), "resumed_at")


def silence_causes(pauses: DataFrame, signals: DataFrame, keys: list[str], stamp: str, width: int | None = None) -> DataFrame:
    """Pauses of `silences` with their cause: serverShutdown (announced before or during the pause), transport_dead (the transport was last seen down), else exchange_silent.

    signals: keys, stamp, signal ('serverShutdown', 'up' or 'down'). Of a pause the state at its deadline counts; once shutdown is announced it stays so.
    """
    both = pauses.select(*pauses.columns, F.col("deadline_at").alias(stamp), F.lit(1).alias("_kind")).unionByName(signals.select(*keys, stamp, F.lit(0).alias("_kind"), "signal"), allowMissingColumns=True)
    link = F.when(F.col("signal").isin("up", "down"), F.col("signal"))
    seen = carried(both, keys, [stamp, "_kind"], width, upto={"_shut": ("max", F.when(F.col("signal") == "serverShutdown", 1)), "_link": ("last", link)})
    cause = F.when(F.col("_shut") == 1, "serverShutdown").when(F.col("_link") == "down", "transport_dead").otherwise("exchange_silent")
    return seen.where("_kind = 1").select(*pauses.columns, cause.alias("cause"))


def silence_sessions(events: DataFrame, keys: list[str], stamp: str, deadline: int, width: int | None = None) -> DataFrame:
    """Islands of activity between silences: keys, session, first, last, n."""
    rows = carried(events, keys, stamp, width, prev={"_was": F.col(stamp)})
    new = F.when(F.col("_was").isNull() | (F.col(stamp) - F.col("_was") >= deadline), 1).otherwise(0)
    marked = carried(rows, keys, stamp, width, upto={"session": ("sum", new)})
    return marked.groupBy(*keys, "session").agg(F.min(stamp).alias("first"), F.max(stamp).alias("last"), F.count(F.lit(1)).alias("n"))


def pong_deadlines(pings: DataFrame, pongs: DataFrame, keys: list[str], token: str, stamp: str, deadline: int, inclusive: bool = False) -> DataFrame:
    """Pings with pong_at and expired: no pong of the same token in time (strictly later, or at the deadline if inclusive)."""
    answers = pongs.groupBy(*keys, token).agg(F.min(stamp).alias("pong_at"))
    waited = F.col("pong_at") - F.col(stamp)
    late = waited >= deadline if inclusive else waited > deadline
    return pings.join(answers, [*keys, token], "left").withColumn("expired", F.col("pong_at").isNull() | late)


def progress_stalls(rows: DataFrame, keys: list[str], stamp: str, counter: str, deadline: int, width: int | None = None) -> DataFrame:
    """Rows with verdict: ok, regressed (counter fell) or stalled (no advance for the deadline)."""
    prev = F.col("_was")
    steps = carried(rows, keys, stamp, width, prev={"_was": F.col(counter)})
    since = carried(steps, keys, stamp, width, upto={"_since": ("last", F.when(prev.isNull() | (F.col(counter) > prev), F.col(stamp)))})
    verdict = F.when(F.col(counter) < prev, "regressed").when(F.col(stamp) - F.col("_since") >= deadline, "stalled").otherwise("ok")
    return since.withColumn("verdict", verdict).drop("_was", "_since")


def coverage_chain(windows: DataFrame, keys: list[str], ready: str = "ready_ns", stop: str = "stop_ns", width: int | None = None) -> DataFrame:
    """Windows with covered_until (highest stop before), hole (starts after it) and crowded (three overlap)."""
    once = carried(windows, keys, [ready, stop], width, prev={"_before": F.col(stop)}, before={"covered_until": ("max", F.col(stop))})
    rows = carried(once, keys, [ready, stop], width, prev={"_third": F.col("_before")})
    hole, crowded = F.col("covered_until").isNotNull() & (F.col(ready) > F.col("covered_until")), F.col("_third").isNotNull() & (F.col(ready) < F.col("_third"))
    return rows.withColumn("hole", hole).withColumn("crowded", crowded).drop("_before", "_third")


def coverage_report(windows: DataFrame, keys: list[str], lower: Column, upper: Column, ready: str = "ready_ns", stop: str = "stop_ns", width: int | None = None) -> DataFrame:
    """keys, windows, holes, crowded, complete: the windows chain and cover [lower, upper]."""
    rows = coverage_chain(windows, keys, ready, stop, width)
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("windows"), F.count_if("hole").alias("holes"), F.count_if("crowded").alias("crowded"), F.min(ready).alias("_a"), F.max(stop).alias("_b"))
    complete = (F.col("holes") == 0) & (F.col("crowded") == 0) & (F.col("_a") <= lower) & (F.col("_b") >= upper)
    return out.withColumn("complete", complete).drop("_a", "_b")


def lane_coverage(events: DataFrame, keys: list[str], lane: str, ready: str, stamp: str, lanes: int = 2, width: int | None = None) -> DataFrame:
    """Coverage after each lane event (ready true or false): keys, stamp, ready_lanes, coverage.

    coverage: STARTING before any lane was ready, REDUNDANT, DEGRADED, or GAP (none ready after one was).
    """
    now = F.when(F.col(ready), 1).otherwise(0)
    steps = carried(events, [*keys, lane], stamp, width, prev={"_was": now})
    rows = steps.withColumn("_step", now - F.coalesce("_was", F.lit(0))).withColumn("_now", now).groupBy(*keys, stamp).agg(F.sum("_step").alias("_step"), F.max("_now").alias("_now"))
    rows = carried(rows, keys, stamp, width, upto={"ready_lanes": ("sum", F.col("_step")), "_ever": ("max", F.col("_now"))})
    kind = F.when(F.col("ready_lanes") >= lanes, "REDUNDANT").when(F.col("ready_lanes") >= 1, "DEGRADED").when(F.col("_ever") == 1, "GAP").otherwise("STARTING")
    return rows.select(*keys, stamp, "ready_lanes", kind.alias("coverage"))


def gap_pairs(states: DataFrame, keys: list[str], stamp: str, state: str = "coverage", width: int | None = None) -> DataFrame:
    """Gap intervals from coverage rows: keys, opened_mono_ns, closed_mono_ns (null while open), unavailable_ns."""
    changed = carried(states, keys, stamp, width, prev={"_was": F.col(state)}).where(~F.col(state).eqNullSafe(F.col("_was")))
    edges = carried(changed, keys, stamp, width, nxt={"_closed": F.col(stamp)})
    return edges.where(F.col(state) == "GAP").select(*keys, F.col(stamp).alias("opened_mono_ns"), F.col("_closed").alias("closed_mono_ns"), (F.col("_closed") - F.col(stamp)).alias("unavailable_ns"))


def pair_gap_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (gap_id, event 'opened' or 'closed', mono_ns) joined to intervals by gap_id."""
    one = lambda what: F.min(F.when(F.col("event") == what, F.col("mono_ns")))
    out = events.groupBy(*keys, "gap_id").agg(one("opened").alias("opened_mono_ns"), one("closed").alias("closed_mono_ns"))
    return out.withColumn("unavailable_ns", F.col("closed_mono_ns") - F.col("opened_mono_ns"))


def outage(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, gaps, unavailable_ns, open_gap, status. Keys without a gap are no rows here; see outage_status."""
    out = gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("gaps"), F.coalesce(F.sum("unavailable_ns"), F.lit(0)).alias("unavailable_ns"), F.bool_or(F.col("closed_mono_ns").isNull()).alias("open_gap"))
    return out.withColumn("status", outage_status(F.col("gaps"), F.col("open_gap")))


def outage_status(gaps: Column, open_gap: Column) -> Column:
    # The three statuses.
    return F.when(open_gap, "COMPLETE_WITH_OPEN_GAP").when(gaps == 0, "COMPLETE_NO_DUAL_OUTAGE").otherwise("COMPLETE_WITH_EXPLICIT_GAPS")


def nearest_interval(points: DataFrame, intervals: DataFrame, keys: list[str], stamp: str, start: str, stop: str, seq: str, tolerance: int, width: int | None = None) -> DataFrame:
    """Each point with its nearest interval of the same keys (distance 0 inside), the smallest seq on ties, and within_tolerance.

    Intervals must not overlap each other within a key (ties at edges are fine); the query fails where they do. The nearest one is then the last that starts at or
    before the point or the first that starts after it: running values over points and intervals in one order, no pairs.
    """
    checked = carried(intervals.select(*keys, start, stop, seq), keys, [start, stop], width, before={"_reach": ("max", F.col(stop))})
    overlap = F.raise_error(F.concat(F.lit("intervals overlap at "), F.col(start).cast("string")))
    a = F.when(F.col("_reach") > F.col(start), overlap.cast(dict(intervals.dtypes)[start])).otherwise(F.col(start))
    i = checked.select(*keys, a.alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(start).alias("a"), F.col(stop).alias("b"), F.col(seq).alias("seq")).alias("_i"), F.lit(None).cast(dict(points.dtypes)[stamp]).alias(stamp))
    rows = points.withColumn("_payload", F.struct(*points.columns))
    p = rows.select(*keys, F.col(stamp).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(i.schema["_i"].dataType).alias("_i"), F.col(stamp), "_payload")
    both = i.withColumn("_payload", F.lit(None).cast(rows.schema["_payload"].dataType)).unionByName(p)
    both = both.withColumn("_back", -F.col("_at")).withColumn("_kind_back", -F.col("_kind"))
    once = carried(both, keys, ["_at", "_kind"], width, upto={"_before": ("last", F.col("_i"))})
    # Looking ahead as a running value of the opposite order.
    out = carried(once, keys, ["_back", "_kind_back"], width, before={"_after": ("last", F.col("_i"))}).where("_kind = 1")
    t = F.col(stamp)
    far = lambda x: F.when(x.isNotNull(), F.greatest(x["a"] - t, t - x["b"], F.lit(0)))
    da, db = far(F.col("_before")), far(F.col("_after"))
    take_after = F.col("_before").isNull() | (F.col("_after").isNotNull() & ((db < da) | ((db == da) & (F.col("_after.seq") < F.col("_before.seq")))))
    best = F.when(take_after, F.col("_after")).otherwise(F.col("_before"))
    distance = F.when(take_after, db).otherwise(da)
    return out.select("_payload.*", best["seq"].alias("nearest_seq"), distance.alias("distance")).withColumn("within_tolerance", F.coalesce(F.col("distance") <= tolerance, F.lit(False)))


def endpoint_correlation(events: DataFrame, flows: DataFrame, slack: int = SECOND, block: int = 3_600 * SECOND, strict: bool = False) -> DataFrame:
    """Events (pid, port_a, port_b, t) joined to flows (pid, port_a, port_b, flow, start, stop) of the same process and unordered port pair, where t
    is within the flow's time and slack; flow is null where none fits, which with strict fails the query.

    A flow takes part in every block of time that it touches, and an event in its own, so a process that lives long is many small joins. A flow is listed once
    for each block: choose a block not much shorter than flows are.
    """
    ports = lambda df: df.withColumn("_lo", F.least("port_a", "port_b")).withColumn("_hi", F.greatest("port_a", "port_b"))
    at = lambda c: F.floor(c / F.lit(block)).cast("bigint")
    left = ports(events).withColumn("_block", at(F.col("t")))
    spread = F.explode(F.sequence(at(F.col("start") - slack), at(F.col("stop") + slack))).alias("_block")
    right = ports(flows).select("pid", "_lo", "_hi", "flow", "start", "stop", spread)
    same = [left[c] == right[c] for c in ("pid", "_lo", "_hi", "_block")]
    joined = left.join(right, [*same, left["t"] >= right["start"] - slack, left["t"] <= right["stop"] + slack], "left")
    flow = F.col("flow")
    if strict:
        flow = F.when(flow.isNull(), F.raise_error(F.lit("an event has no flow")).cast(dict(flows.dtypes)["flow"])).otherwise(flow)
    return joined.select(*(left[c] for c in events.columns), flow.alias("flow"))


def rate_limit_violations(events: DataFrame, keys: list[str], stamp: str, window: int, most: int, width: int | None = None) -> DataFrame:
    """Rows with more than `most` events in the window that ends at them."""
    rows, by = haloed(events, keys, stamp, window - 1, width)
    w = Window.partitionBy(*by).orderBy(stamp).rangeBetween(-(window - 1), 0)
    out = rows.withColumn("in_window", F.count(F.lit(1)).over(w)).where(~F.col("_halo") & (F.col("in_window") > most))
    return out.select(*events.columns, "in_window")


#: A session's own control frames in a second, and the longest payloads.
CONTROL_PER_SECOND, CONTROL_BYTES, DATA_BYTES = 5, 125, 4 * 1024 * 1024


def transport_limits(events: DataFrame, keys: list[str], stamp: str, second: int = SECOND, capacity: int = 4_096, width: int | None = None) -> DataFrame:
    """keys, stamp, rule of a session's frames (kind 'control' or 'data', sent by the client or not, size, queued): control rate, control size, data size, queue."""
    c = F.col
    control = events.where((c("kind") == "control") & c("sent"))
    fast = rate_limit_violations(control, keys, stamp, second, CONTROL_PER_SECOND, width).select(*keys, stamp, F.lit("control rate").alias("rule"))
    rules = [
        F.when((c("kind") == "control") & (c("size") > CONTROL_BYTES), "control size"), F.when((c("kind") == "data") & (c("size") > DATA_BYTES), "data size"), F.when(c("queued") > capacity, "queue"),
    ]
    rest = events.select(*keys, stamp, F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    return fast.unionByName(rest)


# --- classification -----------------------------------------------------------------------------------------------------


def event_counts(rows: DataFrame, keys: list[str], event: str) -> DataFrame:
    """keys, events: a map from event to count."""
    counts = rows.groupBy(*keys, event).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(event, "n")))).alias("events"))


def transport_class(rows: DataFrame, keys: list[str], event: str = "event", tcp_state: str = "tcp_state", order: str = "record_index", expected: DataFrame | None = None) -> DataFrame:
    """keys, classification, error of a connection's journal; the first class that applies, in order of the list.

    rows: keys, order, event, tcp_state, and of the terminal (event TRANSPORT_TERMINAL) status and received. error: no terminal, no received count in it, or a count other than
    expected (keys, received); such a connection has no classification.
    """
    has = lambda name: F.bool_or(F.col(event) == name)
    last_tcp = F.max_by(tcp_state, F.when(F.col(tcp_state).isNotNull(), F.col(order)))
    terminal = F.when(F.col(event) == "TRANSPORT_TERMINAL", F.col(order))
    # Events and their classes, by priority.
    kind = (
        F.when(F.max_by("status", terminal) == "STOPPED", "CLEAN_CLIENT_STOP").when(has("SUPERVISOR_FAILURE_STOP"), "SUPERVISOR_FAILURE_STOP_OBSERVED").when(has("CONNECT_FAILED"), "CONNECT_FAILURE_OBSERVED")
        .when(has("WEBSOCKET_UPGRADE_REJECTED"), "WEBSOCKET_UPGRADE_REJECTION_OBSERVED").when(has("WEBSOCKET_CLOSE"), "WEBSOCKET_CLOSE_FRAME_OBSERVED").when(has("SOCKET_READ_ERROR"), "SOCKET_READ_ERROR_OBSERVED")
        .when(has("TRANSPORT_DEADLINE") & (last_tcp == "ESTABLISHED"), "TRANSPORT_SILENCE_WITH_LOCAL_TCP_ESTABLISHED").when(has("TRANSPORT_DEADLINE"), "TRANSPORT_SILENCE_WITHOUT_LOCAL_ESTABLISHED_PROOF")
        .otherwise("LOCAL_PRODUCER_FAILURE_WITHOUT_TRANSPORT_SUBTYPE")
    )
    out = rows.groupBy(*keys).agg(kind.alias("_kind"), F.max_by("status", terminal).alias("_status"), F.max_by("received", terminal).alias("_received"))
    error = F.when(F.col("_status").isNull(), "no terminal status").when(F.col("_received").isNull(), "no received count")
    if expected is not None:
        out = out.join(expected.select(*keys, F.col("received").alias("_expected")), keys, "left")
        error = error.when(~F.col("_received").eqNullSafe(F.col("_expected")), "received count differs")
    out = out.withColumn("error", error)
    return out.select(*keys, F.when(F.col("error").isNull(), F.col("_kind")).alias("classification"), "error")


def witness_class(dns: Column, tcp: Column, routes: Column, interfaces: Column, venue: str = "VENUE", independent: str = "INDEPENDENT_INTERNET") -> Column:
    """Reachability class of a sample; dns, tcp, routes and interfaces are arrays of structs. venue names the venue in targets and classes."""
    status = lambda rows, target: F.get(F.filter(rows, lambda x: x["target"] == target), F.lit(0))["status"]
    v, i = status(tcp, f"{venue}_PUBLIC_STREAM"), status(tcp, independent)
    failed = lambda x: x.isin("FAILED", "TIMEOUT")
    up = F.exists(interfaces, lambda x: (x["status"] == "Up") & (x["type"] != "Loopback") & (F.size(x["gateways"]) > 0))
    local = ~up | ~F.coalesce(status(routes, independent) == "ROUTE_SELECTED", F.lit(False))
    lost = failed(i) & (v.isNull() | failed(v))
    # Classes by priority.
    return (
        F.when((dns[0]["status"] != "RESOLVED") & (i == "CONNECTED"), f"{venue}_DNS_UNAVAILABLE_INTERNET_TCP_REACHABLE").when((v == "CONNECTED") & (i == "CONNECTED"), f"{venue}_AND_INDEPENDENT_TCP_REACHABLE")
        .when(failed(v) & (i == "CONNECTED"), f"{venue}_PATH_SPECIFIC_TCP_FAILURE_FROM_THIS_HOST").when((v == "CONNECTED") & failed(i), f"INDEPENDENT_WITNESS_FAILURE_{venue}_TCP_REACHABLE")
        .when(lost & local, "LOCAL_INTERFACE_OR_ROUTE_UNAVAILABLE").when(lost, "SHARED_PATH_FAILURE_FROM_THIS_HOST").otherwise("INSUFFICIENT_NETWORK_WITNESS_EVIDENCE")
    )


def incident_class(classes: Column, witness: Column, within: Column, venue: str = "VENUE") -> Column:
    """Class of an incident from the transports' classes (array), and the nearest witness sample's class if within tolerance."""
    has = lambda name: F.array_contains(classes, name)
    failing = F.filter(classes, lambda x: x != "CLEAN_CLIENT_STOP")
    w = F.when(F.coalesce(within, F.lit(False)), witness)
    # Classes by priority.
    correlated = (
        F.when(w == "LOCAL_INTERFACE_OR_ROUTE_UNAVAILABLE", "CORRELATED_LOCAL_INTERFACE_OR_ROUTE_FAILURE_FROM_THIS_HOST").when(w == "SHARED_PATH_FAILURE_FROM_THIS_HOST", "CORRELATED_SHARED_PATH_FAILURE_FROM_THIS_HOST")
        .when(w == f"{venue}_PATH_SPECIFIC_TCP_FAILURE_FROM_THIS_HOST", f"CORRELATED_{venue}_PATH_SPECIFIC_FAILURE_FROM_THIS_HOST").when(w == f"{venue}_DNS_UNAVAILABLE_INTERNET_TCP_REACHABLE", f"CORRELATED_{venue}_DNS_FAILURE_FROM_THIS_HOST")
        .when(w == f"{venue}_AND_INDEPENDENT_TCP_REACHABLE", "SOCKET_SILENCE_WHILE_NEW_TCP_PROBES_WERE_REACHABLE").otherwise("TRANSPORT_SILENCE_CAUSE_UNRESOLVED_AT_OBSERVED_BOUNDARIES")
    )
    return (
        F.when(F.size(failing) == 0, "NO_TRANSPORT_FAILURE_IN_SUPPLIED_GENERATIONS").when(has("WEBSOCKET_CLOSE_FRAME_OBSERVED"), "WEBSOCKET_CLOSE_FRAME_AT_APPLICATION_BOUNDARY")
        .when(has("SOCKET_READ_ERROR_OBSERVED"), "SOCKET_READ_ERROR_AT_APPLICATION_BOUNDARY").when(F.exists(failing, lambda x: x.startswith("TRANSPORT_SILENCE")), correlated)
        .when(has("CONNECT_FAILURE_OBSERVED"), "CONNECT_FAILURE_AT_APPLICATION_BOUNDARY").when(has("WEBSOCKET_UPGRADE_REJECTION_OBSERVED"), "WEBSOCKET_UPGRADE_REJECTION_AT_APPLICATION_BOUNDARY")
        .when(has("SUPERVISOR_FAILURE_STOP_OBSERVED"), "SUPERVISOR_FAILURE_STOP_AT_APPLICATION_BOUNDARY").otherwise("LOCAL_PRODUCER_FAILURE_WITHOUT_NARROWER_OBSERVED_CAUSE")
    )


def cause_domain(observer_failure: Column, raw_status: Column, raw_failure: Column, incident: Column, local: list[str], socket: list[str]) -> Column:
    """Domain of a failed run's cause; local and socket are the incident classes of those domains."""
    # Domains by priority.
    return (
        F.when(observer_failure.isNotNull(), "OBSERVABILITY_INTERNAL_FAILURE").when(raw_status.isNull(), "INNER_QUALIFICATION_TERMINAL_MISSING").when(raw_status == "COMPLETE", "NONE")
        .when(F.coalesce(raw_failure.startswith("HOST_CLOCK_HEALTH_GATE_FAILED:"), F.lit(False)), "HOST_TIME_SYNCHRONIZATION_FAILURE")
        .when(incident.isNull(), "INDETERMINATE_BECAUSE_CROSS_PLANE_INCIDENT_EVIDENCE_DID_NOT_VERIFY").when(incident.isin(*local), "HOST_OR_LOCAL_ACCESS_NETWORK_OUTSIDE_CAPTURE_PROCESS")
        .when(incident.isin(*socket), "EXTERNAL_TO_CAPTURE_PROCESS_AT_OBSERVED_SOCKET_BOUNDARY").otherwise("CAPTURE_OR_SUPERVISOR_INTERNAL_OR_NON_NETWORK_FAILURE")
    )
