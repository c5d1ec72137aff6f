"""Queries of replays, splices of books, exclusions, scalars and codecs that the other modules leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decimals, wire
from ..operators import book, coverage, latency, oracle, sessions, splice, union
from ..operators.ordered import WIDTH, carried
from . import replay
from .feed import FEED, LANES, LEVELS, feed, lanes, levels, row_order
from .log_queries import DISPOSED, raw_logs
from .queries import FP_CHANGE, FP_OLD, SQL, SYM, big, query

# --- complete runs, prefixes, checkpoints -------------------------------------------------------------------------------

def generations(spark, d) -> tuple[DataFrame, DataFrame]:
    """Updates of overlapping generations (generation n holds ids 40 n to 40 n + 49) and the frames that each one's proof gives it."""
    f = feed(spark, d).select("sym", "id", "eid")
    own = F.expr("id div 40")
    both = F.when((F.col("id") % 40 < 10) & (F.col("id") >= 40), F.array(own, own - 1)).otherwise(F.array(own))
    updates = f.withColumn("generation", F.explode(both)).select("sym", "generation", F.col("id").alias("frame"), (F.col("id") * 2 + 1 + F.when(F.col("eid") % 211 == 9, 1).otherwise(0)).alias("first_id"), (F.col("id") * 2 + 2).alias("final_id"))
    proofs = updates.groupBy("sym", "generation").agg(F.max("frame").alias("end_frame")).withColumn("start_frame", F.when(F.col("generation") == 0, 0).otherwise(F.col("generation") * 40 + 10).cast("bigint"))
    return updates, proofs


@query(f"""with {FEED}, g as (select sym, id, eid, case when id < 50 then 0 else (id - 10) // 40 end as generation from feed), e as (select sym, generation, count(*) as frames, arg_min(id * 2 + 1 + case when eid % 211 = 9 then 1 else 0 end, id) as first_id, max(id * 2 + 2) as last_id from g group by all),
l as (select *, lag(last_id) over (partition by sym order by generation) as p from e) select sym, generation, frames, first_id, last_id, p is null or (first_id <= p + 1 and last_id >= p + 1) as bridged from l""")
def complete_depth_run(spark, d):
    """Overlapping generations read within their proven frames, and whether their ids run on."""
    updates, proofs = generations(spark, d)
    return replay.complete_depth(updates, proofs, SYM)


@query(f"""with {FEED}, g as (select sym, id as position, case when eid % 157 = 8 then id - 3 else id end as trade_id, id // 60 as generation from feed), l as (select *, lag(trade_id) over (partition by sym order by position) as p from g)
select sym, generation, count(*) as trades, min(trade_id) as first_id, max(trade_id) as last_id, bool_and(p is null or trade_id > p) as rising from l group by all""")
def complete_trades_run(spark, d):
    rows = feed(spark, d).select("sym", F.col("id").alias("position"), F.when(F.col("eid") % 157 == 8, F.col("id") - 3).otherwise(F.col("id")).alias("trade_id"), F.expr("id div 60").alias("generation"))
    return replay.complete_trades(rows, SYM)


STEPS_SQL = f"""with {FEED}, {LEVELS}, o as (select *, coalesce(lag(qty) over (partition by sym, side, price order by frame), 0) as old from levels),
{FP_OLD}, x as (select sym, frame, (case when qty > 0 then 1 else 0 end) - (case when old > 0 then 1 else 0 end) as step, {FP_CHANGE} as c from h),
r as (select sym, frame, CAST(sum(step) over w AS BIGINT) as n_levels, bit_xor(c) over w as fp0 from x window w as (partition by sym order by frame rows between unbounded preceding and current row))"""


@query(f"{STEPS_SQL} select sym, frame // 100 as segment_index, arg_max(n_levels, frame) as n_levels, arg_max(fp0, frame) as fp0 from r group by all")
def prefix_fingerprints(spark, d):
    """The book's fingerprint at the end of every segment of a failed generation's prefix."""
    rows = levels(spark, d).withColumn("segment_index", F.expr("frame div 100"))
    return replay.prefix_checkpoints(rows, SYM).select("sym", "segment_index", *big("n_levels"), "fp0")


@query(f"with {FEED}, {LEVELS}, n as (select *, lead(frame) over (partition by sym, side, price order by frame) as until from levels), t as (select sym, max(frame) as top from levels group by sym) select n.sym, f.at as frame, side, price, qty from n join t using (sym), (select unnest(range(0, 1000000, 50)) as at) f where qty > 0 and f.at >= n.frame and f.at < coalesce(until, top + 1) and f.at <= top")
def checkpoint_levels(spark, d):
    """Checkpoints of every book after each fifty frames, without replaying them one by one."""
    return replay.checkpoint_store(levels(spark, d), SYM, 50)


@query(f"with {FEED}, t as (select sym, max(id) as top from feed group by sym) select sym, f.at as frame, not (f.at % 150 = 100 and sym % 3 = 1) as matches from t, (select unnest(range(0, 1000000, 50)) as at) f where f.at <= top and f.at > 0")
def checkpoint_validation(spark, d):
    """Stored checkpoints, some with a changed quantity, against the books that the levels give."""
    rows = levels(spark, d)
    stored = replay.checkpoint_store(rows, SYM, 50).where("frame > 0")
    wrong = (F.col("frame") % 150 == 100) & (F.col("sym") % 3 == 1)
    stored = stored.withColumn("qty", F.when(wrong, F.col("qty") + 1).otherwise(F.col("qty")).cast("decimal(28,8)"))
    return replay.checkpoint_validation(stored, rows, SYM)


@query(f"with {DISPOSED} select 'S' || sym as symbol, 'depth' as stream_kind, 'e' || block as connection_epoch, fi as frame_index, first_id as first_sequence, final_id as final_sequence from disp where disposition = 'APPLIED'")
def depth_observations(spark, d):
    """Canonical depth observations of the raw logs."""
    return replay.depth_observations(spark, raw_logs(spark, d)).select("symbol", "stream_kind", "connection_epoch", "frame_index", "first_sequence", "final_sequence")


@query(f"{STEPS_SQL}, a as (select sym, frame, fp0, n_levels from r), m as (select sym, frame, fp0 from r where frame % 10 <> 3) select distinct a.sym, a.frame as final_sequence from a join m using (sym, frame)")
def book_convergence(spark, d):
    """Sequences at which two lanes hold equal books; one lane's are spoiled at every tenth frame."""
    steps = book.fingerprint_steps(levels(spark, d), SYM).withColumnRenamed("frame", "final_sequence")
    other = steps.withColumn("fp0", F.when(F.col("final_sequence") % 10 == 3, F.col("fp0") + 1).otherwise(F.col("fp0")))
    return splice.book_convergence(steps, other, SYM)


FOLD_SQL = f"""with {FEED}, {LEVELS}, all_levels as (select sym, frame + 1 as frame, side, price, qty from levels union all select distinct sym, 0, 'bid', 1::DECIMAL(28,8), 1::DECIMAL(28,8) from levels union all select distinct sym, 0, 'ask', 100::DECIMAL(28,8), 1::DECIMAL(28,8) from levels),
n as (select *, coalesce(lead(frame) over (partition by sym, side, price order by frame), 1000000000) as until from all_levels), f as (select distinct sym, frame from all_levels),
s as (select f.sym, f.frame, count(*) filter (where n.side = 'bid') as bid_levels, count(*) filter (where n.side = 'ask') as ask_levels, max(n.price) filter (where n.side = 'bid') as best_bid, min(n.price) filter (where n.side = 'ask') as best_ask from f left join n on n.sym = f.sym and n.qty > 0 and n.frame <= f.frame and f.frame < n.until group by all),
c as (select sym, min(frame) as cut from s where bid_levels = 0 or ask_levels = 0 group by sym)
select s.sym, s.frame, case when s.frame = 0 then 'SNAPSHOT' when s.frame > cut then 'REJECTED' else 'APPLIED' end as disposition, case when s.frame >= cut then 'INVALID' when s.frame = 0 then 'SYNCING' else 'LIVE' end as state, least(s.frame, coalesce(cut, s.frame)) as last_update_id, t.bid_levels, t.ask_levels, t.best_bid, t.best_ask
from s left join c using (sym) join s t on t.sym = s.sym and t.frame = least(s.frame, coalesce(cut, s.frame))"""


SQL["book_fold"] = FOLD_SQL


# --- lanes --------------------------------------------------------------------------------------------------------------


def stalled(spark, d) -> DataFrame:
    """Both lanes; lane S ends at two thirds of every third symbol's ids."""
    rows = row_order(lanes(spark, d))
    tops = rows.groupBy("sym").agg(F.max("id").alias("top"))
    return rows.join(tops, "sym").where("not (lane = 'S' and sym % 3 = 0 and id > top * 2 div 3)").drop("top").withColumn("mono_ns", F.col("arrival") * 1_000)


STALL = LANES + """, stalled as (select l.*, l.arrival * 1000 as mono_ns from lane_rows l join (select sym, max(id) as top from lane_rows group by sym) t using (sym) where not (lane = 'S' and sym % 3 = 0 and id > top * 2 // 3)),
seen as (select *, max(case when lane = 'P' then mono_ns end) over o as tp, max(case when lane = 'S' then mono_ns end) over o as ts, min(mono_ns) over (partition by sym) as t0 from stalled window o as (partition by sym order by arrival rows between unbounded preceding and current row)),
late as (select sym, 'P' as lane, min(arrival) as excluded_at from seen where mono_ns - coalesce(tp, t0) >= 400000 group by sym union all select sym, 'S', min(arrival) from seen where mono_ns - coalesce(ts, t0) >= 400000 group by sym)"""


def exclusions(spark, d) -> DataFrame:
    return union.lag_exclusion(stalled(spark, d), SYM, "lane", "arrival", "mono_ns", ["P", "S"], horizon_ns=400_000)


@query(f"with {FEED}, {STALL} select sym, lane, excluded_at, 'no durable advance' as reason from late")
def lane_exclusions(spark, d):
    """Lanes without an advance for the horizon, by the other lane's clock."""
    return exclusions(spark, d)


@query(f"""with {FEED}, {STALL}, x as (select s.*, coalesce(max(case when s.lane = 'P' then id + 1 end) over o, 0) as cp, coalesce(max(case when s.lane = 'S' then id + 1 end) over o, 0) as cs, p.excluded_at as xp, q.excluded_at as xs
from stalled s left join late p on p.sym = s.sym and p.lane = 'P' left join late q on q.sym = s.sym and q.lane = 'S' window o as (partition by s.sym order by arrival rows between unbounded preceding and current row))
select sym, arrival, coalesce(least(case when coalesce(arrival >= xp, false) then null else cp end, case when coalesce(arrival >= xs, false) then null else cs end), 0)::BIGINT as watermark from x""")
def union_watermark_excluded(spark, d):
    """The watermark goes on when a lane that stands still is excluded."""
    rows = stalled(spark, d)
    return union.watermark(rows, SYM, "id", "lane", "arrival", ["P", "S"], excluded=exclusions(spark, d)).select("sym", "arrival", "watermark")


@query(f"with {FEED}, old as (select sym, id, sha256(eid::VARCHAR) as digest from feed where eid % 3 <> 0), new as (select sym, id, sha256(case when eid % 10 = 4 then 'x' else eid::VARCHAR end) as digest from feed where eid % 2 = 0) select coalesce(o.sym, n.sym) as sym, coalesce(o.id, n.id) as id, coalesce(o.digest, n.digest) as digest, case when n.id is null then 'LOGGED' when o.id is null then 'NEW' when o.digest = n.digest then 'KNOWN' else 'CONFLICT' end as disposition from old o full join new n on n.sym = o.sym and n.id = o.id")
def identity_log(spark, d):
    f = feed(spark, d)
    old = f.where("eid % 3 <> 0").select("sym", "id", F.sha2(F.col("eid").cast("string"), 256).alias("digest"))
    new = f.where("eid % 2 = 0").select("sym", "id", F.sha2(F.when(F.col("eid") % 10 == 4, "x").otherwise(F.col("eid").cast("string")), 256).alias("digest"))
    return union.identity_log(old, new, SYM, "id", "digest")


@query(f"with {FEED}, g as (select sym, id as number, case when id % 2 = 0 then 'P' else 'S' end as lane, id // 3 as start_ns from feed) select sym, number, lane, start_ns, row_number() over (partition by sym order by start_ns, case when lane = 'P' then 0 else 1 end, number) - 1 as position from g")
def generation_order(spark, d):
    """Generations of both lanes by start; the primary first where starts are equal."""
    rows = feed(spark, d).select("sym", F.col("id").alias("number"), F.when(F.col("id") % 2 == 0, "P").otherwise("S").alias("lane"), F.expr("id div 3").alias("start_ns"))
    return union.generation_order(rows, SYM, "start_ns", "lane", ["P", "S"], "number").withColumn("position", F.col("position").cast("bigint"))


@query(f"""with {FEED}, g as (select distinct sym, id // 8 as k from feed) select sym, k, case k % 5 when 0 then 'switch' when 1 then 'dual_loss' when 2 then 'unprovable_continuation' when 3 then 'sibling_book_diverges' else 'dual_loss' end as verdict from g""")
def depth_switches(spark, d):
    """How a depth lane may go on in its sibling."""
    g = feed(spark, d).select("sym", F.expr("id div 8").alias("k")).distinct()
    k = F.col("k") % 5
    rows = g.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    first = F.when(k == 4, F.lit(None)).otherwise(11 + F.col("j") * 3 + F.when((k == 1) & (F.col("j") == 2), 1).otherwise(0) - F.when((k == 2) & (F.col("j") == 0), 1).otherwise(0)).cast("bigint")
    final = F.when(k == 4, F.lit(None)).otherwise(13 + F.col("j") * 3).cast("bigint")
    frames = rows.select("sym", "k", F.lit(11).cast("bigint").alias("expected"), F.lit(18).cast("bigint").alias("wanted_to"), (k != 3).alias("converged"), first.alias("first_id"), final.alias("final_id"))
    return union.depth_switches(frames, ["sym", "k"])


# --- sessions and silences ----------------------------------------------------------------------------------------------

SEQ_SQL = f"""{FEED}, fr as (select sym, eid, id - case when eid % 17 = 3 then 6 else 0 end + case when eid % 29 = 4 then 3 else 0 end as sequence, id as arrival, id // 100 as epoch from feed),
l as (select *, greatest(max(sequence) over (partition by sym, epoch order by arrival rows between unbounded preceding and 1 preceding) + 1, case when epoch > 0 then epoch * 100 end) as expected, row_number() over (partition by sym, epoch, sequence order by arrival) as copy from fr),
k as (select *, case when expected is null then 'FIRST' when sequence = expected then 'NEXT' when sequence > expected then 'GAP' else 'BEHIND' end as place from l),
w as (select k.*, g.expected as gf, g.sequence as gl from k left join k g on k.place = 'BEHIND' and g.sym = k.sym and g.epoch = k.epoch and g.place = 'GAP' and k.sequence >= g.expected and k.sequence < g.sequence)"""


FEED_ROWS = "select sym, arrival, sequence, expected, case when place <> 'BEHIND' then place when copy = 1 and gf is not null then 'RECOVERED' else 'DUPLICATE' end as disposition, case when place = 'GAP' then expected end as gap_first, case when place = 'GAP' then sequence - 1 end as gap_last from w"
SQL["sequenced_feed"] = f"with {SEQ_SQL.replace('id // 100 as epoch', '0 as epoch')} {FEED_ROWS}"


@query(f"with {SEQ_SQL} select sym, arrival, sequence, expected, case when place <> 'BEHIND' then place when copy = 1 and gf is not null then 'RECOVERED' else 'DUPLICATE' end as disposition, case when place = 'GAP' then expected end as gap_first, case when place = 'GAP' then sequence - 1 end as gap_last from w")
def sequenced_feed_seeded(spark, d):
    """A sequenced feed that a snapshot re-seeds after every hundred frames."""
    f = feed(spark, d)
    s = F.col("id") - F.when(F.col("eid") % 17 == 3, 6).otherwise(0) + F.when(F.col("eid") % 29 == 4, 3).otherwise(0)
    frames = f.select("sym", s.alias("sequence"), F.col("id").alias("arrival"))
    seeds = f.where("id % 100 = 0 and id > 0").select("sym", F.col("id").alias("arrival"), F.col("id").alias("next_sequence"))
    return sessions.sequenced_feed(frames, SYM, snapshots=seeds)


@query(f"""with {FEED}, w as (select user_id, us, lead(us) over (partition by user_id order by us) as r from feed), p as (select user_id, us as silent_from, us + 3 * 28800000000 as deadline_at, r as resumed_at from w where r - us >= 3 * 28800000000),
sg as (select user_id, us - 1000 as seen, case when eid % 4 = 0 then 'down' when eid % 4 = 1 then 'up' when eid % 101 = 2 then 'serverShutdown' end as signal from feed)
select p.*, case when exists (select 1 from sg where sg.user_id = p.user_id and sg.signal = 'serverShutdown' and sg.seen <= p.deadline_at) then 'serverShutdown' when (select arg_max(signal, seen) from sg where sg.user_id = p.user_id and sg.signal in ('up', 'down') and sg.seen <= p.deadline_at) = 'down' then 'transport_dead' else 'exchange_silent' end as cause from p""")
def silence_causes(spark, d):
    f = feed(spark, d)
    pauses = coverage.silences(f, ["user_id"], "us", 28_800_000_000, 3)
    signal = F.when(F.col("eid") % 4 == 0, "down").when(F.col("eid") % 4 == 1, "up").when(F.col("eid") % 101 == 2, "serverShutdown")
    return coverage.silence_causes(pauses, f.select("user_id", (F.col("us") - 1_000).alias("at"), signal.alias("signal")), ["user_id"], "at")


@query(f"""with {FEED}, e as (select user_id, us, eid % 3 = 0 as control, eid % 4 <> 1 as sent, case when eid % 3 = 0 then eid % 140 else eid * 500 % 5000000 end as size, eid % 4500 as queued from feed),
r as (select user_id, us, count(*) over (partition by user_id order by us range between 863999999999 preceding and current row) as n from e where control and sent)
select user_id, us, 'control rate' as rule from r where n > 5 union all select user_id, us, 'control size' from e where control and size > 125 union all select user_id, us, 'data size' from e where not control and size > 4194304 union all select user_id, us, 'queue' from e where queued > 4096""")
def transport_limits(spark, d):
    """Frames of sessions that break a limit."""
    e = F.col("eid")
    size = F.when(e % 3 == 0, e % 140).otherwise(e * 500 % 5_000_000)
    rows = feed(spark, d).select("user_id", "us", F.when(e % 3 == 0, "control").otherwise("data").alias("kind"), (e % 4 != 1).alias("sent"), size.alias("size"), (e % 4_500).alias("queued"))
    return coverage.transport_limits(rows, ["user_id"], "us", 864_000_000_000)


@query(f"with {FEED}, r as (select sym, id, us, us - us % 3600000000 + case when eid % 13 = 5 then 3600000000 else 0 end as declared from feed) select sym, id, declared // 3600000000 as segment_index, us // 3600000000 as actual_segment from r where us // 3600000000 <> declared // 3600000000")
def segment_membership(spark, d):
    """Records whose time is not in the segment that declares them."""
    hour = 3_600_000_000
    declared = F.expr(f"us div {hour}") + F.when(F.col("eid") % 13 == 5, 1).otherwise(0)
    rows = feed(spark, d).select("sym", "id", F.col("us").alias("mono_ns"), F.lit(0).cast("bigint").alias("start_ns"), declared.alias("segment_index"))
    return coverage.segment_membership(rows, hour).select("sym", "id", "segment_index", "actual_segment")


@query(f"""with {FEED}, f as (select sym, id, id * 2 + case when eid % 37 = 3 then 5 else 0 end as first_id, id * 2 + 1 + case when eid % 37 = 3 then 5 else 0 end as final_id from feed), l as (select *, lag(final_id) over (partition by sym order by id) as p from f)
select sym, id as frame, case when p is not null and first_id <> p + 1 then 'GAP' else 'APPLIED' end as step from l""")
def derived_book_gaps(spark, d):
    """Where a book without snapshots breaks, by the relational rule of its fold: a frame that does not follow the one before."""
    shift = F.when(F.col("eid") % 37 == 3, 5).otherwise(0)
    rows = feed(spark, d).select("sym", F.col("id").alias("frame"), (F.col("id") * 2 + shift).alias("first_id"), (F.col("id") * 2 + 1 + shift).alias("final_id"))
    steps = carried(rows, SYM, "frame", prev={"_final": F.col("final_id")})
    return steps.select("sym", "frame", F.when(F.col("_final").isNotNull() & (F.col("first_id") != F.col("_final") + 1), "GAP").otherwise("APPLIED").alias("step"))


@query(f"""with {FEED}, s as (select user_id, us, eid, eid % 91 as rtt, count(*) over (partition by user_id order by us range between 86400000000 preceding and current row) as in_window, first_value(eid % 91) over w as v0, first_value(us) over w as t0, min(us) over (partition by user_id) as connected from feed window w as (partition by user_id order by us rows between 31 preceding and current row))
select eid, round((in_window - 2)::DOUBLE / 2, 6) as rate_deviation, coalesce(case when us - t0 > 0 then (rtt - v0)::DOUBLE / (us - t0) end > 1e-10, false) as rtt_rising, us - connected >= 432000000000 as preventive_rotation from s""")
def anticipation(spark, d):
    """Signals that a connection is about to fail: rate, rising round trips, age."""
    f = feed(spark, d)
    rows = f.join(f.groupBy("user_id").agg(F.min("us").alias("connected")), "user_id").withColumn("rtt", F.col("eid") % 91)
    out = latency.anticipation(rows, ["user_id"], "us", "rtt", "connected", 86_400_000_000, 2, 1e-10, 432_000_000_000)
    return out.select("eid", F.round("rate_deviation", 6).alias("rate_deviation"), "rtt_rising", "preventive_rotation")


@query(f"""with {FEED} select eid, case when d = 0 and i = 'C' then 'V_DNS_UNAVAILABLE_INTERNET_TCP_REACHABLE' when v = 'C' and i = 'C' then 'V_AND_INDEPENDENT_TCP_REACHABLE' when v = 'F' and i = 'C' then 'V_PATH_SPECIFIC_TCP_FAILURE_FROM_THIS_HOST' when v = 'C' and i = 'F' then 'INDEPENDENT_WITNESS_FAILURE_V_TCP_REACHABLE'
when i = 'F' and coalesce(v, 'F') = 'F' and (not up or not routed) then 'LOCAL_INTERFACE_OR_ROUTE_UNAVAILABLE' when i = 'F' and coalesce(v, 'F') = 'F' then 'SHARED_PATH_FAILURE_FROM_THIS_HOST' else 'INSUFFICIENT_NETWORK_WITNESS_EVIDENCE' end as class
from (select eid, eid % 5 as d, case when eid % 3 = 0 then 'C' when eid % 3 = 1 then 'F' end as v, case when eid % 7 < 3 then 'C' else 'F' end as i, eid % 11 <> 0 as up, eid % 13 <> 0 as routed from feed)""")
def witness_classes(spark, d):
    """What a network witness' sample says about reachability."""
    e = F.col("eid")
    sample = lambda target, status: F.struct(F.lit(target).alias("target"), status.alias("status"))
    v, i = F.when(e % 3 == 0, "CONNECTED").otherwise("FAILED"), F.when(e % 7 < 3, "CONNECTED").otherwise("TIMEOUT")
    tcp = F.when(e % 3 == 2, F.array(sample("INDEPENDENT_INTERNET", i))).otherwise(F.array(sample("V_PUBLIC_STREAM", v), sample("INDEPENDENT_INTERNET", i)))
    dns = F.array(F.struct(F.when(e % 5 == 0, "FAILED").otherwise("RESOLVED").alias("status")))
    routes = F.array(sample("INDEPENDENT_INTERNET", F.when(e % 13 != 0, "ROUTE_SELECTED").otherwise("NONE")))
    card = F.array(F.struct(F.when(e % 11 != 0, "Up").otherwise("Down").alias("status"), F.lit("Ethernet").alias("type"), F.array(F.lit("10.0.0.1")).alias("gateways")))
    return feed(spark, d).select("eid", coverage.witness_class(dns, tcp, routes, card, venue="V").alias("class"))


# --- scalars ------------------------------------------------------------------------------------------------------------


@query(f"with {FEED} select eid, CAST(price + qty AS DECIMAL(28,8)) as total, CAST(price - qty AS DECIMAL(28,8)) as rest, sign(price - qty)::INTEGER as compared from feed")
def decimal_arithmetic(spark, d):
    p, q = F.col("price"), F.col("qty")
    return feed(spark, d).select("eid", decimals.add(p, q).alias("total"), decimals.subtract(p, q).alias("rest"), decimals.compare(p, q).cast("int").alias("compared"))


@query(f"with {FEED} select eid, case when eid % 5 = 0 then null else (us + case when eid % 5 = 1 then 0 else -7200000000 end) * 1000 end as ns, strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%fZ') as text from feed")
def utc_conversions(spark, d):
    """Instants written with a zone to nanoseconds; without one there is no instant."""
    plain = F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(F.col("eid") % 5 == 0, "").when(F.col("eid") % 5 == 1, "Z").otherwise("+02:00")
    return feed(spark, d).select("eid", wire.utc_ns(F.concat(plain, zone)).alias("ns"), wire.utc_text(F.col("us") * 1_000).alias("text"))


@query(f"with {FEED} select sym, id, eid from feed order by eid desc limit 5000")
def retained_ids(spark, d):
    """The newest identities: a bounded retention."""
    return union.newest_ids(feed(spark, d).select("sym", "id", "eid"), "eid", 5_000)


@query(f"with {FEED} select eid, rtrim(rpad(event_type, 10, ' ')) as text from feed")
def alpha_fields(spark, d):
    """Texts in fields of fixed length, without the blanks that fill them."""
    rows = feed(spark, d).select("eid", F.concat(F.lit("xx"), F.rpad("event_type", 10, " ")).cast("binary").alias("b"))
    return rows.select("eid", wire.alpha(F.col("b"), 2, 10).alias("text"))


@query(f"with {FEED} select eid, case when eid % 4 = 3 then 'symbol' when eid % 5 = 4 then 'stream' when eid % 7 not in (0, 1) then 'limit' end as reject from feed")
def scope_predicate(spark, d):
    e = F.col("eid")
    symbol = F.when(e % 4 == 0, "BTCUSDT").when(e % 4 == 1, "ethusdt").when(e % 4 == 2, "EthUsdt").otherwise("XRPUSDT")
    stream = F.when(e % 5 == 4, "kline").when(e % 5 < 2, "depth").when(e % 5 == 2, "trade").otherwise("bookTicker")
    return feed(spark, d).select("eid", wire.scope_reject(symbol, stream, F.when(e % 7 == 0, 5000).when(e % 7 == 1, 100).otherwise(e % 7 + 30)).alias("reject"))


@query(f"""with {FEED}, t as (select eid, case when eid % 2 = 0 then 'PRIMARY' else 'SHADOW' end as lane, eid as attempt, eid % 9 as failures, 't' || sym as token from feed),
h as (select *, sha256(encode(lane) || unhex({' || '.join(f"substr(printf('%016x', attempt), {15 - 2 * i}, 2)" for i in range(8))}) || unhex({' || '.join(f"substr(printf('%08x', failures), {7 - 2 * i}, 2)" for i in range(4))}) || encode(token)) as dg from t),
j as (select *, CAST(('0x' || {' || '.join(f"substr(dg, {15 - 2 * i}, 2)" for i in range(8))})::UBIGINT % 501 AS BIGINT) as jitter, CAST(least(250 * power(2, greatest(failures - 1, 0)), 20000) AS BIGINT) as base from h) select eid, least(base + jitter, 20000) as delay_ms from j""")
def reconnect_delays(spark, d):
    lane = F.when(F.col("eid") % 2 == 0, "PRIMARY").otherwise("SHADOW")
    return feed(spark, d).select("eid", wire.reconnect_delay_ms(lane, F.col("eid"), F.col("eid") % 9, F.concat(F.lit("t"), F.col("sym").cast("string")), 250, 20_000, 500).alias("delay_ms"))


PATHS = ["a/b.json", "/a", "a//b", "a/../b", "./a", "a\\\\b", "c:/a", " a", "a ", "a/b c/d", "", "..", "a/.b", "a/..b"]
SAFE = (1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 1, 1)


@query(f"with {FEED} select eid, eid % {len(PATHS)} in ({', '.join(str(i) for i, ok in enumerate(SAFE) if ok)}) as safe from feed")
def safe_paths(spark, d):
    path = F.element_at(F.array(*(F.lit(x) for x in PATHS)), (F.col("eid") % len(PATHS) + 1).cast("int"))
    return feed(spark, d).select("eid", wire.safe_path(path).alias("safe"))


@query(f"""with {FEED}, g as (select sym, us - lag(us) over (partition by sym order by id) as gap from feed), v as (select sym, gap as x, greatest(length(ltrim(bin(gap | 2047), '0')) - 11, 0) as b from g where gap between 0 and 3600000000000),
r as (select sym, (x >> b) << b as lowest, ((x >> b) << b) + (1::BIGINT << (b + case when (x >> b) >= 2048 then 1 else 0 end)) - 1 as highest from v), m as (select *, lowest + ((highest - lowest + 1) >> 1) as mid from r)
select sym, count(*) as n, round(avg(mid::DOUBLE), 3) as mean, round(stddev_pop(mid::DOUBLE) / 1e6, 3) as stddev, min(lowest) as min, max(highest) as max from m group by sym""")
def hdr_moments(spark, d):
    from ..functions import hdr

    gaps = latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH)
    out = hdr.moments(hdr.histogram(gaps, "gap", SYM), SYM)
    return out.select("sym", *big("n"), F.round("mean", 3).alias("mean"), F.round(F.col("stddev") / 1e6, 3).alias("stddev"), "min", "max")


@query(f"with {FEED} select sym, count(*) filter (where id > 10 and eid % 9 = 0) as missing, count(*) filter (where id > 10 and eid % 9 <> 0 and eid % 14 = 5) * 2 as both from feed group by sym")
def union_oracle(spark, d):
    """Published trades against the raw union above the floor: some are left out, some have another digest, which is a trade missing and one invented."""
    f = feed(spark, d)
    digest = lambda text: F.sha2(text, 256).alias("observation_sha256")
    raw = f.select("sym", F.col("id").alias("trade_id"), digest(F.col("eid").cast("string")))
    shown = f.where("eid % 9 <> 0").select("sym", F.lit("TRADE_OBSERVATION").alias("event"), F.col("id").alias("trade_id"), digest(F.when(F.col("eid") % 14 == 5, "x").otherwise(F.col("eid").cast("string"))), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("bigint").alias("trade_floor"))
    start = f.select("sym").distinct().select("sym", F.lit("ARBITRATION_STARTED").alias("event"), F.lit(None).cast("bigint").alias("trade_id"), F.lit(None).cast("string").alias("observation_sha256"), F.lit(None).cast("string").alias("kind"), F.lit(10).cast("bigint").alias("trade_floor"))
    out = oracle.verify_union(shown.where("trade_id > 10").unionByName(start), raw, SYM)
    wrong = F.col("invented")
    return out.select("sym", (F.col("missing") - wrong).cast("bigint").alias("missing"), (wrong * 2).cast("bigint").alias("both"))


@query(f"with {FEED}, t as (select sym, id as record_index, case when id > 0 then id - case when eid % 83 = 9 then 3 else 0 end end as trade_id from feed), l as (select *, max(trade_id) over (partition by sym order by record_index rows between unbounded preceding and 1 preceding) as last, max(record_index) over (partition by sym) // 2 as cut from t) select sym, record_index, 'trade order' as rule from l where trade_id <= last and record_index >= cut")
def tail_audit(spark, d):
    """The second half of every journal, audited with the context of the first half only."""
    f = feed(spark, d)
    own = F.sha2(F.col("eid").cast("string"), 256)
    rows = carried(f, SYM, "id", prev={"_before": own})
    columns = dict(part.rsplit(" ", 1) for part in oracle.PAYLOAD.split(", "))
    made = {"event": F.when(F.col("id") == 0, "ARBITRATION_STARTED").otherwise("TRADE_OBSERVATION"), "trade_id": F.when(F.col("id") > 0, F.col("id") - F.when(F.col("eid") % 83 == 9, 3).otherwise(0))}
    payload = [(made[n] if n in made else F.lit(None)).cast(t).alias(n) for n, t in columns.items() if n != "record_sha256"]
    journal = rows.select("sym", F.col("id").alias("record_index"), own.alias("record_sha256"), F.coalesce("_before", F.lit("0" * 64)).alias("previous_record_sha256"), *payload)
    journal = journal.join(journal.groupBy("sym").agg(F.max("record_index").alias("top")), "sym").withColumn("cut", F.expr("top div 2"))
    context = oracle.journal_context(journal.where("record_index < cut"), SYM)
    return oracle.journal_violations(journal.where("record_index >= cut").drop("top", "cut"), SYM, context)


# --- sessions in SQL ----------------------------------------------------------------------------------------------------

#: The order sessions of `ouch_session` come in cycles of five: two orders entered, the first replaced, the second executed, the replacing one cancelled in part.
SQL["ouch_session"] = f"""with {FEED}, e as (select sym, id, eid, eid % 5 as p, eid % 100 + 1 as qty, eid % 31 = 0 as late from feed),
x as (select *, lag(id, 2) over w is not null as earlier, lag(qty, 2) over w as q2, lag(late, 2) over w as late2, lag(id, 4) over w is not null as whole from e window w as (partition by sym order by id)),
o as (select sym, id as seq, case when p < 2 then id + 1 when p = 2 then id + 1 else id - 1 end as user_ref, p, qty, late, earlier, q2, case when p = 4 then whole and not late2 else earlier end as known from x)
select sym, seq, case when p < 2 then 'Accepted' when not known then 'SilentlyIgnored' when p = 2 and late then 'Rejected' when p = 2 then 'Replaced' when p = 3 then 'Executed' when qty < q2 then 'Canceled' else 'SilentlyIgnored' end as outcome, user_ref,
case when p < 2 then qty when not known then 0 when p = 2 and not late then qty when p = 3 then greatest(q2 - qty, 0) when p = 4 then least(qty, q2) else 0 end as live_qty,
case when p = 3 and known then qty else 0 end as executed, case when p = 4 and known then greatest(q2 - qty, 0) else 0 end as cancelled from o"""

#: A step takes the next message, or a held one whose turn has come.
SQL["fix_session"] = f"""with recursive {FEED}, m as (select sym, id as arrival, case when id = 0 then 'A' when eid % 11 = 3 then '1' else '0' end as kind, case when id = 0 then 1 else id + 1 + case when eid % 23 = 5 then 1 when eid % 23 = 21 then -1 else 0 end end as seq, eid::VARCHAR as test_id from feed),
st as (select distinct sym, 0 as step, 0::BIGINT as nxt, 1::BIGINT as expected, 'AWAITING_LOGON' as state, []::STRUCT(seq BIGINT, kind VARCHAR, test_id VARCHAR, arrival BIGINT)[] as held, false as drain, null::VARCHAR as action, null::BIGINT as msg_seq, null::VARCHAR as reply, null::BIGINT as arrival from feed
union all select sym, step + 1, case when drain then nxt else nxt + 1 end, e2, s2, h2, takes and len(list_filter(h2, lambda h: h.seq = e2)) > 0, case when drain then 'DRAINED' when refused then 'REJECTED_NOT_LOGGED_ON' when seq > expected then 'HELD' when seq < expected then 'IGNORED' else 'CONSUMED' end, seq,
  case when refused then null when takes and kind = '1' then '35=0|112=' || test_id when seq > expected then '35=2|7=' || expected || '|16=' || (seq - 1) end, came
from (select *, case when takes then list_filter(held, lambda h: h.seq >= e2) when not refused and seq > expected then list_append(list_filter(held, lambda h: h.seq <> seq), {{'seq': seq, 'kind': kind, 'test_id': test_id, 'arrival': came}}) else held end as h2
from (select *, case when takes then expected + 1 else expected end as e2, case when refused then state when kind = 'A' and (takes or seq > expected) then 'LOGGED_ON' when takes and kind = '5' then 'CLOSED' else state end as s2
from (select *, not refused and seq = expected as takes from (select *, not drain and kind not in ('A', '5') and state <> 'LOGGED_ON' as refused
from (select st.sym, st.step, st.nxt, st.expected, st.state, st.held, st.drain, case when st.drain then t.seq else m.seq end as seq, case when st.drain then t.kind else m.kind end as kind, case when st.drain then t.test_id else m.test_id end as test_id, case when st.drain then t.arrival else m.arrival end as came
from (select *, list_filter(held, lambda h: h.seq = expected)[1] as t from st) st left join m on m.sym = st.sym and m.arrival = st.nxt where st.drain or m.sym is not null))))))
select sym, arrival, action, msg_seq, reply, expected, state from st where step > 0"""
