"""Registered queries: each operator over the plain tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decimals, digests, hdr, wire
from ..operators import book, coverage, latency, oracle, seq, sessions, splice, union
from ..operators.ordered import WIDTH, carried
from .feed import DIFFS, FEED, LANES, LEVELS, PERTURBED, diffs, feed, lanes, levels, perturbed, row_order, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SYM = ["sym"]
#: Blocks of windows by time, in microseconds.
DAY_US = 86_400_000_000


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def big(*columns: str) -> list[F.Column]:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# --- sequences ----------------------------------------------------------------------------------------------------------

STEPS = f"""with {FEED}, {PERTURBED}, steps as (select *, lag(id) over (partition by sym order by arrival) as prev from perturbed)"""


@query(f"""{STEPS} select sym, count(*) as records, arg_min(id, arrival) as first_id, arg_max(id, arrival) as last_id, count(*) filter (where id = prev) as duplicates,
count(*) filter (where id < prev) as out_of_order, count(*) filter (where id > prev + 1) as jumps, CAST(coalesce(sum(id - prev - 1) filter (where id > prev + 1), 0) AS BIGINT) as missing_sum from steps group by sym""")
def seq_identity_report(spark, d):
    return seq.identity_report(perturbed(spark, d), SYM, "id", "arrival")


@query(f"{STEPS} select sym, id, arrival, prev as prev_id from steps where id <= prev")
def seq_strict_violations(spark, d):
    return seq.strict_violations(perturbed(spark, d), SYM, "id", "arrival").select("sym", "id", "arrival", "prev_id")


@query(f"{STEPS} select sym, id, prev as prev_id from steps where id > prev + 1")
def seq_jump_rows(spark, d):
    return seq.arrival_steps(perturbed(spark, d), SYM, "id", "arrival").where("step = 'jump'").select("sym", "id", "prev_id")


MISSING = """missing as (select a.sym, a.id from feed a where not ({keep})), islands as (select sym, id, id - row_number() over (partition by sym order by id) as g from missing),
gaps as (select sym, min(id) as first_missing, max(id) as last_missing, count(*) as n_missing from islands group by sym, g)"""


def lane_gaps(spark, d, keep: str) -> DataFrame:
    f = feed(spark, d)
    top = f.groupBy("sym").agg(F.max("id").alias("high"))
    return seq.gap_islands(f.where(keep).join(top, "sym"), SYM, "id", 0, F.col("high"))


@query(f"with {FEED}, {MISSING.format(keep='eid % 11 <> 3')} select * from gaps")
def lane_gap_islands(spark, d):
    return lane_gaps(spark, d, "eid % 11 <> 3")


@query(f"with {FEED}, {MISSING.format(keep='eid % 11 <> 3 or eid % 13 <> 5')} select * from gaps")
def consumer_gap_islands(spark, d):
    return seq.intersect_ranges(lane_gaps(spark, d, "eid % 11 <> 3"), lane_gaps(spark, d, "eid % 13 <> 5"), SYM)


@query(f"with {FEED}, {MISSING.format(keep='eid % 29 = 0 or eid % 3 = 1')} select * from gaps")
def reconcile_missing(spark, d):
    return lane_gaps(spark, d, "eid % 29 = 0 or eid % 3 = 1")


@query(f"with {FEED}, {DIFFS}, p as (select *, lag(final_id) over (partition by sym order by id) as prev_final from diffs) select sym, id, first_id, final_id, prev_final from p where not coalesce(first_id <= prev_final + 1 and prev_final + 1 <= final_id, true)")
def bridge_check(spark, d):
    return seq.bridge_status(diffs(spark, d), SYM, "first_id", "final_id", "id").where("not bridged").drop("bridged")


@query(f"with {FEED}, p as (select sym, id, lag(id) over (partition by sym order by id) as prev_id from feed where eid % 11 <> 3) select * from p where id <> prev_id + 1")
def contiguity_check(spark, d):
    return seq.contiguity_status(feed(spark, d).where("eid % 11 <> 3").select("sym", "id"), SYM, "id", "id").where("not contiguous").drop("contiguous")


@query(f"""with {FEED}, {DIFFS}, p as (select *, max(final_id) over (partition by sym order by id rows between unbounded preceding and 1 preceding) + 1 as expected from diffs)
select sym, case when expected is null then 'START' when final_id < expected then 'COVERED' when first_id = expected then 'CONTIGUOUS' when first_id > expected then 'MISSING' else 'STRADDLE' end as frontier, count(*) as n from p group by all""")
def depth_frontier_class(spark, d):
    return seq.frontier_class(diffs(spark, d), SYM, "first_id", "final_id", "id").groupBy("sym", "frontier").agg(F.count(F.lit(1)).alias("n"))


CHAIN_SQL = f"with {FEED}, own as (select sym, id, sha256(eid::VARCHAR) as record_sha256 from feed), chain as (select *, case when id % 37 = 5 then repeat('f', 64) else coalesce(lag(record_sha256) over (partition by sym order by id), repeat('0', 64)) end as previous_record_sha256 from own)"


def chain(spark, d) -> DataFrame:
    own = feed(spark, d).select("sym", "id", F.sha2(F.col("eid").cast("string"), 256).alias("record_sha256"))
    before = F.coalesce("_before", F.lit(digests.ZERO_DIGEST))
    rows = carried(own, SYM, "id", prev={"_before": F.col("record_sha256")})
    return rows.withColumn("previous_record_sha256", F.when(F.col("id") % 37 == 5, F.repeat(F.lit("f"), 64)).otherwise(before)).drop("_before")


@query(f"{CHAIN_SQL}, v as (select *, coalesce(lag(record_sha256) over (partition by sym order by id), repeat('0', 64)) as want from chain) select sym, id, record_sha256 from v where previous_record_sha256 <> want")
def hash_chain_audit(spark, d):
    return seq.hash_chain(chain(spark, d), SYM, "id").where("not chained").select("sym", "id", "record_sha256")


@query(f"{CHAIN_SQL}, v as (select *, coalesce(lag(record_sha256) over (partition by sym order by id), repeat('0', 64)) as want from chain), bad as (select sym, min(id) as cut from v where previous_record_sha256 <> want group by sym) select v.sym, count(*) as records, max(id) as last_id from v left join bad using (sym) where cut is null or id < cut group by v.sym")
def valid_prefix(spark, d):
    ok = seq.hash_chain(chain(spark, d), SYM, "id")
    return seq.valid_prefix(ok, SYM, "id", F.col("chained")).groupBy("sym").agg(F.count(F.lit(1)).alias("records"), F.max("id").alias("last_id"))


@query(f"with {FEED}, {DIFFS}, p as (select *, coalesce(lag(final_id) over (partition by sym order by id), -1) as prev from diffs), bad as (select sym, min(id) as cut from p where not (first_id <= prev + 1 and prev + 1 <= final_id) group by sym) select p.sym, count(*) as trusted from p left join bad using (sym) where cut is null or id < cut group by p.sym")
def trusted_prefix(spark, d):
    rows = diffs(spark, d).withColumn("start", F.lit(-1).cast("bigint"))
    return seq.trusted_prefix(rows, SYM, "first_id", "final_id", "id", "start").groupBy("sym").agg(F.count(F.lit(1)).alias("trusted"))


@query("with p as (select l_orderkey, l_partkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as expected_frame from lineitem) select l_orderkey, l_partkey, l_linenumber, expected_frame from p where l_linenumber <> expected_frame")
def lineitem_contiguity(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber")
    bad = seq.frame_contiguity(rows, ["l_orderkey"], "l_linenumber", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], start=1, width=None)  # an order has few lines
    return bad.select("l_orderkey", "l_partkey", "l_linenumber", "expected_frame")


@query(f"with {FEED}, k as (select sym, id, row_number() over (partition by sym order by id) - 1 as expected_frame from feed where eid % 500 <> 77) select * from k where id <> expected_frame")
def frame_contiguity(spark, d):
    return seq.frame_contiguity(feed(spark, d).where("eid % 500 <> 77").select("sym", "id"), SYM, "id")


SEGMENTS = f"""with {FEED}, s as (select sym, (us - min(us) over (partition by sym)) // 43200000000 as segment_index, id, eid, qty from feed)"""


def segments(spark, d) -> DataFrame:
    f = feed(spark, d)
    start = f.groupBy("sym").agg(F.min("us").alias("_start"))
    return f.join(start, "sym").withColumn("segment_index", coverage.segment_of(F.col("us"), F.col("_start"), 43_200_000_000)).drop("_start")


@query(f"{SEGMENTS} select sym, segment_index, count(*) as records, min(id) as first_frame, max(id) as last_frame, CAST(sum(qty) AS DECIMAL(28,8)) as qty from s group by all")
def segment_rollup(spark, d):
    return segments(spark, d).groupBy("sym", "segment_index").agg(F.count(F.lit(1)).alias("records"), F.min("id").alias("first_frame"), F.max("id").alias("last_frame"), F.sum("qty").cast("decimal(28,8)").alias("qty"))


@query(f"""{SEGMENTS}, g as (select sym, segment_index, min(id) as first_frame, max(id) as last_frame, sha256(arg_min(eid, id)::VARCHAR) as a, sha256((arg_max(eid, id) + 16)::VARCHAR) as terminal_digest from s where segment_index % 9 <> 4 group by all),
h as (select *, case when segment_index % 7 = 3 then 'x' else a end as start_digest from g), w as (select *, lag(segment_index) over o as ps, lag(last_frame) over o as pf, lag(terminal_digest) over o as pt from h window o as (partition by sym order by segment_index))
select sym, segment_index, case when segment_index <> ps + 1 then 'segment index' when first_frame <> pf + 1 then 'frame index' else 'terminal digest' end as reason from w where ps is not null and (segment_index <> ps + 1 or first_frame <> pf + 1 or start_digest <> pt)""")
def segment_transitions(spark, d):
    s = segments(spark, d).where("segment_index % 9 <> 4").groupBy("sym", "segment_index").agg(F.min("id").alias("first_frame"), F.max("id").alias("last_frame"), F.min_by("eid", "id").alias("a"), F.max_by("eid", "id").alias("b"))
    text = lambda c: F.sha2(c.cast("string"), 256)
    rows = s.withColumn("start_digest", F.when(F.col("segment_index") % 7 == 3, "x").otherwise(text(F.col("a")))).withColumn("terminal_digest", text(F.col("b") + 16))
    return seq.segment_transitions(rows, SYM).select("sym", "segment_index", "reason")


@query(f"with {FEED}, c as (select sym, id, id * 5 - case when eid % 41 = 2 then 9 else 0 end as frames, id - case when eid % 67 = 3 then 4 else 0 end as acks from feed), l as (select *, lag(frames) over w as pf, lag(acks) over w as pa from c window w as (partition by sym order by id)) select sym, id, case when frames < pf and acks < pa then 'frames,acks' when frames < pf then 'frames' else 'acks' end as fallen from l where frames < pf or acks < pa")
def monotone_counters(spark, d):
    f = feed(spark, d)
    rows = f.select("sym", "id", (F.col("id") * 5 - F.when(F.col("eid") % 41 == 2, 9).otherwise(0)).alias("frames"), (F.col("id") - F.when(F.col("eid") % 67 == 3, 4).otherwise(0)).alias("acks"))
    return seq.monotone_violations(rows, SYM, "id", ["frames", "acks"]).select("sym", "id", F.array_join("fallen", ",").alias("fallen"))


RUNS = f"with {FEED}, m as (select *, case when event_type is not distinct from lag(event_type) over w and lag(id) over w is not null then 0 else 1 end as c from feed window w as (partition by sym order by id)), r as (select *, sum(c) over (partition by sym order by id) as run from m)"


@query(f"{RUNS} select sym, event_type, min(id) as first_id, max(id) as last_id, min(us) as first_us, max(us) as last_us, count(*) as n from r group by sym, run, event_type")
def classification_runs(spark, d):
    return seq.runs(feed(spark, d), SYM, "id", "event_type", "us")


@query(f"with {FEED}, r as (select sym, case when eid % 31 = 0 then id - 1 else id end as v, sha256((case when eid % 62 = 0 then eid else eid - case when eid % 31 = 0 then 16 else 0 end end)::VARCHAR) as dg, id from feed), l as (select *, lag(v) over w as pv, lag(dg) over w as pd from r window w as (partition by sym order by id)) select sym, case when pv is null or v > pv then 'NEW' when v < pv then 'STALE' when dg = pd then 'DUPLICATE' else 'CONFLICT' end as disposition, count(*) as n from l group by all")
def published_duplicates(spark, d):
    again = F.col("eid") % 31 == 0
    text = F.when(F.col("eid") % 62 == 0, F.col("eid")).otherwise(F.col("eid") - F.when(again, 16).otherwise(0))
    rows = feed(spark, d).select("sym", "id", F.when(again, F.col("id") - 1).otherwise(F.col("id")).alias("v"), F.sha2(text.cast("string"), 256).alias("dg"))
    return seq.published_duplicates(rows, SYM, "v", "dg", "id").groupBy("sym", "disposition").agg(F.count(F.lit(1)).alias("n"))


@query(f"{SEGMENTS}, m as (select sym, segment_index, max(id) as last_trade from s group by all), g as (select *, coalesce(lag(last_trade) over (partition by sym order by segment_index), 0) - case when segment_index % 11 = 4 then 1 else 0 end as floor from m), w as (select *, greatest(lag(floor) over o, lag(last_trade) over o) as expected_floor from g window o as (partition by sym order by segment_index)) select sym, segment_index, floor, expected_floor from w where floor <> expected_floor")
def trade_floor_chain(spark, d):
    g = segments(spark, d).groupBy("sym", "segment_index").agg(F.max("id").alias("last_trade"))
    rows = g.withColumn("floor", F.coalesce(F.lag("last_trade").over(seq.by(SYM, "segment_index")), F.lit(0)) - F.when(F.col("segment_index") % 11 == 4, 1).otherwise(0))
    return seq.floor_chain(rows, SYM).where("not floor_ok").select("sym", "segment_index", "floor", "expected_floor")


@query(f"with {FEED} select sym, count(distinct event_type) as n_identities, count(distinct event_type) = 1 as homogeneous from feed group by sym")
def identity_homogeneity(spark, d):
    return seq.homogeneous(feed(spark, d), SYM, ["event_type"])


@query("select event_id, event_type from events order by event_id limit 25")
def first_frames(spark, d):
    return seq.first_rows(table(spark, d, "events").select("event_id", "event_type"), "event_id", 25)


@query("select event_id, event_type from events order by event_id desc limit 200000")
def tail_rows(spark, d):
    return seq.last_rows(table(spark, d, "events").select("event_id", "event_type"), "event_id", 200_000)


# --- unions -------------------------------------------------------------------------------------------------------------


@query(f"with {FEED}, {LANES} select sym, id, arg_min(lane, arrival) as first_lane, min(arrival) as first_arrival, arg_min(digest, arrival) as digest, count(*) as copies, min(digest) <> max(digest) as conflict from lane_rows group by sym, id")
def two_lane_union(spark, d):
    return union.distinct_union(row_order(lanes(spark, d)), SYM, "id", "lane", "arrival", "digest")


@query(f"with {FEED}, {LANES}, u as (select sym, id, arg_min(lane, arrival) as first_lane from lane_rows group by sym, id) select sym, first_lane, count(*) as n from u group by all")
def union_first_lane_counts(spark, d):
    u = union.distinct_union(row_order(lanes(spark, d)), SYM, "id", "lane", "arrival", "digest")
    return u.groupBy("sym", "first_lane").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {FEED}, {LANES} select sym, id, count(distinct digest) as digests, count(*) as copies from lane_rows group by sym, id having count(distinct digest) > 1")
def union_conflicts(spark, d):
    return union.conflicts(lanes(spark, d), SYM, "id", "digest")


WATERMARK = f"""with {FEED}, {LANES}, w as (select *, least(coalesce(max(case when lane = 'P' then id + 1 end) over o, 0), coalesce(max(case when lane = 'S' then id + 1 end) over o, 0)) as watermark
from lane_rows window o as (partition by sym order by arrival rows between unbounded preceding and current row)),
fa as (select sym, id, min(arrival) as fa, arg_min(digest, arrival) as fd from lane_rows group by sym, id),
ea as (select f.sym, f.id, f.fa, f.fd, min(w.arrival) as ea from fa f left join w on w.sym = f.sym and w.arrival >= f.fa and w.watermark > f.id group by all),
lastpub as (select r.sym, r.arrival, max(e.id) as last from lane_rows r left join ea e on e.sym = r.sym and e.ea < r.arrival group by all),
x as (select r.*, e.fa, e.fd, e.ea, coalesce(r.id <= l.last, false) as late from lane_rows r join ea e using (sym, id) join lastpub l on l.sym = r.sym and l.arrival = r.arrival),
k as (select *, max(case when arrival = fa and not late then 1 else 0 end) over (partition by sym, id) = 1 as known from x),
disp as (select *, case when late and not known and arrival = fa then 'LATE_UNKNOWN' when late and digest = fd then 'LATE_DUPLICATE' when late then 'LATE_CONFLICT' when arrival = fa then 'BUFFERED' when digest = fd then 'DUPLICATE' else 'CONFLICT' end as disposition from k)"""


def dispositions(spark, d) -> DataFrame:
    return union.watermark_union(row_order(lanes(spark, d)), SYM, "id", "lane", "arrival", "digest", ["P", "S"])


@query(f"{WATERMARK} select sym, id, lane, arrival, ea as emitted_at from disp where disposition = 'BUFFERED'")
def union_emission_watermark(spark, d):
    return union.published(dispositions(spark, d)).select("sym", "id", "lane", "arrival", "emitted_at")


@query(f"{WATERMARK} select sym, id, lane, disposition from disp where disposition like 'LATE%'")
def late_corrections(spark, d):
    return dispositions(spark, d).where("disposition like 'LATE%'").select("sym", "id", "lane", "disposition")


@query(f"with {FEED}, {LANES}, raw as (select distinct sym, id, digest from lane_rows), pub as (select sym, id, digest from lane_rows where lane = 'P') select sym, id, digest from raw except select sym, id, digest from pub")
def raw_union_missing(spark, d):
    rows = lanes(spark, d)
    return oracle.missing(rows.where("lane = 'P'"), rows, ["sym", "id", "digest"])


@query(f"with {FEED}, {LANES}, ev as (select distinct sym, id, digest from lane_rows where lane = 'P') select s.sym, s.id, s.digest from lane_rows s where lane = 'S' and not exists (select 1 from ev where ev.sym = s.sym and ev.id = s.id and ev.digest = s.digest)")
def raw_union_invented(spark, d):
    rows = lanes(spark, d)
    return oracle.invented(rows.where("lane = 'S'"), rows.where("lane = 'P'"), ["sym", "id", "digest"])


@query(f"with {FEED}, {LANES}, ev as (select distinct sym, id, digest from lane_rows where lane = 'P') select s.sym, count(*) as proven from lane_rows s where lane = 'S' and exists (select 1 from ev where ev.sym = s.sym and ev.id = s.id and ev.digest = s.digest) group by s.sym")
def published_proof(spark, d):
    rows = lanes(spark, d)
    return oracle.proven(rows.where("lane = 'S'"), rows.where("lane = 'P'"), ["sym", "id", "digest"]).groupBy("sym").agg(F.count(F.lit(1)).alias("proven"))


@query(f"with {FEED}, {LANES}, a as (select sym, id, digest from lane_rows where lane = 'P'), b as (select sym, id, digest from lane_rows where lane = 'S'), n as (select (select count(*) from (select * from a except all select * from b)) as only_a, (select count(*) from (select * from b except all select * from a)) as only_b) select *, only_a = 0 and only_b = 0 as equal from n")
def set_equality(spark, d):
    rows = lanes(spark, d).select("sym", "id", "digest", "lane")
    a, b = rows.where("lane = 'P'").drop("lane"), rows.where("lane = 'S'").drop("lane")
    return oracle.equal_sets(a, b).select(*big("only_a", "only_b"), "equal")


@query(f"with {FEED}, {LANES} select sym, id, array_to_string(list_sort(list(distinct digest)), ',') as evidence, count(*) as copies from lane_rows group by sym, id")
def evidence_map(spark, d):
    return oracle.evidence_map(lanes(spark, d), SYM, "id", "digest").withColumn("evidence", F.array_join("evidence", ","))


@query(f"with {FEED}, {DIFFS}, pts as (select sym, id * 3 + 2 as point from feed where eid % 5 = 0) select p.sym, p.point, exists (select 1 from diffs x where x.sym = p.sym and x.first_id <= p.point and p.point <= x.final_id and x.id % 4 <> 1) as covered from pts p")
def final_omission(spark, d):
    pts = feed(spark, d).where("eid % 5 = 0").select("sym", (F.col("id") * 3 + 2).alias("point"))
    return oracle.covers(diffs(spark, d).where("id % 4 <> 1"), pts, SYM, "point", "first_id", "final_id")


@query(f"""with {FEED}, src as (select sym, id, 0 as r, 'live' as provenance from feed where eid % 3 <> 0 union all select sym, id, 1, 'cache' from feed where eid % 2 = 0 union all select sym, id, 2, 'backfill' from feed where eid % 5 = 0),
u as (select *, row_number() over (partition by sym, id order by r) as n from src) select sym, id, provenance from u where n = 1""")
def layered_provenance(spark, d):
    f = feed(spark, d)
    take = lambda cond: f.where(cond).select("sym", "id")
    return union.layered([("live", take("eid % 3 <> 0")), ("cache", take("eid % 2 = 0")), ("backfill", take("eid % 5 = 0"))], SYM, "id")


# --- splices ------------------------------------------------------------------------------------------------------------

EPOCHS = f"""{FEED}, tops as (select sym, max(id) as top from feed group by sym),
pred as (select sym, id as frame_index, id as first_sequence, id as final_sequence, sha256(eid::VARCHAR) as observation_sha256 from feed join tops using (sym) where id <= top * 2 // 3),
succ as (select sym, id as frame_index, id as first_sequence, id as final_sequence, sha256(case when eid % 9 = 0 then 'x' else eid::VARCHAR end) as observation_sha256 from feed join tops using (sym) where id >= top // 3),
nxt as (select *, lead(first_sequence) over (partition by sym order by frame_index) as next_first, lead(final_sequence) over (partition by sym order by frame_index) as next_final from succ),
cand as (select p.sym, p.final_sequence as boundary, p.frame_index as pred_frame, s.frame_index as succ_frame, s.next_first, s.next_final from pred p join nxt s on s.sym = p.sym and s.final_sequence = p.final_sequence and s.observation_sha256 = p.observation_sha256
where s.next_first <= p.final_sequence + 1 and p.final_sequence + 1 <= s.next_final),
bound as (select sym, max(boundary) as boundary, arg_max(pred_frame, boundary) as pred_frame, arg_max(succ_frame, boundary) as succ_frame, arg_max(next_first, boundary) as next_first, arg_max(next_final, boundary) as next_final from cand group by sym)"""


def epochs(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two epochs of every symbol: the first two thirds of its ids, and the last two thirds."""
    f = feed(spark, d)
    f = f.join(f.groupBy("sym").agg(F.max("id").alias("top")), "sym")
    make = lambda rows, text: rows.select("sym", F.col("id").alias("frame_index"), F.col("id").alias("first_sequence"), F.col("id").alias("final_sequence"), F.sha2(text, 256).alias("observation_sha256"))
    text = F.col("eid").cast("string")
    return make(f.where("id <= top * 2 div 3"), text), make(f.where("id >= top div 3"), F.when(F.col("eid") % 9 == 0, "x").otherwise(text))


@query(f"with {EPOCHS} select * from bound")
def overlap_splice_boundary(spark, d):
    return splice.convergence(*epochs(spark, d), SYM)


@query(f"with {EPOCHS} select p.sym, p.frame_index, p.final_sequence, 0 as side from pred p join bound b using (sym) where p.frame_index <= b.pred_frame union all select s.sym, s.frame_index, s.final_sequence, 1 from succ s join bound b using (sym) where s.frame_index > b.succ_frame")
def overlap_selection(spark, d):
    p, s = epochs(spark, d)
    return splice.selection(p, s, splice.convergence(p, s, SYM), SYM).select("sym", "frame_index", "final_sequence", "side")


@query(f"with {EPOCHS}, a as (select p.sym, count(*) filter (where p.frame_index <= b.pred_frame) as selected_predecessor, count(*) filter (where p.frame_index > b.pred_frame) as excluded_predecessor from pred p join bound b using (sym) group by p.sym), c as (select s.sym, count(*) filter (where s.frame_index > b.succ_frame) as selected_successor, count(*) filter (where s.frame_index <= b.succ_frame) as excluded_successor from succ s join bound b using (sym) group by s.sym) select * from a join c using (sym)")
def overlap_exclusions(spark, d):
    p, s = epochs(spark, d)
    return splice.exclusion_counts(p, s, splice.convergence(p, s, SYM), SYM)


@query(f"with {EPOCHS}, o as (select p.sym, p.observation_sha256 = s.observation_sha256 as same from pred p join succ s on s.sym = p.sym and s.final_sequence = p.final_sequence) select sym, (select top // 3 from tops t where t.sym = o.sym) as low, (select max(final_sequence) from pred p where p.sym = o.sym) as high, count(*) filter (where same) as common, count(*) filter (where not same) as mismatches, count(*) filter (where not same) = 0 and count(*) filter (where same) >= 2 as proven from o group by sym")
def common_range_equality(spark, d):
    p, s = epochs(spark, d)
    return splice.common_range_equality(p, s, SYM, "final_sequence", "observation_sha256")


@query(f"with {EPOCHS}, claims as (select sym, frame_index + case when frame_index % 6 = 0 then 1000000 else 0 end as frame_index, case when frame_index % 7 = 0 then 'x' else observation_sha256 end as record_sha256 from pred) select c.sym, c.frame_index, p.frame_index is not null as found, coalesce(p.observation_sha256 = c.record_sha256, false) as matches from claims c left join pred p on p.sym = c.sym and p.frame_index = c.frame_index")
def position_lookup(spark, d):
    p, _ = epochs(spark, d)
    rows = p.select("sym", "frame_index", F.lit("e").alias("connection_epoch"), F.lit("s").alias("stream"), F.col("observation_sha256").alias("record_sha256"))
    claims = rows.select("sym", (F.col("frame_index") + F.when(F.col("frame_index") % 6 == 0, 1_000_000).otherwise(0)).alias("frame_index"), "connection_epoch", "stream", F.when(F.col("frame_index") % 7 == 0, "x").otherwise(F.col("record_sha256")).alias("record_sha256"))
    return splice.positions(rows, claims, SYM).select("sym", "frame_index", "found", "matches")


@query(f"with {EPOCHS}, b as (select sym, frame_index, case when frame_index % 5 = 0 then 'y' else observation_sha256 end as observation_sha256 from pred where frame_index % 8 <> 3) select p.sym, p.frame_index, case when b.sym is null then 'missing' else 'observation_sha256' end as differs from pred p left join b using (sym, frame_index) where b.sym is null or b.observation_sha256 <> p.observation_sha256")
def record_match(spark, d):
    p, _ = epochs(spark, d)
    b = p.where("frame_index % 8 <> 3").withColumn("observation_sha256", F.when(F.col("frame_index") % 5 == 0, "y").otherwise(F.col("observation_sha256")))
    out = splice.record_match(p, b, ["sym", "frame_index"], ["observation_sha256"])
    return out.where(F.size("differs") > 0).select("sym", "frame_index", F.array_join("differs", ",").alias("differs"))


# --- books --------------------------------------------------------------------------------------------------------------

BOOK = f"with {FEED}, {LEVELS}, book as (select sym, side, price, arg_max(qty, frame) as qty from levels group by all having arg_max(qty, frame) > 0)"


def final_book(spark, d) -> DataFrame:
    return book.final_levels(levels(spark, d), SYM)


@query(f"{BOOK} select * from book")
def book_final_levels(spark, d):
    return final_book(spark, d)


RANKED = BOOK + ", ranked as (select *, row_number() over (partition by sym, side order by case when side = 'bid' then -price else price end) as level from book)"


@query(f"{RANKED} select sym, side, price, qty, level::INTEGER as level from ranked where level <= 5")
def book_top5(spark, d):
    return book.top_levels(final_book(spark, d), SYM, 5)


def _ppm(num: str, den: str) -> str:
    """Exact truncating division in whole hundred-millionths; the sign is taken apart because integer division differs between engines."""
    n, m = f"CAST(({num}) * 100000000 AS HUGEINT)", f"CAST(({den}) * 100000000 AS HUGEINT)"
    return f"case when {den} > 0 then CAST(sign({n}) * ((abs({n}) * 1000000) // {m}) AS BIGINT) end"


@query(f"{RANKED}, s as (select sym, CAST(coalesce(sum(qty) filter (where side = 'bid'), 0) AS DECIMAL(28,8)) as bid_depth, CAST(coalesce(sum(qty) filter (where side = 'ask'), 0) AS DECIMAL(28,8)) as ask_depth, count(*) filter (where side = 'bid') as nb, count(*) filter (where side = 'ask') as na from ranked where level <= 20 group by sym) select sym, bid_depth, ask_depth, {_ppm('bid_depth - ask_depth', 'bid_depth + ask_depth')} as depth_imbalance_ppm, nb >= 20 and na >= 20 as enough from s")
def book_top20_depth(spark, d):
    return book.depth_imbalance(final_book(spark, d), SYM, 20)


@query(f"""{BOOK}, s as (select sym, count(*) filter (where side = 'bid') as bid_levels, count(*) filter (where side = 'ask') as ask_levels, max(price) filter (where side = 'bid') as best_bid, min(price) filter (where side = 'ask') as best_ask,
arg_max(qty, price) filter (where side = 'bid') as bid_qty, arg_min(qty, price) filter (where side = 'ask') as ask_qty from book group by sym) select *, CAST(best_ask - best_bid AS DECIMAL(38,8)) as spread,
case when bid_levels = 0 or ask_levels = 0 or best_bid >= best_ask then 'INVALID' else 'LIVE' end as state, {_ppm('bid_qty - ask_qty', 'bid_qty + ask_qty')} as top_imbalance_ppm, {_ppm('bid_qty', 'bid_qty + ask_qty')} as microprice_position_ppm from s""")
def book_summary(spark, d):
    return book.summary(final_book(spark, d), SYM)


@query(f"with {FEED}, t as (select sym, qty, event_type = 'click' as sell from feed where qty > 0), s as (select sym, count(*) filter (where not sell) as buy_trades, count(*) filter (where sell) as sell_trades, CAST(coalesce(sum(qty) filter (where not sell), 0) AS DECIMAL(28,8)) as buy_qty, CAST(coalesce(sum(qty) filter (where sell), 0) AS DECIMAL(28,8)) as sell_qty from t group by sym) select *, {_ppm('buy_qty - sell_qty', 'buy_qty + sell_qty')} as imbalance_ppm from s")
def aggressor_summary(spark, d):
    trades = feed(spark, d).where("qty > 0").withColumn("buyer_is_maker", F.col("event_type") == "click")
    return book.aggressor_summary(trades, SYM)


TEXT = "(case when {c}::VARCHAR like '%.%' then rtrim(rtrim({c}::VARCHAR, '0'), '.') else {c}::VARCHAR end)"


def _le(value: str, size: int) -> str:
    """SQL: a number below 2**32 as hexadecimal little-endian bytes."""
    return "(" + " || ".join(f"substr(printf('%08x', {value}), {7 - 2 * i}, 2)" for i in range(size)) + ")"


def _bytes(c: str) -> str:
    """SQL: shortest digits of a decimal as 16 bytes and its places as one, hexadecimal."""
    t = TEXT.format(c=c)
    digits = f"CAST(replace({t}, '.', '') AS HUGEINT)"
    words = " || ".join(_le(f"CAST(({digits} // {2 ** (32 * i)}) % 4294967296 AS BIGINT)", 4) for i in range(4))
    return f"({words} || printf('%02x', case when {t} like '%.%' then length({t}) - instr({t}, '.') else 0 end))"


def fp_digest(qty: str = "qty") -> str:
    return f"sha256(unhex(case when side = 'bid' then '62' else '61' end || {_bytes('price')} || {_bytes(qty)}))"


def fp_word(digest: str, i: int) -> str:
    """SQL: the i-th little-endian 64-bit word of a digest, signed."""
    turned = " || ".join(f"substr({digest}, {16 * i + 15 - 2 * k}, 2)" for k in range(8))
    return f"CAST((('0x' || {turned})::UBIGINT)::BIT AS BIGINT)"


#: SQL: what a single level change adds to the running fingerprint's first word.
FP_CHANGE = f"xor(case when qty > 0 then {fp_word('h_new', 0)} else 0 end, case when old > 0 then {fp_word('h_old', 0)} else 0 end)"
FP_OLD = f"h as (select *, {fp_digest()} as h_new, {fp_digest('old')} as h_old from o)"


@query(f"{BOOK}, f as (select sym, {fp_digest()} as h from book) select sym, " + ", ".join(f"bit_xor({fp_word('h', i)}) as fp{i}" for i in range(4)) + ", count(*) as n_levels from f group by sym")
def book_fingerprint(spark, d):
    return book.final_fingerprint(final_book(spark, d), SYM)


@query(f"""{BOOK.rsplit(', book as', 1)[0]}, o as (select *, coalesce(lag(qty) over (partition by sym, side, price order by frame), 0) as old from levels),
{FP_OLD}, x as (select sym, frame, (case when qty > 0 then 1 else 0 end) - (case when old > 0 then 1 else 0 end) as step, {FP_CHANGE} as c from h)
select sym, frame, CAST(sum(step) over w AS BIGINT) as n_levels, bit_xor(c) over w as fp0 from x window w as (partition by sym order by frame rows between unbounded preceding and current row)""")
def book_fingerprint_steps(spark, d):
    return book.fingerprint_steps(levels(spark, d), SYM).select("sym", "frame", *big("n_levels"), "fp0")


@query(f"with {FEED}, {LEVELS} select sym, side, price, arg_max(qty, frame) as qty from levels join (select sym, max(frame) // 2 as half from levels group by sym) using (sym) where frame <= half group by all having arg_max(qty, frame) > 0")
def book_asof_frame(spark, d):
    rows = with_marks(levels(spark, d))
    return book.final_levels(rows, SYM, upto=F.expr("top div 2"))


@query(f"with {FEED}, {LEVELS} select sym, side, price, arg_max(qty, frame) as qty from levels join (select sym, max(frame) * 9 // 10 as upto from levels group by sym) using (sym) where frame <= upto group by all having arg_max(qty, frame) > 0")
def checkpoint_window_replay(spark, d):
    """A book at nine tenths of a symbol's frames, from checkpoints at two and four fifths and the diffs since; SQL replays everything."""
    rows = with_marks(levels(spark, d))
    points = None
    for fifths in (2, 4):
        at = F.expr(f"top * {fifths} div 5")
        one = book.final_levels(rows.withColumn("at", at), [*SYM, "at"], upto=at).withColumnRenamed("at", "frame")
        points = one if points is None else points.unionByName(one)
    wanted = rows.groupBy("sym").agg((F.max("frame") * 9).alias("n")).select("sym", F.expr("n div 10").alias("upto"))
    return book.latest_checkpoint_replay(points, rows.drop("top"), SYM, wanted)


def with_marks(rows: DataFrame) -> DataFrame:
    """rows with top, the last frame of the symbol."""
    return rows.join(rows.groupBy("sym").agg(F.max("frame").alias("top")), "sym")


@query(f"""{BOOK}, t as (select sym, side, price, '["' || {TEXT.format(c='price')} || '","' || {TEXT.format(c='qty')} || '"]' as l from book), a as (select sym, coalesce(string_agg(l, ',' order by price) filter (where side = 'ask'), '') as asks, coalesce(string_agg(l, ',' order by price desc) filter (where side = 'bid'), '') as bids from t group by sym)
select sym, sha256('{{"asks":[' || asks || '],"bids":[' || bids || '],"last_update_id":7,"symbol":"S' || sym || '"}}') as book_sha256 from a""")
def book_digest(spark, d):
    symbol = F.concat(F.lit("S"), F.col("sym").cast("string"))
    return book.digests(final_book(spark, d), SYM, symbol, F.lit(7)).select("sym", "book_sha256")


@query()
def book_fold(spark, d):
    """State after every frame by the fold; its last frame equals book_summary."""
    lv = F.array(F.struct(F.col("side"), F.col("pos"), F.col("price"), F.col("qty")))
    rows = levels(spark, d).select("sym", (F.col("frame") + 1).alias("frame"), F.lit("diff").alias("kind"), (F.col("frame") + 1).alias("first_id"), (F.col("frame") + 1).alias("final_id"), lv.alias("levels"))
    top = F.array(*(F.struct(F.lit(s).alias("side"), F.lit(0).alias("pos"), F.lit(p).cast("decimal(28,8)").alias("price"), F.lit(1).cast("decimal(28,8)").alias("qty")) for s, p in (("bid", 1), ("ask", 100))))
    first = rows.select("sym").distinct().select("sym", F.lit(0).cast("bigint").alias("frame"), F.lit("snapshot").alias("kind"), F.lit(0).cast("bigint").alias("first_id"), F.lit(0).cast("bigint").alias("final_id"), top.alias("levels"))
    return book.fold(first.unionByName(rows), SYM)


# --- coverage -----------------------------------------------------------------------------------------------------------


@query(f"""with {FEED}, w as (select sym, us, lag(us) over o as p, lead(us) over o as n, (select min(us) from feed) as s, (select max(us) from feed) as e from feed window o as (partition by sym order by us, id)),
v as (select sym, 'startup' as kind, s as from_ns, us as to_ns from w where p is null and us - s > 2400000000 union all select sym, 'gap', p, us from w where us - p > 7200000000 union all select sym, 'tail', us, e from w where n is null and e - us > 2400000000) select * from v""")
def freshness_violations(spark, d):
    f = feed(spark, d)
    bounds = f.agg(F.min("us").alias("s"), F.max("us").alias("e"))  # one row
    rows = f.select("sym", "us", "id").crossJoin(F.broadcast(bounds))
    return coverage.freshness(rows, SYM, "us", "s", "e", startup_ns=2_400_000_000, deadline_ns=7_200_000_000, tail_ns=2_400_000_000, width=DAY_US)


@query(f"with {FEED}, w as (select user_id, us, lead(us) over (partition by user_id order by us) as r from feed) select user_id, us as silent_from, us + 3 * 28800000000 as deadline_at, r as resumed_at from w where r - us >= 3 * 28800000000")
def cadence_silence(spark, d):
    return coverage.silences(feed(spark, d), ["user_id"], "us", 28_800_000_000, 3)


@query(f"with {FEED}, w as (select user_id, us, case when lag(us) over o is null or us - lag(us) over o >= 43200000000 then 1 else 0 end as n from feed window o as (partition by user_id order by us)), s as (select *, sum(n) over (partition by user_id order by us) as session from w) select user_id, CAST(session AS BIGINT) as session, min(us) as first, max(us) as last, count(*) as n from s group by all")
def silence_sessions(spark, d):
    return coverage.silence_sessions(feed(spark, d), ["user_id"], "us", 43_200_000_000)


@query(f"with {FEED}, pings as (select sym, id as token, us as t from feed where eid % 3 = 0), pongs as (select sym, id as token, us + (eid % 17) * 1000 as t from feed where eid % 3 = 0 and eid % 5 <> 0) select p.sym, p.token, q.t as pong_at, q.t is null or q.t - p.t > 5000 as expired from pings p left join pongs q using (sym, token)")
def pong_deadlines(spark, d):
    f = feed(spark, d).where("eid % 3 = 0")
    pings = f.select("sym", F.col("id").alias("token"), F.col("us").alias("t"))
    pongs = f.where("eid % 5 <> 0").select("sym", F.col("id").alias("token"), (F.col("us") + F.col("eid") % 17 * 1000).alias("t"))
    return coverage.pong_deadlines(pings, pongs, SYM, "token", "t", 5_000).select("sym", "token", "pong_at", "expired")


@query(f"with {FEED}, c as (select sym, id, id // 4 - case when eid % 53 = 9 then 3 else 0 end as done from feed), l as (select *, lag(done) over w as p from c window w as (partition by sym order by id)), s as (select *, last_value(case when p is null or done > p then id end ignore nulls) over (partition by sym order by id rows between unbounded preceding and current row) as since from l) select sym, case when done < p then 'regressed' when id - since >= 3 then 'stalled' else 'ok' end as verdict, count(*) as n from s group by all")
def progress_stalls(spark, d):
    rows = feed(spark, d).select("sym", "id", (F.expr("id div 4") - F.when(F.col("eid") % 53 == 9, 3).otherwise(0)).alias("done"))
    return coverage.progress_stalls(rows, SYM, "id", "done", 3, WIDTH).groupBy("sym", "verdict").agg(F.count(F.lit(1)).alias("n"))


WINDOWS = f"{FEED}, win as (select sym, id * 10 - case when eid % 7 = 2 then 12 else 0 end as ready_ns, id * 10 + case when eid % 19 = 1 then 8 else 13 end as stop_ns from feed)"


def windows(spark, d) -> DataFrame:
    return feed(spark, d).select("sym", (F.col("id") * 10 - F.when(F.col("eid") % 7 == 2, 12).otherwise(0)).alias("ready_ns"), (F.col("id") * 10 + F.when(F.col("eid") % 19 == 1, 8).otherwise(13)).alias("stop_ns"))


@query(f"with {WINDOWS}, c as (select *, max(stop_ns) over (partition by sym order by ready_ns, stop_ns rows between unbounded preceding and 1 preceding) as u, lag(stop_ns, 2) over (partition by sym order by ready_ns, stop_ns) as t from win) select sym, count(*) as windows, count(*) filter (where ready_ns > u) as holes, count(*) filter (where ready_ns < t) as crowded, count(*) filter (where ready_ns > u) = 0 and count(*) filter (where ready_ns < t) = 0 and min(ready_ns) <= 0 and max(stop_ns) >= 100 as complete from c group by sym")
def coverage_intervals(spark, d):
    return coverage.coverage_report(windows(spark, d), SYM, F.lit(0), F.lit(100), width=10 * WIDTH)


READY = f"{FEED}, ev as (select sym, id as t, case when eid // 16 % 2 = 0 then 'P' else 'S' end as lane, event_type not in ('view', 'error') as ready from feed), st as (select *, (case when ready then 1 else 0 end) - coalesce(lag(case when ready then 1 else 0 end) over (partition by sym, lane order by t), 0) as step from ev), cov as (select sym, t, CAST(sum(step) over w AS BIGINT) as ready_lanes, max(case when ready then 1 else 0 end) over w as ever from st window w as (partition by sym order by t)), kinds as (select sym, t, ready_lanes, case when ready_lanes >= 2 then 'REDUNDANT' when ready_lanes >= 1 then 'DEGRADED' when ever = 1 then 'GAP' else 'STARTING' end as coverage from cov)"


def lane_states(spark, d) -> DataFrame:
    ev = feed(spark, d).select("sym", F.col("id").alias("t"), F.when(F.col("id") % 2 == 0, "P").otherwise("S").alias("lane"), (~F.col("event_type").isin("view", "error")).alias("ready"))
    return coverage.lane_coverage(ev, SYM, "lane", "ready", "t", width=WIDTH).select("sym", "t", *big("ready_lanes"), "coverage")


@query(f"with {READY} select * from kinds")
def lane_coverage(spark, d):
    return lane_states(spark, d)


GAPS = READY + ", edges as (select *, lag(coverage) over (partition by sym order by t) as was from kinds), ch as (select *, lead(t) over (partition by sym order by t) as closed from edges where coverage is distinct from was), gaps as (select sym, t as opened_mono_ns, closed as closed_mono_ns, closed - t as unavailable_ns from ch where coverage = 'GAP')"


@query(f"with {GAPS} select * from gaps")
def gap_pairs(spark, d):
    return coverage.gap_pairs(lane_states(spark, d), SYM, "t", width=WIDTH)


@query(f"with {GAPS} select sym, count(*) as gaps, CAST(coalesce(sum(unavailable_ns), 0) AS BIGINT) as unavailable_ns, bool_or(closed_mono_ns is null) as open_gap, case when bool_or(closed_mono_ns is null) then 'COMPLETE_WITH_OPEN_GAP' else 'COMPLETE_WITH_EXPLICIT_GAPS' end as status from gaps group by sym")
def outage_total(spark, d):
    return coverage.outage(coverage.gap_pairs(lane_states(spark, d), SYM, "t", width=WIDTH), SYM)


@query(f"""with {FEED}, iv as (select sym, id as seq, id * 100 as a, id * 100 + 20 + eid % 30 as b from feed where eid % 3 <> 1), pts as (select sym, eid, id * 100 + (eid * 37) % 100 as t from feed where eid % 4 = 1),
x as (select p.sym, p.eid, p.t, i.seq, greatest(i.a - p.t, p.t - i.b, 0) as dist, row_number() over (partition by p.sym, p.eid order by greatest(i.a - p.t, p.t - i.b, 0), i.seq) as n from pts p left join iv i on i.sym = p.sym and i.seq between p.t // 100 - 40 and p.t // 100 + 40)
select sym, eid, t, seq as nearest_seq, dist as distance, coalesce(dist <= 25, false) as within_tolerance from x where n = 1""")
def nearest_interval(spark, d):
    f = feed(spark, d)
    iv = f.where("eid % 3 <> 1").select("sym", F.col("id").alias("seq"), (F.col("id") * 100).alias("a"), (F.col("id") * 100 + 20 + F.col("eid") % 30).alias("b"))
    pts = f.where("eid % 4 = 1").select("sym", "eid", (F.col("id") * 100 + F.col("eid") * 37 % 100).alias("t"))
    return coverage.nearest_interval(pts, iv, SYM, "t", "a", "b", "seq", 25, width=100 * WIDTH)


@query(f"with {FEED}, ev as (select eid, user_id as pid, eid % 5 as port_a, eid % 3 + 7 as port_b, us as t from feed), fl as (select eid as flow, user_id as pid, eid % 3 + 7 as port_a, eid % 5 as port_b, us as start, us + 3600000000 as stop from feed where eid % 10 = 0) select e.eid, f.flow from ev e left join fl f on f.pid = e.pid and least(f.port_a, f.port_b) = least(e.port_a, e.port_b) and greatest(f.port_a, f.port_b) = greatest(e.port_a, e.port_b) and e.t between f.start - 1000000000 and f.stop + 1000000000")
def fault_correlation(spark, d):
    f = feed(spark, d)
    ev = f.select("eid", F.col("user_id").alias("pid"), (F.col("eid") % 5).alias("port_a"), (F.col("eid") % 3 + 7).alias("port_b"), F.col("us").alias("t"))
    fl = f.where("eid % 10 = 0").select(F.col("eid").alias("flow"), F.col("user_id").alias("pid"), (F.col("eid") % 3 + 7).alias("port_a"), (F.col("eid") % 5).alias("port_b"), F.col("us").alias("start"), (F.col("us") + 3_600_000_000).alias("stop"))
    return coverage.endpoint_correlation(ev, fl, 1_000_000_000, block=DAY_US).select("eid", "flow")


@query(f"with {FEED}, c as (select user_id, us, count(*) over (partition by user_id order by us range between 1799999999 preceding and current row) as in_window from feed) select * from c where in_window > 1")
def rate_limit_violations(spark, d):
    return coverage.rate_limit_violations(feed(spark, d).select("user_id", "us"), ["user_id"], "us", 1_800_000_000, 1)


@query(f"with {FEED}, c as (select sym, event_type, count(*) as n from feed group by all) select sym, string_agg(event_type || '=' || n, ',' order by event_type) as events from c group by sym")
def event_counts(spark, d):
    out = coverage.event_counts(feed(spark, d), SYM, "event_type")
    return out.select("sym", F.array_join(F.transform(F.map_entries("events"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("events"))


TRANSPORT = f"""{FEED}, tr as (select user_id, eid, case eid % 23 when 0 then 'CONNECT_FAILED' when 1 then 'WEBSOCKET_CLOSE' when 2 then 'SOCKET_READ_ERROR' when 3 then 'TRANSPORT_DEADLINE' when 4 then 'SUPERVISOR_FAILURE_STOP' when 5 then 'WEBSOCKET_UPGRADE_REJECTED' else 'FRAME' end as event, case when eid % 3 = 0 then 'ESTABLISHED' when eid % 3 = 1 then 'RESET' end as tcp_state from feed where eid % 8 = 0 or user_id % 7 < 3),
ends as (select user_id, case when user_id % 11 <> 3 then case when user_id % 4 = 0 then 'STOPPED' else 'FAILED' end end as status, case when user_id % 13 <> 5 then count(*) - case when user_id % 17 = 2 then 1 else 0 end end as received, count(*) as expected from tr group by user_id),
sums as (select user_id, bool_or(event = 'SUPERVISOR_FAILURE_STOP') as sup, bool_or(event = 'CONNECT_FAILED') as con, bool_or(event = 'WEBSOCKET_UPGRADE_REJECTED') as upg, bool_or(event = 'WEBSOCKET_CLOSE') as ws, bool_or(event = 'SOCKET_READ_ERROR') as rd, bool_or(event = 'TRANSPORT_DEADLINE') as late, arg_max(tcp_state, eid) filter (where tcp_state is not null) as tcp from tr group by user_id),
raw as (select user_id, case when status = 'STOPPED' then 'CLEAN_CLIENT_STOP' when sup then 'SUPERVISOR_FAILURE_STOP_OBSERVED' when con then 'CONNECT_FAILURE_OBSERVED' when upg then 'WEBSOCKET_UPGRADE_REJECTION_OBSERVED' when ws then 'WEBSOCKET_CLOSE_FRAME_OBSERVED' when rd then 'SOCKET_READ_ERROR_OBSERVED'
when late and tcp = 'ESTABLISHED' then 'TRANSPORT_SILENCE_WITH_LOCAL_TCP_ESTABLISHED' when late then 'TRANSPORT_SILENCE_WITHOUT_LOCAL_ESTABLISHED_PROOF' else 'LOCAL_PRODUCER_FAILURE_WITHOUT_TRANSPORT_SUBTYPE' end as kind,
case when status is null then 'no terminal status' when received is null then 'no received count' when received <> expected then 'received count differs' end as error from sums join ends using (user_id)),
cls as (select user_id, case when error is null then kind end as classification, error from raw)"""


def transports(spark, d) -> DataFrame:
    """A connection journal for each user: events, and a terminal whose status or received count is missing or wrong for some."""
    names = {0: "CONNECT_FAILED", 1: "WEBSOCKET_CLOSE", 2: "SOCKET_READ_ERROR", 3: "TRANSPORT_DEADLINE", 4: "SUPERVISOR_FAILURE_STOP", 5: "WEBSOCKET_UPGRADE_REJECTED"}
    event = F.lit("FRAME")
    for k, v in names.items():
        event = F.when(F.col("eid") % 23 == k, v).otherwise(event)
    tcp = F.when(F.col("eid") % 3 == 0, "ESTABLISHED").when(F.col("eid") % 3 == 1, "RESET")
    rows = feed(spark, d).where("eid % 8 = 0 or user_id % 7 < 3").select("user_id", F.col("eid").alias("record_index"), event.alias("event"), tcp.alias("tcp_state"))
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("received"), (F.max("record_index") + 1).alias("record_index"))
    u = F.col("user_id")
    status = F.when(u % 11 != 3, F.when(u % 4 == 0, "STOPPED").otherwise("FAILED"))
    received = F.when(u % 13 != 5, F.col("received") - F.when(u % 17 == 2, 1).otherwise(0))
    ends = counts.select("user_id", "record_index", F.lit("TRANSPORT_TERMINAL").alias("event"), status.alias("status"), received.alias("received"))
    return coverage.transport_class(rows.unionByName(ends, allowMissingColumns=True), ["user_id"], expected=counts)


@query(f"with {TRANSPORT} select * from cls")
def transport_diagnosis(spark, d):
    return transports(spark, d)


@query(f"""with {TRANSPORT}, g as (select user_id % 50 as grp, coalesce(bool_or(classification <> 'CLEAN_CLIENT_STOP'), false) as failing, bool_or(classification = 'WEBSOCKET_UPGRADE_REJECTION_OBSERVED') as upg, bool_or(classification = 'SUPERVISOR_FAILURE_STOP_OBSERVED') as sup, bool_or(classification = 'WEBSOCKET_CLOSE_FRAME_OBSERVED') as ws, bool_or(classification = 'SOCKET_READ_ERROR_OBSERVED') as rd, bool_or(classification like 'TRANSPORT_SILENCE%') as sil, bool_or(classification = 'CONNECT_FAILURE_OBSERVED') as con from cls group by all)
select grp, case when not failing then 'NO_TRANSPORT_FAILURE_IN_SUPPLIED_GENERATIONS' when ws then 'WEBSOCKET_CLOSE_FRAME_AT_APPLICATION_BOUNDARY' when rd then 'SOCKET_READ_ERROR_AT_APPLICATION_BOUNDARY' when sil and grp % 2 = 0 then 'CORRELATED_SHARED_PATH_FAILURE_FROM_THIS_HOST' when sil then 'TRANSPORT_SILENCE_CAUSE_UNRESOLVED_AT_OBSERVED_BOUNDARIES'
when con then 'CONNECT_FAILURE_AT_APPLICATION_BOUNDARY' when upg then 'WEBSOCKET_UPGRADE_REJECTION_AT_APPLICATION_BOUNDARY' when sup then 'SUPERVISOR_FAILURE_STOP_AT_APPLICATION_BOUNDARY' else 'LOCAL_PRODUCER_FAILURE_WITHOUT_NARROWER_OBSERVED_CAUSE' end as incident from g""")
def incident_class(spark, d):
    g = transports(spark, d).groupBy((F.col("user_id") % 50).alias("grp")).agg(F.collect_set("classification").alias("classes"))
    return g.select("grp", coverage.incident_class(F.col("classes"), F.lit("SHARED_PATH_FAILURE_FROM_THIS_HOST"), F.col("grp") % 2 == 0).alias("incident"))


@query(f"with {FEED} select eid, case when eid % 11 = 0 then 'OBSERVABILITY_INTERNAL_FAILURE' when eid % 7 = 0 then 'INNER_QUALIFICATION_TERMINAL_MISSING' when eid % 5 = 0 then 'NONE' when eid % 3 = 0 then 'HOST_TIME_SYNCHRONIZATION_FAILURE' when event_type = 'view' then 'INDETERMINATE_BECAUSE_CROSS_PLANE_INCIDENT_EVIDENCE_DID_NOT_VERIFY' when event_type = 'click' then 'HOST_OR_LOCAL_ACCESS_NETWORK_OUTSIDE_CAPTURE_PROCESS' when event_type = 'purchase' then 'EXTERNAL_TO_CAPTURE_PROCESS_AT_OBSERVED_SOCKET_BOUNDARY' else 'CAPTURE_OR_SUPERVISOR_INTERNAL_OR_NON_NETWORK_FAILURE' end as domain from feed")
def cause_domain(spark, d):
    e = F.col("eid")
    out = coverage.cause_domain(F.when(e % 11 == 0, "x"), F.when(e % 7 != 0, F.when(e % 5 == 0, "COMPLETE").otherwise("FAILED")), F.when(e % 3 == 0, "HOST_CLOCK_HEALTH_GATE_FAILED: x"), F.when(F.col("event_type") != "view", F.col("event_type")), ["click"], ["purchase"])
    return feed(spark, d).select("eid", out.alias("domain"))


# --- latency ------------------------------------------------------------------------------------------------------------

ARRIVALS = f"with {FEED}, g as (select sym, us - lag(us) over (partition by sym order by id) as gap from feed)"


@query(f"{ARRIVALS}, v as (select sym, list(gap order by gap) as l from g where gap is not null group by sym) select sym, p, l[(floor(p * (len(l) - 1) + 0.5))::BIGINT + 1] as value from v, (values (0.5::DOUBLE), (0.99::DOUBLE)) t(p)")
def inter_arrival_p50_p99(spark, d):
    gaps = latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH)
    return latency.percentile_nearest(gaps, SYM, "gap", [0.5, 0.99])


@query(f"{ARRIVALS} select sym, 0.99::DOUBLE as p, quantile_disc(gap, 0.99) as value from g where gap is not null group by sym")
def percentile_ceil_rank(spark, d):
    return latency.percentile_ceil(latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH), SYM, "gap", [0.99])


@query(f"{ARRIVALS}, v as (select sym, list(gap order by gap) as l, count(*) as n, CAST(max(gap) AS BIGINT) as max from g where gap is not null group by sym) select sym, n, max, l[(floor(0.5 * (n - 1) + 0.5))::BIGINT + 1] as p50, l[(floor(0.99 * (n - 1) + 0.5))::BIGINT + 1] as p99 from v")
def latency_report(spark, d):
    gaps = latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH)
    return latency.latency_report(gaps, SYM, "gap").select("sym", "n", "max", "p50", "p99")


HDR_SQL = f"""{ARRIVALS}, v as (select sym, gap as x, greatest(length(ltrim(bin(gap | 2047), '0')) - 11, 0) as b from g where gap between 0 and 3600000000000),
r as (select sym, (x >> b) << b as lowest, ((x >> b) << b) + (1::BIGINT << (b + case when (x >> b) >= 2048 then 1 else 0 end)) - 1 as highest, count(*) as n from v group by all)"""


@query(f"{HDR_SQL} select * from r")
def hdr_histogram(spark, d):
    gaps = latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH)
    return hdr.histogram(gaps, "gap", SYM)


@query(f"""{HDR_SQL}, c as (select *, sum(n) over (partition by sym order by lowest) as reached, sum(n) over (partition by sym) as total from r), ps as (select unnest([0.0, 50.0, 90.0, 99.0, 99.9, 99.99, 100.0])::DOUBLE as percentile)
select sym, percentile, case when percentile = 0 then min(lowest) else min(highest) end as value from c, ps where reached >= greatest(floor(percentile / 100 * total + 0.5), 1) group by sym, percentile""")
def hdr_percentiles(spark, d):
    gaps = latency.inter_arrival(feed(spark, d), SYM, "us", "id", WIDTH)
    return hdr.percentiles(hdr.histogram(gaps, "gap", SYM), [0, 50, 90, 99, 99.9, 99.99, 100], SYM)


@query(f"with {FEED} select user_id, us, count(*) over (partition by user_id order by us range between 86400000000 preceding and current row) as in_window from feed")
def sliding_rate(spark, d):
    return latency.sliding_rate(feed(spark, d).select("user_id", "us"), ["user_id"], "us", 86_400_000_000)


@query(f"with {FEED}, s as (select sym, id, us, eid % 91 as rtt, first_value(eid % 91) over w as v0, first_value(us) over w as t0 from feed window w as (partition by sym order by us, id rows between 31 preceding and current row)) select sym, id, round(case when us - t0 > 0 then (rtt - v0)::DOUBLE / (us - t0) end * 1e9, 6) as slope from s")
def rtt_slope_32(spark, d):
    rows = feed(spark, d).select("sym", "id", "us", (F.col("eid") % 91).alias("rtt"))
    return latency.sample_slope(rows, SYM, "us", "rtt", ties="id", width=DAY_US).select("sym", "id", F.round(F.col("slope") * 1e9, 6).alias("slope"))


@query(f"with {FEED}, s as (select sym, us + eid % 1000 as server, us as sent, (eid % 40) * 2 as rtt from feed) select sym, round(median(server - sent - rtt / 2.0), 3) as median_offset, round(median(rtt), 3) as median_rtt from s group by sym")
def clock_offset_median(spark, d):
    s = feed(spark, d).select("sym", latency.clock_offset(F.col("us") + F.col("eid") % 1000, F.col("us"), F.col("eid") % 40 * 2).alias("offset"), (F.col("eid") % 40 * 2).alias("rtt"))
    return latency.median(s, SYM, "offset", "rtt").select("sym", F.round("median_offset", 3).alias("median_offset"), F.round("median_rtt", 3).alias("median_rtt"))


@query(f"with {FEED} select eid, us + 500 - (us - 30) as corrected, us + 500 - (us + 30) as reference from feed")
def one_way_delay(spark, d):
    local, event, offset = F.col("us") + 500, F.col("us"), F.lit(30).cast("bigint")
    return feed(spark, d).select("eid", latency.one_way_delay(local, event, offset).alias("corrected"), latency.one_way_delay(local, event, offset, "reference").alias("reference"))


# --- scalars ------------------------------------------------------------------------------------------------------------

MADE = "case eid % 9 when 0 then '1e5' when 1 then '+1' when 2 then '01.5' when 3 then eid::VARCHAR || '.50' when 4 then '-' || eid || '.123456789' when 5 then '0.00' when 6 then eid::VARCHAR when 7 then '' else eid || '.12345678' end"


@query(rf"""with {FEED}, t as (select eid, {MADE} as s from feed) select eid, s, case when not regexp_matches(s, '^-?(0|[1-9][0-9]*)([.][0-9]{{1,18}})?$') then 'grammar' when not regexp_matches(s, '^-?[0-9]{{1,20}}([.][0-9]{{1,8}}0*)?$') then 'range' end as reject,
case when regexp_matches(s, '^-?(0|[1-9][0-9]*)([.][0-9]{{1,18}})?$') and regexp_matches(s, '^-?[0-9]{{1,20}}([.][0-9]{{1,8}}0*)?$') then CAST(s AS DECIMAL(28,8)) end as value from t""")
def decimal_strict_parse(spark, d):
    made = F.expr(MADE.replace("eid::VARCHAR", "cast(eid as string)"))
    return feed(spark, d).select("eid", made.alias("s")).select("eid", "s", decimals.decimal_reject(F.col("s")).alias("reject"), decimals.parse_decimal(F.col("s")).alias("value"))


@query(f"with {FEED} select eid, {TEXT.format(c='price')} as canonical, {TEXT.format(c='qty')} as qty_text from feed")
def decimal_canonical_text(spark, d):
    return feed(spark, d).select("eid", decimals.decimal_text(F.col("price")).alias("canonical"), decimals.decimal_text(F.col("qty")).alias("qty_text"))


@query(f"""with {FEED} select eid, sha256('{{"best_match":true,"buyer_is_maker":' || case when eid % 2 = 0 then 'true' else 'false' end || ',"price":"' || {TEXT.format(c='price')} || '","quantity":"' || {TEXT.format(c='qty')} || '","schema":"CanonicalTradeEventV1","symbol":"S' || sym || '","trade_id":' || id || ',"trade_time":' || us || '}}') as digest from feed""")
def trade_event_digest(spark, d):
    f = feed(spark, d)
    return f.select("eid", digests.trade_digest(F.concat(F.lit("S"), F.col("sym").cast("string")), F.col("id"), F.col("price").cast("string"), F.col("qty").cast("string"), F.col("us"), F.col("eid") % 2 == 0, F.lit(True)).alias("digest"))


@query("""select event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) as k from events""")
def json_props_projection(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query(f"with {FEED} select eid, CAST(eid % 997 * 1000000 // (eid % 13 + 1) AS BIGINT) as ppm, CAST(-((eid % 997 * 1000000) // (eid % 13 + 1)) AS BIGINT) as negative_ppm from feed")
def ratio_ppm(spark, d):
    num, den = (F.col("eid") % 997).cast("decimal(28,8)"), (F.col("eid") % 13 + 1).cast("decimal(28,8)")
    return feed(spark, d).select("eid", decimals.ratio_ppm(num, den).alias("ppm"), decimals.ratio_ppm(-num, den).alias("negative_ppm"))


@query(f"with {FEED} select eid, CAST(((eid * 2654435761 % 4294967296 - eid * 40503 % 4294967296 + 2147483648 + 4294967296) % 4294967296) - 2147483648 AS INTEGER) as difference from feed")
def serial_difference(spark, d):
    a, b = F.col("eid") * 2654435761 % 4294967296, F.col("eid") * 40503 % 4294967296
    return feed(spark, d).select("eid", wire.serial_difference(a, b).alias("difference"))


@query("with b as (select event_id, regexp_matches(sha256(event_id::VARCHAR), '^[0-9a-f]{64}$') and event_id % 3 <> 0 as ok from events) select count(*) filter (where ok) as good, count(*) filter (where not ok) as bad from b")
def digest_form(spark, d):
    x = F.when(F.col("event_id") % 3 == 0, F.upper(F.concat(F.lit("g"), F.sha2(F.col("event_id").cast("string"), 256)))).otherwise(F.sha2(F.col("event_id").cast("string"), 256))
    rows = table(spark, d, "events").select(digests.well_formed(x).alias("ok"))
    return rows.agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"))


# --- keys, sums, sets ---------------------------------------------------------------------------------------------------


@query("select o_custkey, count(*) as children, (select count(*) from customer c where c.c_custkey = o.o_custkey) as parents from orders o group by o_custkey")
def orders_fk_binding(spark, d):
    return oracle.foreign_keys(table(spark, d, "orders").select("o_custkey"), table(spark, d, "customer").select("c_custkey"), [("o_custkey", "c_custkey")])


@query("select n_name, count(*) as orders, CAST(sum(CAST(o_totalprice AS DECIMAL(28,8))) AS DECIMAL(38,8)) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name")
def exact_decimal_sum(spark, d):
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    rows = o.select("o_custkey", F.col("o_totalprice").cast(decimals.DECIMAL).alias("p")).join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    out = rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("p").alias("total")).join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("n_name", "orders", "total")


@query(f"with {FEED} select sym, string_agg(distinct event_type, ',' order by event_type) as kinds, bool_and(qty >= 0) as all_valid from feed group by sym")
def distinct_sets(spark, d):
    return feed(spark, d).groupBy("sym").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"), F.bool_and(F.col("qty") >= 0).alias("all_valid"))


@query("""with a as (select doc_id // 1024 as b, count(*) as n, sum(length(text)) as c, sha256(string_agg(sha256(coalesce(text, '')), chr(10) order by doc_id)) as h from documents group by 1),
t as (select b // 1024 as b, sum(n) as n, sum(c) as c, sha256(string_agg(h, chr(10) order by b)) as h from a group by 1)
select CAST(sum(n) AS BIGINT) as files, CAST(sum(c) AS BIGINT) as chars, sha256(string_agg(h, chr(10) order by b)) as tree_sha256 from t""")
def content_tree_digest(spark, d):
    """Digests of 1,024 documents, of 1,024 such groups, and of those: no group holds more than 1,024 lines but the last."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("b"), F.lit(1).cast("bigint").alias("n"), F.length("text").cast("bigint").alias("c"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), "\n")
    for _ in range(2):
        up = F.expr("b div 1024").alias("_b")
        rows = rows.groupBy(up).agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.sha2(lines, 256).alias("h")).withColumnRenamed("_b", "b")
    return rows.agg(F.sum("n").alias("files"), F.sum("c").alias("chars"), F.sha2(lines, 256).alias("tree_sha256"))


@query("with a as (select distinct o_orderpriority as leaf from orders), b as (select unnest(['1-URGENT', '2-HIGH', 'extra']) as leaf) select leaf, 'unexpected' as side from a where leaf not in (select leaf from b) union all select leaf, 'missing' from b where leaf not in (select leaf from a)")
def inventory_difference(spark, d):
    from ..sources.journals import inventory_difference as difference

    found = table(spark, d, "orders").select(F.col("o_orderpriority").alias("leaf")).distinct()
    return difference(found, spark.range(1).select(F.explode(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("extra"))).alias("leaf")))


@query(f"with {FEED}, s as (select sym, id, case event_type when 'view' then 'LIVE' when 'click' then 'GAP' when 'purchase' then 'HANDOVER' else 'LIVE' end as state from feed), l as (select *, lag(state) over (partition by sym order by id) as previous_state from s) select sym, id, state, previous_state from l where previous_state <> state and (previous_state || '>' || state) not in ('LIVE>HANDOVER', 'HANDOVER>LIVE', 'LIVE>GAP', 'HANDOVER>GAP', 'GAP>LIVE')")
def publication_transitions(spark, d):
    state = F.when(F.col("event_type") == "view", "LIVE").when(F.col("event_type") == "click", "GAP").when(F.col("event_type") == "purchase", "HANDOVER").otherwise("LIVE")
    return sessions.transition_violations(feed(spark, d).select("sym", "id", state.alias("state")), SYM, "id", "publication")


@query(f"with {FEED}, l as (select user_id, id, us, event_type = 'click' as failed, count(*) filter (where event_type = 'click') over (partition by user_id order by us range between 864000000000 preceding and current row) as f from feed) select user_id, us, f as failures_in_window, f >= 5 as open from l")
def circuit_breaker(spark, d):
    rows = feed(spark, d).select("user_id", "us", (F.col("event_type") == "click").alias("failed"))
    return sessions.circuit_breaker(rows, ["user_id"], "us", window=864_000_000_000).select("user_id", "us", "failures_in_window", "open")


@query(f"""with {FEED}, r as (select sym, id, case when id = 0 then 'INITIALIZED' when id % 2 = 1 then 'PREPARED' else case when eid % 43 = 3 then 'PREPARED' else 'ACTIVATED' end end as event, (id + 1) // 2 + case when eid % 59 = 8 then 1 else 0 end as fencing_token from feed), l as (select *, lag(event) over w as pe, lag(fencing_token) over w as pt from r window w as (partition by sym order by id)),
v as (select sym, id as record_index, case when pe is null and event <> 'INITIALIZED' then 'not initialised' when event = 'PREPARED' and pe = 'PREPARED' then 'prepared twice' when event = 'ACTIVATED' and pe <> 'PREPARED' then 'activated without preparation' when event = 'PREPARED' and fencing_token <> pt + 1 then 'token' when event = 'ACTIVATED' and fencing_token <> pt then 'token' end as rule from l) select * from v where rule is not null""")
def ownership_ledger(spark, d):
    event = F.when(F.col("id") == 0, "INITIALIZED").when((F.col("id") % 2 == 1) | (F.col("eid") % 43 == 3), "PREPARED").otherwise("ACTIVATED")
    rows = feed(spark, d).select("sym", F.col("id").alias("record_index"), event.alias("event"), (F.expr("(id + 1) div 2") + F.when(F.col("eid") % 59 == 8, 1).otherwise(0)).alias("fencing_token"))
    return sessions.ownership_recovery(rows, SYM)


@query(f"""with {FEED}, fr as (select sym, eid, id - case when eid % 17 = 3 then 6 else 0 end + case when eid % 29 = 4 then 3 else 0 end as sequence, id as arrival from feed),
l as (select *, max(sequence) over (partition by sym order by arrival rows between unbounded preceding and 1 preceding) + 1 as expected from fr) select sym, arrival, sequence, expected, case when expected is null then 'FIRST' when sequence = expected then 'NEXT' when sequence > expected then 'GAP' else 'BEHIND' end as position from l""")
def sequenced_feed_positions(spark, d):
    out = sequenced(spark, d)
    place = F.when(F.col("disposition").isin("RECOVERED", "DUPLICATE"), "BEHIND").otherwise(F.col("disposition"))
    return out.select("sym", "arrival", "sequence", "expected", place.alias("position"))


def sequenced(spark, d) -> DataFrame:
    s = F.col("id") - F.when(F.col("eid") % 17 == 3, 6).otherwise(0) + F.when(F.col("eid") % 29 == 4, 3).otherwise(0)
    return sessions.sequenced_feed(feed(spark, d).select("sym", s.alias("sequence"), F.col("id").alias("arrival")), SYM)


@query()
def sequenced_feed(spark, d):
    return sequenced(spark, d)
