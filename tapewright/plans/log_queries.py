"""Queries over real files: logs, journals and exports made from the events are written to the shared folder and read back by the scans."""

from __future__ import annotations

import hashlib
import json
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book, oracle, seq, sessions
from ..scratch import shared
from ..sources import framed, journals
from ..sources.files import put_files
from ..streaming.sources import DurableFollower
from . import replay
from .feed import FEED, feed
from .queries import query

_made: dict[tuple, str] = {}


def folder(spark: SparkSession, d: str, name: str, make) -> str:
    """The folder of files that make(path) writes, made once for a session and input."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _made:
        path = shared(spark, name)
        make(path)
        _made[key] = path
    return _made[key]


# --- raw logs ----------------------------------------------------------------------------------------------------------

#: Ids of one symbol in one log; a log is one epoch and one kind of stream.
BLOCK = 256

DEPTH_TEXT = (
    "concat('{\"e\":\"', case when fi % 97 = 61 and sym % 4 = 2 then 'other' when fi % 89 = 63 and sym % 4 = 3 then 'serverShutdown' else 'depthUpdate' end, '\",\"E\":', us, ',\"s\":\"S', sym, '\",\"U\":', {first}, ',\"u\":', {final}, "
    "',\"b\":[', case when side = 'bid' then concat('[\"', level, '\",\"', qty, '\"]') else '' end, '],\"a\":[', case when side = 'ask' then concat('[\"', level, '\",\"', qty, '\"]') else '' end, ']}}')"
).replace("{first}", "fi * 3 + 1 + case when sym % 4 = 1 and fi >= 60 then 5 else 0 end").replace("{final}", "fi * 3 + 3 + case when sym % 4 = 1 and fi >= 60 then 5 else 0 end").replace("]}}'", "]}'")
TRADE_TEXT = (
    "concat('{\"e\":\"trade\",\"E\":', us, ',\"s\":\"S', sym, '\",\"t\":', id, ',\"p\":\"', case when eid % 61 = 7 then '0' else cast(deal as string) end, '\",\"q\":\"', cast(qty + 1 as string), '\",\"T\":', us, ',\"m\":', "
    "case when event_type = 'click' then 'true' else 'false' end, ',\"M\":true}')"
)
SNAP_TEXT = "'{\"lastUpdateId\":0,\"bids\":[[\"0.5\",\"1\"]],\"asks\":[[\"100\",\"2\"]]}'"


def raw_frames(spark: SparkSession, d: str) -> DataFrame:
    f = feed(spark, d).withColumn("block", F.expr(f"id div {BLOCK}")).withColumn("kind", F.when(F.col("id") % 3 == 2, "trade").otherwise("depth"))
    f = f.withColumn("fi", (F.row_number().over(seq.by(["sym", "block", "kind"], "id")) - 1).cast("bigint"))
    whole = F.floor(F.abs(F.col("price"))).cast("bigint") % 40
    f = f.withColumn("level", F.when(F.col("side") == "bid", whole + 1).otherwise(whole + 50)).withColumn("deal", F.abs(F.col("price")) + F.lit(1).cast("decimal(28,8)"))
    f = f.withColumn("deal", F.col("deal").cast("decimal(28,8)")).withColumn("qty", F.col("qty").cast("bigint"))
    rows = f.withColumn("payload", F.expr(f"case when kind = 'trade' then {TRADE_TEXT} else {DEPTH_TEXT} end"))
    snap = rows.where("kind = 'depth' and fi = 0").withColumn("kind", F.lit("snapshot")).withColumn("payload", F.expr(SNAP_TEXT))
    return rows.unionByName(snap).select("sym", "block", "kind", "fi", "id", "us", "payload")


FR = f"""{FEED}, b as (select *, id // {BLOCK} as block, case when id % 3 = 2 then 'trade' else 'depth' end as kind from feed),
n as (select *, row_number() over (partition by sym, block, kind order by id) - 1 as fi, CAST(floor(abs(price)) AS BIGINT) % 40 + case when side = 'bid' then 1 else 50 end as level, CAST(abs(price) + 1 AS DECIMAL(28,8)) as deal, CAST(qty AS BIGINT) as q from b),
t as (select * replace (q as qty) from n), p as (select *, case when kind = 'trade' then {TRADE_TEXT.replace('cast(deal as string)', 'deal::VARCHAR').replace('cast(qty + 1 as string)', '(qty + 1)::VARCHAR')} else {DEPTH_TEXT} end as payload from t),
fr as (select sym, block, kind, fi, id, us, payload from p union all select sym, block, 'snapshot', fi, id, us, {SNAP_TEXT} from p where kind = 'depth' and fi = 0)"""


def _log(pdf: pd.DataFrame, break_last: str = "") -> bytes:
    """One chained raw log of the rows of a (symbol, block, kind); break_last spoils the last record's link."""
    frames = [
        {
            "venue": "V", "environment": "test", "endpoint": "wss://v", "stream": f"s{r.sym}@{r.kind}", "symbol": f"S{r.sym}", "connection_epoch": f"e{r.block}", "frame_index": int(r.fi), "receive_wall_ns": int(r.us) * 1_000,
            "receive_mono_ns": int(r.us) * 1_000, "clock_quality": "GOOD", "clock_source": "test", "clock_offset_ns": 0, "clock_uncertainty_ns": 1, "payload": r.payload.encode(), "spec_revision": "r1",
        }
        for r in pdf.sort_values("fi").itertuples(index=False)
    ]
    bodies = list(framed.append_frames(frames))
    if break_last:
        previous = hashlib.sha256(bodies[-2]).hexdigest() if len(bodies) > 1 else framed.ZERO_DIGEST
        last = frames[-1] | ({"frame_index": frames[-1]["frame_index"] + 1} if break_last == "frame" else {})
        bodies[-1] = framed.raw_body(last, "f" * 64 if break_last == "chain" else previous)
    return framed.encode_log(bodies)


def raw_logs(spark: SparkSession, d: str) -> str:
    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            k = pdf.iloc[0]
            return pd.DataFrame({"name": [f"S{k['sym']}-{k['block']}-{k['kind']}.bnraw"], "content": [_log(pdf)]})

        put_files(raw_frames(spark, d).groupBy("sym", "block", "kind").applyInPandas(build, "name string, content binary"), path)

    return folder(spark, d, "raw-logs", make)


@query(f"with {FR} select 'S' || sym as symbol, 'e' || block as connection_epoch, 's' || sym || '@' || kind as stream, fi as frame_index, us * 1000 as receive_mono_ns, octet_length(encode(payload))::INTEGER as payload_length, sha256(payload) as payload_sha256, true as good from fr")
def raw_log_frames(spark, d):
    """Every frame of the raw logs, with its payload checked against length and digest."""
    f = framed.frames(framed.strict(framed.read_framed(spark, raw_logs(spark, d))))
    return f.select("symbol", "connection_epoch", "stream", "frame_index", "receive_mono_ns", "payload_length", "payload_sha256", F.col("frame_reject").isNull().alias("good"))


def faulty_logs(spark: SparkSession, d: str) -> str:
    """Logs of which seven in eight are spoiled at the end, each in its own way."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            k = pdf.iloc[0]
            mode = int(k["sym"] * 7 + k["block"]) % 8
            data = _log(pdf, {6: "chain", 7: "frame"}.get(mode, ""))
            if mode == 1:
                data = data[:-10]
            elif mode == 2:
                data = data[:-40] + bytes([data[-40] ^ 1]) + data[-39:]
            elif mode == 3:
                data += b"\x00\x00"
            elif mode == 4:
                data = b"XXRAW\x00\x01\n" + data[8:]
            elif mode == 5:
                data += struct.pack(">I", 5 * 1024 * 1024) + b"x" * 50
            return pd.DataFrame({"name": [f"S{k['sym']}/{k['block']}.bnraw"], "content": [data]})

        put_files(raw_frames(spark, d).where("kind = 'trade'").groupBy("sym", "block", "kind").applyInPandas(build, "name string, content binary"), path)

    return folder(spark, d, "faulty-logs", make)


FAULTS = f"""{FR}, m as (select sym, block, (sym * 7 + block) % 8 as mode, count(*) as n from fr where kind = 'trade' group by all),
st as (select sym, block, mode, case when mode = 4 then 0 when mode in (1, 2, 6, 7) then n - 1 else n end as records, mode = 0 as clean,
case mode when 1 then 'partial record digest' when 2 then 'record digest mismatch' when 3 then 'partial length prefix' when 4 then 'bad magic' when 5 then 'record length exceeds limit' when 6 then 'record chain mismatch' when 7 then 'non-contiguous frame index: expected ' || (n - 1) || ', got ' || n end as reason from m)"""


def _place(path: str = "path") -> list[F.Column]:
    """sym and block of a faulty log's path."""
    return [F.regexp_extract(path, r"/S(\d+)/(\d+)\.bnraw$", i).cast("bigint").alias(n) for i, n in ((1, "sym"), (2, "block"))]


@query(f"with {FAULTS} select sym, block, records, clean, reason from st")
def raw_log_status(spark, d):
    """The valid prefix of every log and why it ends there."""
    status = framed.file_status(framed.read_framed(spark, faulty_logs(spark, d)))
    return status.select(*_place(), "records", "clean", "reason")


@query(f"with {FAULTS} select sym, block, records, true as clean from st where mode <> 4 and records > 0")
def raw_log_recovered(spark, d):
    """Logs cut after their last good record, written again and read back clean."""
    source = faulty_logs(spark, d)
    target = folder(spark, d, "recovered-logs", lambda path: framed.recovered(spark, source, path))
    return framed.file_status(framed.read_framed(spark, target)).select(*_place(), "records", "clean")


@query(f"with {FR}, c as (select sym, block, count(*) as n from fr where kind = 'depth' group by all) select sym, least(sum(least(n, 100)), sum(n))::BIGINT as records, max(least(n, 100) - 1) as last_frame from c group by sym")
def raw_log_durable_prefix(spark, d):
    """Frames up to the offset acknowledged after a log's hundredth record."""
    records = framed.read_framed(spark, raw_logs(spark, d)).where(F.col("path").endswith("depth.bnraw"))
    acks = records.where("record_index < 100").groupBy("path").agg(F.max("end_offset").alias("ack_offset"))
    rows = framed.frames(framed.durable_prefix(records, acks))
    return rows.groupBy(F.substring("symbol", 2, 9).cast("bigint").alias("sym")).agg(F.count(F.lit(1)).alias("records"), F.max("frame_index").alias("last_frame"))


@query(f"with {FR}, c as (select sym, block, count(*) as n from fr where kind = 'depth' group by all) select sym, sum(least(n, 100) - least(n, 50))::BIGINT as records from c where n > 50 group by sym")
def raw_log_durable_delta(spark, d):
    """Records between two acknowledgements, after the fiftieth and the hundredth record."""
    records = framed.read_framed(spark, raw_logs(spark, d)).where(F.col("path").endswith("depth.bnraw"))
    marks = records.where("record_index < 100").groupBy("path").agg(F.max(F.when(F.col("record_index") < 50, F.col("end_offset"))).alias("previous_offset"), F.max("end_offset").alias("next_offset"))
    rows = framed.durable_delta(records, marks)
    return rows.groupBy(F.regexp_extract("path", r"S(\d+)-", 1).cast("bigint").alias("sym")).agg(F.count(F.lit(1)).alias("records"))


@query(f"with {FR}, c as (select sym, block, count(*) as n from fr where kind = 'trade' group by all) select sym, block, least(n, 20) as records from c")
def raw_log_frozen(spark, d):
    """Prefixes that were acknowledged after twenty records, copied out and read as logs of their own."""
    source = raw_logs(spark, d)
    records = framed.read_framed(spark, source).where(F.col("path").endswith("trade.bnraw"))
    acks = records.where("record_index < 20").groupBy("path").agg(F.max("end_offset").alias("ack_offset"))
    target = folder(spark, d, "frozen-logs", lambda path: framed.frozen(spark, source, path, acks))
    name = lambda i: F.regexp_extract("path", r"S(\d+)-(\d+)-trade", i).cast("bigint")
    return framed.file_status(framed.strict(framed.read_framed(spark, target))).select(name(1).alias("sym"), name(2).alias("block"), "records")


@query(f"""with {FR}, c as (select sym, block, count(*) as n from fr where kind = 'trade' group by all), x as (select *, sym % 5 = 3 as off from c)
select sym, block, least(n, 10) as first_step, case when off then 0 else greatest(least(n, 30) - 10, 0) end as second_step, case when off then 'acknowledgement is off a record boundary' end as poisoned from x""")
def durable_follower(spark, d):
    """Two steps of a follower: after ten records of a log, then after thirty; an acknowledgement off a boundary poisons its log."""
    source = raw_logs(spark, d)
    records = framed.read_framed(spark, source).where(F.col("path").endswith("trade.bnraw"))
    sym, block = (F.regexp_extract("path", r"S(\d+)-(\d+)-trade", i).cast("bigint").alias(n) for i, n in ((1, "sym"), (2, "block")))
    ack = lambda n, off: records.where(f"record_index < {n}").groupBy("path").agg(F.max("end_offset").alias("ack_offset")).withColumn("ack_offset", F.col("ack_offset") + F.when(off, 1).otherwise(0))
    follower = DurableFollower(spark, source, shared(spark, "follower"))
    wrong = F.regexp_extract("path", r"S(\d+)-", 1).cast("bigint") % 5 == 3
    first = follower.advance(0, ack(10, F.lit(False))).groupBy("path").agg(F.count(F.lit(1)).alias("first_step"))
    second = follower.advance(1, ack(30, wrong)).groupBy("path").agg(F.count(F.lit(1)).alias("second_step"))
    out = follower.followed(1).join(first, "path", "left").join(second, "path", "left")
    return out.select(sym, block, F.coalesce("first_step", F.lit(0)).alias("first_step"), F.coalesce("second_step", F.lit(0)).alias("second_step"), "poisoned")


DISPOSED = f"""{FR}, d as (select *, fi * 3 + 1 + case when sym % 4 = 1 and fi >= 60 then 5 else 0 end as first_id, fi * 3 + 3 + case when sym % 4 = 1 and fi >= 60 then 5 else 0 end as final_id,
case when fi % 97 = 61 and sym % 4 = 2 then 'unexpected event' when fi % 89 = 63 and sym % 4 = 3 then 'control' end as reject from fr where kind = 'depth'),
l as (select *, coalesce(max(case when reject is null then final_id end) over (partition by sym, block order by fi rows between unbounded preceding and 1 preceding), 0) as prev from d),
k as (select *, max(case when reject is null and not (first_id <= prev + 1 and prev + 1 <= final_id) then 1 else 0 end) over (partition by sym, block order by fi) as broken from l),
disp as (select *, case when reject = 'control' then 'CONTROL' when reject is not null then 'REJECTED' when broken = 1 then 'GAP' else 'APPLIED' end as disposition from k)"""


@query(f"""with {DISPOSED}, a as (select sym, block, count(*) as depth_frames, count(*) filter (where disposition = 'APPLIED') as applied, count(*) filter (where disposition = 'CONTROL') as control, count(*) filter (where disposition = 'REJECTED') as rejected, count(*) filter (where disposition = 'GAP') as after_gap,
greatest(coalesce(max(final_id) filter (where disposition = 'APPLIED'), 0), 0) as last_update_id from disp group by all),
lv as (select t.sym, t.block, t.fi, t.side, t.level::DECIMAL(28,8) as price, t.qty from t join disp using (sym, block, kind, fi) where disposition = 'APPLIED' union all select distinct sym, block, -1, 'bid', 0.5::DECIMAL(28,8), 1 from disp union all select distinct sym, block, -1, 'ask', 100::DECIMAL(28,8), 2 from disp),
bk as (select sym, block, side, price, arg_max(qty, fi) as qty from lv group by all having arg_max(qty, fi) > 0),
bs as (select sym, block, count(*) filter (where side = 'bid') as bid_levels, count(*) filter (where side = 'ask') as ask_levels, max(price) filter (where side = 'bid') as best_bid, min(price) filter (where side = 'ask') as best_ask from bk group by all),
tr as (select sym, block, count(*) as records, count(*) filter (where event_type <> 'click') as buy_trades, count(*) filter (where event_type = 'click') as sell_trades from t where kind = 'trade' and eid % 61 <> 7 group by all)
select 'S' || sym as symbol, 'e' || block as connection_epoch, depth_frames, applied, control, rejected, after_gap, last_update_id, bid_levels, ask_levels, best_bid, best_ask, records, buy_trades, sell_trades, true as digest_ok from a left join bs using (sym, block) left join tr using (sym, block)""")
def session_audit(spark, d):
    """A session's report from its raw logs alone: dispositions of depth frames, the final book, trades and aggressors, sealed by a digest."""
    r = replay.session_report(spark, raw_logs(spark, d))
    keep = ["symbol", "connection_epoch", "depth_frames", "applied", "control", "rejected", "after_gap", "last_update_id", "bid_levels", "ask_levels", "best_bid", "best_ask", "records", "buy_trades", "sell_trades"]
    return r.select(*keep, F.col("report_sha256").rlike("^[0-9a-f]{64}$").alias("digest_ok"))


@query(f"""with {FR} select 'S' || sym as symbol, 'trade' as stream_kind, 'e' || block as connection_epoch, fi as frame_index, id as first_sequence, id as final_sequence, sha256('{{"best_match":true,"buyer_is_maker":' || case when event_type = 'click' then 'true' else 'false' end || ',"price":"' || (case when deal::VARCHAR like '%.%' then rtrim(rtrim(deal::VARCHAR, '0'), '.') else deal::VARCHAR end) || '","quantity":"' || (qty + 1) || '","schema":"CanonicalTradeEventV1","symbol":"S' || sym || '","trade_id":' || id || ',"trade_time":' || us || '}}') as observation_sha256 from t where kind = 'trade' and eid % 61 <> 7""")
def trade_observations(spark, d):
    """Canonical trade observations of the raw logs; trades with a price of zero are none."""
    return replay.observations(spark, raw_logs(spark, d)).select("symbol", "stream_kind", "connection_epoch", "frame_index", "first_sequence", "final_sequence", "observation_sha256")


@query(f"with {DISPOSED} select sym, block, disposition, count(*) as n from disp group by all")
def depth_dispositions(spark, d):
    updates = replay.depth_updates(replay.session_frames(spark, raw_logs(spark, d)))
    rows = replay.audit(updates, ["symbol", "connection_epoch"]).where("frame >= 0")
    number = lambda c: F.expr(f"cast(substring({c}, 2) as bigint)")
    return rows.groupBy(number("symbol").alias("sym"), number("connection_epoch").alias("block"), "disposition").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {FR}, s as (select sym, case when eid % 61 = 7 then 'not positive' else 'ok' end as reject from t where kind = 'trade') select sym, reject, count(*) as n from s group by all")
def trade_rejects(spark, d):
    """Why trade payloads are refused."""
    t = book.trade_fields(replay.session_frames(spark, raw_logs(spark, d)).where("kind = 'trade'"))
    return t.groupBy(F.expr("cast(substring(symbol, 2) as bigint)").alias("sym"), F.coalesce("reject", F.lit("ok")).alias("reject")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {FR}, s as (select id, id % 7 as k, sym from feed where id % 3 = 0 and sym < 8), m as (select sym, id, case k when 0 then 'update id' when 1 then 'levels' when 2 then 'levels' end as reject, case when k > 2 then id end as last_id, case when k > 2 then 1 + k % 3 end as bids from s)
select sym, id, reject, last_id, bids from m""")
def snapshot_shapes(spark, d):
    """Snapshot documents with a missing id, missing sides or levels of three strings."""
    k = F.col("id") % 7
    level = F.lit('["1.5","2"]')
    bids = F.array_join(F.array_repeat(level, (1 + k % 3).cast("int")), ",")
    text = (
        F.when(k == 0, F.lit('{"bids":[],"asks":[]}')).when(k == 1, F.concat(F.lit('{"lastUpdateId":'), F.col("id"), F.lit(',"bids":[["1","2","3"]],"asks":[]}')))
        .when(k == 2, F.concat(F.lit('{"lastUpdateId":'), F.col("id"), F.lit(',"bids":[]}'))).otherwise(F.concat(F.lit('{"lastUpdateId":'), F.col("id"), F.lit(',"bids":['), bids, F.lit('],"asks":[]}')))
    )
    out = book.snapshot_fields(feed(spark, d).where("id % 3 = 0 and sym < 8").select("sym", "id", text.alias("payload")))
    good = F.col("reject").isNull()
    return out.select("sym", "id", "reject", F.when(good, F.col("last_id")).alias("last_id"), F.when(good, F.size("bids")).cast("bigint").alias("bids"))


# --- other framed journals ----------------------------------------------------------------------------------------------


def chained_log(kind: str, bodies: list[dict]) -> bytes:
    """Bodies as one framed log; each gets its index and the digest before it."""
    out, previous = [], framed.ZERO_DIGEST
    for i, b in enumerate(bodies):
        body = {"record_index": i, "previous_record_sha256": previous} | b
        if isinstance(body.get("proposal_record_sha256"), int):
            body["proposal_record_sha256"] = previous if body["proposal_record_sha256"] else "f" * 64
        text = json.dumps(body, separators=(",", ":")).encode()
        out.append(text)
        previous = hashlib.sha256(text).hexdigest()
    return framed.encode_log(out, kind)


def journal_logs(spark: SparkSession, d: str, kind: str, bodies) -> str:
    """One log of a kind for each symbol and block, with the bodies that bodies(sym, block, ids) gives."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            sym, block = int(pdf["sym"].iloc[0]), int(pdf["block"].iloc[0])
            return pd.DataFrame({"name": [f"S{sym}/{block}.bnraw"], "content": [chained_log(kind, bodies(sym, block, sorted(int(x) for x in pdf["id"])))]})

        rows = feed(spark, d).select("sym", F.expr(f"id div {BLOCK}").alias("block"), "id")
        put_files(rows.groupBy("sym", "block").applyInPandas(build, "name string, content binary"), path)

    return folder(spark, d, f"{kind}-logs", make)


@query(f"with {FEED}, g as (select distinct sym, id // {BLOCK} as block from feed) select sym, block, 1 as record_index, case (sym + block) % 4 when 1 then 'commit without proposal' when 2 then 'other proposal' when 3 then 'proposed twice' end as rule from g where (sym + block) % 4 in (2, 3) union all select sym, block, 0, 'commit without proposal' from g where (sym + block) % 4 = 1")
def boundary_journals(spark, d):
    """Handover boundaries: proposals and commits that break the rules."""

    def bodies(sym: int, block: int, ids: list[int]) -> list[dict]:
        base = {"schema": "BoundaryJournalRecordV1", "boundary_id": f"b{block}", "boundary": {"symbol": f"S{sym}", "stream_kind": "depth", "boundary_sequence": ids[-1]}}
        propose, commit = base | {"action": "PROPOSED", "proposal_record_sha256": None}, base | {"action": "COMMITTED", "proposal_record_sha256": 1}
        return {0: [propose, commit], 1: [commit], 2: [propose, commit | {"proposal_record_sha256": 0}], 3: [propose, propose]}[(sym + block) % 4]

    rows = framed.typed(framed.read_framed(spark, journal_logs(spark, d, "boundary", bodies), "boundary", check_chain=False), "boundary")
    return framed.boundary_violations(rows).select(*_place(), "record_index", "rule")


@query(f"with {FEED}, g as (select distinct sym, id // {BLOCK} as block from feed) select sym, block, case when (sym + block) % 3 = 1 then 2 else 4 end as record_index, case when (sym + block) % 3 = 1 then 'token' else 'prepared twice' end as rule from g where (sym + block) % 3 > 0")
def ownership_journals(spark, d):
    """Ownership ledgers from their files."""

    def bodies(sym: int, block: int, ids: list[int]) -> list[dict]:
        def step(action: str, token: int) -> dict:
            return {"schema": "OwnershipRecordV1", "action": action, "initial_owner": None, "activation": {"generation_id": f"g{token}", "fencing_token": token}}

        first = {"schema": "OwnershipRecordV1", "action": "INITIALIZED", "initial_owner": {"generation_id": "g1", "fencing_token": 1}, "activation": None}
        wrong = (sym + block) % 3
        if wrong == 1:
            return [first, step("PREPARED", 2), step("ACTIVATED", 3)]
        return [first, step("PREPARED", 2), step("ACTIVATED", 2), step("PREPARED", 3), *([step("PREPARED", 4)] if wrong else [])]

    rows = framed.typed(framed.read_framed(spark, journal_logs(spark, d, "ownership", bodies), "ownership", check_chain=False), "ownership")
    return sessions.ownership_recovery(framed.ownership_rows(rows), ["path"]).select(*_place(), "record_index", "rule")


@query(f"with {FEED}, g as (select sym, id // {BLOCK} as block, count(*) as n from feed group by all) select sym, block, n + 1 as record_index, 'ownership change' as rule from g where (sym + block) % 2 = 1 union all select sym, block, 3, 'sequence' from g where (sym + block) % 5 = 2 and n >= 3")
def output_journals(spark, d):
    """Canonical outputs: observations, and an owner change that keeps the connection in every second log."""

    def bodies(sym: int, block: int, ids: list[int]) -> list[dict]:
        owner = {"generation_id": "g1", "connection_epoch": "c1", "fencing_token": 1, "last_sequence": -1}
        base = {"schema": "CanonicalOutputRecordV1", "symbol": f"S{sym}", "stream_kind": "trade", "observation": None, "ownership_activation_record_sha256": None}
        out = [base | {"action": "INITIALIZED", "owner": owner}]
        for k, i in enumerate(ids):
            at = ids[1] if (sym + block) % 5 == 2 and k == 2 else i
            owner = owner | {"last_sequence": at}
            out.append(base | {"action": "OBSERVATION", "owner": owner, "observation": {"first_sequence": i, "final_sequence": i, "observation_sha256": "0" * 64}})
        changed = owner | {"generation_id": "g2", "fencing_token": 2, "connection_epoch": "c1" if (sym + block) % 2 else "c2"}
        return [*out, base | {"action": "OWNERSHIP_CHANGED", "owner": changed, "ownership_activation_record_sha256": "a" * 64}]

    rows = framed.typed(framed.read_framed(spark, journal_logs(spark, d, "output", bodies), "output", check_chain=False), "output")
    return framed.output_violations(rows).select(*_place(), "record_index", "rule")


SEALS = f"""{FEED}, g as (select sym, id // {BLOCK} as block, id // 32 as seg, min(id) as a, max(id) as b from feed group by all)"""


@query(f"with {SEALS}, l as (select *, lag(seg) over w as pseg, lag(b) over w as pb from g where seg % 11 <> 6 window w as (partition by sym, block order by seg)), e as (select sym, block, seg as segment_index, case when seg <> pseg + 1 then 'segment index' when seg % 5 = 3 then 'terminal digest' end as reason from l where pseg is not null) select * from e where reason is not null")
def segment_manifests(spark, d):
    """Seals of segment manifests that do not continue the one before."""

    def bodies(sym: int, block: int, ids: list[int]) -> list[dict]:
        out = []
        for s in sorted({i // 32 for i in ids}):
            own = [i for i in ids if i // 32 == s]
            if s % 11 != 6:
                out.append({"segment_index": s, "raw_file": f"{s}.bnraw", "first_frame": own[0], "last_frame": own[-1], "records": len(own), "start_digest": "x" if s % 5 == 3 else f"d{s}", "terminal_digest": f"d{s + 1}", "connection_epoch": "e", "stream": "s"})
        return out

    rows = framed.segment_manifest(framed.read_framed(spark, journal_logs(spark, d, "segments", bodies), "segments", check_chain=False))
    return seq.segment_transitions(rows, ["path"]).select(*_place(), "segment_index", "reason")


# --- text journals and exports ------------------------------------------------------------------------------------------

#: The faults of journals by symbol: the rule that breaks and the record at which it does, 30 records a journal.
JOURNAL_FAULTS = [
    (1, "unknown event", 7), (2, "second start", 9), (3, "trade order", 8), (4, "trade below floor", 5), (5, "correction above published", 11), (6, "unknown correction below floor", 12), (7, "depth continuity", 14),
    (8, "depth after gap without rebootstrap", 19), (9, "rebootstrap lane", 20), (10, "rebootstrap bridge", 20), (11, "gap cursor", 17), (12, "rebootstrap without gap", 16), (13, "terminal counters", 29), (14, "no start", 0), (15, "after terminal", 30),
]


def journal_events(sym: int) -> list[dict]:
    """A journal of all eleven events; symbols 1 to 15 break one rule each."""
    fault = {s: rule for s, rule, _ in JOURNAL_FAULTS}.get(sym)
    depth = lambda lane, first, final: {"event": "DEPTH_OBSERVATION", "lane": lane, "first_sequence": first, "final_sequence": final}
    trade = lambda i: {"event": "TRADE_OBSERVATION", "trade_id": i, "lane": "P"}
    e = [{"event": "ARBITRATION_STARTED", "trade_floor": 100}]
    e += [trade(101 + i) for i in range(4)] + [trade(105), trade(106), {"event": "TRADE_LAG", "lane": "S", "buffered": 3}, trade(107), {"event": "ARBITRATION_RESUMED", "trade_floor": 100}]
    e += [{"event": "TRADE_CONFLICT", "trade_id": 105}, {"event": "TRADE_LATE_CORRECTION", "trade_id": 104, "kind": "duplicate"}, {"event": "TRADE_LATE_CORRECTION", "trade_id": 103, "kind": "unknown"}]
    e += [depth("P", 1, 5), depth("P", 6, 9), {"event": "DEPTH_SWITCH_PROVEN", "from_lane": "P", "to_lane": "S"}, depth("S", 10, 12), {"event": "GAP", "reason": "dual_loss", "canonical_last_sequence": 12}]
    e += [{"event": "TRADE_LAG", "lane": "P", "buffered": 1}, {"event": "DEPTH_REBOOTSTRAP", "lane": "P", "generation": 2, "snapshot_last_update_id": 40}, depth("P", 41, 45), depth("P", 46, 47)]
    e += [trade(108 + i) for i in range(7)]
    e.append({"event": "ARBITRATION_TERMINAL", "status": "STOPPED", "trades": 14, "depth_frames": 5, "gaps": 1, "late_corrections": 2})
    if fault == "unknown event":
        e[7] = {"event": "NOISE"}
    elif fault == "second start":
        e[9]["event"] = "ARBITRATION_STARTED"
    elif fault == "trade order":
        e[8]["trade_id"] = 106
    elif fault == "trade below floor":
        e[0]["trade_floor"], e[5]["trade_id"] = 90, 105
        e[4] = {"event": "ARBITRATION_RESUMED", "trade_floor": 105}
        e[9]["trade_floor"] = 105
        e[-1]["trades"] = 13
        e[12]["trade_id"] = 106
    elif fault == "correction above published":
        e[11]["trade_id"] = 500
    elif fault == "unknown correction below floor":
        e[12]["trade_id"] = 99
    elif fault == "depth continuity":
        e[14]["first_sequence"] = 7
    elif fault == "depth after gap without rebootstrap":
        e[19] = depth("P", 41, 43)
        e[20]["first_sequence"] = 44
        e[-1]["depth_frames"] = 6
    elif fault == "rebootstrap lane":
        e[20]["lane"] = "S"
    elif fault == "rebootstrap bridge":
        e[20] = depth("P", 38, 40)
        e[21]["first_sequence"] = 41
    elif fault == "gap cursor":
        e[17]["canonical_last_sequence"] = 9
    elif fault == "rebootstrap without gap":
        e[16] = {"event": "DEPTH_REBOOTSTRAP", "lane": "S", "generation": 1, "snapshot_last_update_id": 9}
        e[17]["canonical_last_sequence"] = 9
        e[-1]["depth_frames"] = 4
    elif fault == "terminal counters":
        e[-1]["trades"] = 99
    elif fault == "no start":
        e[0] = {"event": "TRADE_LAG", "lane": "P", "buffered": 0}
    elif fault == "after terminal":
        e.append({"event": "TRADE_LAG", "lane": "P", "buffered": 0})
    return e


def text_journals(spark: SparkSession, d: str) -> str:
    """One journal file for every 16 ids of a symbol, all of the symbol's kind; symbol 0 keeps the rules, and every fifth file of it has a broken chain."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            sym, part = int(pdf["sym"].iloc[0]), int(pdf["part"].iloc[0])
            previous, lines = framed.ZERO_DIGEST, []
            for i, e in enumerate(journal_events(sym)):
                wrong = sym == 0 and part % 5 == 2 and i == 3
                line, previous = journals.journal_line({"schema": "ArbitrationRecordV1", "record_index": i, "wall_ns": i, "mono_ns": i, "channel": "c", "payload": e, "previous_record_sha256": "f" * 64 if wrong else previous})
                lines.append(line)
            return pd.DataFrame({"name": [f"S{sym}/{part}.jsonl"], "content": [("\n".join(lines) + "\n" + "torn" * (part % 3)).encode()]})

        rows = feed(spark, d).select("sym", F.expr("id div 64").alias("part")).distinct()
        put_files(rows.groupBy("sym", "part").applyInPandas(build, "name string, content binary"), path)

    return folder(spark, d, "text-journals", make)


PARTS = f"{FEED}, parts as (select distinct sym, id // 64 as part from feed)"


def _file(ending: str) -> list[F.Column]:
    return [F.regexp_extract("path", rf"/S(\d+)/(\d+)\.{ending}$", i).cast("bigint").alias(n) for i, n in ((1, "sym"), (2, "part"))]


@query(f"with {PARTS}, f(sym, rule, record_index) as (values {', '.join(f'({s}, {chr(39)}{r}{chr(39)}, {i})' for s, r, i in JOURNAL_FAULTS)}) select sym, part, f.record_index::BIGINT as record_index, rule from parts join f using (sym) union all select sym, part, 3, 'hash chain' from parts where sym = 0 and part % 5 = 2")
def journal_rules(spark, d):
    """Arbitration journals from their files, over all events, one broken rule for each symbol."""
    rows = journals.read_arbitration(spark, f"{text_journals(spark, d)}/*").where("record_index is not null")
    return oracle.journal_violations(rows, ["path"]).select(*_file("jsonl"), "record_index", "rule")


@query(f"with {PARTS} select sym, part, CASE WHEN sym = 15 THEN 31 ELSE 30 END::BIGINT as lines, true as body_ok, (part % 3) * 4 as tail_bytes from parts")
def journal_tails(spark, d):
    """Lines whose stored digest is that of their text, and what stands after the last line feed."""
    path = f"{text_journals(spark, d)}/*"
    lines = journals.read_arbitration(spark, path).where("record_index is not null").groupBy("path").agg(F.count(F.lit(1)).alias("lines"), F.bool_and("body_ok").alias("body_ok"))
    key = F.regexp_extract("path", r"(S\d+/\d+\.jsonl)$", 1).alias("leaf")
    tails = journals.torn_tails(spark, path).select(key, "tail_bytes")
    return lines.select("path", key, "lines", "body_ok").join(tails, "leaf").select(*_file("jsonl"), "lines", "body_ok", "tail_bytes")


@query(f"""with {PARTS} select sym, part, 2 as record_index, case (sym + part) % 4 when 1 then 'acknowledgement did not rise' when 2 then 'chain' else 'index' end as rule from parts where (sym + part) % 4 in (1, 2)
union all select sym, part, 9, 'index' from parts where (sym + part) % 4 = 3""")
def durability_journals(spark, d):
    """Durability journals: acknowledgements that do not rise, a spoiled chain, an index left out."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            sym, part = int(pdf["sym"].iloc[0]), int(pdf["part"].iloc[0])
            previous, lines, mode = framed.ZERO_DIGEST, [], (sym + part) % 4
            for i in range(5):
                n = i if mode == 1 and i == 2 else i + 1
                ack = {"durable_record_count": 10 * (i + 1), "durable_through_offset": 100 * (n if mode == 1 and i == 2 else i + 1), "terminal_record_sha256": "0" * 64}
                index = 9 if mode == 3 and i == 4 else i
                line, previous = journals.journal_line({"schema": "RawDurabilityProgressV1", "record_index": index, "wall_ns": i, "mono_ns": i, "previous_record_sha256": "f" * 64 if mode == 2 and i == 2 else previous, "ack": ack})
                lines.append(line)
            return pd.DataFrame({"name": [f"S{sym}/{part}.jsonl"], "content": ["".join(x + chr(10) for x in lines).encode()]})

        put_files(feed(spark, d).select("sym", F.expr("id div 64").alias("part")).distinct().groupBy("sym", "part").applyInPandas(build, "name string, content binary"), path)

    rows = journals.read_chained(spark, f"{folder(spark, d, 'durability-journals', make)}/*", "durability")
    return journals.durability_violations(rows).select(*_file("jsonl"), "record_index", "rule")


@query(f"with {FEED} select eid, case eid % 6 when 1 then 'duplicate key' when 2 then 'constant NaN' when 3 then 'syntax' when 4 then 'constant -Infinity' end as reject from feed")
def strict_json(spark, d):
    e = F.col("eid").cast("string")
    made = (
        F.when(F.col("eid") % 6 == 1, F.concat(F.lit('{"a":'), e, F.lit(',"a":1}'))).when(F.col("eid") % 6 == 2, F.lit('{"a":NaN}')).when(F.col("eid") % 6 == 3, F.concat(F.lit('{"a":'), e))
        .when(F.col("eid") % 6 == 4, F.lit('[-Infinity]')).otherwise(F.concat(F.lit('{"a":'), e, F.lit("}")))
    )
    return feed(spark, d).select("eid", journals.strict_json_reject(made).alias("reject"))


@query(f"with {PARTS} select sym, part, case when part % 3 = 1 then 4 else 5 end::BIGINT as frames, case part % 3 when 1 then 'truncated' when 2 then 'trailing bytes' else 'ok' end as ending from parts")
def sbe_frame_files(spark, d):
    """Length-prefixed frame files, whole, cut short or with bytes left over."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            sym, part = int(pdf["sym"].iloc[0]), int(pdf["part"].iloc[0])
            data = b"".join(struct.pack("<I", 10 + i) + bytes([i]) * (10 + i) for i in range(5))
            data = data[:-3] if part % 3 == 1 else data + b"zz" if part % 3 == 2 else data
            return pd.DataFrame({"name": [f"S{sym}/{part}.sbe"], "content": [data]})

        put_files(feed(spark, d).select("sym", F.expr("id div 64").alias("part")).distinct().groupBy("sym", "part").applyInPandas(build, "name string, content binary"), path)

    rows = journals.read_sbe_frames(spark, f"{folder(spark, d, 'sbe-files', make)}/*")
    out = rows.groupBy("path").agg(F.count_if(F.col("status") == "ok").alias("frames"), F.coalesce(F.max(F.when(F.col("status") != "ok", F.col("status"))), F.lit("ok")).alias("ending"))
    return out.select(*_file("sbe"), "frames", "ending")


@query(f"with {FEED} select sym, id, eid from feed where id between 20 and 90")
def event_store_window(spark, d):
    """A range of ids from an event store partitioned by symbol and sorted by id; the range reaches the scan."""
    path = folder(spark, d, "event-store", lambda p: journals.write_event_store(feed(spark, d).select("sym", "id", "eid"), p, ["sym"], "id"))
    return journals.read_window(spark, path, "id", 20, 90).select(F.col("sym").cast("bigint").alias("sym"), "id", "eid")


@query(f"with {FEED} select eid, case when eid % 4 = 3 then 99 else 10 + eid % 2 end::BIGINT as event_id, case when eid % 4 = 3 then 'event id' when eid % 10 = 4 then 'fields' end as reject, 'v' || eid as value from feed where eid % 3 <> 1")
def event_exports(spark, d):
    """Exports of a host's event log: one provider's events, checked against an allow-list of ids and fields."""

    def make(path: str) -> None:
        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            text = ["<Events>"]
            for e in pdf["eid"].tolist():
                number = 99 if e % 4 == 3 else 10 + e % 2
                extra = '<Data Name="Extra">1</Data>' if e % 10 == 4 else ""
                text.append(f'<Event><System><Provider Name="{"Other" if e % 3 == 1 else "Net"}"/><EventID>{number}</EventID><TimeCreated SystemTime="2024-01-01T00:00:00Z"/></System><EventData><Data Name="Eid">{e}</Data><Data Name="Value">v{e}</Data>{extra}</EventData></Event>')
            return pd.DataFrame({"name": [f"{int(pdf['part'].iloc[0])}.xml"], "content": ["".join([*text, "</Events>"]).encode()]})

        put_files(feed(spark, d).select("eid", F.expr("eid div 512").alias("part")).groupBy("part").applyInPandas(build, "name string, content binary"), path)

    rows = journals.read_event_xml(spark, folder(spark, d, "event-exports", make), "Net", {10: ["Eid", "Value"], 11: ["Eid", "Value"]})
    return rows.select(F.col("data")["Eid"].cast("bigint").alias("eid"), "event_id", "reject", F.col("data")["Value"].alias("value"))


def artifact_tree(spark: SparkSession, d: str) -> str:
    """artifact/lane/campaign/generation/leaf files of a few bytes."""

    def make(path: str) -> None:
        rows = feed(spark, d).where("id % 40 = 0").select(
            F.concat(F.lit("a"), F.col("sym"), F.when(F.col("id") % 80 == 0, "/P/").otherwise("/S/"), F.lit("c0/g"), F.expr("id div 400"), F.lit("/"), F.col("id"), F.lit(".json")).alias("name"),
            F.concat(F.lit("file "), F.col("eid")).cast("binary").alias("content"),
        )
        put_files(rows, path)

    return folder(spark, d, "artifacts", make)


@query(f"with {FEED}, t as (select * from feed where id % 40 = 0) select 'a' || sym as artifact, case when id % 80 = 0 then 'P' else 'S' end as lane, 'c0' as campaign, 'g' || (id // 400) as generation, id || '.json' as leaf, length('file ' || eid)::BIGINT as length from t")
def artifact_discovery(spark, d):
    return journals.discover(spark, artifact_tree(spark, d)).drop("path")


@query(f"""with {FEED}, t as (select 'a' || sym || case when id % 80 = 0 then '/P/' else '/S/' end || 'c0/g' || (id // 400) || '/' || id || '.json' as name, 'file ' || eid as body from feed where id % 40 = 0),
l as (select name, length(body) as n, name || chr(9) || length(body) || chr(9) || sha256(body) as line from t), a as (select substr(sha256(name), 1, 2) as g, sum(n) as n, count(*) as c, sha256(string_agg(line, chr(10) order by name)) as h from l group by 1)
select CAST(sum(c) AS BIGINT) as files, CAST(sum(n) AS BIGINT) as bytes, sha256(string_agg(g || chr(9) || h, chr(10) order by g)) as tree_sha256 from a""")
def artifact_tree_digest(spark, d):
    return journals.tree_digest(spark, artifact_tree(spark, d))
