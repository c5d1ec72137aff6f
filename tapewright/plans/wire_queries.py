"""Queries over generated wire messages and journals: codecs and sessions. What SQL cannot decode has no twin; tests compare with vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codecs, wire
from ..operators import oracle, sessions
from ..operators.ordered import carried
from .feed import FEED, feed
from .queries import query


def be(value, size: int) -> F.Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 2 * size, "0"))


def le(value, size: int) -> F.Column:
    text = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
    return F.unhex(F.concat(*(F.substring(text, 2 * (size - i) - 1, 2) for i in range(size))))


def text(value: str | F.Column) -> F.Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("binary")


def itch_bytes(f: DataFrame) -> DataFrame:
    """Add-order and delete messages from the feed; every 50th is cut short, every 53rd has a price beyond the limit."""
    price = F.when(F.col("eid") % 53 == 7, F.lit(2_000_000_001)).otherwise(F.col("eid") * 7 + 10_000)
    add = F.concat(text("A"), be(F.col("sym"), 2), be(F.lit(3), 2), be(F.lit(34_200_000_000_000) + F.col("eid"), 6), be(F.col("eid"), 8), text(F.when(F.col("side") == "bid", "B").otherwise("S")), be(F.lit(100) + F.col("eid") % 7, 4), text("AAPL    "), be(price, 4))
    delete = F.concat(text("D"), be(F.col("sym"), 2), be(F.lit(3), 2), be(F.lit(34_200_000_000_000) + F.col("eid"), 6), be(F.col("eid"), 8))
    whole = F.when(F.col("eid") % 5 == 0, delete).otherwise(add)
    return f.select("eid", F.when(F.col("eid") % 50 == 49, F.substring(whole, 1, 10)).otherwise(whole).alias("payload"))


@query(f"""with {FEED}, m as (select eid, sym, case when eid % 50 = 49 then 'Truncated' when eid % 5 <> 0 and eid % 53 = 7 then 'PriceOutOfRange' else 'Ok' end as status, eid % 5 = 0 as del, side from feed)
select eid, status, case when status = 'Ok' then case when del then 'D' else 'A' end end as msg_type, case when status = 'Ok' then sym end as locate, case when status = 'Ok' then 34200000000000 + eid end as timestamp_ns, case when status = 'Ok' and not del then case when side = 'bid' then 'B' else 'S' end end as side,
case when status = 'Ok' and not del then 100 + eid % 7 end as shares, case when status = 'Ok' and not del then 'AAPL' end as stock, case when status = 'Ok' and not del then eid * 7 + 10000 end as price from m""")
def itch_decode(spark, d):
    return codecs.itch(itch_bytes(feed(spark, d))).select("eid", "status", "msg_type", "locate", "timestamp_ns", "side", F.col("shares").cast("bigint").alias("shares"), "stock", "price")


@query(f"with {FEED} select eid, case when eid % 3 = 0 then 'X' else 'O' end as msg_type, eid + 1 as user_ref, eid % 900 + 1 as quantity, case when eid % 3 <> 0 then 'MSFT' end as symbol, 'Ok' as status from feed")
def ouch_decode(spark, d):
    enter = F.concat(text("O"), be(F.col("eid") + 1, 4), text("B"), be(F.col("eid") % 900 + 1, 4), text("MSFT    "), be(F.lit(5), 8), text("0YPN"), text("N"), text("client        "), be(F.lit(0), 2))
    cancel = F.concat(text("X"), be(F.col("eid") + 1, 4), be(F.col("eid") % 900 + 1, 4), be(F.lit(0), 2))
    rows = feed(spark, d).select("eid", F.when(F.col("eid") % 3 == 0, cancel).otherwise(enter).alias("payload"))
    return codecs.ouch(rows).select("eid", "msg_type", "user_ref", "quantity", "symbol", "status")


@query(f"with {FEED} select eid, 10000::INTEGER as template_id, us as event_us, eid as trade_id, eid * 3 as price, eid % 7 as qty, 'SYM' || sym as symbol from feed")
def sbe_decode(spark, d):
    out = sbe_decoded(spark, d)
    return out.select("eid", "template_id", "event_us", F.col("trades")[0]["id"].alias("trade_id"), F.col("trades")[0]["price"].alias("price"), F.col("trades")[0]["qty"].alias("qty"), "symbol")


def sbe_decoded(spark, d) -> DataFrame:
    body = F.concat(le(F.lit(18), 2), le(F.lit(10000), 2), le(F.lit(1), 2), le(F.lit(0), 2), le(F.col("us"), 8), le(F.col("us"), 8), F.unhex(F.lit("FEFB")), le(F.lit(25), 2), le(F.lit(1), 4), le(F.col("eid"), 8), le(F.col("eid") * 3, 8), le(F.col("eid") % 7, 8), F.unhex(F.lit("01")))
    symbol = F.concat(F.lit("SYM"), F.col("sym").cast("string"))
    rows = feed(spark, d).select("eid", F.concat(body, be(F.length(symbol), 1), text(symbol)).alias("payload"))
    return codecs.sbe(rows).where("status = 'Ok'")


@query(f"with {FEED} select eid, case when eid % 17 = 3 then 'BadChecksum' else 'Ok' end as status, case when eid % 17 <> 3 then 'D' end as msg_type, case when eid % 17 <> 3 then eid::VARCHAR end as seq from feed")
def fix_parse(spark, d):
    pair = lambda tag, v: F.struct(F.lit(tag).alias("tag"), v.alias("value"))
    raw = wire.fix_build(F.array(pair(35, F.lit("D")), pair(34, F.col("eid").cast("string")), pair(49, F.lit("S")), pair(56, F.lit("T"))))
    wrong = F.concat(F.expr("substring(raw, 1, length(raw) - 4)"), F.expr("lpad(cast((cast(substring(raw, length(raw) - 3, 3) as int) + 1) % 256 as string), 3, '0')"), F.lit("\x01"))
    rows = feed(spark, d).select("eid", raw.alias("raw")).select("eid", F.when(F.col("eid") % 17 == 3, wrong).otherwise(F.col("raw")).alias("raw"))
    m = wire.let(wire.fix_message(F.col("raw")), lambda p: F.struct(p["status"].alias("status"), p["fields"][35].alias("msg_type"), p["fields"][34].alias("seq")))
    return rows.select("eid", m.alias("m")).select("eid", "m.*")


@query(f"with {FEED} select eid, case when eid % 19 = 2 then 'IntegrityMismatch' else 'Ok' end as status, case when eid % 19 <> 2 then eid end as sequence, case when eid % 19 <> 2 then sym end as session_id from feed")
def feed_frame_parse(spark, d):
    body = F.concat(F.lit("payload-"), F.col("eid").cast("string")).cast("binary")
    check = wire.fnv1a32(F.col("body")) + F.when(F.col("eid") % 19 == 2, 1).otherwise(0)
    head = F.concat(be(F.lit(1), 1), be(F.lit(2), 1), be(F.col("sym"), 4), be(F.col("eid"), 4), be(F.lit(0), 1), be(F.col("us"), 8), be(F.octet_length("body"), 2), be(check % 4294967296, 4))
    rows = feed(spark, d).withColumn("body", body).select("eid", F.concat(head, "body").alias("payload"))
    return codecs.feed(rows).select("eid", "status", "sequence", "session_id")


@query(f"with {FEED} select eid, CAST(sym * 258 + 1 AS BIGINT) as big, CAST(eid AS BIGINT) as little, CAST(-eid - 1 AS BIGINT) as signed from feed")
def integer_reads(spark, d):
    rows = feed(spark, d).select("eid", F.concat(be(F.col("sym") * 258 + 1, 4), le(F.col("eid"), 6), le(-F.col("eid") - 1, 8)).alias("b"))
    return rows.select("eid", wire.uint_be(F.col("b"), 0, 4).alias("big"), wire.uint_le(F.col("b"), 4, 6).alias("little"), wire.int64_le(F.col("b"), 10).alias("signed"))


@query(f"""with {FEED}, m as (select eid, case when eid % 5 = 3 then -eid * 100 else eid * 10 end as mantissa, eid % 7 - 4 as exponent from feed), d as (select *, abs(mantissa)::VARCHAR as digits, greatest(-exponent, 0) as places from m)
select eid, case when mantissa < 0 then '-' else '' end || case when exponent >= 0 then digits || repeat('0', exponent) when length(digits) > places then left(digits, length(digits) - places) || '.' || right(digits, places)
else '0.' || repeat('0', places - length(digits)) || digits end as value from d""")
def sbe_decimal_text(spark, d):
    mantissa = F.when(F.col("eid") % 5 == 3, -F.col("eid") * 100).otherwise(F.col("eid") * 10)
    return feed(spark, d).select("eid", wire.scaled_text(mantissa, F.col("eid") % 7 - 4).alias("value"))


def _made(layouts: dict, header: list) -> dict[str, list]:
    """Fields of each type with what the messages below hold: numbers eid * 3 + offset (below the field's range), prices eid + 7, texts of one letter."""
    return {k: [*header, *v[1]] for k, v in layouts.items()}


def fixed_messages(f: DataFrame, layouts: dict, header: list, appendage: bool) -> DataFrame:
    """One message for each event, of the type that its number names; every 40th is cut by one byte, every 41st has an unknown type."""
    kinds = sorted(layouts)
    e, whole = F.col("eid"), None
    for i, (kind, fields) in enumerate(sorted(_made(layouts, header).items())):
        size, at, parts = layouts[kind][0], 1, [text(kind)]
        for name, start, n, k in sorted(fields, key=lambda x: x[1]):
            if start > at:
                parts.append(F.unhex(F.lit("00" * (start - at))))
            value = (e + 7) if k == "p" else (e * 3 + start)
            parts.append(be(value % (256 ** min(n, 4)), n) if k in "up" else text(F.rpad(F.chr(F.lit(65) + (e + start) % 26), n, " ")))
            at = start + n
        end = layouts[kind][2] if appendage else size
        if at < end:
            parts.append(F.unhex(F.lit("00" * (end - at))))
        if appendage:  # its length and three letters
            parts.append(F.unhex(F.lit("0003616263")))
        message = F.concat(*parts)
        whole = message if whole is None else F.when(e % len(kinds) == i, message).otherwise(whole)
    sizes = F.element_at(F.create_map(*(x for i, k in enumerate(kinds) for x in (F.lit(i), F.lit(layouts[k][0])))), (e % len(kinds)).cast("int"))
    cut = F.when(e % 40 == 11, F.expr("substring(whole, 1, size - 1)")).when(e % 41 == 12, F.concat(text("?"), F.expr("substring(whole, 2, 1000)"))).otherwise(F.col("whole"))
    return f.select("eid", whole.alias("whole"), sizes.alias("size")).select("eid", cut.alias("payload"))


def fixed_sql(layouts: dict, header: list, appendage: bool) -> str:
    """SQL of the rows that the messages hold."""
    kinds = sorted(layouts)
    columns: dict[str, list[str]] = {}
    for i, (_, fields) in enumerate(sorted(_made(layouts, header).items())):
        for name, start, n, k in fields:
            value = "eid + 7" if k == "p" else f"(eid * 3 + {start}) % {256 ** min(n, 4)}" if k == "u" else f"chr((65 + (eid + {start}) % 26)::INTEGER)"
            columns.setdefault(name, []).append(f"when k = {i} then {value}")
    status = "case when eid % 40 = 11 then 'Truncated' when eid % 41 = 12 then 'UnknownType' else 'Ok' end"
    rows = ", ".join(f"case when status = 'Ok' then case {' '.join(whens)} end end as {name}" for name, whens in columns.items())
    names = ", ".join(f"when k = {i} then '{kind}'" for i, kind in enumerate(kinds)).replace(", when", " when")
    extra = ", case when status = 'Ok' then 3 end as appendage_len, case when status = 'Ok' then 'abc' end as appendage" if appendage else ""
    return f"with {FEED}, m as (select eid, eid % {len(kinds)} as k, {status} as status from feed) select eid, status, case when status = 'Ok' then case {names} end end as msg_type, {rows}{extra} from m"


def plain(df: DataFrame) -> DataFrame:
    """Numbers as bigint, bytes as text."""
    return df.select(*(F.col(f.name).cast("bigint" if f.dataType.simpleString().startswith("decimal") else "string" if f.dataType.simpleString() == "binary" else f.dataType).alias(f.name) for f in df.schema if f.name != "payload"))


@query(fixed_sql(codecs.ITCH, codecs.ITCH_HEADER, False))
def itch_all_types(spark, d):
    return plain(codecs.itch(fixed_messages(feed(spark, d), codecs.ITCH, codecs.ITCH_HEADER, False)))


@query(fixed_sql(codecs.OUCH_IN, [], True))
def ouch_inbound_types(spark, d):
    return plain(codecs.ouch(fixed_messages(feed(spark, d), codecs.OUCH_IN, [], True)))


@query(fixed_sql(codecs.OUCH_OUT, [], True))
def ouch_outbound_types(spark, d):
    return plain(codecs.ouch(fixed_messages(feed(spark, d), codecs.OUCH_OUT, [], True), inbound=False))


def sbe_levels(price, qty, n: int) -> F.Column:
    return F.concat(le(F.lit(16), 2), le(F.lit(n), 2), *(F.concat(le(price + i, 8), le(qty + i, 8)) for i in range(n)))


@query(f"""with {FEED}, m as (select eid, us, sym, eid % 6 as k from feed) select eid, case k when 4 then 'UnknownTemplate' when 5 then 'Truncated' else 'Ok' end as status, (case when k < 4 then 10000 + k when k = 4 then 10009 else 10001 end)::INTEGER as template, case when k < 4 then us end as event_us,
case when k in (1, 2) then eid end as book_id, case when k = 3 then eid end as first_id, case when k = 3 then eid + 5 end as last_id, case k when 1 then eid || 'x' || (eid + 1) when 2 then eid || 'x' || (eid + 1) || ',' || (eid + 1) || 'x' || (eid + 2) when 3 then '' end as bids,
case k when 1 then (eid + 2) || 'x' || (eid + 3) when 2 then (eid + 2) || 'x' || (eid + 3) when 3 then (eid + 2) || 'x' || (eid + 3) end as asks, case when k = 0 then eid || 'x' || (eid * 3) || 'x' || (eid % 2 = 1) end as trades, case when k < 4 then 'S' || sym end as symbol from m""")
def sbe_all_templates(spark, d):
    """All four templates, an unknown one and messages cut short."""
    e, us = F.col("eid"), F.col("us")
    head = lambda block, template: F.concat(le(F.lit(block), 2), le(F.lit(template), 2), le(F.lit(1), 2), le(F.lit(0), 2))
    symbol = F.concat(F.lit("S"), F.col("sym").cast("string"))
    tail, scale = F.concat(be(F.length(symbol), 1), text(symbol)), F.unhex(F.lit("FEFB"))
    trades = F.concat(head(18, 10000), le(us, 8), le(us, 8), scale, le(F.lit(25), 2), le(F.lit(1), 4), le(e, 8), le(e * 3, 8), le(F.lit(2), 8), be(e % 2, 1), tail)
    top = F.concat(head(50, 10001), le(us, 8), le(e, 8), scale, le(e, 8), le(e + 1, 8), le(e + 2, 8), le(e + 3, 8), tail)
    book = F.concat(head(18, 10002), le(us, 8), le(e, 8), scale, sbe_levels(e, e + 1, 2), sbe_levels(e + 2, e + 3, 1), tail)
    diff = F.concat(head(26, 10003), le(us, 8), le(e, 8), le(e + 5, 8), scale, sbe_levels(e, e, 0), sbe_levels(e + 2, e + 3, 1), tail)
    made = F.when(e % 6 == 0, trades).when(e % 6 == 1, top).when(e % 6 == 2, book).when(e % 6 == 3, diff).when(e % 6 == 4, F.concat(head(18, 10009), le(us, 8))).otherwise(F.expr("substring(top, 1, 40)"))
    rows = feed(spark, d).withColumn("top", top).select("eid", made.alias("payload"))
    side = lambda c: F.when(F.col(c).isNotNull(), F.array_join(F.transform(c, lambda x: F.concat_ws("x", x["price"].cast("string"), x["qty"].cast("string"))), ","))
    deals = F.array_join(F.transform("trades", lambda t: F.concat_ws("x", t["id"].cast("string"), t["price"].cast("string"), t["buyer_maker"].cast("string"))), ",")
    out = codecs.sbe(rows.withColumn("template", codecs.template_id(F.col("payload")).cast("int")))
    return out.select("eid", "status", "template", "event_us", "book_id", "first_id", "last_id", side("bids").alias("bids"), side("asks").alias("asks"), F.when(F.col("trades").isNotNull(), deals).alias("trades"), "symbol")


@query(f"with {FEED} select eid, 'SYM' || sym as symbol, eid as id, eid * 3 as price, eid % 7 as qty from feed")
def sbe_trade_rows(spark, d):
    """One row for each trade of decoded messages."""
    return codecs.sbe_trades(sbe_decoded(spark, d), ["eid"]).select("eid", "symbol", "id", "price", "qty")


@query(f"with {FEED} select eid, CAST(eid * 1000000 AS DECIMAL(38,0)) as units from feed")
def fixed8_units(spark, d):
    return feed(spark, d).select("eid", wire.fixed8(F.col("eid"), F.lit(-2)).alias("units"))


@query(f"with {FEED} select eid, CAST(((10000 + eid * 7)::DECIMAL(18,4) * 0.0001) AS DECIMAL(14,4)) as price from feed")
def price4_values(spark, d):
    return feed(spark, d).select("eid", wire.price4(F.lit(10_000) + F.col("eid") * 7).alias("price"))


@query()
def ouch_session(spark, d):
    """Order sessions of 16 firms from the feed."""
    e = F.col("eid")
    kind = F.when(e % 5 < 2, "enter").when(e % 5 == 2, "replace").when(e % 5 == 3, "execute").otherwise("cancel")
    ref = F.when(e % 5 < 2, F.col("id") + 1).when(e % 5 == 2, F.col("id") + 1).otherwise(F.col("id") - 1)
    rows = feed(spark, d).select("sym", F.col("id").alias("seq"), kind.alias("kind"), ref.cast("bigint").alias("user_ref"), (F.col("id") - 1).cast("bigint").alias("orig_ref"), (e % 100 + 1).alias("qty"), (e % 31 == 0).alias("late"))
    return sessions.order_session(rows, ["sym"])


@query()
def fix_session(spark, d):
    """FIX sessions of 16 firms with swapped and missing numbers."""
    e, i = F.col("eid"), F.col("id")
    seq = i + 1 + F.when(e % 23 == 5, 1).when(e % 23 == 21, -1).otherwise(0)
    kind = F.when(i == 0, "A").when(e % 11 == 3, "1").otherwise("0")
    rows = feed(spark, d).select("sym", i.alias("arrival"), kind.alias("msg_type"), F.when(i == 0, 1).otherwise(seq).cast("bigint").alias("msg_seq"), F.lit(None).cast("bigint").alias("new_seq"), e.cast("string").alias("test_id"))
    return sessions.fix_session(rows, ["sym"])


JOURNAL = f"""{FEED}, j as (select sym, id as record_index, sha256(eid::VARCHAR) as record_sha256, case when eid % 71 = 5 then 'x' else coalesce(lag(sha256(eid::VARCHAR)) over (partition by sym order by id), repeat('0', 64)) end as previous_record_sha256,
case when id = 0 then 'ARBITRATION_STARTED' else 'TRADE_OBSERVATION' end as event, case when id > 0 then id - case when eid % 83 = 9 then 3 else 0 end end as trade_id from feed),
t as (select *, max(case when event = 'TRADE_OBSERVATION' then trade_id end) over (partition by sym order by record_index rows between unbounded preceding and 1 preceding) as last, coalesce(lag(record_sha256) over (partition by sym order by record_index), repeat('0', 64)) as want from j)"""


@query(f"with {JOURNAL} select sym, record_index, 'hash chain' as rule from t where previous_record_sha256 <> want union all select sym, record_index, 'trade order' from t where event = 'TRADE_OBSERVATION' and trade_id <= coalesce(last, -1)")
def journal_audit(spark, d):
    own = F.sha2(F.col("eid").cast("string"), 256)
    f = carried(feed(spark, d), ["sym"], "id", prev={"_before": own})
    before = F.coalesce("_before", F.lit("0" * 64))
    columns = dict(part.rsplit(" ", 1) for part in oracle.PAYLOAD.split(", "))
    made = {"event": F.when(F.col("id") == 0, "ARBITRATION_STARTED").otherwise("TRADE_OBSERVATION"), "trade_id": F.when(F.col("id") > 0, F.col("id") - F.when(F.col("eid") % 83 == 9, 3).otherwise(0))}
    payload = [(made[n] if n in made else F.lit(None)).cast(t).alias(n) for n, t in columns.items() if n != "record_sha256"]
    rows = f.select("sym", F.col("id").alias("record_index"), own.alias("record_sha256"), F.when(F.col("eid") % 71 == 5, "x").otherwise(before).alias("previous_record_sha256"), *payload)
    return oracle.journal_violations(rows, ["sym"])
