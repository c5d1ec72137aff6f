"""Binary codecs as Arrow decoders: fixed layouts are data; one reader takes all messages of a type in a batch as a matrix of bytes, column by column.

A message that fails to decode keeps all payload columns null and says why in `status`.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wire import PRICE4_MAX

# Layouts as (name, offset, size, kind); kinds: u unsigned big-endian, a text, c one character, p four-place price.
ITCH_HEADER = [("locate", 1, 2, "u"), ("tracking", 3, 2, "u"), ("timestamp_ns", 5, 6, "u")]
ITCH = {
    "S": (12, [("event_code", 11, 1, "c")]),
    "R": (39, [("stock", 11, 8, "a"), ("market", 19, 1, "c"), ("financial", 20, 1, "c"), ("round_lot", 21, 4, "u"), ("lots_only", 25, 1, "c"), ("issue_class", 26, 1, "c"), ("subtype", 27, 2, "a"), ("authenticity", 29, 1, "c"), ("short_sale", 30, 1, "c"), ("ipo", 31, 1, "c"), ("luld", 32, 1, "c"), ("etp", 33, 1, "c"), ("leverage", 34, 4, "u"), ("inverse", 38, 1, "c")]),
    "H": (25, [("stock", 11, 8, "a"), ("trading_state", 19, 1, "c"), ("reason", 21, 4, "a")]),
    "A": (36, [("order_ref", 11, 8, "u"), ("side", 19, 1, "c"), ("shares", 20, 4, "u"), ("stock", 24, 8, "a"), ("price", 32, 4, "p")]),
    "F": (40, [("order_ref", 11, 8, "u"), ("side", 19, 1, "c"), ("shares", 20, 4, "u"), ("stock", 24, 8, "a"), ("price", 32, 4, "p"), ("attribution", 36, 4, "a")]),
    "E": (31, [("order_ref", 11, 8, "u"), ("shares", 19, 4, "u"), ("match", 23, 8, "u")]),
    "C": (36, [("order_ref", 11, 8, "u"), ("shares", 19, 4, "u"), ("match", 23, 8, "u"), ("printable", 31, 1, "c"), ("price", 32, 4, "p")]),
    "X": (23, [("order_ref", 11, 8, "u"), ("shares", 19, 4, "u")]),
    "D": (19, [("order_ref", 11, 8, "u")]),
    "U": (35, [("order_ref", 11, 8, "u"), ("new_order_ref", 19, 8, "u"), ("shares", 27, 4, "u"), ("price", 31, 4, "p")]),
    "P": (44, [("order_ref", 11, 8, "u"), ("side", 19, 1, "c"), ("shares", 20, 4, "u"), ("stock", 24, 8, "a"), ("price", 32, 4, "p"), ("match", 36, 8, "u")]),
    "Q": (40, [("shares", 11, 8, "u"), ("stock", 19, 8, "a"), ("price", 27, 4, "p"), ("match", 31, 8, "u"), ("cross_type", 39, 1, "c")]),
    "B": (19, [("match", 11, 8, "u")]),
}

_ORDER_TAIL = lambda at: [("side", at, 1, "c"), ("quantity", at + 1, 4, "u"), ("symbol", at + 5, 8, "a"), ("price", at + 13, 8, "u"), ("time_in_force", at + 21, 1, "c"), ("display", at + 22, 1, "c")]
#: (least length, fields, offset of the appendage's length, whether it may be absent)
OUCH_IN = {
    "O": (47, [("user_ref", 1, 4, "u"), *_ORDER_TAIL(5), ("capacity", 28, 1, "c"), ("sweep", 29, 1, "c"), ("cross_type", 30, 1, "c"), ("client_id", 31, 14, "a")], 45, False),
    "U": (40, [("orig_ref", 1, 4, "u"), ("user_ref", 5, 4, "u"), ("quantity", 9, 4, "u"), ("price", 13, 8, "u"), ("time_in_force", 21, 1, "c"), ("display", 22, 1, "c"), ("sweep", 23, 1, "c"), ("client_id", 24, 14, "a")], 38, False),
    "X": (11, [("user_ref", 1, 4, "u"), ("quantity", 5, 4, "u")], 9, True),
}
OUCH_OUT = {
    "A": (64, [("timestamp_ns", 1, 8, "u"), ("user_ref", 9, 4, "u"), *_ORDER_TAIL(13), ("order_ref", 36, 8, "u"), ("capacity", 44, 1, "c"), ("sweep", 45, 1, "c"), ("cross_type", 46, 1, "c"), ("order_state", 47, 1, "c"), ("client_id", 48, 14, "a")], 62, False),
    "U": (68, [("timestamp_ns", 1, 8, "u"), ("orig_ref", 9, 4, "u"), ("user_ref", 13, 4, "u"), *_ORDER_TAIL(17), ("order_ref", 40, 8, "u"), ("capacity", 48, 1, "c"), ("sweep", 49, 1, "c"), ("cross_type", 50, 1, "c"), ("order_state", 51, 1, "c"), ("client_id", 52, 14, "a")], 66, False),
    "C": (18, [("timestamp_ns", 1, 8, "u"), ("user_ref", 9, 4, "u"), ("quantity", 13, 4, "u"), ("reason", 17, 1, "c")], 18, True),
    "E": (34, [("timestamp_ns", 1, 8, "u"), ("user_ref", 9, 4, "u"), ("quantity", 13, 4, "u"), ("price", 17, 8, "u"), ("liquidity", 25, 1, "c"), ("match", 26, 8, "u")], 34, True),
    "J": (29, [("timestamp_ns", 1, 8, "u"), ("user_ref", 9, 4, "u"), ("reject_code", 13, 2, "u"), ("client_id", 15, 14, "a")], 29, True),
}


def _columns(layouts: dict, extra: list[tuple[str, str]]) -> list[tuple[str, str]]:
    out: dict[str, str] = {"msg_type": "string"}
    for layout in layouts.values():
        for name, _, size, kind in layout[1]:
            out[name] = "decimal(20,0)" if kind == "u" and size == 8 else "bigint" if kind in "up" else "string"
    return [*out.items(), *extra, ("status", "string")]


def _arrow(kind: str) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "decimal(20,0)": pa.decimal128(20, 0)}[kind]


def _decode(df: DataFrame, payload: str, columns: list[tuple[str, str]], one) -> DataFrame:
    """Other columns pass unchanged; `one` turns bytes into a dictionary of columns."""
    at = df.columns.index(payload)
    schema = df.schema.simpleString()[len("struct<") : -1]
    names = [*df.columns, *(n for n, _ in columns)]
    types = [_arrow(k) for _, k in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(b) if b is not None else {"status": "Truncated"} for b in batch.column(at).to_pylist()]
            made = []
            for (name, _), t in zip(columns, types, strict=True):
                values = [r.get(name) for r in rows]
                if pa.types.is_decimal(t):
                    values = [None if v is None else Decimal(v) for v in values]
                made.append(pa.array(values, t))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return df.mapInArrow(run, ", ".join([schema_part(schema), *(f"`{n}` {k}" for n, k in columns)]))


def schema_part(simple: str) -> str:
    """`a:int,b:string` as `a int, b string` at the top level (nested types keep their colons)."""
    out, depth, field, done = [], 0, "", False
    for c in simple:
        depth += c in "<("
        depth -= c in ">)"
        if c == "," and depth == 0:
            out.append(field)
            field, done = "", False
        elif c == ":" and depth == 0 and not done:
            field, done = field + " ", True
        else:
            field += c
    return ", ".join([*out, field])


class Fixed:
    """Messages of a batch by type: the leading bytes of all messages of one type as a matrix, read column by column."""

    def __init__(self, payloads: pa.Array, columns: list[tuple[str, str]]) -> None:
        plain = pa.compute.fill_null(payloads.cast(pa.large_binary()), b"")
        self.offsets = np.frombuffer(plain.buffers()[1], dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
        self.data = np.frombuffer(plain.buffers()[2], dtype=np.uint8) if plain.buffers()[2] is not None else np.empty(0, np.uint8)
        self.sizes = np.diff(self.offsets)
        n = len(plain)
        self.kind = np.zeros(n, dtype=np.uint8)
        some = np.flatnonzero(self.sizes > 0)
        self.kind[some] = self.data[self.offsets[some]]
        self.status = np.full(n, "UnknownType", dtype=object)
        self.status[self.sizes == 0] = "Truncated"
        self.columns = columns
        self.out = {name: np.zeros(n, dtype=np.uint64) if k in ("bigint", "decimal(20,0)") else np.full(n, None, dtype=object) for name, k in columns}
        self.known = {name: np.zeros(n, dtype=bool) for name, _ in columns}

    def rows(self, kind: str, size: int) -> np.ndarray:
        """Rows of the type that are long enough; shorter ones are truncated."""
        own = self.kind == ord(kind)
        self.status[own] = np.where(self.sizes[own] < size, "Truncated", "Ok")
        return np.flatnonzero(own & (self.sizes >= size))

    def matrix(self, rows: np.ndarray, size: int) -> np.ndarray:
        return self.data[self.offsets[rows][:, None] + np.arange(size)]

    def put(self, name: str, rows: np.ndarray, values: np.ndarray) -> None:
        self.out[name][rows] = values
        self.known[name][rows] = True

    def arrays(self) -> list[pa.Array]:
        good, made = self.status == "Ok", []
        for name, k in self.columns:
            if name == "status":
                made.append(pa.array(self.status, pa.string()))
                continue
            missing = ~(good & self.known[name])
            values = pa.array(self.out[name], mask=missing) if k in ("bigint", "decimal(20,0)") else pa.array(np.where(missing, None, self.out[name]), _arrow(k))
            made.append(values.cast(_arrow(k)))
        return made


def _read(m: np.ndarray, at: int, size: int, kind: str) -> np.ndarray:
    """One field of all rows: unsigned big-endian numbers, or texts of one byte a character without outer blanks on the right (kind a)."""
    part = m[:, at : at + size]
    if kind in "up":
        out = np.zeros(len(m), dtype=np.uint64)
        for i in range(size):
            out = (out << np.uint64(8)) | part[:, i].astype(np.uint64)
        return out
    texts = [bytes(x).decode("latin-1") for x in part]
    return np.array([t.rstrip(" ") if kind == "a" else t for t in texts], dtype=object)


def _fixed(df: DataFrame, payload: str, columns: list[tuple[str, str]], fill) -> DataFrame:
    """Other columns pass unchanged; fill(messages) reads all types of a batch into its columns."""
    at = df.columns.index(payload)
    names = [*df.columns, *(n for n, _ in columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            messages = Fixed(batch.column(at), columns)
            fill(messages)
            yield pa.RecordBatch.from_arrays([*batch.columns, *messages.arrays()], names=names)

    schema = schema_part(df.schema.simpleString()[len("struct<") : -1])
    return df.mapInArrow(run, ", ".join([schema, *(f"`{n}` {k}" for n, k in columns)]))


def itch(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Columns of all 13 message types, prices in units of 1/10000, and status Ok, Truncated, UnknownType or PriceOutOfRange."""

    def fill(messages: Fixed) -> None:
        for kind, (size, fields) in ITCH.items():
            rows = messages.rows(kind, size)
            m = messages.matrix(rows, size)
            messages.put("msg_type", rows, np.full(len(rows), kind, dtype=object))
            for name, at, n, k in [*ITCH_HEADER, *fields]:
                values = _read(m, at, n, k)
                messages.put(name, rows, values)
                if k == "p":
                    messages.status[rows[values > PRICE4_MAX]] = "PriceOutOfRange"

    return _fixed(df, payload, _columns({k: (v[0], [*ITCH_HEADER, *v[1]]) for k, v in ITCH.items()}, []), fill)


def ouch(df: DataFrame, payload: str = "payload", inbound: bool = True) -> DataFrame:
    """Order-entry messages of one direction, with appendage_len and appendage; status Ok, Truncated or UnknownType."""
    layouts = OUCH_IN if inbound else OUCH_OUT

    def fill(messages: Fixed) -> None:
        for kind, (size, fields, tail, optional) in layouts.items():
            rows = messages.rows(kind, size)
            if optional:  # one byte alone is half a length
                half = messages.sizes[rows] == size + 1
                messages.status[rows[half]] = "Truncated"
                rows = rows[~half]
            m = messages.matrix(rows, size)
            messages.put("msg_type", rows, np.full(len(rows), kind, dtype=object))
            for name, at, n, k in fields:
                messages.put(name, rows, _read(m, at, n, k))
            given = messages.sizes[rows] > size if optional else np.ones(len(rows), dtype=bool)
            start, end = messages.offsets[rows] + tail, messages.offsets[rows + 1]
            length = np.zeros(len(rows), dtype=np.uint64)
            length[given] = messages.data[start[given]].astype(np.uint64) << np.uint64(8) | messages.data[start[given] + 1]
            messages.put("appendage_len", rows, length)
            rest = np.empty(len(rows), dtype=object)
            rest[:] = [messages.data[a + 2 : b].tobytes() if g else b"" for a, b, g in zip(start.tolist(), end.tolist(), given.tolist(), strict=True)]
            messages.put("appendage", rows, rest)

    return _fixed(df, payload, _columns(layouts, [("appendage_len", "bigint"), ("appendage", "binary")]), fill)


def ouch_encode(kind: str, **f) -> bytes:
    """An inbound message; quantity of enter and replace must lie in 1..999,999."""
    size, fields, tail, _ = OUCH_IN[kind]
    if kind in "OU" and not 0 < f["quantity"] < 1_000_000:
        raise ValueError("quantity")
    out = bytearray(b" " * size)
    out[0] = ord(kind)
    for name, at, n, k in fields:
        value = f.get(name, 0 if k in "up" else "")
        out[at : at + n] = int(value).to_bytes(n, "big") if k in "up" else str(value).encode("latin-1")[:n].ljust(n)
    appendage = f.get("appendage", b"")
    out[tail : tail + 2] = len(appendage).to_bytes(2, "big")
    return bytes(out) + appendage


# --- SBE ----------------------------------------------------------------------------------------------------------------

LEVEL = "array<struct<price:bigint,qty:bigint>>"
SBE_COLUMNS = [
    ("template_id", "int"), ("event_us", "bigint"), ("transact_us", "bigint"), ("book_id", "bigint"), ("first_id", "bigint"), ("last_id", "bigint"), ("price_exponent", "int"), ("qty_exponent", "int"),
    ("trades", "array<struct<id:bigint,price:bigint,qty:bigint,buyer_maker:boolean,best_match:boolean>>"), ("bids", LEVEL), ("asks", LEVEL), ("symbol", "string"), ("status", "string"),
]
#: Root length and the group header's layout, by template.
SBE_ROOTS = {10000: 18, 10001: 50, 10002: 18, 10003: 26}


class _Short(Exception):
    pass


def _need(data: bytes, end: int) -> None:
    if end > len(data):
        raise _Short


def sbe_message(data: bytes) -> dict:
    """One message of templates 10000 to 10003 (schema 1, version 0)."""
    if len(data) < 8:
        return {"status": "Truncated"}
    block, template, schema, version = struct.unpack_from("<4H", data)
    if schema != 1 or version != 0:
        return {"status": "SchemaMismatch"}
    if template not in SBE_ROOTS:
        return {"status": "UnknownTemplate"}
    if block < SBE_ROOTS[template]:
        return {"status": "InvalidLayout"}
    try:
        _need(data, 8 + block)
        at = 8 + block
        row: dict = {"template_id": template, "event_us": struct.unpack_from("<q", data, 8)[0]}
        if template == 10000:
            row["transact_us"], row["price_exponent"], row["qty_exponent"] = struct.unpack_from("<qbb", data, 16)
            _need(data, at + 6)
            size, n = struct.unpack_from("<HI", data, at)
            if size < 25:
                return {"status": "InvalidLayout"}
            at += 6
            _need(data, at + size * n)
            row["trades"] = [dict(zip(("id", "price", "qty", "buyer_maker"), struct.unpack_from("<qqqB", data, at + i * size), strict=True)) for i in range(n)]
            for t in row["trades"]:
                t |= {"buyer_maker": t["buyer_maker"] != 0, "best_match": True}
            at += size * n
        elif template == 10001:
            row["book_id"], row["price_exponent"], row["qty_exponent"], bp, bq, ap, aq = struct.unpack_from("<qbbqqqq", data, 16)
            row["bids"], row["asks"] = [{"price": bp, "qty": bq}], [{"price": ap, "qty": aq}]
        else:
            if template == 10002:
                row["book_id"], row["price_exponent"], row["qty_exponent"] = struct.unpack_from("<qbb", data, 16)
            else:
                row["first_id"], row["last_id"], row["price_exponent"], row["qty_exponent"] = struct.unpack_from("<qqbb", data, 16)
            for side in ("bids", "asks"):
                _need(data, at + 4)
                size, n = struct.unpack_from("<HH", data, at)
                if size < 16:
                    return {"status": "InvalidLayout"}
                at += 4
                _need(data, at + size * n)
                row[side] = [dict(zip(("price", "qty"), struct.unpack_from("<qq", data, at + i * size), strict=True)) for i in range(n)]
                at += size * n
        _need(data, at + 1)
        _need(data, at + 1 + data[at])
        row["symbol"] = data[at + 1 : at + 1 + data[at]].decode("utf-8", "replace")
    except _Short:
        return {"status": "Truncated"}
    return {**row, "status": "Ok"}


def sbe(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Columns of all four templates with levels and trades as arrays; see sbe_trades for one row a trade."""
    level = pa.list_(pa.struct([("price", pa.int64()), ("qty", pa.int64())]))
    trade = pa.list_(pa.struct([("id", pa.int64()), ("price", pa.int64()), ("qty", pa.int64()), ("buyer_maker", pa.bool_()), ("best_match", pa.bool_())]))
    types = [trade if n == "trades" else level if n in ("bids", "asks") else _arrow(k) for n, k in SBE_COLUMNS]
    at = df.columns.index(payload)
    names = [*df.columns, *(n for n, _ in SBE_COLUMNS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sbe_message(b) if b is not None else {"status": "Truncated"} for b in batch.column(at).to_pylist()]
            made = [pa.array([r.get(n) for r in rows], t) for (n, _), t in zip(SBE_COLUMNS, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    schema = schema_part(df.schema.simpleString()[len("struct<") : -1])
    return df.mapInArrow(run, ", ".join([schema, *(f"`{n}` {k}" for n, k in SBE_COLUMNS)]))


def sbe_trades(decoded: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each trade of decoded messages."""
    return decoded.where("template_id = 10000").select(*keep, "symbol", "event_us", "transact_us", "price_exponent", "qty_exponent", F.explode("trades").alias("t")).select(*keep, "symbol", "event_us", "transact_us", "price_exponent", "qty_exponent", "t.*")


def template_id(payload) -> F.Column:
    """The template of a message without decoding it."""
    from .wire import uint_le

    return uint_le(payload, 2, 2)


# --- feed frames --------------------------------------------------------------------------------------------------------


def fnv1a32(data: bytes) -> int:
    h = 2166136261
    for b in data:
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return h


#: Fixed value: version, type, session, sequence, time domain, time, payload length, integrity; big-endian, 25 bytes.
FEED_HEADER = struct.Struct(">BBIIBQHI")
FEED_COLUMNS = [("version", "bigint"), ("type", "bigint"), ("session_id", "bigint"), ("sequence", "bigint"), ("time_domain", "bigint"), ("timestamp_ns", "decimal(20,0)"), ("body", "binary"), ("status", "string")]


def feed_frame(data: bytes, version: int = 1) -> dict:
    """One frame; an integrity field of 0 means not checked."""
    if len(data) < FEED_HEADER.size:
        return {"status": "Truncated"}
    head = FEED_HEADER.unpack_from(data)
    if head[0] != version:
        return {"status": "UnknownVersion"}
    body = data[FEED_HEADER.size : FEED_HEADER.size + head[6]]
    if len(body) < head[6]:
        return {"status": "Truncated"}
    if body and head[7] and head[7] != fnv1a32(body):
        return {"status": "IntegrityMismatch"}
    return dict(zip(("version", "type", "session_id", "sequence", "time_domain", "timestamp_ns"), head, strict=False)) | {"body": body, "status": "Ok"}


def feed_encode(type_: int, session: int, sequence: int, timestamp_ns: int, body: bytes, version: int = 1, time_domain: int = 0) -> bytes:
    return FEED_HEADER.pack(version, type_, session, sequence, time_domain, timestamp_ns, len(body), fnv1a32(body) if body else 0) + body


def feed(df: DataFrame, payload: str = "payload", version: int = 1) -> DataFrame:
    return _decode(df, payload, FEED_COLUMNS, lambda data: feed_frame(data, version))
