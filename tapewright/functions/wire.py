"""Scalar expressions over wire bytes, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import canonical_text


def byte_at(data: Column, offset: Column | int) -> Column:
    at = F.lit(offset) if isinstance(offset, int) else offset
    return F.conv(F.hex(F.substring(data, at + 1, F.lit(1))), 16, 10).cast("bigint")


def uint_be(data: Column, offset: int, size: int) -> Column:
    """Unsigned big-endian integer; decimal(20,0) for 8 bytes, else bigint."""
    digits = F.conv(F.hex(F.substring(data, offset + 1, size)), 16, 10)
    return digits.cast("decimal(20,0)" if size == 8 else "bigint")


def uint_le(data: Column, offset: int, size: int) -> Column:
    """Unsigned little-endian integer; decimal(20,0) for 8 bytes, else bigint."""
    turned = F.concat(*(F.hex(F.substring(data, offset + i + 1, 1)) for i in range(size - 1, -1, -1)))
    return F.conv(turned, 16, 10).cast("decimal(20,0)" if size == 8 else "bigint")


def int64_le(data: Column, offset: int) -> Column:
    """Signed little-endian 64-bit integer."""
    u = uint_le(data, offset, 8)
    return F.when(u >= F.lit("9223372036854775808").cast("decimal(20,0)"), u - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(u).cast("bigint")


def alpha(data: Column, offset: int, size: int) -> Column:
    """Text field with its spaces at the right removed."""
    return F.rtrim(F.decode(F.substring(data, offset + 1, size), "ISO-8859-1"))


def fnv1a32(data: Column) -> Column:
    """32-bit FNV-1a: XOR, then multiply."""
    step = lambda h, i: ((h.bitwiseXOR(byte_at(data, i))) * F.lit(16777619).cast("bigint")).bitwiseAND(F.lit(4294967295).cast("bigint"))
    start = F.lit(2166136261).cast("bigint")
    return F.when(F.octet_length(data) > 0, F.aggregate(F.sequence(F.lit(0), F.octet_length(data) - 1), start, step)).otherwise(start)


def serial_difference(a: Column, b: Column) -> Column:
    """a - b as signed 32-bit serial numbers."""
    return (F.pmod(a - b + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)).cast("int")


#: Fixed value: the highest price of the four-place format, inclusive.
PRICE4_MAX = 2_000_000_000


def price4(raw: Column) -> Column:
    """Four-place price, null above the format's limit."""
    return F.when(raw <= PRICE4_MAX, (raw.cast("decimal(10,0)") / F.lit(10_000).cast("decimal(5,0)")).cast("decimal(14,4)"))


def scaled_text(mantissa: Column, exponent: Column) -> Column:
    """mantissa * 10**exponent as text that keeps every digit: zeros are neither added to a fraction nor taken from it; exponents -18 to 18."""
    digits = F.abs(mantissa.cast("decimal(20,0)")).cast("string")
    places = F.greatest(-exponent, F.lit(0))
    long = F.lpad(digits, F.greatest(F.length(digits), places + 1).cast("int"), "0")
    whole, part = F.substring(long, F.lit(1), (F.length(long) - places).cast("int")), F.substring(long, (F.length(long) - places + 1).cast("int"), places.cast("int"))
    text = F.when(exponent < 0, F.concat(whole, F.lit("."), part)).otherwise(F.concat(digits, F.repeat(F.lit("0"), F.greatest(exponent, F.lit(0)).cast("int"))))
    return F.concat(F.when(mantissa < 0, "-").otherwise(""), text)


def fixed8(mantissa: Column, exponent: Column) -> Column:
    """mantissa * 10**exponent in units of 10**-8, exact; null where it is no whole number of them."""
    shift = exponent + 8
    up = F.aggregate(F.sequence(F.lit(1), F.greatest(F.abs(shift), F.lit(1))), F.lit(1).cast("decimal(38,0)"), lambda a, _: (a * F.lit(10).cast("decimal(2,0)")).cast("decimal(38,0)"))
    factor = F.when(shift == 0, F.lit(1).cast("decimal(38,0)")).otherwise(up)
    m = mantissa.cast("decimal(20,0)")
    return F.when(shift >= 0, (m * factor).cast("decimal(38,0)")).when(m % factor == 0, F.call_function("div", m, factor).cast("decimal(38,0)"))


def fix_fields(raw: Column) -> Column:
    """Array of struct(tag, value) of a tag=value message; a field without a number and '=' has tag null."""
    parts = F.filter(F.split(raw, "\x01"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(F.when(x.rlike("^[0-9]+="), F.substring_index(x, "=", 1).try_cast("int")).alias("tag"), F.regexp_replace(x, "^[^=]*=", "").alias("value")))


def byte_sum(text: Column) -> Column:
    """Sum of the bytes of a text: of its characters if all are ASCII, else of its hexadecimal form two digits at a time."""
    plain = F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: s + F.ascii(c))
    wide = let(F.hex(F.encode(text, "UTF-8")), lambda h: F.aggregate(F.sequence(F.lit(1), F.length(h) - 1, F.lit(2)), F.lit(0), lambda s, i: s + F.conv(F.substring(h, i, F.lit(2)), 16, 10).cast("int")))
    return F.when(F.length(text) == F.octet_length(text), plain).otherwise(wide)


def fix_checksum(raw: Column) -> Column:
    """Sum of the bytes before the checksum field, modulo 256, as three digits."""
    body = F.regexp_extract(raw, "^(?s)(.*\x01)10=[0-9]{3}\x01$", 1)
    return F.when(F.length(body) > 0, F.lpad((byte_sum(body) % 256).cast("string"), 3, "0"))


def fix_body_length(raw: Column) -> Column:
    """Number of bytes between the body-length field and the checksum field."""
    return F.octet_length(F.regexp_extract(raw, "^(?s)8=[^\x01]*\x019=[^\x01]*\x01(.*)10=[0-9]{3}\x01$", 1))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fix_verdict(raw: Column, fields: Column) -> Column:
    def judged(p: Column) -> Column:
        value = lambda tag: F.element_at(F.filter(p["f"], lambda x: x["tag"] == tag), 1)["value"]
        return (
            F.when(~p["framed"] | F.exists(p["f"], lambda x: x["tag"].isNull()), "MalformedField").when(F.size(F.array_distinct(p["tags"])) != F.size(p["tags"]), "DuplicateTag")
            .when(value(9).try_cast("int") != fix_body_length(raw), "BadBodyLength").when(value(10) != fix_checksum(raw), "BadChecksum").otherwise("Ok")
        )

    framed = raw.rlike("^(?s)8=[^\x01]*\x019=[0-9]+\x01.*10=[0-9]{3}\x01$")
    return let(F.struct(fields.alias("f"), F.transform(fields, lambda x: x["tag"]).alias("tags"), framed.alias("framed")), judged)


def fix_status(raw: Column) -> Column:
    """Ok, or the first of MalformedField, DuplicateTag, BadBodyLength, BadChecksum that holds."""
    return let(fix_fields(raw), lambda fields: _fix_verdict(raw, fields))


def fix_message(raw: Column) -> Column:
    """struct(status, fields): the status, and tag to value (null unless it is Ok), from one pass over the fields."""
    parsed = let(fix_fields(raw), lambda fields: F.struct(_fix_verdict(raw, fields).alias("status"), fields.alias("fields")))
    return let(parsed, lambda p: F.struct(p["status"].alias("status"), F.when(p["status"] == "Ok", F.map_from_entries(p["fields"])).alias("fields")))


def fix_map(raw: Column) -> Column:
    """tag to value, null unless the message is Ok."""
    return fix_message(raw)["fields"]


def fix_build(pairs: Column) -> Column:
    """A message from array<struct<tag int, value string>> without tags 8, 9 and 10, as version 4.4."""
    body = F.concat(F.array_join(F.transform(pairs, lambda x: F.concat(x["tag"].cast("string"), F.lit("="), x["value"])), "\x01"), F.lit("\x01"))
    head = F.concat(F.lit("8=FIX.4.4\x019="), F.octet_length(body).cast("string"), F.lit("\x01"), body)
    return let(head, lambda h: F.concat(h, F.lit("10="), F.lpad((byte_sum(h) % 256).cast("string"), 3, "0"), F.lit("\x01")))


def reconnect_delay_ms(lane: Column, attempt: Column, failures: Column, token: Column, initial_ms: int, max_ms: int, jitter_ms: int) -> Column:
    """Exponential delay with a jitter taken from a SHA-256 over lane, attempt (8 bytes), failures (4 bytes; both little-endian) and token; never above max_ms."""
    turned = lambda text, n: F.concat(*(F.substring(text, 2 * (n - i) - 1, 2) for i in range(n)))
    le = lambda x, n: F.unhex(turned(F.lpad(F.hex(x.cast("bigint")), 2 * n, "0"), n))
    digest = F.sha2(F.concat(lane.cast("binary"), le(attempt, 8), le(failures, 4), token.cast("binary")), 256)
    jitter = F.conv(turned(F.substring(digest, 1, 16), 8), 16, 10).cast("decimal(20,0)") % F.lit(jitter_ms + 1).cast("decimal(20,0)")
    base = F.least(F.lit(float(initial_ms)) * F.pow(F.lit(2.0), F.least(F.greatest(failures - 1, F.lit(0)), F.lit(63))), F.lit(float(max_ms))).cast("bigint")
    return F.least(base + jitter.cast("bigint"), F.lit(max_ms).cast("bigint"))


def safe_path(path: Column) -> Column:
    """A relative path of plain parts: no empty, dot or dot-dot part, no drive, no backslash, no NUL, no blanks around it."""
    return F.coalesce(path.rlike(r"^(?U)(?!\s)(?!.*(?:^|/)[.]{1,2}(?:/|$))[^/\\:\x00]+(?:/[^/\\:\x00]+)*(?<!\s)$"), F.lit(False))


def utc_ns(text: Column) -> Column:
    """Nanoseconds since 1970 of an instant written with a zone (Z or an offset), to the microsecond; null for a text without one."""
    zoned = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, F.unix_micros(F.try_to_timestamp(text)) * 1_000)


def utc_text(ns: Column) -> Column:
    """The instant as text in UTC with microseconds."""
    return F.date_format(F.timestamp_micros(F.call_function("div", ns.cast("bigint"), F.lit(1_000).cast("bigint"))), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


#: What a recorder may ask for.
SCOPE_SYMBOLS, SCOPE_STREAMS, SCOPE_LIMITS = ("BTCUSDT", "ETHUSDT"), ("depth", "trade", "bookTicker"), (5, 10, 20, 50, 100, 500, 1000, 5000)


def scope_reject(symbol: Column, stream: Column, limit: Column | None = None) -> Column:
    """Why a request lies outside the scope: symbol (in any case), stream or snapshot limit; null inside."""
    out = F.when(~F.coalesce(F.upper(symbol).isin(*SCOPE_SYMBOLS), F.lit(False)), "symbol").when(~F.coalesce(stream.isin(*SCOPE_STREAMS), F.lit(False)), "stream")
    return out if limit is None else out.when(~F.coalesce(limit.isin(*SCOPE_LIMITS), F.lit(False)), "limit")
