"""Digests: trade identity, book levels, whole books and self-digested reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decimals import canonical_text, decimal_text

ZERO_DIGEST = "0" * 64


def well_formed(digest: Column) -> Column:
    return F.coalesce(digest.rlike("^[0-9a-f]{64}$"), F.lit(False))


def trade_digest(symbol: Column, trade_id: Column, price: Column, quantity: Column, trade_time: Column, buyer_is_maker: Column, best_match: Column) -> Column:
    """Identity of a trade; the dispatch time is no part of it. Price and quantity are texts."""
    # Schema name and key order of the digested document.
    doc = F.struct(
        best_match.alias("best_match"), buyer_is_maker.alias("buyer_is_maker"), canonical_text(price).alias("price"), canonical_text(quantity).alias("quantity"),
        F.lit("CanonicalTradeEventV1").alias("schema"), symbol.alias("symbol"), trade_id.alias("trade_id"), trade_time.alias("trade_time"),
    )
    return F.sha2(F.to_json(doc), 256)


FP_PARTS = 4


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _turned(text: Column, size: int, start: int = 0) -> Column:
    """size bytes of a hexadecimal text from byte start, in the opposite order."""
    return F.concat(*(F.substring(text, 2 * (start + size - i) - 1, 2) for i in range(size)))


def _decimal_bytes(value: Column) -> Column:
    """Hexadecimal: the digits of a non-negative decimal in its shortest form as a 16-byte little-endian number, then one byte with the number of decimal places."""
    word = F.lit(4_294_967_296).cast("decimal(20,0)")

    def split(text: Column) -> Column:
        dot, digits = F.instr(text, "."), F.replace(text, F.lit("."), F.lit("")).cast("decimal(28,0)")
        scale = F.when(dot > 0, F.length(text) - dot).otherwise(0)
        parts = F.struct((digits % word).cast("bigint").alias("low"), F.call_function("div", digits, word).alias("high"), scale.cast("bigint").alias("scale"))
        return _let(parts, join)

    def join(x: Column) -> Column:
        # 28 digits take 94 bits: three words of 32 bits.
        words = F.concat(F.lpad(F.hex(x["high"]), 16, "0"), F.lpad(F.hex(x["low"]), 8, "0"))
        return F.concat(_let(words, lambda w: _turned(w, 12)), F.lit("00000000"), F.lpad(F.hex(x["scale"]), 2, "0"))

    return _let(decimal_text(value), split)


def level_words(side: Column, price: Column, quantity: Column) -> Column:
    """The four little-endian 64-bit words (signed) of the SHA-256 of a level, as an array; all zero for quantity 0, so that a deleted level leaves no trace in an XOR."""
    # Fixed values: 'b' or 'a', then price and quantity as coefficient (16 bytes) and scale (1 byte) each.
    tag = F.when(side == "bid", "62").otherwise("61")
    digest = F.sha2(F.unhex(F.concat(tag, _decimal_bytes(price), _decimal_bytes(quantity))), 256)
    words = _let(digest, lambda h: F.array(*(F.conv(_turned(h, 8, 8 * i), 16, -10).cast("bigint") for i in range(FP_PARTS))))
    return F.when(quantity > 0, words).otherwise(F.array(*(F.lit(0).cast("bigint") for _ in range(FP_PARTS))))


def _levels(levels: Column) -> Column:
    return F.array_join(F.transform(levels, lambda x: F.concat(F.lit('["'), decimal_text(x["price"]), F.lit('","'), decimal_text(x["qty"]), F.lit('"]'))), ",")


def book_digest(symbol: Column, last_update_id: Column, bids: Column, asks: Column) -> Column:
    """SHA-256 of a book; bids from the highest, asks from the lowest price, as arrays of struct(price, qty)."""
    text = F.concat(F.lit('{"asks":['), _levels(asks), F.lit('],"bids":['), _levels(bids), F.lit('],"last_update_id":'), last_update_id.cast("string"), F.lit(',"symbol":"'), symbol, F.lit('"}'))
    return F.sha2(text, 256)


def with_report_digest(report: DataFrame, column: str = "report_sha256") -> DataFrame:
    """Adds the digest of each row's JSON (its columns in order, without the digest itself)."""
    columns = [c for c in report.columns if c != column]
    return report.select(*columns, F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias(column))
