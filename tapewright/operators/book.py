"""Level-2 book operators: payload decoding, final and as-of states without a fold, fingerprints, top levels, and a per-frame fold."""

from __future__ import annotations

import heapq
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decimals import DECIMAL, imbalance_ppm, parse_decimal, ratio_ppm
from ..functions.digests import FP_PARTS, book_digest, level_words
from .ordered import WIDTH, carried

DEPTH = "e string, E bigint, s string, U bigint, u bigint, b array<array<string>>, a array<array<string>>"
TRADE = "e string, E bigint, s string, t bigint, p string, q string, T bigint, m boolean, M boolean"
SNAPSHOT = "lastUpdateId bigint, bids array<array<string>>, asks array<array<string>>"


def _pairs_ok(levels: Column) -> Column:
    return levels.isNotNull() & F.forall(levels, lambda x: F.size(x) == 2)


def depth_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds first_id, final_id, bids, asks and reject (null, control, or the reason why a payload is no depth update)."""
    d = F.from_json(F.col(payload).cast("string"), _exact_case(DEPTH))
    out = df.withColumn("_d", d)
    ev, a, b = F.col("_d.e"), F.col("_d.U_first"), F.col("_d.u_final")
    reject = (
        F.when(ev == "serverShutdown", "control").when(ev.isNull() | (ev != "depthUpdate"), "unexpected event").when(a.isNull() | b.isNull(), "update ids")
        .when(a > b, "id range").when(~_pairs_ok(F.col("_d.b")) | ~_pairs_ok(F.col("_d.a")), "levels")
    )
    return out.select(*df.columns, a.alias("first_id"), b.alias("final_id"), F.col("_d.b").alias("bids"), F.col("_d.a").alias("asks"), reject.alias("reject"))


def _exact_case(schema: str) -> str:
    """Names that differ in case only are renamed; see _recased."""
    return schema.replace("U bigint, u bigint", "U_first bigint, u_final bigint").replace("E bigint", "E_time bigint").replace("T bigint", "T_time bigint").replace("m boolean, M boolean", "m_maker boolean, M_best boolean")


def recased(payload: Column) -> Column:
    """The payload's JSON text with names that differ in case only made distinct, as Spark compares names without case."""
    text = payload.cast("string")
    for old, new in (("E", "E_time"), ("U", "U_first"), ("u", "u_final"), ("T", "T_time"), ("m", "m_maker"), ("M", "M_best")):
        text = F.regexp_replace(text, rf'([{{,]\s*)"{old}"\s*:', f'$1"{new}":')
    return text


def trade_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds trade_id, dispatch_time, trade_time, price_text, qty_text, price, qty, buyer_is_maker, best_match and reject."""
    out = df.withColumn("_t", F.from_json(recased(F.col(payload)), _exact_case(TRADE)))
    t = lambda c: F.col(f"_t.{c}")
    price, qty = parse_decimal(t("p")), parse_decimal(t("q"))
    missing = t("t").isNull() | t("E_time").isNull() | t("T_time").isNull() | t("m_maker").isNull() | t("M_best").isNull()
    reject = (
        F.when(t("e") == "serverShutdown", "control").when(t("e").isNull() | (t("e") != "trade"), "unexpected event").when(missing, "field type")
        .when(price.isNull() | qty.isNull(), "decimal").when((price <= 0) | (qty <= 0), "not positive")
    )
    return out.select(
        *df.columns, t("s").alias("trade_symbol"), t("t").alias("trade_id"), t("E_time").alias("dispatch_time"), t("T_time").alias("trade_time"), t("p").alias("price_text"), t("q").alias("qty_text"),
        price.alias("price"), qty.alias("qty"), t("m_maker").alias("buyer_is_maker"), t("M_best").alias("best_match"), reject.alias("reject"),
    )


def depth_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """depth_fields over a payload whose names still differ in case only."""
    return depth_fields(df.withColumn("_recased", recased(F.col(payload))), "_recased").drop("_recased")


def snapshot_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds last_id, bids, asks and reject of a snapshot document (at most 16 MiB, arrays of two strings)."""
    out = df.withColumn("_s", F.from_json(F.col(payload).cast("string"), SNAPSHOT))
    size = F.octet_length(F.col(payload).cast("binary"))
    reject = F.when(size > 16 * 1024 * 1024, "size").when(F.col("_s.lastUpdateId").isNull(), "update id").when(~_pairs_ok(F.col("_s.bids")) | ~_pairs_ok(F.col("_s.asks")), "levels")
    return out.select(*df.columns, F.col("_s.lastUpdateId").alias("last_id"), F.col("_s.bids").alias("bids"), F.col("_s.asks").alias("asks"), reject.alias("reject"))


def explode_levels(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each level: kept columns, side, pos, price, qty, level_reject (price above 0, quantity not below)."""
    def side(name: str, column: str) -> Column:
        given = F.coalesce(F.col(column), F.array().cast("array<array<string>>"))
        return F.transform(given, lambda x, i: F.struct(F.lit(name).alias("side"), i.alias("pos"), x[0].alias("p"), x[1].alias("q")))

    sides = F.concat(side("bid", "bids"), side("ask", "asks"))
    rows = df.select(*keep, F.explode(sides).alias("l"))
    price, qty = parse_decimal(F.col("l.p")), parse_decimal(F.col("l.q"))
    reject = F.when(price.isNull() | qty.isNull(), "decimal").when(price <= 0, "price").when(qty < 0, "quantity")
    return rows.select(*keep, F.col("l.side").alias("side"), F.col("l.pos").alias("pos"), price.alias("price"), qty.alias("qty"), reject.alias("level_reject"))


def final_levels(levels: DataFrame, keys: list[str], frame: str = "frame", pos: str = "pos", upto: Column | None = None) -> DataFrame:
    """Levels that stand after all frames (or those up to a bound): the last quantity set for each side and price, if above 0.

    Snapshot levels come in as frame -1. One partial aggregation, no ordering of frames.
    """
    rows = levels if upto is None else levels.where(F.col(frame) <= upto)
    last = rows.groupBy(*keys, "side", "price").agg(F.max_by("qty", F.struct(frame, pos)).alias("qty"))
    return last.where("qty > 0")


def top_levels(book: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The best n levels of each side with their rank; bids from the highest, asks from the lowest price."""
    better = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*keys, "side").orderBy(better)
    return book.withColumn("level", F.row_number().over(w)).where(F.col("level") <= n)


def book_arrays(book: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bids and asks as ordered arrays of struct(price, qty)."""
    level = F.struct("price", "qty")
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, level)))
    rows = book.groupBy(*keys).agg(F.reverse(side("bid")).alias("bids"), side("ask").alias("asks"))
    return rows


def digests(book: DataFrame, keys: list[str], symbol: Column, last_update_id: Column) -> DataFrame:
    return book_arrays(book, keys).withColumn("book_sha256", book_digest(symbol, last_update_id, F.col("bids"), F.col("asks")))


def summary(book: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Level counts, best prices and quantities, spread, and features of the top, in parts per million."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    rows = book.groupBy(*keys).agg(
        F.count_if(bid).alias("bid_levels"), F.count_if(ask).alias("ask_levels"), F.max(F.when(bid, F.col("price"))).alias("best_bid"), F.min(F.when(ask, F.col("price"))).alias("best_ask"),
        F.max_by("qty", F.when(bid, F.col("price"))).alias("bid_qty"), F.min_by("qty", F.when(ask, F.col("price"))).alias("ask_qty"),
    )
    b, a = F.col("bid_qty"), F.col("ask_qty")
    rows = rows.withColumn("spread", (F.col("best_ask") - F.col("best_bid")).cast("decimal(38,8)"))
    state = F.when((F.col("bid_levels") == 0) | (F.col("ask_levels") == 0), "INVALID").when(F.col("best_bid") >= F.col("best_ask"), "INVALID").otherwise("LIVE")
    return rows.withColumn("state", state).withColumn("top_imbalance_ppm", imbalance_ppm(b, a, strict)).withColumn("microprice_position_ppm", ratio_ppm(b, a + b, strict))


def depth_imbalance(book: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys, bid_depth, ask_depth, depth_imbalance_ppm over the best n levels; enough says whether both sides have n."""
    best = top_levels(book, keys, n)
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    sums = best.groupBy(*keys).agg(F.sum(F.when(bid, F.col("qty")).otherwise(0)).cast(DECIMAL).alias("bid_depth"), F.sum(F.when(ask, F.col("qty")).otherwise(0)).cast(DECIMAL).alias("ask_depth"), F.count_if(bid).alias("nb"), F.count_if(ask).alias("na"))
    return sums.select(*keys, "bid_depth", "ask_depth", imbalance_ppm(F.col("bid_depth"), F.col("ask_depth")).alias("depth_imbalance_ppm"), ((F.col("nb") >= n) & (F.col("na") >= n)).alias("enough"))


def fingerprint_steps(levels: DataFrame, keys: list[str], frame: str = "frame", pos: str = "pos", width: int | None = WIDTH) -> DataFrame:
    """keys, frame, fp0..fp3 and level counts after each frame, by running XOR over changes of single levels.

    The first window is partitioned by side and price and spreads a hot symbol; changes fold to one row a frame before the running one, which is split by blocks of frames.
    """
    own = Window.partitionBy(*keys, "side", "price").orderBy(frame, pos)
    old = F.coalesce(F.lag("qty").over(own), F.lit(0).cast(DECIMAL))
    rows = levels.withColumn("old", old)
    rows = rows.withColumn("_new", level_words(F.col("side"), F.col("price"), F.col("qty"))).withColumn("_old", level_words(F.col("side"), F.col("price"), F.col("old")))
    step = F.when(F.col("qty") > 0, 1).otherwise(0) - F.when(F.col("old") > 0, 1).otherwise(0)
    changes = rows.select(*keys, frame, step.alias("step"), *(F.col("_new")[i].bitwiseXOR(F.col("_old")[i]).alias(f"fp{i}") for i in range(FP_PARTS)))
    frames = changes.groupBy(*keys, frame).agg(F.sum("step").alias("step"), *(F.bit_xor(f"fp{i}").alias(f"fp{i}") for i in range(FP_PARTS)))
    names = {f"fp{i}": ("xor", F.col(f"fp{i}")) for i in range(FP_PARTS)}
    return carried(frames, keys, frame, width, upto={"n_levels": ("sum", F.col("step")), **names}).drop("step")


def final_fingerprint(book: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fp0..fp3 of a set of levels, in any order."""
    rows = book.withColumn("_words", level_words(F.col("side"), F.col("price"), F.col("qty")))
    return rows.groupBy(*keys).agg(*(F.bit_xor(F.col("_words")[i]).alias(f"fp{i}") for i in range(FP_PARTS)), F.count(F.lit(1)).alias("n_levels"))


# --- per-frame fold -----------------------------------------------------------------------------------------------------

FOLD = "frame bigint, disposition string, state string, last_update_id bigint, bid_levels bigint, ask_levels bigint, best_bid decimal(28,8), best_ask decimal(28,8)"


class Side:
    """One side of a book: quantities by price, and a heap of prices from which those that are gone are dropped only when they come up."""

    def __init__(self, highest_first: bool) -> None:
        self.sign = -1 if highest_first else 1
        self.clear()

    def clear(self) -> None:
        self.levels: dict[Decimal, Decimal] = {}
        self.heap: list[Decimal] = []

    def set(self, price: Decimal, qty: Decimal) -> None:
        if qty == 0:
            self.levels.pop(price, None)
            return
        if price not in self.levels:
            heapq.heappush(self.heap, self.sign * price)
        self.levels[price] = qty

    def best(self) -> Decimal | None:
        while self.heap and self.sign * self.heap[0] not in self.levels:
            heapq.heappop(self.heap)
        return self.sign * self.heap[0] if self.heap else None

    def __len__(self) -> int:
        return len(self.levels)


class Book:
    """One book in memory, with the state machine of a session that starts from a snapshot."""

    def __init__(self, strict_next: bool = False) -> None:
        self.sides = {"bid": Side(True), "ask": Side(False)}
        self.state, self.last, self.strict_next = "EMPTY", None, strict_next

    def load(self, last_id: int, levels: list[tuple[str, Decimal, Decimal]]) -> str:
        seen = set()
        for s in self.sides.values():
            s.clear()
        for side, price, qty in levels:
            if (side, price) in seen:
                self.state = "INVALID"
                return "DUPLICATE_PRICE"
            seen.add((side, price))
            self.sides[side].set(price, qty)
        self.last = last_id
        bid, ask = self.best("bid"), self.best("ask")
        self.state = "SYNCING" if bid is not None and ask is not None and bid < ask else "INVALID"
        return "SNAPSHOT"

    def best(self, side: str) -> Decimal | None:
        return self.sides[side].best()

    def apply(self, first: int, final: int, levels: list[tuple[str, Decimal, Decimal]]) -> str:
        if self.state in ("EMPTY", "INVALID", "STOPPED", "GAP"):
            return "REJECTED"
        if final <= self.last:
            return "OLD"
        fits = first == self.last + 1 if self.strict_next else first <= self.last + 1 <= final
        if not fits:
            self.state = "GAP"
            return "GAP"
        for side, price, qty in levels:
            self.sides[side].set(price, qty)
        self.last = final
        bid, ask = self.best("bid"), self.best("ask")
        self.state = "LIVE" if bid is not None and ask is not None and bid < ask else "INVALID"
        return "APPLIED"


def fold(updates: DataFrame, keys: list[str]) -> DataFrame:
    """State after every frame: keys and FOLD columns.

    updates: keys, frame, kind ('snapshot' or 'diff'), first_id, final_id, levels (array of struct(side, pos, price, qty)). One group is one
    generation of one symbol; rows of a group are streamed in order by frame through the fold.
    """
    kinds = {f.name: f.dataType.simpleString() for f in updates.schema if f.name in keys}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        book, out = Book(), []
        for r in pdf.sort_values("frame").itertuples(index=False):
            levels = [(x["side"], x["price"], x["qty"]) for x in sorted(r.levels, key=lambda x: (x["side"], x["pos"]))]
            what = book.load(int(r.final_id), levels) if r.kind == "snapshot" else book.apply(int(r.first_id), int(r.final_id), levels)
            out.append((*(getattr(r, k) for k in keys), r.frame, what, book.state, book.last, len(book.sides["bid"]), len(book.sides["ask"]), book.best("bid"), book.best("ask")))
        return pd.DataFrame(out, columns=[*keys, *(c.split()[0] for c in FOLD.split(", "))])

    return updates.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {t}" for k, t in kinds.items()), FOLD]))


def derived_fold(updates: DataFrame, keys: list[str]) -> DataFrame:
    """A book without snapshots: a diff must start at the last id + 1; after a gap the book clears and the next diff is taken."""
    kinds = {f.name: f.dataType.simpleString() for f in updates.schema if f.name in keys}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = {"bid": Side(True), "ask": Side(False)}
        last, out = None, []
        for r in pdf.sort_values("frame").itertuples(index=False):
            if last is not None and r.first_id != last + 1:
                for side in sides.values():
                    side.clear()
                last, what, state = None, "GAP", "GAP"
            else:
                for x in sorted(r.levels, key=lambda x: (x["side"], x["pos"])):
                    sides[x["side"]].set(x["price"], x["qty"])
                last, what, state = int(r.final_id), "APPLIED", "LIVE"
            out.append((*(getattr(r, k) for k in keys), r.frame, what, state, last, len(sides["bid"]), len(sides["ask"]), sides["bid"].best(), sides["ask"].best()))
        return pd.DataFrame(out, columns=[*keys, *(c.split()[0] for c in FOLD.split(", "))]).astype({"last_update_id": "Int64"})

    return updates.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {t}" for k, t in kinds.items()), FOLD]))


def aggressor_summary(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and quantities by aggressor (buyer_is_maker: the seller attacked), and their imbalance in parts per million."""
    sell = F.col("buyer_is_maker")
    q = F.col("qty").cast(DECIMAL)
    sums = trades.groupBy(*keys).agg(
        F.count_if(~sell).alias("buy_trades"), F.count_if(sell).alias("sell_trades"),
        F.sum(F.when(~sell, q).otherwise(0)).cast(DECIMAL).alias("buy_qty"), F.sum(F.when(sell, q).otherwise(0)).cast(DECIMAL).alias("sell_qty"),
    )
    return sums.withColumn("imbalance_ppm", imbalance_ppm(F.col("buy_qty"), F.col("sell_qty")))


def latest_checkpoint_replay(checkpoints: DataFrame, levels: DataFrame, keys: list[str], upto: int | DataFrame, frame: str = "frame") -> DataFrame:
    """Final levels at frame upto, from the newest checkpoint (keys, frame, side, price, qty) not after it and the diffs since.

    upto: one frame for all keys, or a relation (keys, upto).
    """
    bounds = upto if isinstance(upto, DataFrame) else levels.select(*keys).unionByName(checkpoints.select(*keys)).distinct().withColumn("upto", F.lit(upto))
    newest = checkpoints.join(bounds, keys).where(F.col(frame) <= F.col("upto")).groupBy(*keys).agg(F.max(frame).alias("_at"))
    # One row a key: the bound travels with every row instead of through the driver.
    marks = bounds.join(newest, keys, "left")
    base = checkpoints.join(marks, keys).where(F.col(frame) == F.col("_at")).select(*keys, F.lit(-1).cast("bigint").alias(frame), F.lit(0).alias("pos"), "side", "price", "qty")
    since = levels.join(marks, keys).where((F.col(frame) <= F.col("upto")) & (F.col(frame) > F.coalesce("_at", F.lit(-1)))).select(*keys, frame, "pos", "side", "price", "qty")
    return final_levels(base.unionByName(since), keys, frame)
