"""Overlap splicing: where two epochs agree, which rows of each to take, and proofs over common ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import WIDTH, carried


def convergence(predecessor: DataFrame, successor: DataFrame, keys: list[str], seq: str = "final_sequence", digest: str = "observation_sha256", first: str = "first_sequence", order: str = "frame_index", width: int | None = WIDTH) -> DataFrame:
    """keys, boundary, pred_frame, succ_frame, next_first, next_final: the largest sequence on which both sides hold equal digests and after which
    the successor goes on without a break. An equi-join on sequence and digest; no side is assumed small."""
    ahead = carried(successor, keys, order, width, nxt={"next_first": F.col(first), "next_final": F.col(seq)})
    left = predecessor.select(*keys, F.col(seq).alias("boundary"), F.col(digest).alias("_d"), F.col(order).alias("pred_frame"))
    right = ahead.select(*keys, F.col(seq).alias("boundary"), F.col(digest).alias("_d"), F.col(order).alias("succ_frame"), "next_first", "next_final")
    both = left.join(right, [*keys, "boundary", "_d"])
    going_on = both.where((F.col("next_first") <= F.col("boundary") + 1) & (F.col("boundary") + 1 <= F.col("next_final")))
    pick = F.max_by(F.struct("pred_frame", "succ_frame", "next_first", "next_final"), "boundary").alias("s")
    return going_on.groupBy(*keys).agg(F.max("boundary").alias("boundary"), pick).select(*keys, "boundary", "s.*")


def selection(predecessor: DataFrame, successor: DataFrame, boundaries: DataFrame, keys: list[str], order: str = "frame_index") -> DataFrame:
    """Predecessor rows up to its boundary frame, then successor rows after its own; side tells them apart. One boundary a key."""
    b = boundaries.select(*keys, "pred_frame", "succ_frame")
    left = predecessor.join(b, keys).where(F.col(order) <= F.col("pred_frame")).drop("pred_frame", "succ_frame").withColumn("side", F.lit(0))
    right = successor.join(b, keys).where(F.col(order) > F.col("succ_frame")).drop("pred_frame", "succ_frame").withColumn("side", F.lit(1))
    return left.unionByName(right)


def exclusion_counts(predecessor: DataFrame, successor: DataFrame, boundaries: DataFrame, keys: list[str], order: str = "frame_index") -> DataFrame:
    """keys, selected_predecessor, excluded_predecessor, selected_successor, excluded_successor."""
    b = boundaries.select(*keys, "pred_frame", "succ_frame")
    left = predecessor.join(b, keys).groupBy(*keys).agg(F.count_if(F.col(order) <= F.col("pred_frame")).alias("selected_predecessor"), F.count_if(F.col(order) > F.col("pred_frame")).alias("excluded_predecessor"))
    right = successor.join(b, keys).groupBy(*keys).agg(F.count_if(F.col(order) > F.col("succ_frame")).alias("selected_successor"), F.count_if(F.col(order) <= F.col("succ_frame")).alias("excluded_successor"))
    return left.join(right, keys)


def positions(rows: DataFrame, claims: DataFrame, keys: list[str], frame: str = "frame_index") -> DataFrame:
    """Claims (keys, frame, connection_epoch, stream, record_sha256) with found and matches against the rows at that frame."""
    have = rows.select(*keys, frame, *(F.col(c).alias(f"_{c}") for c in ("connection_epoch", "stream", "record_sha256")), F.lit(True).alias("_found"))
    out = claims.join(have, [*keys, frame], "left")
    same = F.lit(True)
    for c in ("connection_epoch", "stream", "record_sha256"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out.select(*claims.columns, F.coalesce("_found", F.lit(False)).alias("found"), (F.coalesce("_found", F.lit(False)) & same).alias("matches"))


def book_convergence(left: DataFrame, right: DataFrame, keys: list[str], seq: str = "final_sequence", fingerprint: list[str] = ("fp0", "fp1", "fp2", "fp3")) -> DataFrame:  # type: ignore[assignment]
    """Sequences at which both sides' book fingerprints agree; candidates for an exact digest."""
    on = [*keys, seq, *fingerprint]
    return left.select(*on).join(right.select(*on), on).select(*keys, seq).distinct()


def common_range_equality(a: DataFrame, b: DataFrame, keys: list[str], id_col: str, digest: str) -> DataFrame:
    """keys, low, high, common, mismatches, proven: equal (id, digest) lists over [larger first, smaller last], two common ids at least."""
    ends = lambda df, t: df.groupBy(*keys).agg(F.min(id_col).alias(f"lo{t}"), F.max(id_col).alias(f"hi{t}"))
    bounds = ends(a, "a").join(ends(b, "b"), keys).select(*keys, F.greatest("loa", "lob").alias("low"), F.least("hia", "hib").alias("high"), "hia", "hib")
    rows = a.select(*keys, id_col, F.col(digest).alias("_da")).join(b.select(*keys, id_col, F.col(digest).alias("_db")), [*keys, id_col], "full_outer")
    inside = rows.join(bounds, keys).where(F.col(id_col).between(F.col("low"), F.col("high")))
    out = inside.groupBy(*keys).agg(
        F.first("low").alias("low"), F.first("high").alias("high"), F.count_if(F.col("_da").eqNullSafe(F.col("_db"))).alias("common"),
        F.count_if(~F.col("_da").eqNullSafe(F.col("_db"))).alias("mismatches"), F.first("hia").alias("_ha"), F.first("hib").alias("_hb"),
    )
    proven = (F.col("mismatches") == 0) & (F.col("common") >= 2) & (F.col("_hb") >= F.col("_ha"))
    return out.withColumn("proven", proven).drop("_ha", "_hb")


def record_match(a: DataFrame, b: DataFrame, on: list[str], compared: list[str]) -> DataFrame:
    """Rows of a with the names of the compared columns in which b's row of the same keys differs; missing where b has none."""
    right = b.select(*on, *(F.col(c).alias(f"_{c}") for c in compared), F.lit(True).alias("_found"))
    wrong = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in compared)))
    out = a.join(right, on, "left")
    return out.select(*a.columns, F.when(F.col("_found").isNull(), F.array(F.lit("missing"))).otherwise(wrong).alias("differs"))
