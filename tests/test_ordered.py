"""Block-split windows against plain ones, whatever the width, with null keys, null orders, holes and negative orders."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapewright.operators import coverage, latency, seq, union
from tapewright.operators.ordered import carried, haloed, positions, row_halo


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out, at = [], -40
    for i in range(400):
        at += rng.choice([1, 1, 2, 9, 60])
        out.append((rng.choice(["hot"] * 9 + ["b", None]), at, rng.choice([None, *range(20)]), rng.choice("xy")))
    return spark.createDataFrame(out, "k string, at long, v long, c string").repartition(3).cache()


@pytest.mark.parametrize("width", [1, 7, 100, 10_000, None])
def test_carried_equals_windows(rows, width):
    w = Window.partitionBy("k").orderBy("at")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select(
        "*", F.lag("v").over(w).alias("p"), F.lead("c").over(w).alias("n"), F.max("v").over(before).alias("m"), F.sum("v").over(upto).alias("s"),
        F.bit_xor("v").over(upto).alias("x"), F.last("v", ignorenulls=True).over(upto).alias("l"), F.min("v").over(upto).alias("lo"), (F.row_number().over(w) - 1).cast("bigint").alias("position"),
    )
    v = F.col("v")
    got = carried(rows, ["k"], "at", width, prev={"p": v}, nxt={"n": F.col("c")}, before={"m": ("max", v)}, upto={"s": ("sum", v), "x": ("xor", v), "l": ("last", v), "lo": ("min", v)})
    got = positions(got, ["k"], "at", width).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("width", [5, 64, None])
def test_halos_equal_windows(rows, width):
    w = Window.partitionBy("k").orderBy("at")
    want = rows.select("*", F.count(F.lit(1)).over(w.rangeBetween(-30, 0)).alias("n"), F.sum("v").over(w.rowsBetween(-4, 0)).alias("s"))
    ranged, by = haloed(rows, ["k"], "at", 30, width)
    n = ranged.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*by).orderBy("at").rangeBetween(-30, 0))).where("not _halo").select(*rows.columns, "n")
    counted, by = row_halo(n, ["k"], "at", 4, width, block_rows=9)
    got = counted.withColumn("s", F.sum("v").over(Window.partitionBy(*by).orderBy("at").rowsBetween(-4, 0))).where("not _halo").select(want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_key_is_split(rows):
    """No block of the hot key holds more than its width."""
    from tapewright.operators.ordered import block_of

    sizes = rows.where("k = 'hot'").groupBy(block_of("at", 64)).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) <= 64


def test_operators_do_not_depend_on_width(rows):
    same = lambda f: [sorted(map(tuple, f(w).collect()), key=str) for w in (3, 50, None)]
    cases = [
        lambda w: seq.runs(rows, ["k"], "at", "c", "v", width=w), lambda w: seq.gap_islands(rows, ["k"], "at", -60, F.lit(9_999), width=w),
        lambda w: seq.valid_prefix(rows, ["k"], "at", F.col("v") != 7, width=w), lambda w: seq.published_duplicates(rows, ["k"], "v", "c", "at", width=w),
        lambda w: coverage.gap_pairs(coverage.lane_coverage(rows.withColumn("r", F.col("v") > 6), ["k"], "c", "r", "at", width=w), ["k"], "at", width=w),
        lambda w: coverage.coverage_chain(rows.select("k", "at", (F.col("at") + F.coalesce("v", F.lit(0))).alias("stop")), ["k"], "at", "stop", width=w),
        lambda w: coverage.progress_stalls(rows.where("v is not null"), ["k"], "at", "v", 30, width=w), lambda w: latency.sample_slope(rows.where("v is not null"), ["k"], "at", "v", 5, width=w),
        lambda w: coverage.silence_sessions(rows, ["k"], "at", 9, width=w), lambda w: latency.sliding_rate(rows, ["k"], "at", 40, width=w),
        lambda w: seq.frame_contiguity(rows, ["k"], "v", "at", width=w), lambda w: coverage.freshness(rows.withColumns({"a": F.lit(-100), "b": F.lit(9_000)}), ["k"], "at", "a", "b", 5, 20, 30, width=w),
    ]
    for f in cases:
        a, b, c = same(f)
        assert a == b == c and a


def test_common_ranges_of_any_length(spark):
    a = spark.createDataFrame([("k", 0, 10**12), ("k", 2 * 10**12, 2 * 10**12 + 5), ("j", 5, 9)], "k string, first_missing long, last_missing long")
    b = spark.createDataFrame([("k", -5, -1), ("k", 7, 7), ("k", 100, 3 * 10**12), ("j", 10, 12)], "k string, first_missing long, last_missing long")
    got = sorted(tuple(r) for r in seq.intersect_ranges(a, b, ["k"]).collect())
    assert got == [("k", 7, 7, 1), ("k", 100, 10**12, 10**12 - 99), ("k", 2 * 10**12, 2 * 10**12 + 5, 6)]


def test_overlapping_intervals_fail(spark):
    points = spark.createDataFrame([("k", 50)], "k string, t long")
    apart = spark.createDataFrame([("k", 0, 40, 1), ("k", 60, 70, 2)], "k string, a long, b long, seq long")
    assert coverage.nearest_interval(points, apart, ["k"], "t", "a", "b", "seq", 5).first()["nearest_seq"] == 1
    with pytest.raises(Exception, match="intervals overlap"):
        coverage.nearest_interval(points, spark.createDataFrame([("k", 0, 100, 1), ("k", 10, 12, 2)], apart.schema), ["k"], "t", "a", "b", "seq", 5).collect()


def test_level_fingerprint_by_plain_digests(spark):
    """Words of the digest over tag, coefficient, scale, coefficient, scale against plain Python."""
    import hashlib
    from decimal import Decimal

    from tapewright.functions.digests import level_words

    rows = [("bid", Decimal("27000.10"), Decimal("0.5")), ("ask", Decimal("12345678901234567890.12345678"), Decimal("3")), ("ask", Decimal("100"), Decimal("0.00000001")), ("bid", Decimal("1"), Decimal("0"))]
    got = spark.createDataFrame(rows, "side string, price decimal(28,8), qty decimal(28,8)").select(level_words(F.col("side"), F.col("price"), F.col("qty")).alias("w")).collect()
    for (side, price, qty), words in zip(rows, got, strict=True):
        body = side[0].encode()
        for x in (price, qty):
            x = x.normalize()
            scale = max(-x.as_tuple().exponent, 0)
            body += int(x.scaleb(scale)).to_bytes(16, "little") + bytes([scale])
        digest = hashlib.sha256(body).digest()
        assert list(words["w"]) == ([int.from_bytes(digest[8 * i : 8 * i + 8], "little", signed=True) for i in range(4)] if qty else [0] * 4)
