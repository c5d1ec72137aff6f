"""Deterministic market-data views over the plain tables, the same in Spark and in SQL.

`events` becomes a feed of 16 symbols with dense ids in each: symbol event_id % 16, id event_id div 16. Two redundant lanes each lose some
of its rows; a third stream is perturbed by delays and repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SYMBOLS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(
        F.col("event_id").alias("eid"), (F.col("event_id") % SYMBOLS).alias("sym"), F.expr(f"event_id div {SYMBOLS}").alias("id"),
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))").cast("bigint").alias("us"),
        F.col("value").cast("decimal(28,8)").alias("price"), (F.col("event_id") % 7).cast("decimal(28,8)").alias("qty"),
        F.when(F.col("event_type").isin("view", "click"), "bid").otherwise("ask").alias("side"), "event_type", "user_id", "props",
    )


FEED = f"""feed as (select event_id as eid, event_id % {SYMBOLS} as sym, event_id // {SYMBOLS} as id, epoch_us(ts) as us, CAST(value AS DECIMAL(28,8)) as price,
CAST(event_id % 7 AS DECIMAL(28,8)) as qty, case when event_type in ('view', 'click') then 'bid' else 'ask' end as side, event_type, user_id, props from events)"""


def digest() -> F.Column:
    return F.sha2(F.concat_ws("|", F.col("eid").cast("string"), F.col("price").cast("string")), 256)


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lanes with arrival order; lane S is late by 12 ids at every 97th event and has another price at every 101st."""
    f = feed(spark, sf_dir)
    a = f.where("eid % 11 <> 3").select("sym", "id", "eid", F.lit("P").alias("lane"), (F.col("id") * 2).alias("arrival"), digest().alias("digest"))
    changed = f.withColumn("price", F.when(F.col("eid") % 101 == 0, F.col("price") + F.lit(1).cast("decimal(28,8)")).otherwise(F.col("price")).cast("decimal(28,8)"))
    late = F.when(F.col("eid") % 97 == 0, 24).otherwise(0)
    b = changed.where("eid % 13 <> 5").select("sym", "id", "eid", F.lit("S").alias("lane"), (F.col("id") * 2 + 1 + late).alias("arrival"), digest().alias("digest"))
    return a.unionByName(b)


def row_order(df: DataFrame) -> DataFrame:
    """Arrival made unique: a late row arrives just after the row whose turn it takes."""
    return df.withColumn("arrival", F.col("arrival") * 4 + F.when((F.col("lane") == "S") & (F.col("eid") % 97 == 0), 1).otherwise(0))


LANES = """lane_rows as (
select sym, id, eid, 'P' as lane, id * 8 as arrival, sha256(eid::VARCHAR || '|' || price::VARCHAR) as digest from feed where eid % 11 <> 3
union all
select sym, id, eid, 'S', (id * 2 + 1 + case when eid % 97 = 0 then 24 else 0 end) * 4 + case when eid % 97 = 0 then 1 else 0 end,
       sha256(eid::VARCHAR || '|' || (case when eid % 101 = 0 then price + CAST(1 AS DECIMAL(28,8)) else price end)::DECIMAL(28,8)::VARCHAR) from feed where eid % 13 <> 5)"""


def perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane P with some rows delayed and some repeated: sym, id, arrival."""
    f = feed(spark, sf_dir).where("eid % 11 <> 3")
    rows = f.select("sym", "id", "us", (F.col("id") * 10 + F.when(F.col("eid") % 50 == 7, 35).otherwise(0)).alias("arrival"))
    return rows.unionByName(f.where("eid % 60 = 9").select("sym", "id", "us", (F.col("id") * 10 + 2).alias("arrival")))


PERTURBED = """perturbed as (select sym, id, us, id * 10 + case when eid % 50 = 7 then 35 else 0 end as arrival from feed where eid % 11 <> 3
union all select sym, id, us, id * 10 + 2 from feed where eid % 11 <> 3 and eid % 60 = 9)"""


def diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth ranges: id covers first_id .. final_id of its own range; some overlap or leave a hole."""
    f = feed(spark, sf_dir)
    base = F.col("id") * 3
    return f.select("sym", "id", (base - F.when(F.col("eid") % 19 == 4, 1).otherwise(0)).alias("first_id"), (base + 2 - F.when(F.col("eid") % 23 == 6, 1).otherwise(0)).alias("final_id"))


DIFFS = """diffs as (select sym, id, id * 3 - case when eid % 19 = 4 then 1 else 0 end as first_id, id * 3 + 2 - case when eid % 23 = 6 then 1 else 0 end as final_id from feed)"""


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-level depth changes: sym, frame, pos, side, price (whole units), qty; quantity 0 deletes."""
    f = feed(spark, sf_dir)
    whole = F.floor(F.abs(F.col("price"))).cast("bigint") % 40
    price = F.when(F.col("side") == "bid", whole + 1).otherwise(whole + 50)
    return f.select("sym", F.col("id").alias("frame"), F.lit(0).alias("pos"), "side", price.cast("decimal(28,8)").alias("price"), "qty")


LEVELS = """levels as (select sym, id as frame, 0 as pos, side, CAST(case when side = 'bid' then CAST(floor(abs(price)) AS BIGINT) % 40 + 1 else CAST(floor(abs(price)) AS BIGINT) % 40 + 50 end AS DECIMAL(28,8)) as price, qty from feed)"""
