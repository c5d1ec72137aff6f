"""Queries that run a stateful stream to its end over landed rows and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import shared
from ..streaming.sources import follow, rocksdb, stream_feed
from ..streaming.union import stream_union
from .feed import FEED, feed, lanes, row_order
from .queries import WATERMARK, query

def run(spark: SparkSession, rows: DataFrame, transform, files_per_batch: int = 64) -> DataFrame:
    """Land rows as they are partitioned, stream them through transform, return its output."""
    source, out, state = (shared(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    rows.write.parquet(source)
    with rocksdb(spark):
        result = transform(follow(spark, source, rows.schema, files_per_batch))
        result.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


@query(f"{WATERMARK} select sym, id, lane from disp where disposition = 'BUFFERED' and ea is not null")
def union_stream(spark, d):
    """What the streaming union releases before the end; equal to the batch form."""
    rows = row_order(lanes(spark, d)).select("sym", "id", "lane", "digest", "arrival")
    return run(spark, rows, stream_union).where("event = 'PUBLISHED'").select("sym", "id", "lane")


@query(f"""with {FEED}, fr as (select sym, id - case when eid % 17 = 3 then 6 else 0 end + case when eid % 29 = 4 then 3 else 0 end as sequence, id as arrival from feed),
l as (select *, max(sequence) over (partition by sym order by arrival rows between unbounded preceding and 1 preceding) + 1 as expected from fr) select sym as session, count(*) as gaps from l where sequence > expected group by all""")
def sequenced_feed_stream(spark, d):
    """Gaps that the streaming feed opens."""
    s = F.col("id") - F.when(F.col("eid") % 17 == 3, 6).otherwise(0) + F.when(F.col("eid") % 29 == 4, 3).otherwise(0)
    rows = feed(spark, d).select(F.col("sym").alias("session"), s.alias("sequence"), F.col("id").alias("arrival"))
    return run(spark, rows, stream_feed).where("disposition = 'GAP'").groupBy("session").agg(F.count(F.lit(1)).alias("gaps"))
