"""Streaming sinks: hash-chained journals, one per key, continued batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digests import ZERO_DIGEST
from ..sources.journals import append_journal


class JournalSink:
    """For foreachBatch: appends rows (keys, order, schema, wall_ns, mono_ns, channel, payload) to journals under path.

    Each batch is one folder, written again as a whole if the batch is repeated. A batch's chain starts from the last line of each key before it, which a small table of
    heads holds: one folder a batch too, made from the batch's own lines and the heads before it, so no batch reads the lines of earlier ones.
    """

    def __init__(self, path: str, keys: list[str], order: str) -> None:
        self.path, self.keys, self.order = path, keys, order

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        w = Window.partitionBy(*self.keys).orderBy(self.order)
        rows = batch.withColumn("record_index", (F.row_number().over(w) - 1).cast("bigint"))
        heads = self.heads(spark, batch, number - 1) if number else None
        if heads is not None:
            rows = rows.join(heads.withColumnsRenamed({"record_index": "_last", "record_sha256": "_previous"}), self.keys, "left")
        else:
            rows = rows.withColumn("_last", F.lit(None).cast("bigint")).withColumn("_previous", F.lit(None).cast("string"))
        rows = rows.withColumn("record_index", F.col("record_index") + F.coalesce("_last", F.lit(-1)) + 1).withColumn("previous", F.coalesce("_previous", F.lit(ZERO_DIGEST)))
        lines = append_journal(rows.drop("_last", "_previous"), self.keys)
        digest = F.regexp_extract("line", '"record_sha256":"([0-9a-f]{64})"}$', 1)
        lines.withColumn("record_sha256", digest).write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        own = spark.read.schema(self.schema(batch)).parquet(f"{self.path}/batch={number}").select(*self.keys, "record_index", "record_sha256")
        both = own if heads is None else own.unionByName(heads)
        last = both.groupBy(*self.keys).agg(F.max("record_index").alias("record_index"), F.max_by("record_sha256", "record_index").alias("record_sha256"))
        last.write.mode("overwrite").parquet(f"{self.path}/heads-{number}")

    def heads(self, spark, batch: DataFrame, number: int) -> DataFrame:
        """The last line of each key after a batch: keys, record_index, record_sha256."""
        kinds = {f.name: f.dataType.simpleString() for f in batch.schema}
        return spark.read.schema(", ".join([*(f"{k} {kinds[k]}" for k in self.keys), "record_index bigint, record_sha256 string"])).parquet(f"{self.path}/heads-{number}")

    def schema(self, batch: DataFrame) -> str:
        kinds = {f.name: f.dataType.simpleString() for f in batch.schema}
        return ", ".join([*(f"{k} {kinds[k]}" for k in self.keys), "record_index bigint, line string, record_sha256 string"])


def lines(spark, path: str) -> DataFrame:
    """All lines of a sink's journals."""
    return spark.read.parquet(f"{path}/batch=*")
