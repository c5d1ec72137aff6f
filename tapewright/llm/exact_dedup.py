"""Exact deduplication as a stateful stream.

Digests flow through a streaming aggregation whose state lives in RocksDB on the executors' disks, is checkpointed to the shared
folder and never expires. Per digest it retains the stable identifier of the row to keep (the largest id), a content locator (number of that row in the
landed keys, and the file its text is in) and the group's size. Partial aggregation before the shuffle folds a hot group to one row a task. Where a digest
was hit more than once, the full bytes of its rows are fetched and compared; rows of one digest with different bytes (a
collision) are grouped by their bytes. Rows whose digest was met once are answered from the row itself; only digests with hits are joined back.

Defined cases. Null text: as empty text. Repeated rows: one output row each, and each counts; of several rows with the group's largest id the one
that the locator names is kept, and only that one. Null id: counts in its group; keep_id is null only if all ids of the group are. Texts of any length
are hashed and compared whole. Empty table: no rows. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, land, pick, scratch_path, spread_join

#: State on disk; files are not preallocated (some 4 MB for each partition otherwise).
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@dataclass(frozen=True)
class Params:
    files_per_batch: int = 1_000
    #: Up to so many digests with hits (some 100 bytes each) are broadcast to their rows; above, that join is a shuffle over copies of them.
    broadcast_digests: int = 100_000


@contextmanager
def rocksdb(spark: SparkSession):
    old = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_state(keys: DataFrame, p: Params = Params()) -> DataFrame:
    """Run landed keys (digest, id, row, file) through the stream: digest, keep (id, row, file), group_size as the state holds them at last."""
    spark = keys.sparkSession
    out = scratch_path(spark, "dedup-state")
    source = spark.readStream.schema(keys.schema).option("maxFilesPerTrigger", p.files_per_batch).parquet(keys._landed_at)
    state = source.groupBy("digest").agg(F.max(F.struct("id", "row", "file")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    with rocksdb(spark):
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "dedup-stream")).trigger(availableNow=True)
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")).start()
        )
        query.awaitTermination()
    if not query.lastProgress:
        return spark.createDataFrame([], state.schema)
    seen = spark.read.schema(state.schema).parquet(f"{out}/batch=*")
    # A digest is written once for each micro-batch that met it; both columns only ever grow.
    return seen.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, text_hash (xxhash64 of the text), keep_file."""
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = hashed.select("digest", "id", F.xxhash64("text").alias("text_hash"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"))
    keys = land(keys, "dedup-keys")
    if keys.isEmpty():
        state = keys.sparkSession.createDataFrame([], "digest binary, keep struct<id:long,row:long,file:string>, group_size long")
    else:
        state = stream_state(keys, p)
    hits = land(state.where("group_size > 1"), "dedup-groups")

    # Full bytes of hits: group them by digest and text; the hash table compares the texts byte by byte.
    digests = hits.select("digest")
    texts = hashed.join(F.broadcast(digests) if hits.count() <= p.broadcast_digests else digests, "digest", "left_semi")
    variants = texts.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    collided = land(variants.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "dedup-collisions")
    groups = spread_join(keys, hits, "digest", p.broadcast_digests, ["row"], "left")
    met_once = F.col("group_size").isNull()
    out = groups.select(
        "digest", "id", F.when(met_once, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (met_once | (F.col("row") == F.col("keep.row"))).alias("kept"), "text_hash", F.coalesce("keep.file", "file").alias("keep_file"),
    )
    if not collided.isEmpty():  # pragma: no cover - needs two texts of one SHA-256
        apart = hashed.join(collided, "digest", "left_semi").join(variants, ["digest", "text"])
        apart = apart.select("digest", "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.xxhash64("text").alias("text_hash"), F.lit(None).cast("string").alias("keep_file"))
        out = out.join(collided, "digest", "left_anti").unionByName(apart)
    else:
        discard(collided)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "text_hash", "keep_file")
