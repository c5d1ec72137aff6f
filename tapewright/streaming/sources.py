"""Streaming sources and sinks: landed files with admission control, sequenced feeds, silence timers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.sessions import TRACKED
from ..sources.framed import read_framed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store for streams that are started inside; the session's settings come back after."""
    old = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def use_rocksdb(spark: SparkSession) -> None:
    """The same for the rest of the session."""
    for k, v in STATE.items():
        spark.conf.set(k, v)


def follow(spark: SparkSession, path: str, schema, files_per_batch: int = 8) -> DataFrame:
    """Landed Parquet files as a stream, a bounded number of files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class DurableFollower:
    """Follows framed logs by their acknowledged offsets; a log that contradicts what was followed before is poisoned and never goes on.

    The state (path, ack_offset, last digest, reason) is a folder for every step in the shared place `state`, so a follower that starts anew goes on where the last
    finished step ended, and a step that was cut short is done again.
    """

    STATE = "path string, ack_offset bigint, last_sha256 string, poisoned string"

    def __init__(self, spark: SparkSession, path: str, state: str, kind: str = "raw") -> None:
        self.spark, self.path, self.state, self.kind = spark, path, state.rstrip("/"), kind

    def followed(self, step: int) -> DataFrame:
        """The state after a step; empty before the first."""
        if step < 0:
            return self.spark.createDataFrame([], self.STATE)
        return self.spark.read.schema(self.STATE).parquet(f"{self.state}/step-{step}")

    def advance(self, step: int, acks: DataFrame) -> DataFrame:
        """Do a step: acks (path, ack_offset) are new acknowledgements. Returns the records that became durable, in logs that are not poisoned.

        Reasons: acknowledgement went back; a bad record lies before it; it is off a record's boundary; the prefix that was followed has changed.
        """
        old = self.followed(step - 1).select("path", F.col("ack_offset").alias("_from"), F.col("last_sha256").alias("_last"), F.col("poisoned").alias("_was"))
        marks = acks.select("path", "ack_offset").join(old, "path", "full_outer").withColumn("_from", F.coalesce("_from", F.lit(0))).withColumn("_to", F.coalesce("ack_offset", "_from")).drop("ack_offset")
        records = read_framed(self.spark, self.path, self.kind).join(marks, "path")
        new = (F.col("start_offset") >= F.col("_from")) & (F.col("end_offset") <= F.col("_to"))
        delta = records.where("status = 'ok'").where(new)
        seen = delta.groupBy("path").agg(F.max("end_offset").alias("_reached"), F.min_by("previous_record_sha256", "record_index").alias("_before"), F.max_by("record_sha256", "record_index").alias("_digest"))
        bad = records.where("status <> 'ok' and start_offset < _to").groupBy("path").agg(F.min("status").alias("_bad"))
        rows = marks.join(seen, "path", "left").join(bad, "path", "left")
        moved = F.col("_to") > F.col("_from")
        reason = (
            F.when(F.col("_was").isNotNull(), F.col("_was")).when(F.col("_to") < F.col("_from"), "acknowledgement went back").when(F.col("_bad").isNotNull(), F.concat(F.lit("bad record: "), "_bad"))
            .when(moved & ~F.col("_reached").eqNullSafe(F.col("_to")), "acknowledgement is off a record boundary").when(moved & F.col("_last").isNotNull() & (F.col("_before") != F.col("_last")), "followed prefix changed")
        )
        rows = rows.withColumn("poisoned", reason)
        good = F.col("poisoned").isNull()
        after = rows.select("path", F.when(good, F.col("_to")).otherwise(F.col("_from")).alias("ack_offset"), F.when(good, F.coalesce("_digest", "_last")).otherwise(F.col("_last")).alias("last_sha256"), "poisoned")
        after.write.mode("overwrite").parquet(f"{self.state}/step-{step}")
        return delta.join(self.followed(step).where("poisoned is null").select("path"), "path", "left_semi").drop("_from", "_last", "_was", "_to")


class FeedProcessor(StatefulProcessor):
    """Sequenced feed: NEXT, GAP (with its range), RECOVERED or DUPLICATE; numbers missing are kept until they come.

    A row with next_sequence set (its own sequence is then not read) is a snapshot: SEED. It sets the cursor and forgets what was missing.
    """

    def __init__(self, tracked: int = TRACKED) -> None:
        self.tracked = tracked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", "next bigint")
        self.missing = handle.getMapState("missing", "seq bigint", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        expected = self.cursor.get()[0] if self.cursor.exists() else None
        out = []
        batch = pd.concat(list(rows), ignore_index=True)  # one session's rows of one batch, bounded by the source's admission
        if len(batch):
            for r in batch.sort_values("arrival").itertuples(index=False):
                first, last = None, None
                seed = getattr(r, "next_sequence", None)
                if seed is not None and seed == seed:
                    self.missing.clear()
                    expected = int(seed)
                    out.append((key[0], expected, "SEED", None, None))
                    continue
                s = int(r.sequence)
                if expected is None:
                    what, expected = "FIRST", s + 1
                elif s == expected:
                    what, expected = "NEXT", s + 1
                elif s > expected:
                    what, first, last = "GAP", expected, s - 1
                    if s - expected <= self.tracked:
                        for i in range(expected, s):
                            self.missing.updateValue((i,), (False,))
                    expected = s + 1
                elif self.missing.containsKey((s,)):
                    self.missing.removeKey((s,))
                    what = "RECOVERED"
                else:
                    what = "DUPLICATE"
                out.append((key[0], s, what, first, last))
        if expected is not None:
            self.cursor.update((expected,))
        yield pd.DataFrame(out, columns=["session", "sequence", "disposition", "gap_first", "gap_last"]).astype({"gap_first": "Int64", "gap_last": "Int64"})

    def close(self) -> None:
        pass


def stream_feed(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """rows: a stream of (session, sequence, arrival), and next_sequence where snapshots come along."""
    return rows.groupBy("session").transformWithStateInPandas(FeedProcessor(tracked), "session bigint, sequence bigint, disposition string, gap_first bigint, gap_last bigint", "Append", "None")


class SilenceProcessor(StatefulProcessor):
    """One row whenever a key stays silent for the deadline, by processing-time timer; sticky until the next row."""

    def __init__(self, deadline_ms: int) -> None:
        self.deadline_ms = deadline_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        now = timerValues.getCurrentProcessingTimeInMs()
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(now + self.deadline_ms)
        self.latest.update((now,))
        yield pd.DataFrame({"key": [], "silent_since_ms": []}).astype({"key": "int64", "silent_since_ms": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"key": [key[0]], "silent_since_ms": [self.latest.get()[0]]})

    def close(self) -> None:
        pass


def stream_silence(rows: DataFrame, key: str, deadline_ms: int) -> DataFrame:
    return rows.groupBy(key).transformWithStateInPandas(SilenceProcessor(deadline_ms), "key bigint, silent_since_ms bigint", "Append", "ProcessingTime")
