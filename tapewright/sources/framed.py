"""Framed logs as a Spark data source: `magic, then (u32 length, body, 32-byte digest)*`, one partition for each file.

Each record becomes a row with its offsets, digest and state; the row at which a file breaks carries the reason, so that the valid prefix of a
file is `status = 'ok'`. Files are read through Spark's binary file reader, so any store that Spark reads will do.
"""

from __future__ import annotations

import hashlib
import json
import struct
from base64 import b64encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators.ordered import carried
from .files import listed, put, put_files, store

ZERO_DIGEST = "0" * 64

#: Magic and longest body of each kind of log.
FORMATS = {
    "raw": (b"BNRAW\x00\x01\n", 4 * 1024 * 1024),
    "segments": (b"BNSEG\x00\x01\n", 256 * 1024),
    "boundary": (b"BNHND\x00\x01\n", 256 * 1024),
    "ownership": (b"BNOWN\x00\x01\n", 256 * 1024),
    "output": (b"BNPUB\x00\x01\n", 256 * 1024),
}

RECORD_SCHEMA = "path string, record_index bigint, start_offset bigint, end_offset bigint, record_sha256 string, previous_record_sha256 string, body string, status string"


def _chained(body: bytes, previous: str, frames: dict[tuple, int] | None, first_frame: int) -> str | None:
    """Why a record does not continue its log, or None."""
    try:
        record = json.loads(body)
    except (ValueError, UnicodeDecodeError):
        return "body is not JSON"
    if not isinstance(record, dict):
        return "record is not an object"
    if record.get("previous_record_sha256") != previous:
        return "record chain mismatch"
    if frames is not None:
        key = (record.get("connection_epoch"), record.get("stream"))
        want = frames.get(key, first_frame)
        if record.get("frame_index") != want:
            return f"non-contiguous frame index: expected {want}, got {record.get('frame_index')}"
        frames[key] = want + 1
    return None


def scan(data: bytes, kind: str = "raw", genesis: str = ZERO_DIGEST, first_frame: int = 0, check_chain: bool = True) -> Iterator[tuple]:
    """(record_index, start, end, digest, previous, body, status) of each record; a last row with a reason where the log breaks."""
    magic, most = FORMATS[kind]
    if data[: len(magic)] != magic:
        yield (0, 0, 0, None, None, None, "bad magic")
        return
    at, index, previous = len(magic), 0, genesis
    frames: dict[tuple, int] | None = {} if kind == "raw" else None
    while at < len(data):
        reason, body, digest = None, b"", b""
        if at + 4 > len(data):
            reason = "partial length prefix"
        else:
            (size,) = struct.unpack_from(">I", data, at)
            body, digest = data[at + 4 : at + 4 + size], data[at + 4 + size : at + 36 + size]
            if size > most:
                reason = "record length exceeds limit"
            elif len(body) < size:
                reason = "partial record body"
            elif len(digest) < 32:
                reason = "partial record digest"
            elif hashlib.sha256(body).digest() != digest:
                reason = "record digest mismatch"
            elif check_chain:
                reason = _chained(body, previous, frames, first_frame)
        if reason:
            yield (index, at, at, None, previous, None, reason)
            return
        end = at + 36 + len(body)
        yield (index, at, end, digest.hex(), previous, body.decode("utf-8"), "ok")
        at, index, previous = end, index + 1, digest.hex()


def read_framed(spark: SparkSession, path: str, kind: str = "raw", genesis: str = ZERO_DIGEST, first_frame: int = 0, check_chain: bool = True) -> DataFrame:
    """Records of all files under path, with RECORD_SCHEMA. A file is one task's work and must fit in it (segments are bounded by design)."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                for r in scan(data, kind, genesis, first_frame, check_chain):
                    rows.append((name, *r))
                    if len(rows) == 4_096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def file_status(records: DataFrame) -> DataFrame:
    """path, records, last_good_offset, clean, reason, last_record_sha256 of each file."""
    ok = F.col("status") == "ok"
    return records.groupBy("path").agg(
        F.count_if(ok).alias("records"), F.coalesce(F.max(F.when(ok, F.col("end_offset"))), F.lit(0)).alias("last_good_offset"), F.bool_and(ok).alias("clean"),
        F.max(F.when(~ok, F.col("status"))).alias("reason"), F.max_by("record_sha256", F.when(ok, F.col("record_index"))).alias("last_record_sha256"),
    )


def strict(records: DataFrame) -> DataFrame:
    """The records; the query fails on the first row that is not good."""
    checked = F.when(F.col("status") == "ok", F.col("status")).otherwise(F.raise_error(F.concat(F.col("path"), F.lit(": "), F.col("status"))))
    return records.withColumn("status", checked)


def durable_prefix(records: DataFrame, ack_offset: int | DataFrame) -> DataFrame:
    """Good records up to an acknowledged offset (one for all files, or a relation path, ack_offset), which must be a record's end in each file (else the query fails)."""
    acks = ack_offset if isinstance(ack_offset, DataFrame) else records.select("path").distinct().withColumn("ack_offset", F.lit(ack_offset))
    inside = records.join(acks, "path").where((F.col("status") == "ok") & (F.col("end_offset") <= F.col("ack_offset")))
    reached = inside.groupBy("path").agg(F.max("end_offset").alias("_reached"))
    on_edge = F.when(F.col("_reached") == F.col("ack_offset"), F.col("status")).otherwise(F.raise_error(F.lit("acknowledged offset is not on a record boundary")))
    return inside.join(reached, "path").withColumn("status", on_edge).select(*records.columns)


def durable_delta(records: DataFrame, previous_offset: int | DataFrame, next_offset: int | None = None) -> DataFrame:
    """Good records between two acknowledgements, given as two offsets or as a relation (path, previous_offset, next_offset)."""
    if isinstance(previous_offset, DataFrame):
        rows = records.join(previous_offset, "path")
    else:
        rows = records.withColumn("previous_offset", F.lit(previous_offset)).withColumn("next_offset", F.lit(next_offset))
    inside = (F.col("status") == "ok") & (F.col("start_offset") >= F.col("previous_offset")) & (F.col("end_offset") <= F.col("next_offset"))
    return rows.where(inside).select(*records.columns)


FRAME = (
    "schema string, venue string, environment string, endpoint string, stream string, symbol string, connection_epoch string, frame_index bigint, receive_wall_ns bigint, receive_mono_ns bigint, clock_quality string, "
    "clock_source string, clock_offset_ns bigint, clock_uncertainty_ns bigint, payload_length int, payload_sha256 string, payload_base64 string, recorder_state string, spec_revision string, previous_record_sha256 string"
)


def frames(records: DataFrame) -> DataFrame:
    """Frame columns of good records, with the payload's bytes and frame_reject (schema, payload length or payload digest)."""
    f = F.from_json("body", FRAME)
    rows = records.where("status = 'ok'").select("path", "record_index", "start_offset", "end_offset", "record_sha256", f.alias("f"))
    payload = F.unbase64("f.payload_base64")
    reject = (
        F.when(~F.col("f.schema").eqNullSafe(F.lit("RawFrameV1")), "schema").when(F.octet_length(payload) != F.col("f.payload_length"), "payload length")
        .when(F.sha2(payload, 256) != F.col("f.payload_sha256"), "payload digest")
    )
    keep = [c.split()[0] for c in FRAME.split(", ") if not c.startswith("payload_base64")]
    return rows.select("path", "record_index", "start_offset", "end_offset", "record_sha256", *(F.col(f"f.{c}") for c in keep), payload.alias("payload"), reject.alias("frame_reject"))


#: Fields of the bodies of the other journals.
BODIES = {
    "segments": "segment_index bigint, raw_file string, first_frame bigint, last_frame bigint, records bigint, start_digest string, terminal_digest string, connection_epoch string, stream string",
    "boundary": "schema string, record_index bigint, previous_record_sha256 string, action string, boundary_id string, boundary struct<symbol:string,stream_kind:string,boundary_sequence:bigint>, proposal_record_sha256 string",
    "ownership": "schema string, record_index bigint, previous_record_sha256 string, action string, initial_owner struct<generation_id:string,fencing_token:bigint>, activation struct<generation_id:string,fencing_token:bigint>, prepared_record_sha256 string",
    "output": "schema string, record_index bigint, previous_record_sha256 string, action string, symbol string, stream_kind string, owner struct<generation_id:string,connection_epoch:string,fencing_token:bigint,last_sequence:bigint>, "
              "observation struct<first_sequence:bigint,final_sequence:bigint,observation_sha256:string>, ownership_activation_record_sha256 string",
}


def typed(records: DataFrame, kind: str) -> DataFrame:
    """Good records with the fields of their kind's body."""
    fields = F.from_json("body", BODIES[kind]).alias("r")
    own = [c for c in ("record_index", "previous_record_sha256") if c in BODIES[kind]]
    rows = records.where("status = 'ok'").select("path", "record_index", "record_sha256", fields)
    names = [f.name for f in rows.schema["r"].dataType.fields]
    return rows.select("path", "record_index", "record_sha256", *(F.col(f"r.{n}").alias(f"stored_{n}" if n in own else n) for n in names))


def boundary_violations(boundaries: DataFrame) -> DataFrame:
    """path, record_index, rule of boundary journals: one PROPOSED first, then at most one COMMITTED that names its digest; indices and chain run on."""
    rows = carried(boundaries, ["path"], "record_index", prev={"_digest": F.col("record_sha256"), "_action": F.col("action")})
    rule = (
        F.when(F.col("stored_record_index") != F.col("record_index"), "index").when(F.col("stored_previous_record_sha256") != F.coalesce("_digest", F.lit(ZERO_DIGEST)), "chain")
        .when((F.col("action") == "PROPOSED") & F.col("_action").isNotNull(), "proposed twice").when((F.col("action") == "COMMITTED") & ~F.col("_action").eqNullSafe(F.lit("PROPOSED")), "commit without proposal")
        .when((F.col("action") == "COMMITTED") & ~F.col("proposal_record_sha256").eqNullSafe(F.col("_digest")), "other proposal").when(~F.col("action").isin("PROPOSED", "COMMITTED"), "unknown action")
    )
    return rows.withColumn("rule", rule).where("rule is not null").select("path", "record_index", "rule")


def ownership_rows(ledger: DataFrame) -> DataFrame:
    """Ownership ledgers as rows of sessions.ownership_recovery: path, record_index, event, fencing_token."""
    token = F.coalesce("activation.fencing_token", "initial_owner.fencing_token")
    return ledger.select("path", "record_index", F.col("action").alias("event"), token.alias("fencing_token"))


def output_violations(output: DataFrame) -> DataFrame:
    """path, record_index, rule of canonical outputs: INITIALIZED first; an owner change names its activation, raises the fencing token by one, changes generation and
    connection and keeps the last sequence; observations run on."""
    was = {"_owner": F.col("owner"), "_action": F.col("action"), "_digest": F.col("record_sha256"), "_final": F.col("observation.final_sequence")}
    rows = carried(output, ["path"], "record_index", prev=was)
    o, p = F.col("owner"), F.col("_owner")
    change = (
        (o["generation_id"] == p["generation_id"]) | (o["connection_epoch"] == p["connection_epoch"]) | (o["fencing_token"] != p["fencing_token"] + 1)
        | (o["last_sequence"] != p["last_sequence"]) | F.col("ownership_activation_record_sha256").isNull()
    )
    rule = (
        F.when(F.col("stored_previous_record_sha256") != F.coalesce("_digest", F.lit(ZERO_DIGEST)), "chain").when(F.col("_action").isNull() & (F.col("action") != "INITIALIZED"), "observation before initialization")
        .when((F.col("action") == "OWNERSHIP_CHANGED") & change, "ownership change").when((F.col("action") == "OBSERVATION") & (o["last_sequence"] <= p["last_sequence"]), "sequence")
        .when(~F.col("action").isin("INITIALIZED", "OBSERVATION", "OWNERSHIP_CHANGED"), "unknown action")
    )
    return rows.withColumn("rule", rule).where("rule is not null").select("path", "record_index", "rule")


def segment_manifest(records: DataFrame) -> DataFrame:
    """Segment seals of a manifest log."""
    return typed(records, "segments")


# --- writing ------------------------------------------------------------------------------------------------------------


def raw_body(frame: dict, previous: str) -> bytes:
    """Canonical body of a raw record; frame has the frame columns and payload bytes."""
    payload = bytes(frame["payload"])
    # Keys and their order.
    record = {
        "schema": "RawFrameV1", "venue": frame["venue"], "environment": frame["environment"], "endpoint": frame["endpoint"], "stream": frame["stream"], "symbol": frame["symbol"],
        "connection_epoch": frame["connection_epoch"], "frame_index": frame["frame_index"], "receive_wall_ns": frame["receive_wall_ns"], "receive_mono_ns": frame["receive_mono_ns"],
        "clock_quality": frame["clock_quality"], "clock_source": frame["clock_source"], "clock_offset_ns": frame["clock_offset_ns"], "clock_uncertainty_ns": frame["clock_uncertainty_ns"],
        "payload_length": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "payload_base64": b64encode(payload).decode(), "recorder_state": "PENDING",
        "spec_revision": frame["spec_revision"], "previous_record_sha256": previous,
    }
    return json.dumps(record, ensure_ascii=False, separators=(",", ":"), allow_nan=False).encode()


def encode_log(bodies: Iterator[bytes], kind: str = "raw") -> bytes:
    out = [FORMATS[kind][0]]
    for body in bodies:
        out += [struct.pack(">I", len(body)), body, hashlib.sha256(body).digest()]
    return b"".join(out)


def append_frames(rows: list[dict], previous: str = ZERO_DIGEST) -> Iterator[bytes]:
    """Bodies of frames in order, chained; frame indices must run on within (epoch, stream)."""
    seen: dict[tuple, int] = {}
    for row in rows:
        key = (row["connection_epoch"], row["stream"])
        if key in seen and row["frame_index"] != seen[key] + 1:
            raise ValueError("frame index does not continue")
        seen[key] = row["frame_index"]
        body = raw_body(row, previous)
        previous = hashlib.sha256(body).hexdigest()
        yield body


class FramedSource(DataSource):
    """format("framed"): options path, kind, genesis_digest, first_frame. Reads and writes file, hdfs and object store paths that pyarrow knows; read_framed takes any other."""

    @classmethod
    def name(cls) -> str:
        return "framed"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FramedReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FramedWriter(dict(self.options))


class FilePartition(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class FramedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[FilePartition]:
        fs, root = store(self.options["path"])
        return [FilePartition(p) for p in listed(fs, root)]

    def read(self, partition: FilePartition):
        fs, _ = store(self.options["path"])
        with fs.open_input_stream(partition.path) as f:
            data = f.read()
        for r in scan(data, self.options.get("kind", "raw"), self.options.get("genesis_digest", ZERO_DIGEST), int(self.options.get("first_frame", 0))):
            yield (partition.path, *r)


class FramedWriter(DataSourceWriter):
    """Writes frame rows (columns of the frame and payload) as one raw log a task; the caller orders and partitions them by stream."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def write(self, rows) -> WriterCommitMessage:
        import uuid

        frames_ = [r.asDict() for r in rows]
        if frames_:
            put(self.options["path"], f"{uuid.uuid4().hex}.bnraw", encode_log(append_frames(frames_)))
        return WriterCommitMessage()


def recover_prefix(data: bytes, kind: str = "raw") -> bytes:
    """The log cut after its last good record, checked again."""
    end = max((r[2] for r in scan(data, kind) if r[6] == "ok"), default=len(FORMATS[kind][0]))
    out = data[:end]
    assert all(r[6] == "ok" for r in scan(out, kind))
    return out


def recovered(spark: SparkSession, path: str, target: str, kind: str = "raw") -> DataFrame:
    """Copy every log under path, cut after its last good record, to the same place under target; name and bytes of each. A log without its magic is not copied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if data.startswith(FORMATS[kind][0]):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([recover_prefix(data, kind)], pa.binary())], names=["name", "content"])

    root = path.split("://")[-1].rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    place = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    names = files.select(F.substring(place, F.lit(len(root) + 2), F.length(place)).alias("name"), "content")
    return put_files(names.mapInArrow(run, "name string, content binary"), target)


def frozen(spark: SparkSession, path: str, target: str, acks: DataFrame, kind: str = "raw") -> DataFrame:
    """Copy the prefix up to the acknowledged offset of each log (path, ack_offset; at a record's end) to the same leaf under target."""
    durable_prefix(read_framed(spark, path, kind), acks).agg(F.count(F.lit(1))).collect()  # fails off a boundary
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).join(acks, "path")
    return put_files(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.substring("content", F.lit(1), F.col("ack_offset").cast("int")).alias("content")), target)
