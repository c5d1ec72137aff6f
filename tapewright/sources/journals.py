"""JSONL journals with hash chains, torn tails, strict JSON, XML event exports, length-prefixed frames, folders and event stores."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.digests import ZERO_DIGEST
from ..operators.oracle import PAYLOAD
from ..operators.ordered import carried

BODY = "schema string, record_index bigint, wall_ns bigint, mono_ns bigint, channel string, previous_record_sha256 string"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSONL files parsed by a typed schema: path, line, and its columns. A line that does not parse has them all null."""
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return lines.select("path", "line", F.from_json("line", schema).alias("r")).select("path", "line", "r.*")


def read_arbitration(spark: SparkSession, path: str) -> DataFrame:
    """Arbitration journals: path, record_index, chain columns, payload columns, and body_ok (the stored digest is that of the body's text).

    Order comes from record_index, never from the lines' positions in a task.
    """
    rows = read_jsonl(spark, path, f"body struct<{BODY.replace(' ', ':').replace(',:', ',')},payload:struct<{PAYLOAD.replace(', ', ',').replace(' ', ':')}>>, record_sha256 string")
    # The payload names the digest of its raw evidence like the chain's own.
    payload = [F.col(f"body.payload.{c}").alias("evidence_sha256" if c == "record_sha256" else c) for c in (x.split()[0] for x in PAYLOAD.split(", "))]
    text = F.regexp_extract("line", r'^\{"body":(.*),"record_sha256":"[0-9a-f]{64}"\}$', 1)
    return rows.select("path", "body.record_index", "body.wall_ns", "body.mono_ns", "body.channel", "body.schema", "body.previous_record_sha256", "record_sha256", (F.sha2(text, 256) == F.col("record_sha256")).alias("body_ok"), *payload)


#: What the bodies of the other chained journals hold besides the chain's own columns.
BODIES = {
    "durability": "ack struct<durable_record_count:bigint,durable_through_offset:bigint,terminal_record_sha256:string>",
    "campaign": "event string, payload struct<lane:string,generation:bigint,status:string>",
    "supervisor": "event string, payload struct<lane:string,run_token:string,launch_attempt:bigint,reason:string>",
    "transport": "event string, payload struct<status:string,error:string,received:bigint,sample:struct<state_name:string>>",
    "witness": "sample struct<sample_index:bigint,classification:string>",
}


def read_chained(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Chained JSONL journals of a kind: path, record_index, schema, wall_ns, mono_ns, chain columns, body_ok, and the columns of its body."""
    columns = [c.split()[0] for c in BODY.split(", ") if not c.startswith("channel")]
    own = BODIES[kind]
    rows = read_jsonl(spark, path, f"body struct<{BODY.replace(' ', ':').replace(',:', ',')},{own.replace(', ', ',').replace(' ', ':')}>, record_sha256 string")
    text = F.regexp_extract("line", r'^\{"body":(.*),"record_sha256":"[0-9a-f]{64}"\}$', 1)
    names = [f.name for f in rows.schema["body"].dataType.fields if f.name not in [*columns, "channel"]]
    return rows.select("path", *(F.col(f"body.{c}").alias(c) for c in columns), "record_sha256", (F.sha2(text, 256) == F.col("record_sha256")).alias("body_ok"), *(F.col(f"body.{n}").alias(n) for n in names))


def durability_violations(progress: DataFrame) -> DataFrame:
    """path, record_index, rule of durability journals: body digest, index, chain, and acknowledgements that rise in records and offset."""
    rows = carried(progress, ["path"], "record_index", prev={"_digest": F.col("record_sha256"), "_ack": F.col("ack")}, before={"_n": ("sum", F.lit(1).cast("bigint"))})
    a, b = F.col("ack"), F.col("_ack")
    rule = (
        F.when(~F.col("body_ok"), "body digest").when(F.col("record_index") != F.coalesce("_n", F.lit(0)), "index").when(F.col("previous_record_sha256") != F.coalesce("_digest", F.lit(ZERO_DIGEST)), "chain")
        .when((a["durable_record_count"] <= b["durable_record_count"]) | (a["durable_through_offset"] <= b["durable_through_offset"]), "acknowledgement did not rise")
    )
    return rows.withColumn("rule", rule).where("rule is not null").select("path", "record_index", "rule")


def journal_line(body: dict) -> tuple[str, str]:
    """A journal's line and its digest."""
    text = json.dumps(body, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return f'{{"body":{text},"record_sha256":"{digest}"}}', digest


def append_journal(events: DataFrame, keys: list[str], order: str = "record_index") -> DataFrame:
    """Lines of journals, one journal a key: keys, record_index, line. The chain makes a journal's lines one group's work.

    A column `previous`, if there is one, holds the digest that a key's first line continues; indices then start at its record_index.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema if f.name in keys}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, out = pdf.sort_values(order).to_dict("records"), []
        previous = rows[0].get("previous", ZERO_DIGEST)
        start = rows[0][order] if "previous" in rows[0] else 0
        for i, r in enumerate(rows, start=start):
            payload = json.loads(r["payload"])
            line, previous = journal_line({"schema": r["schema"], "record_index": i, "wall_ns": int(r["wall_ns"]), "mono_ns": int(r["mono_ns"]), "channel": r["channel"], "payload": payload, "previous_record_sha256": previous})
            out.append((*(r[k] for k in keys), i, line))
        return pd.DataFrame(out, columns=[*keys, "record_index", "line"])

    return events.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {t}" for k, t in kinds.items()), "record_index bigint, line string"]))


def torn_tails(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, tail_bytes: what stands after the last line feed of each file."""
    files = spark.read.format("binaryFile").load(path)
    text = F.decode("content", "ISO-8859-1")
    # One byte is one character in that encoding.
    tail = F.length(F.substring_index(text, "\n", -1))
    return files.select("path", F.col("length").alias("bytes"), tail.cast("bigint").alias("tail_bytes"))


def _json_reject(text: str | None) -> str | None:
    if text is None:
        return "missing"

    def pairs(items: list) -> dict:
        if len({k for k, _ in items}) != len(items):
            raise ValueError("duplicate key")
        return dict(items)

    def constant(name: str) -> None:
        raise ValueError(f"constant {name}")

    try:
        json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    except (ValueError, RecursionError) as e:
        return str(e) if str(e).startswith(("duplicate", "constant")) else "syntax"
    return None


@F.pandas_udf(StringType())
def strict_json_reject(texts: pd.Series) -> pd.Series:
    """Why a text is not strict JSON: repeated keys or NaN and infinities, which Spark's parser accepts; null if it is. Batches come by Arrow."""
    return pd.Series([_json_reject(t) for t in texts], dtype=object)


def read_sbe_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames of `u32 little-endian length, payload` files: path, index, payload, status (ok, truncated or trailing bytes)."""
    names, kinds = ["path", "index", "payload", "status"], [pa.string(), pa.int64(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, at, i = [], 0, 0
                while at < len(data):
                    if at + 4 > len(data):
                        rows.append((name, i, None, "trailing bytes"))
                        break
                    (size,) = struct.unpack_from("<I", data, at)
                    if at + 4 + size > len(data):
                        rows.append((name, i, None, "truncated"))
                        break
                    rows.append((name, i, data[at + 4 : at + 4 + size], "ok"))
                    at, i = at + 4 + size, i + 1
                    if len(rows) == 4_096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, index bigint, payload binary, status string")


def read_event_xml(spark: SparkSession, path: str, provider: str, fields: dict[int, list[str]]) -> DataFrame:
    """Events of XML exports by one provider: event_id, system_time, data (map), reject (event id or fields outside the allow-list)."""
    schema = "System struct<Provider:struct<_Name:string>,EventID:bigint,TimeCreated:struct<_SystemTime:string>>, EventData struct<Data:array<struct<_Name:string,_VALUE:string>>>"
    rows = spark.read.format("xml").option("rowTag", "Event").schema(schema).load(path).where(F.col("System.Provider._Name") == provider)
    data = F.map_from_entries(F.transform("EventData.Data", lambda d: F.struct(d["_Name"], d["_VALUE"])))
    have = F.sort_array(F.transform("EventData.Data", lambda d: d["_Name"]))
    reject = F.when(~F.col("System.EventID").isin(*fields), "event id")
    for number, names in fields.items():
        reject = reject.when((F.col("System.EventID") == number) & ~have.eqNullSafe(F.array(*(F.lit(n) for n in sorted(names)))), "fields")
    return rows.select(F.col("System.EventID").alias("event_id"), F.col("System.TimeCreated._SystemTime").alias("system_time"), data.alias("data"), reject.alias("reject"))


def discover(spark: SparkSession, path: str) -> DataFrame:
    """Files below a root with the parts of their place: artifact, lane, campaign, generation, leaf, length; in order of path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    part = lambda i: F.nullif(F.regexp_extract("path", r"/([^/]+)/([^/]+)/([^/]+)/([^/]+)/([^/]+)$", i), F.lit(""))
    return files.select("path", "length", part(1).alias("artifact"), part(2).alias("lane"), part(3).alias("campaign"), part(4).alias("generation"), F.element_at(F.split("path", "/"), -1).alias("leaf")).orderBy("path")


def inventory_difference(found: DataFrame, expected: DataFrame, column: str = "leaf") -> DataFrame:
    """Names on one side only, with side 'unexpected' or 'missing'."""
    extra = found.select(column).exceptAll(expected.select(column)).withColumn("side", F.lit("unexpected"))
    return extra.union(expected.select(column).exceptAll(found.select(column)).withColumn("side", F.lit("missing")))


def tree_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row: files, bytes and a SHA-256 over the tree.

    A file's line is its place below path, its length and its digest. Lines are dealt to 256 groups by the first two digits of the place's digest; a group's digest is
    that of its lines in order of place, the tree's that of the groups'. A group holds a 256th of the lines, never all.
    """
    root = path.split("://")[-1].rstrip("/")
    place = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = files.select(F.substring(place, F.lit(len(root) + 2), F.length(place)).alias("name"), "length", F.sha2("content", 256).alias("h"))
    lines = rows.withColumn("g", F.substring(F.sha2("name", 256), 1, 2)).withColumn("line", F.concat_ws("\t", "name", F.col("length").cast("string"), "h"))
    joined = lambda key, text: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, text))), lambda x: x[text]), "\n"), 256)
    groups = lines.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), joined("name", "line").alias("h"))
    groups = groups.withColumn("line", F.concat_ws("\t", "g", "h"))
    return groups.agg(F.sum("n").alias("files"), F.sum("b").alias("bytes"), joined("g", "line").alias("tree_sha256"))


def write_event_store(events: DataFrame, path: str, by: list[str], order: str) -> None:
    """Events as Parquet folders by symbol and stream, sorted within files, so that row-group statistics stand in for an index."""
    events.repartitionByRange(*by, order).sortWithinPartitions(*by, order).write.partitionBy(*by).parquet(path)


def read_window(spark: SparkSession, path: str, order: str, low: int, high: int) -> DataFrame:
    """Events with low <= order <= high; the range reaches the scan."""
    return spark.read.parquet(path).where(F.col(order).between(low, high))
