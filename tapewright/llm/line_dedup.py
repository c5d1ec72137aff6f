"""Line deduplication by winnowing over line hashes.

Lines with a word are hashed without their outer spaces (128 bits). Of every window of `window` such lines the one with the smallest hash (the
right one of equal ones) is selected as a fingerprint; of windows that select the same line there is one row. Two equal windows select their
fingerprint at the same place, so every run of `window` lines or more that occurs again shares a fingerprint: this is what winnowing guarantees,
and rows whose fingerprint occurs at one place only are dropped at once. Lines of `heavy_words` words or more are fingerprints by themselves.

The places of the rows that are left are joined: a window is matched with the first place, in order of id and line, that holds the same lines (the hashes of
all its lines are compared), never with all others, so a hot line costs one row for each occurrence, and its rows are dealt out over copies of its key. A match is then extended both ways, to the lines
before and after it that equal the source's, as far as matches with the same source at the same distance reach; where the source ends, another one
may begin. Of each run the later occurrence is deleted and the first one stays.

Single lines below `heavy_words` words stay, however often they occur: headings, greetings and closing brackets are no copies.

Defined cases. Null or empty text: no lines, nothing removed, text empty. Blank lines are never matched and stay. Repeated ids: rows of one id and text
count as one document, and each is returned; rows of one id with different texts are documents of their own. Null id: ordered first.
Very long texts are taken whole, in time linear in their lines. Empty table: no rows. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, land, pick, slices, spread_join

WORD = re.compile(r"[^\x20\t-\r]")
WHITE = re.compile(r"[\x20\t-\r]+")


@dataclass(frozen=True)
class Params:
    #: Lines of a window: the shortest run that is deleted.
    window: int = 2
    #: A line of so many words is removed as a repeat by itself; shorter ones only in runs.
    heavy_words: int = 50


def content_lines(text: str) -> list[tuple[int, str]]:
    """Number and content, without outer spaces, of the lines that hold a word."""
    return [(i, x) for i, x in ((i, line.strip(" ")) for i, line in enumerate(text.split("\n"))) if WORD.search(x)]


def selected(h: np.ndarray, window: int) -> np.ndarray:
    """For each window of line hashes the place of its smallest one, the right one of equal ones."""
    if len(h) < window:
        return np.empty(0, dtype=np.int64)
    best, at = h[: len(h) - window + 1].copy(), np.arange(len(h) - window + 1)
    for i in range(1, window):
        other = h[i : len(h) - window + 1 + i]
        better = other <= best
        best = np.where(better, other, best)
        at = np.where(better, np.arange(i, i + len(best)), at)
    return at


def _fingerprints(docs: DataFrame, p: Params) -> DataFrame:
    """id, doc, fp, at (its line) and windows: one row a fingerprint, with the windows that selected it.

    A window has k (its place among the lines with a word), size, first and last (line numbers) and key (16 bytes for the content of its lines).
    """
    window = pa.struct([("k", pa.int32()), ("size", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("key", pa.binary())])
    names, kinds = ["id", "doc", "fp", "at", "windows"], [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(window)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            rows: list[list] = [[] for _ in names]
            for doc_id, doc, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                lines = content_lines(text)
                digests = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for _, x in lines]
                h = np.frombuffer(b"".join(digests), dtype=np.int64)[::2]
                of: dict[int, list[dict]] = {}
                for k, at in enumerate(selected(h, p.window).tolist()):
                    end = k + p.window - 1
                    of.setdefault(at, []).append({"k": k, "size": p.window, "first": lines[k][0], "last": lines[end][0], "key": xxhash.xxh3_128_digest(b"".join(digests[k : end + 1]))})
                for k, (number, line) in enumerate(lines):
                    # Words and the white space between them take two characters each, at least.
                    if len(line) >= 2 * p.heavy_words - 1 and sum(map(bool, WHITE.split(line))) >= p.heavy_words:
                        of.setdefault(k, []).append({"k": k, "size": 1, "first": number, "last": number, "key": digests[k]})
                for k, windows in of.items():
                    for row, x in zip(rows, (doc_id, doc, int(h[k]), lines[k][0], windows), strict=True):
                        row.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(rows, kinds, strict=True)], names=names)

    schema = "id long, doc long, fp long, at int, windows array<struct<k:int,size:int,first:int,last:int,key:binary>>"
    return docs.select("id", "doc", "text").mapInArrow(run, schema)


def matches(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Windows of docs (id, doc, text) that an earlier place holds as well: id, doc, k, size, first, last and source (id, doc, k, first)."""
    prints = land(_fingerprints(docs, p), "line-fingerprints")
    # The first and the last place tell one place from several; a count of distinct places would need another shuffle.
    place = F.struct("id", "doc", "at")
    repeated = land(prints.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("not (a <=> b)").select("fp"), "line-repeated")
    windows = spread_join(prints, repeated, "fp", 0, ["id", "doc", "at"]).select("id", "doc", F.explode("windows").alias("w"))
    windows = land(windows.select("id", "doc", "w.*"), "line-windows")
    spot = F.struct("id", "doc", "k", "first")
    firsts = land(windows.groupBy("key").agg(F.min(spot).alias("source"), F.max(spot).alias("other")).where("not (source <=> other)").drop("other"), "line-sources")
    found = spread_join(windows, firsts, "key", 0, ["id", "doc", "k"]).drop("key").where(spot > F.col("source"))
    out = land(found.distinct(), "line-matches")  # rows of one id and text make the same matches
    discard(prints, repeated, windows, firsts)
    return out


def extended(found: list[dict]) -> list[dict]:
    """Maximal runs of one document's matches: first, last (line numbers), source_id, source_line.

    A run takes in the next window while it overlaps or touches the lines so far and its source does so at the same distance: then the lines of both
    documents go on being equal. Where the earliest source of the next window is another one, another run begins.
    """
    runs: list[dict] = []
    for m in sorted(found, key=lambda m: (m["k"], -m["size"])):
        s, end = m["source"], m["k"] + m["size"] - 1
        line = (s["id"], s["doc"], s["k"] - m["k"])
        if runs and runs[-1]["line"] == line and m["k"] <= runs[-1]["end"] + 1:
            runs[-1]["last"], runs[-1]["end"] = max(runs[-1]["last"], m["last"]), max(runs[-1]["end"], end)
        else:
            runs.append({"first": m["first"], "last": m["last"], "source_id": s["id"], "source_line": s["first"], "line": line, "end": end})
    return runs


def stretches(runs: list[dict]) -> list[tuple[int, int]]:
    """The union of the runs, in order of their first lines, as [first, end) stretches of neighbouring lines."""
    out: list[tuple[int, int]] = []
    for r in runs:
        if out and r["first"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r["last"] + 1))
        else:
            out.append((r["first"], r["last"] + 1))
    return out


OUT = "doc_id long, n_lines long, n_removed long, n_runs long, text string, runs array<struct<first:int,last:int,source_id:long,source_line:int>>"


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """A row for each row of docs: doc_id, n_lines, n_removed, n_runs, the text that is left, runs.

    n_runs counts the stretches of neighbouring lines that went; runs lists the extended matches (first and last line, id and line of the source).
    """
    docs = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # id0 and doc name a row's content; null ids have hashes of their own.
    docs = docs.withColumn("doc", F.xxhash64("text", F.col("id").isNull())).withColumn("id0", F.coalesce("id", F.lit(0).cast("long")))
    of = matches(docs, p).groupBy(F.coalesce("id", F.lit(0).cast("long")).alias("id0"), "doc").agg(F.collect_list(F.struct("k", "size", "first", "last", "source")).alias("found"))
    run_kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("source_id", pa.int64()), ("source_line", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            rows: list[list] = [[] for _ in range(5)]
            for text, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                runs = extended(found or [])
                gone, lines = stretches(runs), text.split("\n") if text else []
                kept, at = [], 0
                for first, end in gone:
                    kept += lines[at:first]
                    at = end
                rest = "\n".join([*kept, *lines[at:]]) if gone else text
                own = [{c: r[c] for c in ("first", "last", "source_id", "source_line")} for r in runs]
                for row, x in zip(rows, (len(lines), sum(b - a for a, b in gone), len(gone), rest, own), strict=True):
                    row.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), run_kind]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, k) for x, k in zip(rows, kinds, strict=True))], names=["doc_id", "n_lines", "n_removed", "n_runs", "text", "runs"])

    return docs.join(of, ["id0", "doc"], "left").select("id", "text", "found").mapInArrow(run, OUT)
