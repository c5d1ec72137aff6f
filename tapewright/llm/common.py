"""Shared helpers: scratch tables in the cluster's shared folder, word tables, seeds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the word pattern [^\x20\x09-\x0D]+ takes it; bytes.split() cuts at the same bytes.
WHITE = b" \t\n\x0b\x0c\r"

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one only in a local session that names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="tapewright-")
    return _own_dir[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Remove landed tables that no later plan reads."""
    for table in tables:
        path = getattr(table, "_landed_at", None)
        if path:
            remove(table.sparkSession, path)


def spread_join(rows: DataFrame, table: DataFrame, on: str | list[str], most: int, by: list[str], how: str = "inner", copies: int = 8) -> DataFrame:
    """rows joined with a landed table that has one row for each key, however many rows share a key.

    A table of at most `most` rows is broadcast; of a larger one each row is copied, and the rows of a key are dealt out over its copies by the
    hash of their columns `by`, so that a task that runs again deals them alike.
    """
    if most and table.count() <= most:
        return rows.join(F.broadcast(table), on, how)
    keys = [on] if isinstance(on, str) else list(on)
    spread = table.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    return rows.withColumn("_copy", F.pmod(F.xxhash64(*by, F.lit(29)), F.lit(copies))).join(spread, [*keys, "_copy"], how).drop("_copy")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """The named columns only, under our own names, so that further columns of any name do no harm.

    Where a name occurs more than once, the first column of that name is taken.
    """
    where = {alias: df.columns.index(column) for alias, column in names.items()}
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(alias) for alias, i in where.items()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_fold(id_column: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo folds."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds about most_bytes of text; a single longer text stays whole.

    The numpy work on a slice takes some 60 bytes for each byte of text.
    """
    for batch in batches:
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if len(lengths) > start:
            yield batch.slice(start)


class WordTable(dict):
    """Maps each word to a running number; `new` holds the words numbered since the last drain."""

    LIMIT = 400_000

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a text column (null: none), the place of each word among them, and the number of words of each text."""
    parts = pa.compute.ascii_split_whitespace(pa.compute.fill_null(texts, ""))
    flat = parts.flatten().cast(pa.binary()).dictionary_encode()
    words, at = flat.dictionary.to_pylist(), flat.indices.to_numpy().astype(np.int64)
    lengths = np.asarray(pa.compute.list_value_length(parts), dtype=np.int64)
    if b"" in words:  # outer white space leaves empty parts
        real = at != words.index(b"")
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[real], minlength=len(lengths))
        at = at[real]
    return words, at, lengths


_TABLE = np.random.default_rng(20).integers(0, 2**64, (64, 256), dtype=np.uint64)
_IS_WHITE = np.isin(np.arange(256), np.frombuffer(WHITE, dtype=np.uint8))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after the other (null: none), and where each text starts, with the end."""
    plain = pa.compute.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if plain.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words [^\\x20\\x09-\\x0D]+ of a text column, in order, and the number of words of each text.

    Tabulation hashing over (position modulo 64, byte), with a factor for the position's upper part, all in numpy.
    """
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    inside = ~_IS_WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    first[starts] = inside[starts]  # a text's first byte never continues the text before
    at = np.flatnonzero(inside)
    head = np.flatnonzero(first)
    word = np.cumsum(first)[at] - 1
    place = at - head[word]
    byte = data[at]
    if lower:
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    with np.errstate(over="ignore"):
        h = _TABLE[place & 63, byte]
        if place.max(initial=0) >= 64:
            h = h * (np.uint64(2) * mix64((place >> 6).astype(np.uint64)) + np.uint64(1))
        hashes = mix64(np.add.reduceat(h, np.flatnonzero(first[at])))
    ends = np.searchsorted(head, offsets)
    return hashes, np.diff(ends)


class Growing:
    """Rows that are only ever appended; capacity doubles, so appending costs its own size."""

    def __init__(self, shape: tuple[int, ...], dtype) -> None:
        self.rows, self.used = np.empty((1_024, *shape), dtype=dtype), 0

    def extend(self, more: np.ndarray) -> None:
        end = self.used + len(more)
        if end > len(self.rows):
            wider = np.empty((max(end, 2 * len(self.rows)), *self.rows.shape[1:]), dtype=self.rows.dtype)
            wider[: self.used] = self.rows[: self.used]
            self.rows = wider
        self.rows[self.used : end] = more
        self.used = end


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix, element by element."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
