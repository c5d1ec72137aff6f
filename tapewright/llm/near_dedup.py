"""MinHash near-duplicates: a multi-index Hamming join over b-bit signatures, confirmed on full shingle sets.

Signature: `symbols` b-bit minima (b = 8) of a document's shingle set, cut into `chunks` chunks. Two signatures at a Hamming
distance (in symbols) of at most chunks * (chunk_errors + 1) - 1 agree, by pigeonhole, in some chunk up to `chunk_errors`
symbols; every choice of `chunk_errors` symbols to leave out of a chunk gives an index key, so all such pairs share a key.
Farther pairs may share one as well and are treated alike. The defaults (18 chunks of 9 symbols, 1 error, 162 keys) guarantee
distance 35; a pair of Jaccard similarity 0.8 has mean distance 32 and is missed with probability 3e-5, one of 0.85 with 2e-7.

Work is near-linear in a group of copies. Equal shingle sets collapse to one class first. Then every class is compared with
the smallest and the largest class of each of its buckets (stars), and the confirmed links are closed to components.

Only buckets that still hold several components are searched further, between components only. First the components that may be linked are
gathered to arenas: of each component in a bucket one row meets one of the bucket's largest component; where several are left, all rows of the bucket
meet in blocks, their signatures are compared in numpy, and of all near pairs only a spanning forest of the components leaves the block. A pair of similarity 0.8 has 32 of 162 unequal symbols on average; up to 4.2 deviations more count as near, so one such
pair is missed with probability 1.3e-5. Then the rows of an arena meet with their full shingle sets, and again only a spanning forest of the
components with a confirmed link leaves a block. In both steps the rows of the largest component are dealt out once and the few others are sent to
each of its blocks, so what moves grows with the rows, and what comes out with the components, never with the pairs. Nothing is capped.

Defined cases. Null, empty or word-less text: empty set, linked with nothing, kept. Fewer words than a shingle: the whole
word sequence is the one shingle. Repeated ids: every set of an id is a class of its own, and the classes of one id are linked by the
id. Null id: the row is returned with itself as component (null) and kept. Empty table: no rows. Only the id and
text columns are read, so others may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, land, mix64, pick, slices, spread_join, word_hashes
from .graph import components


@dataclass(frozen=True)
class Params:
    shingle_words: int = 5
    #: Link when 100 * intersection >= percent * union.
    percent: int = 80
    chunks: int = 18
    chunk_symbols: int = 9
    chunk_errors: int = 1
    #: Deviations by which the signatures of a pair may be farther apart than those of a pair at the limit, on average.
    deviations: float = 4.2
    #: Rows of one bucket that are compared in one block; larger buckets are split into blocks.
    block_rows: int = 4_096
    #: Shingles of one arena that are compared in one block.
    block_shingles: int = 1_000_000
    #: Up to so many ids (8 bytes each) a list of ids is broadcast; above, the same semi-join is a shuffle.
    broadcast_ids: int = 500_000
    #: The same for tables of up to 100 bytes a row.
    broadcast_rows: int = 100_000

    @property
    def symbols(self) -> int:
        return self.chunks * self.chunk_symbols

    @property
    def most_unequal(self) -> int:
        """Unequal symbols up to which two signatures count as near."""
        apart = 1 - self.percent / 100
        return int(self.symbols * apart + self.deviations * (self.symbols * apart * (1 - apart)) ** 0.5) + 1


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted, distinct 64-bit hashes of each text's k-word shingles; of fewer words, the whole sequence is one."""
    words, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        h = np.full(max(len(words) - k + 1, 0), np.uint64(k))
        for i in range(k):
            h = mix64(h + words[i : len(words) - k + 1 + i] * np.uint64(0x9E3779B97F4A7C15))
        out = []
        for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            if end - start >= k:
                own = np.sort(h[start : end - k + 1])
                out.append(own[np.append(True, own[1:] != own[:-1])])
            else:
                short = np.full(1, np.uint64(end - start))
                for i in range(start, end):
                    short = mix64(short + words[i : i + 1] * np.uint64(0x9E3779B97F4A7C15))
                out.append(short if end > start else words[:0])
    return out


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray], block: int = 1_024) -> np.ndarray:
    """One byte of each minimum under the hash functions x -> odd * x + add, modulo 2**32, over folded shingle hashes."""
    odd, add = family
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(len(odd), 0xFFFFFFFF, dtype=np.uint32)
    held = np.empty((min(block, len(x)), len(odd)), dtype=np.uint32)
    for at in range(0, len(x), block):
        part = x[at : at + block, None]
        h = held[: len(part)]
        np.multiply(part, odd, out=h)
        np.add(h, add, out=h)
        np.minimum(least, h.min(axis=0), out=least)
    return (mix64(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (random >> np.uint64(32)).astype(np.uint32) | np.uint32(1), random.astype(np.uint32)


def index_keys(signatures: np.ndarray, p: Params) -> np.ndarray:
    """Rows of 64-bit index keys: one for each chunk and each choice of chunk_errors symbols left out of it."""
    keys = []
    with np.errstate(over="ignore"):
        for chunk in range(p.chunks):
            part = signatures[:, chunk * p.chunk_symbols : (chunk + 1) * p.chunk_symbols].astype(np.uint64)
            for out in itertools.combinations(range(p.chunk_symbols), p.chunk_errors):
                keep = [i for i in range(p.chunk_symbols) if i not in out]
                h = np.full(len(part), np.uint64(1 + len(keys)) * np.uint64(0x9E3779B97F4A7C15))
                for i in keep:
                    h = mix64(h * np.uint64(31) + part[:, i] + np.uint64(1))
                keys.append(h)
    return np.stack(keys, axis=1).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _signed(docs: DataFrame, p: Params) -> DataFrame:
    """id, text_hash, n, print and sig (null for an empty set) of each row."""
    family = hash_family(p.symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            sizes, prints, signatures = [], [], []
            for s in shingle_sets(part.column(1), p.shingle_words):
                sizes.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()))
                signatures.append(signature(s, family).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())], names=["id", "text_hash", "n", "print", "sig"])

    rows = docs.select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return rows.mapInArrow(run, "id long, text_hash long, n long, print binary, sig binary")


def _bucketed(classes: DataFrame, p: Params) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(-1, p.symbols)
                keys = index_keys(sig, p)
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """Landed: id, n and words (sorted 64-bit shingle hashes) of the wanted classes (id), from the texts of docs."""
    rows = classes.join(wanted, "id", "left_semi").select("id", "n", "print", "doc")
    ids = rows.select("doc").distinct()
    small = ids.count() <= p.broadcast_ids
    texts = docs.join(F.broadcast(ids) if small else ids, docs["id"] == ids["doc"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            raw = [x.tobytes() for x in shingle_sets(part.column(0), p.shingle_words)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()), pa.array(raw, pa.large_binary()).cast(pa.binary())], names=["print", "words"])

    sets = texts.select("text").mapInArrow(run, "print binary, words binary")
    # Other rows of a repeated id have other prints; equal rows of one print are one class.
    sets = sets.dropDuplicates(["print"]) if docs._ids_repeat else sets
    return land(rows.drop("doc").join(sets, "print").drop("print"), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Landed: those of the pairs (a, b) whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            both = [[np.frombuffer(x, dtype=np.uint64) for x in part.column(i).to_pylist()] for i in (2, 3)]
            ok = [linked(x, y, p.percent) for x, y in zip(*both, strict=True)]
            yield part.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    words = sets.select("id", "words")
    left = pairs.select("a", "b").join(words.toDF("a", "words_a"), "a")
    both = left.join(words.toDF("b", "words_b").hint("merge"), "b").select("a", "b", "words_a", "words_b")
    return land(both.mapInArrow(run, "a long, b long"), "near-links")


class Forest:
    """Components merged step by step; `c` is the component of each row, `found` the pairs of labels that merged two."""

    def __init__(self, labels: np.ndarray) -> None:
        self.labels, self.c = np.unique(labels, return_inverse=True)
        self.into = np.arange(len(self.labels))
        self.found: list[tuple[int, int]] = []

    def merge(self, left: np.ndarray, right: np.ndarray) -> None:
        """Rows left[i] and right[i] belong together; a pair of components is looked at once."""
        pairs = np.unique(self.c[left] * len(self.labels) + self.c[right])
        for a, b in zip((pairs // len(self.labels)).tolist(), (pairs % len(self.labels)).tolist(), strict=True):
            while self.into[a] != a:
                a = int(self.into[a])
            while self.into[b] != b:
                b = int(self.into[b])
            if a != b:
                self.into[max(a, b)] = min(a, b)
                self.found.append((int(self.labels[a]), int(self.labels[b])))
        if len(pairs):
            roots = self.into[self.into]
            while (roots != self.into).any():
                self.into, roots = roots, roots[roots]
            self.c = self.into[self.c]


def near_forest(c: np.ndarray, sig: np.ndarray, n: np.ndarray, side: np.ndarray, within: bool, p: Params, chunk: int = 200_000) -> list[tuple[int, int]]:
    """A spanning forest of the components c that hold rows with near signatures. Rows of side 1 meet those of side 0, and each other if within."""
    forest = Forest(c)
    words = np.zeros((len(sig), -(-sig.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : sig.shape[1]] = sig
    probes, others = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
    step = max(1, chunk // max(1, len(probes)))
    for at in range(0, len(others), step):  # a slice of the others against all probes that are not one with all of it yet
        _near_pairs(forest, probes, others[at : at + step], words, n, p)
    for i in range(0, len(probes) if within else 0, 64):
        _near_pairs(forest, probes[i : i + 64], probes[i:], words, n, p)
    return forest.found


def _near_pairs(forest: Forest, left: np.ndarray, right: np.ndarray, words: np.ndarray, n: np.ndarray, p: Params) -> None:
    apart = forest.c[left][:, None] != forest.c[right][None, :]
    apart &= 100 * np.minimum(n[left][:, None], n[right][None, :]) >= p.percent * np.maximum(n[left][:, None], n[right][None, :])
    i, j = np.nonzero(apart)
    for at in range(0, len(i), 100_000):
        a, b = left[i[at : at + 100_000]], right[j[at : at + 100_000]]
        still = forest.c[a] != forest.c[b]
        a, b = a[still], b[still]
        near = (words[a] != words[b]).sum(axis=1) <= p.most_unequal
        forest.merge(a[near], b[near])


def linked_forest(c: np.ndarray, sets: list[np.ndarray], side: np.ndarray, within: bool, p: Params) -> list[tuple[int, int]]:
    """A spanning forest of the components c that hold linked sets; sides as in near_forest."""
    forest = Forest(c)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    mark = np.zeros(int(flat.max(initial=-1)) + 1, dtype=np.int64)
    probes = np.flatnonzero(side == 1)
    for k, i in enumerate(probes):
        targets = np.concatenate([np.flatnonzero(side == 0), probes[k + 1 :] if within else probes[:0]])
        targets = targets[(forest.c[targets] != forest.c[i]) & (100 * np.minimum(sizes[targets], sizes[i]) >= p.percent * np.maximum(sizes[targets], sizes[i]))]
        if not len(targets):
            continue
        own = flat[ends[i] - sizes[i] : ends[i]]
        mark[own] = 1
        cut = np.cumsum(sizes[targets])
        at = np.repeat(ends[targets] - cut, sizes[targets]) + np.arange(cut[-1])
        common = np.add.reduceat(mark[flat[at]], cut - sizes[targets])
        mark[own] = 0
        found = targets[100 * common >= p.percent * (sizes[targets] + sizes[i] - common)]
        forest.merge(np.full(len(found), i), found)
    return forest.found


def _dealt(rows: DataFrame, big: Column, blocks_big: Column, blocks_rest: Column) -> DataFrame:
    """rows with g1, g2 and side: the groups in which each row takes part.

    Rows of the largest component are dealt to blocks_big blocks, the rest to blocks_rest. Each block of the first meets each of the second (group
    i, blocks_big + j), the blocks of the rest meet one another (side 0 is the first), and a block of the rest meets itself in the group of i = 0.
    """
    own = F.pmod(F.xxhash64("id"), F.when(big, blocks_big).otherwise(blocks_rest)).cast("int")
    place = lambda g1, g2, side: F.struct(g1.cast("int").alias("g1"), g2.cast("int").alias("g2"), F.lit(side).alias("side"))
    first, last = F.lit(0), F.lit(-1)
    of_big = F.transform(F.sequence(first, blocks_rest + last), lambda j: place(F.col("_own"), blocks_big + j, 0))
    with_big = F.transform(F.sequence(first, blocks_big + last), lambda i: place(i, blocks_big + F.col("_own"), 1))
    others = F.filter(F.sequence(first, blocks_rest + last), lambda j: j != F.col("_own"))
    with_rest = F.transform(others, lambda j: F.when(j < F.col("_own"), place(blocks_big + j, blocks_big + F.col("_own"), 1)).otherwise(place(blocks_big + F.col("_own"), blocks_big + j, 0)))
    out = rows.withColumn("_own", own).withColumn("_g", F.explode(F.when(big, of_big).otherwise(F.concat(with_big, with_rest))))
    return out.select("*", "_g.*").drop("_own", "_g")


def _forests(groups: DataFrame, key: str, value: str, find) -> DataFrame:
    """Edges (u, v) of find(c, values, n, side, within) for each group of rows (key, g1, g2, side, c, n, value), streamed through sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            at = [table.column(i).to_numpy() for i in range(3)]
            new = np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in at]))
            starts = np.flatnonzero(new)
            side, c, n = (table.column(i).to_numpy() for i in range(3, 6))
            values, out = table.column(6), []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                out += find(c[start:end], values.slice(start, end - start).to_pylist(), n[start:end], side[start:end], at[1][start] == 0)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 10_000 and sum(b.nbytes for b in held) < 8_000_000:
                continue
            table = pa.Table.from_batches(held)
            same = np.ones(table.num_rows, dtype=bool)
            for i in range(3):
                same &= table.column(i).to_numpy() == table.column(i)[table.num_rows - 1].as_py()
            cut = int(np.argmax(same))  # the last group may go on in the next batch
            if cut:
                yield found(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield found(pa.Table.from_batches(held))

    rows = groups.select(key, "g1", "g2", "side", "c", "n", value).repartition(key, "g1", "g2").sortWithinPartitions(key, "g1", "g2")
    return rows.mapInArrow(run, "u long, v long").distinct()


def _near(pairs: DataFrame, p: Params) -> DataFrame:
    """(u, v) of the pairs (u, v, n_a, sig_a, n_b, sig_b) whose signatures are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (3, 5))
            n, m = (batch.column(i).to_numpy() for i in (2, 4))
            ok = ((a != b).sum(axis=1) <= p.most_unequal) & (100 * np.minimum(n, m) >= p.percent * np.maximum(n, m)) if batch.num_rows else np.empty(0, bool)
            yield batch.filter(pa.array(ok)).select(["u", "v"])

    return pairs.select("u", "v", "n_a", "sig_a", "n_b", "sig_b").mapInArrow(run, "u long, v long").distinct()


def _mixed(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, id, c) by key and component, and the keys with several components: big (k, c and rep of the largest), k (rows), m0, m1 (members)."""
    members = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"m{i}") for i in (0, 1)]
    by = labelled.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.min("id").alias("rep"), *members)
    mixed = by.groupBy("key").agg(F.max(F.struct("k", "c", "rep")).alias("big"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("kinds"), F.bit_xor("m0").alias("m0"), F.bit_xor("m1").alias("m1"))
    return by, mixed.where("kinds > 1")


def _arenas(shared: DataFrame, comps: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Landed (node, component) over components: those that may be linked, by the signatures of rows that share a key, come together."""
    labelled = land(shared.join(comps.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("c")), "near-labelled")
    # First one row of each component of a key with one of the key's largest component: most that are near come together here.
    by, mixed = _mixed(labelled)
    reps = by.join(mixed.select("key", "big"), "key").where(F.col("c") != F.col("big.c"))
    reps = reps.select(F.col("rep").alias("a"), F.col("big.rep").alias("b"), F.col("c").alias("u"), F.col("big.c").alias("v")).distinct()
    signs = classes.select("id", "n", "sig")
    pairs = reps.join(signs.toDF("a", "n_a", "sig_a"), "a").join(signs.toDF("b", "n_b", "sig_b"), "b")
    edges = land(_near(pairs, p), "near-arena-edges")
    first = components(edges)

    # Then all rows of the keys that still hold several.
    labelled = labelled.join(first.toDF("c", "arena"), "c", "left").select("key", "id", F.coalesce("arena", "c").alias("c"))
    _, mixed = _mixed(labelled)
    once = mixed.groupBy("k", "m0", "m1").agg(F.min("key").alias("key"), F.first("big").alias("big")).select("key", "k", "big")  # of keys with the same members one will do
    rows = land(spread_join(labelled, land(once, "near-mixed-keys"), "key", p.broadcast_rows, ["id"]), "near-mixed")
    blocks = lambda x: F.greatest(F.ceil(x / p.block_rows), F.lit(1)).cast("int")
    groups = _dealt(rows.join(signs, "id"), F.col("c") == F.col("big.c"), blocks(F.col("big.k")), blocks(F.col("k") - F.col("big.k")))

    def find(c, values, n, side, within):
        return near_forest(c, np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(c), -1), n, side, within, p)

    found = components(edges.union(_forests(groups, "key", "sig", find)))
    out = land(found.union(found.select("component", "component").distinct()), "near-arenas")  # the smallest of each is a node as well
    discard(rows, edges)
    return out


def _across(docs: DataFrame, classes: DataFrame, comps: DataFrame, arenas: DataFrame, p: Params) -> DataFrame:
    """Landed edges (u, v) between components of one arena that hold a confirmed link."""
    labelled = classes.join(comps.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("c"))
    rows = land(spread_join(labelled, arenas.toDF("c", "arena"), "c", p.broadcast_rows, ["id"]).select("id", "c", "arena"), "near-arena-rows")
    sets = _sets(docs, classes, rows.select("id"), p)
    placed = rows.join(sets, "id")
    sizes = placed.select("arena", "c", "n").groupBy("arena", "c").agg(F.sum("n").alias("k")).groupBy("arena").agg(F.max(F.struct("k", "c")).alias("big"), F.sum("k").alias("k"))
    blocks = lambda x: F.greatest(F.ceil(x / p.block_shingles), F.lit(1)).cast("int")
    groups = _dealt(spread_join(placed, land(sizes, "near-arena-sizes"), "arena", p.broadcast_rows, ["id"]), F.col("c") == F.col("big.c"), blocks(F.col("big.k")), blocks(F.col("k") - F.col("big.k")))

    def find(c, values, n, side, within):
        return linked_forest(c, [np.frombuffer(x, dtype=np.uint64) for x in values], side, within, p)

    out = land(_forests(groups, "arena", "words", find), "near-across")
    discard(rows, sets)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (smallest id reachable), kept, text_hash (xxhash64 of the text)."""
    docs = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    signed = land(_signed(docs, p), "near-signed")
    with_set = signed.where("n > 0 and id is not null")
    totals = with_set.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).first()
    docs._ids_repeat = totals["n"] != totals["ids"]
    # One class a set. It is numbered by its smallest id; where ids repeat, in the order of its smallest ids.
    prints = with_set.groupBy("print").agg(F.min("id").alias("doc"), F.max("n").alias("n"), F.first("sig").alias("sig"))
    if docs._ids_repeat:
        prints = prints.orderBy("doc", "print").withColumn("id", F.monotonically_increasing_id())
    else:
        prints = prints.withColumn("id", F.col("doc"))
    classes = land(prints.select("id", "print", "doc", "n", "sig"), "near-classes")

    # Stars: each class with the smallest and largest class of each of its buckets.
    # Keys are made twice, which costs less than to keep them; small tasks, as each row makes many keys.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = _bucketed(classes.select("id", "sig").repartition(tasks), p)
    ends = buckets.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("n > 1 and lo <> hi").drop("n")
    shared = land(buckets.join(ends, "key"), "near-shared")
    pair = lambda a, b: F.struct(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    stars = shared.select(F.explode(F.array(pair("id", "lo"), pair("id", "hi"))).alias("p")).select("p.*").where("a <> b").distinct()
    stars = land(stars, "near-stars")
    sets = _sets(docs, classes, stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct(), p)
    edges = _confirmed(stars, sets, p).toDF("u", "v")
    discard(stars, sets)
    if docs._ids_repeat:  # the classes of one id belong together: each with the first
        of_id = with_set.select("id", "print").distinct().join(classes.select("print", F.col("id").alias("u")), "print").select("id", "u")
        edges = edges.union(of_id.join(of_id.groupBy("id").agg(F.min("u").alias("v")), "id").where("u <> v").select("u", "v"))
    comps = land(components(edges), "near-comps")

    # What is left: pairs of different components in one bucket.
    arenas = _arenas(shared, comps, classes, p)
    more = _across(docs, classes, comps, arenas, p)
    discard(shared, arenas)
    final = land(components(edges.union(more)), "near-comps")

    of_class = classes.join(final.withColumnRenamed("node", "id"), "id", "left").select("print", F.coalesce("component", "id").alias("component_id"))
    if docs._ids_repeat:  # back from numbers to ids, through sixteen copies of each so that no number is hot
        salt = F.pmod(F.xxhash64("print"), F.lit(16)).alias("salt")
        names = classes.select(F.col("id").alias("component_id"), "doc", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(15).cast("bigint"))).alias("salt"))
        of_class = of_class.select("print", "component_id", salt).join(names, ["component_id", "salt"]).select("print", F.col("doc").alias("component_id"))
    out = signed.select("id", "n", "print", "text_hash").join(of_class, "print", "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), "text_hash")
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")
