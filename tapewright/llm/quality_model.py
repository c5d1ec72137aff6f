"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer numpy network.

Word vectors. Words are split into all their runs of letters and digits and runs of symbols (a run of more than 20 characters into its 3-grams), and a mark for
capitals; each of these is a token of its own. Every token has a sparse ternary index vector, a function of its hash, so no table of all words is needed. The tokens that occur in most of the
labelled training rows, `vocabulary` of them at most, have a context vector as well: the sum of the index vectors of their neighbours, `window` on each side, over the whole corpus,
summed in Spark. A document is the weighted mean and deviation of its tokens' context and index vectors; tokens outside the vocabulary come in by their index vectors alone.

Classifier. Fitted on at most `most_labelled` labelled rows (those with the smallest hash of the id) of the training folds; one
fold in five of these is kept apart to calibrate the temperature. Only the text is an input of a score.

Defined cases. Null, empty or symbol-free text: pooled vector of zeros, scored like any other. No labelled rows, or one class
only: the score is the share of label 1 (0.5 without rows). Repeated rows are scored one by one. Null id: scored, never used in
training. Empty table: no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Growing, WordTable, discard, land, mix64, pick, slices, split_words

RUNS = re.compile(r"([^\W_]+)|[\W_]+")
LONGEST, GRAM = 20, 3


@dataclass(frozen=True)
class Params:
    dims: int = 32
    nonzero: int = 4
    #: Neighbours on each side whose index vectors a word takes in.
    window: int = 2
    most_labelled: int = 20_000
    #: Words with a context vector: those in most of the labelled training rows, in two at least.
    vocabulary: int = 16_384
    hidden: int = 32
    epochs: int = 60
    threshold: float = 0.3
    seed: int = 20


#: What often follows a word without a space; a shortcut for the general rule, with the same result.
CLOSING = ".,;:!?)\"'"
_hash = xxhash.xxh3_64_intdigest
CAPITALS = _hash(b"c")


def token_hashes(word: bytes) -> list[int]:
    """Hashes of a word's tokens: one for each of its runs (3-grams of a long one), then a mark of capitals."""
    if len(word) <= LONGEST and word.isalnum():  # plain letters and digits
        small = word.lower()
        return [_hash(b"w" + small)] if small == word or len(word) < 2 or not word.isupper() else [_hash(b"w" + small), CAPITALS]
    text = word.decode("utf-8", "replace")
    core = text.rstrip(CLOSING)
    small = core.lower()
    if core.isalnum() and max(len(text), len(small)) <= LONGEST:  # letters and digits of any script, then closing signs
        out = [_hash(("w" + small).encode())]
        if len(core) < len(text):
            out.append(_hash(("s" + text[len(core) :]).encode()))
        return [*out, CAPITALS] if len(core) > 1 and core.isupper() else out
    out, capitals = [], False
    for m in RUNS.finditer(text):
        run, kind = m[0], "w" if m[1] else "s"
        capitals |= len(run) > 1 and run.isupper()
        run = run.lower()
        grams = [run] if len(run) <= LONGEST else [run[i : i + GRAM] for i in range(len(run) - GRAM + 1)]
        out += [_hash((kind + g).encode("utf-8", "replace")) for g in grams]
    return [*out, CAPITALS] if capitals else out


class Tokens:
    """Texts to hashes of tokens; the tokens of a word are remembered, up to a bounded number of words and tokens (`most`)."""

    def __init__(self, most: int = 4_000_000) -> None:
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.words, self.parts, self.spans = WordTable(), Growing((), np.uint64), Growing((2,), np.int64)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token hashes of all texts, one after the other, and how many each text has."""
        if len(self.words) > WordTable.LIMIT or self.parts.used > self.most:
            self._forget()
        words, at, counts = split_words(texts)
        numbers = self.words.numbers(words)
        if self.words.new:
            new = [token_hashes(w) for w in self.words.new]
            sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
            self.spans.extend(np.stack([self.parts.used + np.cumsum(sizes) - sizes, sizes], axis=1))
            self.parts.extend(np.fromiter(itertools.chain.from_iterable(new), dtype=np.uint64, count=int(sizes.sum())))
            self.words.new.clear()
        start, size = self.spans.rows[numbers[at]].T
        ends = np.cumsum(size)
        found = self.parts.rows[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        of = np.repeat(np.arange(len(counts)), counts)
        return found, np.bincount(of, weights=size, minlength=len(counts)).astype(np.int64)


def index_vectors(hashes: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each token's index vector, a function of its hash: no table of all words is needed."""
    h = mix64(hashes + np.uint64(p.seed))[:, None] >> (np.arange(p.nonzero, dtype=np.uint64) * np.uint64(16))
    return (h >> np.uint64(1) & np.uint64(0x7FFF)).astype(np.int64) % p.dims, 1 - 2 * (h & np.uint64(1)).astype(np.int64)


def known(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places of hashes in the sorted vocabulary, -1 for others."""
    if not len(vocabulary):
        return np.full(len(hashes), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def vocabulary_of(sample: DataFrame, p: Params) -> np.ndarray:
    """Sorted hashes of the words that occur in most rows of the labelled sample (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for part in slices(batches, 0):
            t, sizes = tokens.of(part.column(0))
            kinds, at = np.unique(t, return_inverse=True)
            once = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(kinds) + at) % max(len(kinds), 1)  # a token once for each text
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(np.bincount(once, minlength=len(kinds)))], names=["h", "n"])

    rows = sample.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    top = rows.orderBy(F.col("n").desc(), "h").limit(p.vocabulary).select("h").toPandas()  # at most p.vocabulary rows
    return np.sort(top["h"].to_numpy(dtype=np.int64).view(np.uint64))


def word_sums(docs: DataFrame, text_col: str, vocabulary: np.ndarray, p: Params) -> tuple[np.ndarray, int]:
    """For each word of the vocabulary its count, then the sum of its neighbours' index vectors, over all documents: shape (words, 1 + dims); and the number of all tokens."""
    columns, size = ["n", *(f"v{i}" for i in range(p.dims))], len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        counts, sums, total = np.zeros(size, dtype=np.int64), np.zeros(size * p.dims, dtype=np.float64), 0
        for part in slices(batches, 0, 2_000_000):
            t, sizes = tokens.of(part.column(0))
            kinds, t = np.unique(t, return_inverse=True)
            word = known(kinds, vocabulary)
            places, signs = index_vectors(kinds, p)
            total += len(t)
            w = word[t]
            counts += np.bincount(w[w >= 0], minlength=size)
            of = np.repeat(np.arange(len(sizes)), sizes)
            mine, other = [], []
            for far in range(1, p.window + 1):  # pairs of neighbours within a text, both ways
                here = np.flatnonzero(of[far:] == of[:-far])
                for a, b in ((here, here + far), (here + far, here)):
                    a, b = a[w[a] >= 0], b[w[a] >= 0]
                    mine.append(w[a])
                    other.append(t[b])
            a, b = np.concatenate(mine), np.concatenate(other)
            for i in range(p.nonzero):
                sums += np.bincount(a * p.dims + places[b, i], weights=signs[b, i], minlength=len(sums))
        used = np.flatnonzero(counts)
        table = sums.reshape(size, p.dims)[used].astype(np.int64)
        rows = [np.append(used, size), np.append(counts[used], total), *(np.append(table[:, i], 0) for i in range(p.dims))]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in rows], names=["word", *columns])

    rows = pick(docs, text=text_col).mapInArrow(run, ", ".join(f"{c} long" for c in ["word", *columns]))
    total = rows.groupBy("word").agg(*(F.sum(c).alias(c) for c in columns)).toPandas()  # at most p.vocabulary + 1 rows
    out = np.zeros((size + 1, 1 + p.dims))
    out[total["word"].to_numpy(dtype=np.int64)] = total[columns].to_numpy()
    return out[:size], int(out[size, 0])


@dataclass
class Words:
    """What is known of words: hashes of the vocabulary, their context directions and smooth inverse-frequency weights."""

    vocabulary: np.ndarray
    context: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, vocabulary: np.ndarray, sums: np.ndarray, total: int) -> Words:
        context = sums[:, 1:] / np.maximum(np.linalg.norm(sums[:, 1:], axis=1, keepdims=True), 1e-9)
        return cls(vocabulary, context.astype(np.float32), (1e-2 / (1e-2 + sums[:, 0] / max(total, 1))).astype(np.float32))


class Pool:
    """Texts to rows: weighted mean and deviation of their words' context directions (zero outside the vocabulary) and index vectors.

    Index vectors are never written out: their non-zero entries are summed straight into the texts' rows.
    """

    def __init__(self, words: Words, p: Params) -> None:
        self.words, self.p, self.tokens = words, p, Tokens()

    def rows(self, texts: pa.Array) -> np.ndarray:
        p = self.p
        t, sizes = self.tokens.of(texts)
        n = len(sizes)
        hashes, at = np.unique(t, return_inverse=True)
        word = known(hashes, self.words.vocabulary)
        weight = np.where(word >= 0, self.words.weights[word] if len(self.words.weights) else 1.0, 1.0)
        places, signs = index_vectors(hashes, p)
        of = np.repeat(np.arange(n), sizes)
        w = weight[at]
        total = np.maximum(np.bincount(of, weights=w, minlength=n), 1e-30)[:, None]
        mean, square = np.zeros(n * p.dims), np.zeros(n * p.dims)
        for i in range(p.nonzero):
            cell = of * p.dims + places[at, i]
            mean += np.bincount(cell, weights=w * signs[at, i], minlength=n * p.dims)
            square += np.bincount(cell, weights=w, minlength=n * p.dims)
        mean, square = mean.reshape(n, p.dims) / np.sqrt(p.nonzero) / total, square.reshape(n, p.dims) / p.nonzero / total
        inside = np.flatnonzero(word[at] >= 0)
        context, context2 = np.zeros((n, p.dims)), np.zeros((n, p.dims))
        if len(inside):
            row, starts = np.unique(of[inside], return_index=True)
            for begin, end, i in zip(starts.tolist(), [*starts[1:].tolist(), len(inside)], row.tolist(), strict=True):
                own = at[inside[begin:end]]
                v, own_w = self.words.context[word[own]], weight[own].astype(np.float32)
                context[i] = own_w @ v
                np.multiply(v, v, out=v)
                context2[i] = own_w @ v
        context, context2 = context / total, context2 / total
        deviation = np.sqrt(np.maximum(np.concatenate([context2, square], axis=1) - np.concatenate([context, mean], axis=1) ** 2, 0))
        return np.concatenate([context, mean, deviation], axis=1).astype(np.float32)


@dataclass
class Network:
    """Two layers; the probability of label 1 is sigmoid(logit / temperature)."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray, p: Params) -> Network:
    """Adam on the logistic loss; the temperature minimises the loss of the rows kept apart."""
    width = x.shape[1]
    rng = np.random.default_rng(p.seed)
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, p.hidden)), np.zeros(p.hidden), np.zeros(p.hidden), 0.0)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        net.b2 = float(np.log(share / (1 - share)))
        return net
    if not (~apart).any() or y[~apart].min() == y[~apart].max():
        apart = np.zeros(len(y), dtype=bool)
    train_x, train_y = x[~apart].astype(np.float64), y[~apart].astype(np.float64)
    net.shift, net.scale = train_x.mean(axis=0), train_x.std(axis=0) + 1e-3
    net.w1 = rng.normal(0, 1 / np.sqrt(width), (width, p.hidden))
    net.w2 = rng.normal(0, 1 / np.sqrt(p.hidden), p.hidden)
    state = {k: [np.zeros_like(np.asarray(getattr(net, k), dtype=np.float64)) for _ in range(2)] for k in ("w1", "b1", "w2", "b2")}
    z, step = (train_x - net.shift) / net.scale, 0
    for _ in range(p.epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            h = np.tanh(z[rows] @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - train_y[rows]) / len(rows)
            back = np.outer(error, net.w2) * (1 - h * h)
            grads = {"w1": z[rows].T @ back + 1e-4 * net.w1, "b1": back.sum(axis=0), "w2": h.T @ error + 1e-4 * net.w2, "b2": error.sum()}
            step += 1
            for k, g in grads.items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                setattr(net, k, getattr(net, k) - 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    if apart.any():
        logits, labels = net.logits(x[apart]), y[apart]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, -np.where(labels == 1, 1, -1) * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def train(docs: DataFrame, labels: DataFrame, held_out, p: Params) -> tuple[Words, Network]:
    """Word vectors of all docs (id, text) and a network from the labels (id, label); held_out: a column over id."""
    # Few ids first, then their texts: a top-k over ids and labels, at most most_labelled rows.
    rows = labels.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out).groupBy("id").agg(F.max("label").alias("label"))
    few = rows.withColumn("h", F.xxhash64("id", F.lit(p.seed))).orderBy("h", "id").limit(p.most_labelled).drop("h")
    sample = land(docs.join(F.broadcast(few), "id").select("id", F.col("label").cast("int").alias("label"), "text"), "quality-sample")
    vocabulary = vocabulary_of(sample, p)
    words = Words.of(vocabulary, *word_sums(docs, "text", vocabulary, p))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pool(shared.value, p)
        for part in slices(batches, 2):
            x = pool.rows(part.column(2))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "x"])

    got = sample.mapInArrow(run, "id long, label int, x binary").toPandas().sort_values(["id", "x"], ignore_index=True)
    discard(sample)
    x = np.frombuffer(b"".join(bytes(r) for r in got["x"]), dtype=np.float32).reshape(-1, 4 * p.dims)
    apart = np.array([zlib.crc32(f"t{i}".encode()) % 5 == 0 for i in got["id"]], dtype=bool)
    return words, fit(x, got["label"].to_numpy(dtype=np.int64), apart, p)


def score(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id", p: Params = Params()) -> DataFrame:
    """doc_id, score, predicted for every row of docs. held_out: a condition over column `id` of rows never trained on."""
    docs = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    words, net = train(docs, pick(labels, id=label_id, label=label_col), held_out, p)
    shared = docs.sparkSession.sparkContext.broadcast((words, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, net = shared.value
        pool = Pool(words, p)
        for part in slices(batches, 1, 2_000_000):
            s = net.scores(pool.rows(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array((s >= p.threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, score double, predicted int")
