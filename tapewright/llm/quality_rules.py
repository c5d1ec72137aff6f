"""Quality rules: word and line counts, and in-document repetition from a suffix array.

A suffix array over the words of every document gives longest-common-prefix (LCP) intervals. A suffix whose longest
repeated prefix has at least `min_repeat_words` words starts an occurrence of a maximal repeated substring; the union of
those spans over the document's words is its covered fraction, the greatest length its longest repeat.

Defined cases. Null or empty text: no words, all counts 0, base rule fails. Repeated rows: judged one by one. Very long
texts: suffix arrays are built for whole texts, in slices of a record batch. Empty table: no rows. Further columns,
whatever their names, are not read by `judge` and pass unchanged through `keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, mix64, pick, slices, word_hashes

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    #: A document fails when more than this share of its words lies in repeated 3-word windows.
    max_repeat_window_percent: int = 50
    #: Only repeats of at least so many words count for the suffix-array verdict.
    min_repeat_words: int = 10
    max_covered_fraction: float = 0.50
    max_longest_fraction: float = 0.20
    #: A longest repeat of fewer words never decides alone.
    longest_floor_words: int = 25


def suffix_ranks(first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols (prefix doubling); end[i]: where i's document ends.

    Suffixes of different documents must differ in their first symbol. The last ranks are all different.
    """
    n = len(first)
    order = np.argsort(first)
    s = first[order]
    new = np.ones(n, dtype=bool)
    new[1:] = s[1:] != s[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(starts, sizes)
    active = order[np.repeat(sizes > 1, sizes)]
    small = np.int32 if n < 2**31 else np.int64  # a level is kept for each doubling
    levels, width = [rank.astype(small)], 1
    while len(active):
        after = active + width
        second = np.where(after < end[active], rank[np.minimum(after, n - 1)], -1)
        key = rank[active] * (n + 1) + second + 1
        by = np.argsort(key)
        active, key = active[by], key[by]
        old = rank[active]
        at = np.arange(len(active))
        new_key = np.ones(len(active), dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new_old = np.ones(len(active), dtype=bool)
        new_old[1:] = old[1:] != old[:-1]
        shift = np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_old, at, 0))
        rank = rank.copy()
        rank[active] = old + shift
        levels.append(rank.astype(small))
        sizes = np.diff(np.append(np.flatnonzero(new_key), len(active)))
        active = active[np.repeat(sizes > 1, sizes)]
        width *= 2
    return levels


def repeated_prefixes(levels: list[np.ndarray]) -> np.ndarray:
    """For each suffix, how many of its first symbols occur at another place too: the larger of its two LCPs."""
    n = len(levels[-1])
    order = np.empty(n, dtype=np.int64)
    order[levels[-1]] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(max(n - 1, 0), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        same = (a < n) & (b < n)
        same &= ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)]
        step = same.astype(np.int64) << level
        lcp += step
        a += step
        b += step
    longest = np.zeros(n, dtype=np.int64)
    longest[order[:-1]] = lcp
    longest[order[1:]] = np.maximum(longest[order[1:]], lcp)
    return longest


def covered(length: np.ndarray, least: int, width: np.ndarray | None = None) -> np.ndarray:
    """Which positions lie in the union of the spans [i, i + width[i]) over all i with length[i] >= least."""
    starts = np.flatnonzero(length >= least)
    turns = np.zeros(len(length) + 1, dtype=np.int64)
    turns[starts] += 1
    np.subtract.at(turns, starts + (least if width is None else width[starts]), 1)
    return np.cumsum(turns)[:-1] > 0


def measure(texts: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """All counts and the verdict of a few texts."""
    hashes, counts = word_hashes(texts)
    chars, symbols, dup = [], [], []
    for text in texts.cast(pa.binary()).to_pylist():
        raw = text or b""
        solid = raw.translate(None, WHITE)
        chars.append(len(solid) if solid.isascii() else len(solid.decode("utf-8", "surrogatepass")))
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip(WHITE)]
        dup.append(len(lines) - len(set(lines)))
    docs, total = len(texts), len(hashes)
    repeat3, in_repeats, longest = (np.zeros(docs, dtype=np.int64) for _ in range(3))
    if total:
        of = np.repeat(np.arange(docs), counts)
        end = np.repeat(np.cumsum(counts), counts)
        # Equal words of different documents are different symbols: the document's number is mixed in.
        length = repeated_prefixes(suffix_ranks(hashes ^ mix64(of.astype(np.uint64) + np.uint64(1)), end))
        repeat3 = np.bincount(of[covered(length, 3)], minlength=docs)
        in_repeats = np.bincount(of[covered(length, rules.min_repeat_words, length)], minlength=docs)
        np.maximum.at(longest, of, length)
    base_failed = (counts < rules.min_words) | (100 * repeat3 > rules.max_repeat_window_percent * counts)
    share = in_repeats / np.maximum(counts, 1)
    too_long = (longest >= rules.longest_floor_words) & (longest > rules.max_longest_fraction * counts)
    return {
        "n_words": counts, "word_chars": np.array(chars, dtype=np.int64), "n_symbols": np.array(symbols, dtype=np.int64),
        "n_dup_lines": np.array(dup, dtype=np.int64), "n_repeat_words": repeat3, "base_failed": base_failed,
        "covered_fraction": share, "longest_repeat": longest, "kept": ~(base_failed | (share > rules.max_covered_fraction) | too_long),
    }


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_fraction double, longest_repeat long, kept boolean"


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row of counts and the verdict for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            found = measure(part.column(1), rules)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in found.values())], names=["doc_id", *found])

    return pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            yield part.filter(pa.array(measure(part.column(at), rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
