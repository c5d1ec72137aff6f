"""The two-lane union as a stateful stream: one processor for each symbol, state in RocksDB without expiry.

State: identities seen and not yet released, identities released, each lane's cursor, the last id released. Every input row
gives a row (BUFFERED, DUPLICATE, CONFLICT, LATE_* or IGNORED), every release a row PUBLISHED; nothing is dropped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "sym bigint, id bigint, lane string, digest string, event string"


class UnionProcessor(StatefulProcessor):
    """clamps bound a lane's cursor from above; ids at or below floor are ignored; a lane of `excluded` (arrival from which on) no longer holds the watermark back.

    Besides the map of waiting rows a list of their ids is kept in order, so a batch reads the ids once and the rows only of ids below the new watermark or met again.
    """

    def __init__(self, lanes: tuple[str, ...] = ("P", "S"), floor: int | None = None, clamps: dict[str, int] | None = None, excluded: dict[str, int] | None = None) -> None:
        self.lanes, self.floor, self.clamps, self.excluded = lanes, floor, clamps or {}, excluded or {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState("waiting", "id bigint", "lane string, digest string")
        self.released = handle.getMapState("released", "id bigint", "digest string")
        self.cursors = handle.getMapState("cursors", "lane string", "next bigint")
        self.last = handle.getValueState("last", "id bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sym = key[0]
        last = self.last.get()[0] if self.last.exists() else -(2**62)
        cursor = {k[0]: v[0] for k, v in self.cursors.iterator()}
        heap = [k[0] for k in self.waiting.keys()]
        heapq.heapify(heap)
        known = set(heap)  # waiting now, in the state or added by this batch
        out, added = [], {}
        batch = pd.concat(list(rows), ignore_index=True)  # one symbol's rows of one batch, bounded by the source's admission
        if len(batch):
            for r in batch.sort_values("arrival").itertuples(index=False):
                i = int(r.id)
                if self.floor is not None and i <= self.floor:
                    out.append((sym, i, r.lane, r.digest, "IGNORED"))
                    continue
                if i <= last:
                    seen = self.released.getValue((i,)) if self.released.containsKey((i,)) else None
                    if seen is None:
                        self.released.updateValue((i,), (r.digest,))
                        out.append((sym, i, r.lane, r.digest, "LATE_UNKNOWN"))
                    else:
                        out.append((sym, i, r.lane, r.digest, "LATE_DUPLICATE" if seen[0] == r.digest else "LATE_CONFLICT"))
                    continue
                if i in known:
                    digest = (added[i] if i in added else self.waiting.getValue((i,)))[1]
                    out.append((sym, i, r.lane, r.digest, "DUPLICATE" if digest == r.digest else "CONFLICT"))
                else:
                    added[i] = (r.lane, r.digest)
                    known.add(i)
                    heapq.heappush(heap, i)
                    out.append((sym, i, r.lane, r.digest, "BUFFERED"))
                cursor[r.lane] = max(cursor.get(r.lane, 0), i + 1)
                counted = [x for x in self.lanes if x not in self.excluded or r.arrival < self.excluded[x]]
                mark = min((min(cursor.get(x, 0), self.clamps.get(x, 2**62)) for x in counted), default=0)
                while heap and heap[0] < mark:
                    ready = heapq.heappop(heap)
                    known.discard(ready)
                    if ready in added:
                        lane, digest = added.pop(ready)
                    else:
                        lane, digest = self.waiting.getValue((ready,))
                        self.waiting.removeKey((ready,))
                    self.released.updateValue((ready,), (digest,))
                    last = max(last, ready)
                    out.append((sym, ready, lane, digest, "PUBLISHED"))
        for i, v in added.items():
            self.waiting.updateValue((i,), v)
        for lane, n in cursor.items():
            self.cursors.updateValue((lane,), (n,))
        self.last.update((last,))
        yield pd.DataFrame(out, columns=["sym", "id", "lane", "digest", "event"])

    def close(self) -> None:
        pass


def stream_union(rows: DataFrame, processor: UnionProcessor | None = None) -> DataFrame:
    """rows: a stream of (sym, id, lane, digest, arrival). Needs the RocksDB state store provider."""
    return rows.groupBy("sym").transformWithStateInPandas(processor or UnionProcessor(), OUTPUT, "Append", "None")
