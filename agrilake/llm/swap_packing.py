"""Packing of documents into token sequences: best fit, then swap-based local search.

Documents become pieces: one each, or full pieces after a shorter first one where a document is longer than a sequence.
Pieces are packed in two rounds. First every task packs what it reads, in runs of a bounded number of pieces: best fit
in descending order, then local search. What is left in underfull bins is dealt to groups by a hash and packed again.
Only piece records move, never texts or ids.

Local search takes the emptiest bin and tries to get rid of its pieces: a piece moves into a bin with room for it, or is
exchanged for a smaller one, or for two that are smaller together. Every step is one that raises the sum of squared
fills, so it ends; emptied bins disappear.

Cases: a null or empty text is one piece holding the end id; equal rows are packed one by one; without rows the result
is empty; very long texts are tokenized whole and cut into as many pieces as they need; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored
from agrilake.llm.tokens import REMEMBERED, TOGETHER, encoder_of

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces packed together in the first round and, about, in the second.
RUN, GROUP = 50_000, 4_000


class _Bins:
    """Bins by free room; a bit for every room that some bin has."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.rooms = 0

    def place(self, at: int, fill: int) -> None:
        old = self.capacity - self.fill[at]
        self.by_room[old].discard(at)
        if not self.by_room[old]:
            self.rooms &= ~(1 << old)
        self.fill[at] = fill
        self.by_room[self.capacity - fill].add(at)
        self.rooms |= 1 << (self.capacity - fill)

    def open(self) -> int:
        self.items.append([])
        self.fill.append(0)
        self.by_room[self.capacity].add(len(self.fill) - 1)
        self.rooms |= 1 << self.capacity
        return len(self.fill) - 1

    def tightest(self, length: int, but: int = -1) -> int:
        """A bin with the least room that is at least `length`, or -1."""
        rooms = self.rooms >> length << length
        while rooms:
            room = (rooms & -rooms).bit_length() - 1
            for at in self.by_room[room]:
                if at != but and self.fill[at]:
                    return at
            rooms &= rooms - 1
        return -1

    def take(self, at: int, length_of: np.ndarray, out: list[int], into: list[int]) -> None:
        for x in out:
            self.items[at].remove(x)
        self.items[at].extend(into)
        self.place(at, self.fill[at] - sum(int(length_of[x]) for x in out) + sum(int(length_of[x]) for x in into))


def best_fit(lengths: np.ndarray, capacity: int) -> _Bins:
    bins = _Bins(capacity)
    for x in np.argsort(-lengths, kind="stable"):
        n = int(lengths[x])
        at = bins.tightest(n)
        if at < 0:
            at = bins.open()
        bins.items[at].append(int(x))
        bins.place(at, bins.fill[at] + n)
    return bins


def local_search(bins: _Bins, lengths: np.ndarray, work: int = 200, patience: int = 8) -> None:
    """Empties bins, the emptiest first.

    `work` bounds the steps spent on one bin; after `patience` bins in a row that could not be emptied, fuller ones,
    which are harder to empty, aren't tried.
    """
    queue = sorted((b for b, f in enumerate(bins.fill) if 0 < f < bins.capacity), key=lambda b: bins.fill[b])
    room = sum(bins.capacity - bins.fill[b] for b in queue)
    failed = 0
    for source in queue:
        if failed == patience or room < bins.capacity:  # less than a whole bin of room: nothing can be emptied
            return
        for _ in range(work):
            if not bins.fill[source] or not _improve(bins, lengths, source):
                break
        if bins.fill[source]:
            failed += 1
        else:
            failed, room = 0, room - bins.capacity


def _improve(bins: _Bins, lengths: np.ndarray, source: int) -> bool:
    """One move or exchange that fills another bin at the source's cost."""
    own = sorted(bins.items[source], key=lambda x: -lengths[x])
    for x in own:  # move
        target = bins.tightest(int(lengths[x]), but=source)
        if target >= 0:
            bins.take(source, lengths, [x], [])
            bins.take(target, lengths, [], [x])
            return True
    # underfull bins with the least room first, so that an exchange can fill one to the brim
    targets, rooms = [], bins.rooms & ~(1 << bins.capacity) & ~1
    while rooms and len(targets) < 48:
        room = (rooms & -rooms).bit_length() - 1
        targets += [b for b in islice(bins.by_room[room], 4) if b != source and bins.fill[b] >= bins.fill[source]]
        rooms &= rooms - 1
    best: tuple[int, int, list[int], list[int]] | None = None
    for target in targets:
        room = bins.capacity - bins.fill[target]
        theirs = sorted(bins.items[target], key=lambda y: -lengths[y])
        # one for one, one for two of the target's, two of the source's for one
        swaps = [([x], [y]) for x in own for y in theirs]
        swaps += [([x], list(two)) for two in combinations(theirs[:24], 2) for x in own]
        swaps += [(list(two), [y]) for two in combinations(own[:24], 2) for y in theirs]
        for give, get in swaps:
            gain = int(sum(lengths[x] for x in give)) - int(sum(lengths[y] for y in get))
            if 0 < gain <= room and (best is None or gain > best[0]):
                best = (gain, target, give, get)
        if best and best[0] == room:
            break
    if best is None:
        return False
    _, target, give, get = best
    bins.take(source, lengths, give, get)
    bins.take(target, lengths, get, give)
    return True


def packed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin (numbered from 0) and place in it of every piece."""
    bins = best_fit(lengths, capacity)
    local_search(bins, lengths)
    bin_of, offset, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for items in bins.items:
        at = 0
        for x in items:
            bin_of[x], offset[x] = number, at
            at += int(lengths[x])
        number += bool(items)
    return bin_of, offset


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, remembered: int = REMEMBERED, together: int = TOGETHER
) -> DataFrame:
    """Every document's ids, end id last, as pieces of at most `capacity` ids.

    A worker remembers words in `remembered` bytes and cuts about `together` bytes of texts at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, joined=True, remembered=remembered, together=together)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows: list[tuple] = []
            coded = encoder.encode_column(batch.column("text"))
            for name, one in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                ids = np.concatenate([one, end])
                first = len(ids) % capacity
                starts = [0] * bool(first) + list(range(first, len(ids), capacity))
                for piece, start in enumerate(starts):
                    until = starts[piece + 1] if piece + 1 < len(starts) else len(ids)
                    rows.append((name, piece, start, until - start, zlib.crc32(ids[start:until])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """sequence_id and offset for every piece, in two rounds."""
    kept = [f.name for f in cut.schema.fields]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)

    def first_round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, held, rows = TaskContext.get().partitionId() << 36, [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= RUN:
                yield (done := _numbered(pd.concat(held), base, capacity))
                base, held, rows = int(done["sequence_id"].max()) + 1, [], 0
        if rows:
            yield _numbered(pd.concat(held), base, capacity)

    schema = f"{kinds}, sequence_id long, offset long, fill long"
    first = stored(stored(cut, "pieces").mapInPandas(first_round, schema), "packed-once")
    left = first.where(F.col("fill") < capacity)
    groups = max(1, -(-left.count() // GROUP))
    if left.isEmpty():
        return first.select(*kept, "sequence_id", "offset")

    def second_round(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _numbered(rows[kept], (1 << 62) + (int(key[0]) << 36), capacity)[[*kept, "sequence_id", "offset"]]

    dealt = left.withColumn("__group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    again = dealt.groupBy("__group").applyInPandas(second_round, f"{kinds}, sequence_id long, offset long")
    full = first.where(F.col("fill") == capacity).select(*kept, "sequence_id", "offset")
    return full.unionByName(again.select(*kept, "sequence_id", "offset"))


def _numbered(rows: pd.DataFrame, base: int, capacity: int) -> pd.DataFrame:
    lengths = rows["length"].to_numpy(np.int64)
    bin_of, offset = packed(lengths, capacity)
    return rows.assign(sequence_id=base + bin_of, offset=offset, fill=np.bincount(bin_of, lengths).astype(np.int64)[bin_of])


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, remembered: int = REMEMBERED, together: int = TOGETHER
) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity, end_id, remembered, together), capacity)
