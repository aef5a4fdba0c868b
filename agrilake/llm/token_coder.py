"""Token ids in compressed, checksummed blocks: an adaptive context-mixing range coder.

A block holds the ids of whole documents and can be read alone: all models start anew with it. Its ids are cut into
lanes, which take their steps together as numpy vectors and learn into common models:

- order 0: counts of all ids so far, turned into cumulative frequencies again whenever enough new ids have come;
- order 1: for the id before, an id that followed it, with a confidence that hits raise and misses lower;
- order 2: the same for the two ids before, in a hashed table.

Each confidence level has a measured hit rate. The three predictions are mixed into one distribution with those rates
as weights: P(id) = w2 [id = guess2] + w1 [id = guess1] + w0 P0(id). Each lane is a range coder by an asymmetric numeral
system: a 64-bit state takes the id's interval in the distribution, and all lanes share one row of 32-bit words. Such a
coder writes from the last step to the first and reads from the first to the last.

Models learn after 1, 2, 4, 8 and 16 steps, then after every 16, from all steps since. So the writer, who knows all ids,
finds the intervals of many steps at once. Reader and writer learn alike, so the file holds nothing but the codes.

Cases: an empty document has only its end id; without rows nothing is written and the result is empty; null ids of
documents sort first; documents with equal ids keep a fixed order by their text; long documents make a long block, as
blocks never cut a document; other columns are ignored. A damaged block raises ValueError.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrilake.llm.scratch import new_path
from agrilake.llm.tokens import encoder_of

MAGIC = b"AMC2"
HEAD = struct.Struct("<4sIIIIII")  # magic, vocabulary, ids, documents, lanes, checksum of ids, checksum of the rest
SHARES = 12  # bits of the mixing weights
COUNTS = 20  # bits of the order-0 frequencies; with the weights' bits they fill a word
LEAST = 64  # of 4096: weight that order 0 always keeps
LEVEL = 3  # bits of a confidence
LEVELS = 1 << LEVEL
SLOTS = 18  # bits of the order-2 table's index
LANES = 4096
STEPS = 16  # between two updates of the models
REMEMBERED, TOGETHER = 192 << 20, 6 << 20  # bytes of words that a worker remembers, of texts that it cuts at a time
WORD = np.uint64(32)
LEAST_STATE = np.uint64(1 << 32)
#: By twice the confidence, and one for a hit: whether the guess is given up, and else what is added to the confidence.
GIVEN_UP = np.arange(2 * LEVELS) < 3
GIVEN_UP[1] = False
CHANGE = np.array([x for s in range(LEVELS) for x in (s // 2 - s, min(s + 1, LEVELS - 1) - s)], np.int64)


class _Models:
    """Everything that the reader and the writer learn alike. An entry of the orders 1 and 2 is a guess over its confidence."""

    def __init__(self, vocabulary: int, lanes: int, reads: bool = False):
        self.v, self.reads = vocabulary, reads
        self.counts = np.zeros(vocabulary, np.int64)
        self.seen, self.due = 0, 0
        self.after1 = np.zeros(vocabulary, np.int32)
        self.after2 = np.zeros(1 << SLOTS, np.int32)
        # hits and tries of each level; untouched entries have no say
        self.hits = np.outer([1, 1], np.arange(LEVELS) * 2.0)
        self.tries = np.full((2, LEVELS), 2.0 * LEVELS)
        self.last1 = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)
        self._weigh()

    def mix(self, n: int) -> None:
        """Predictions and weights for the next id of the first n lanes."""
        self.predict(self.last1[:n], self.last2[:n])

    def predict(self, before: np.ndarray, earlier: np.ndarray) -> None:
        """Predictions and weights for the ids after `before`, which are after `earlier`."""
        if self.seen >= self.due:
            self._count_again()
        self.p1 = before
        self.slot = ((before * 0x9E3779B1 ^ earlier * 0x85EBCA6B) >> 7) & ((1 << SLOTS) - 1)
        self.e1, self.e2 = self.after1.take(before).astype(np.int64), self.after2.take(self.slot).astype(np.int64)
        self.g1, self.g2 = self.e1 >> LEVEL, self.e2 >> LEVEL
        levels = (self.e2 & (LEVELS - 1)) << LEVEL | self.e1 & (LEVELS - 1)
        self.w0, self.w1, self.w2 = (w.take(levels) for w in self.weights)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, size = self.w0 * self.below.take(ids), self.w0 * self.each.take(ids)
        low += self.w1 * (self.g1 < ids)
        low += self.w2 * (self.g2 < ids)
        size += self.w1 * (self.g1 == ids)
        size += self.w2 * (self.g2 == ids)
        return low, size

    def find(self, at: np.ndarray) -> np.ndarray:
        """Ids whose intervals hold the values `at`."""
        # a guess's weight lies before its share of order 0; without both weights, only order 0's shares are left
        past = at - self.w0 * self.below.take(self.g1)
        past -= self.w2 * (self.g2 < self.g1)
        at = at - np.minimum(np.maximum(past, 0), self.w1)
        past = at - self.w0 * self.below.take(self.g2)
        at -= np.minimum(np.maximum(past, 0), self.w2)
        # both are far below 2^53, so the quotient is never rounded up to the next whole number
        return self.holder.take((at / self.w0).astype(np.int64)).astype(np.int64)

    def learn(self, ids: np.ndarray, p1: np.ndarray, slot: np.ndarray, e1: np.ndarray, e2: np.ndarray) -> None:
        """From ids and what `predict` found for them; of equal contexts, the last one counts."""
        # twice the confidence, and one for a hit
        outcome1, outcome2 = ((e & (LEVELS - 1)) * 2 + (e >> LEVEL == ids) for e in (e1, e2))
        found = np.bincount(outcome2 * 2 * LEVELS + outcome1, minlength=4 * LEVELS**2).reshape(LEVELS, 2, LEVELS, 2)
        # order 1 matters where order 2 missed
        for order, of in enumerate((found.sum(axis=(2, 3)), found[:, 0].sum(axis=0))):
            self.tries[order] += of.sum(axis=1)
            self.hits[order] += of[:, 1]
        fresh = (ids << LEVEL) + 1
        for table, at, entry, outcome in ((self.after2, slot, e2, outcome2), (self.after1, p1, e1, outcome1)):
            table[at] = np.where(GIVEN_UP.take(outcome), fresh, entry + CHANGE.take(outcome))
        self.counts += np.bincount(ids, minlength=self.v)
        self.seen += len(ids)
        self._weigh()

    def _weigh(self) -> None:
        """The three weights for every pair of confidences."""
        rate = self.hits / self.tries
        w2 = np.minimum(4000 * rate[0], 3900).astype(np.int64)[:, None]
        w1 = (np.minimum(rate[1], 0.97)[None, :] * (4096 - LEAST - w2)).astype(np.int64)
        w0 = 4096 - w1 - w2
        self.weights = w0.ravel(), (w1 << COUNTS).ravel(), (np.broadcast_to(w2, w1.shape) << COUNTS).ravel()

    def _count_again(self) -> None:
        spare = (1 << COUNTS) - self.v
        each = 1 + self.counts * spare // max(1, self.seen) if self.seen else np.full(self.v, (1 << COUNTS) // self.v)
        each[int(each.argmax())] += (1 << COUNTS) - int(each.sum())
        self.each = each
        self.below = np.concatenate([[0], np.cumsum(each)])
        if self.reads:  # the id that holds each of the frequencies' places
            self.holder = np.repeat(np.arange(self.v, dtype=np.uint16 if self.v <= 1 << 16 else np.int32), each)
        self.due = self.seen + min(max(1024, self.seen), 1 << 16)


def _lanes(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids."""
    steps = -(-n // max(1, min(LANES, n // 256)))
    return (-(-n // steps), steps) if n else (0, 0)


def _rounds(n: int, lanes: int, steps: int) -> Iterator[tuple[int, int, int]]:
    """First and last step between two updates, and how many lanes take them: the last lane may end before the others."""
    ends = n - (lanes - 1) * steps
    start = 0
    while start < steps:
        until = min(steps, start + min(STEPS, max(1, start)))
        if start < ends < until:
            until = ends
        yield start, until, lanes if start < ends else lanes - 1
        start = until


def encode_block(documents: list[np.ndarray], vocabulary: int) -> bytes:
    """One block of whole documents, each an array of ids below `vocabulary`."""
    if not 0 < vocabulary <= 1 << 18:
        raise ValueError("the vocabulary must be below 262145")
    ids = np.concatenate([np.zeros(0, "<u4"), *documents]).astype("<u4")
    if len(ids) and int(ids.max()) >= vocabulary:
        raise ValueError("an id lies beyond the vocabulary")
    n = len(ids)
    lanes, steps = _lanes(n)
    # two steps of zeros stand before the first
    table = np.zeros((steps + 2, lanes), np.int64)
    padded = np.zeros(lanes * steps, np.uint32)
    padded[:n] = ids
    table[2:] = padded.reshape(lanes, steps).T
    models = _Models(max(2, vocabulary), lanes)
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    for start, until, active in _rounds(n, lanes, steps):
        now = table[start + 2 : until + 2, :active].ravel()
        models.predict(table[start + 1 : until + 1, :active].ravel(), table[start:until, :active].ravel())
        low, size = models.interval(now)
        taken += zip(low.view(np.uint64).reshape(-1, active), size.view(np.uint64).reshape(-1, active), strict=True)
        models.learn(now, models.p1, models.slot, models.e1, models.e2)
    states, words = np.full(lanes, LEAST_STATE), [np.zeros(0, "<u4")]
    for low, size in reversed(taken):
        state = states[: len(low)]
        full = np.flatnonzero(state >= size << WORD)
        over = state[full]
        words.append(over.astype("<u4"))
        state[full] = over >> WORD
        times = state // size
        state += low + times * (LEAST_STATE - size)
    body = np.array([len(d) for d in documents], "<u4").tobytes() + states.astype("<u8").tobytes()
    body += np.concatenate(words[::-1]).tobytes()
    head = HEAD.pack(MAGIC, vocabulary, n, len(documents), lanes, zlib.crc32(ids.tobytes()), zlib.crc32(body))
    return head + body


def decode_block(block: bytes) -> list[np.ndarray]:
    """Documents of a block; ValueError if a checksum does not agree."""
    if len(block) < HEAD.size:
        raise ValueError("the block is cut off")
    magic, vocabulary, n, count, lanes, of_ids, of_body = HEAD.unpack_from(block)
    body = block[HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != of_body:
        raise ValueError("the block is damaged")
    if _lanes(n)[0] != lanes:
        raise ValueError("the block is damaged")
    steps = _lanes(n)[1]
    lengths = np.frombuffer(body, "<u4", count)
    states = np.frombuffer(body, "<u8", lanes, 4 * count).astype(np.uint64)
    words, read = np.frombuffer(body, "<u4", -1, 4 * count + 8 * lanes).astype(np.uint64), 0
    table = np.zeros((steps, lanes), np.uint32)
    models = _Models(max(2, vocabulary), lanes, reads=True)
    for start, until, active in _rounds(n, lanes, steps):
        state = states[:active]
        met = np.empty((5, until - start, active), np.int64)
        for step in range(start, until):
            models.mix(active)
            at = state.view(np.int64) & 0xFFFFFFFF
            now = models.find(at)
            low, size = models.interval(now)
            state >>= WORD
            state *= size.view(np.uint64)
            state += (at - low).view(np.uint64)
            empty = np.flatnonzero(state < LEAST_STATE)
            state[empty] = state[empty] << WORD | words[read : read + len(empty)]
            read += len(empty)
            table[step, :active] = now
            for row, found in zip(met, (now, models.p1, models.slot, models.e1, models.e2), strict=True):
                row[step - start] = found
            models.last2[:active] = models.last1[:active]
            models.last1[:active] = now
        models.learn(*met.reshape(5, -1))
    ids = table.T.reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != of_ids or int(lengths.sum()) != n:
        raise ValueError("the block is damaged")
    return np.split(ids, np.cumsum(lengths)[:-1]) if count else []


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = 1 << 20) -> None:
    """Encodes every whole text and writes the blocks below `path`, in ascending order of doc_id.

    A row is a block: its range partition, the ids before it there, its documents' doc_ids and its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, joined=False, remembered=REMEMBERED, together=TOGETHER)
        end = np.array([end_id], "<u4")
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        part, before, number = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            values = [[part], [number], [before], [size], [names], [encode_block(held, vocabulary)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, TYPES.values(), strict=True)], list(TYPES)
            )

        for batch in batches:
            texts = encoder.encode_column(batch.column("text"))
            for name, coded in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                names.append(name)
                held.append(np.concatenate([coded, end]))
                size += len(held[-1])
                if size >= block_ids:
                    yield row()
                    before, number, size, names, held = before + size, number + 1, 0, [], []
        if held:
            yield row()

    TYPES = {
        "part": pa.int32(),
        "block": pa.int32(),
        "before": pa.int64(),
        "n_ids": pa.int64(),
        "doc_ids": pa.list_(pa.int64()),
        "bytes": pa.binary(),
    }
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    schema = "part int, block int, before long, n_ids long, doc_ids array<long>, bytes binary"
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the blocks' bytes."""
    blocks = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, names, data in zip(*(batch.column(c) for c in ("part", "before", "doc_ids", "bytes")), strict=True):
                documents = decode_block(data.as_py())
                lengths = np.array([len(d) for d in documents], np.int64)
                starts = before.as_py() + np.cumsum(lengths) - lengths
                sums = [zlib.crc32(d.tobytes()) for d in documents]
                columns = [pa.array([part.as_py()] * len(sums), pa.int32()), pa.array(names.as_py(), pa.int64())]
                columns += [pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    # One row per range partition: as many as the writing job had tasks.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    read = blocks.select("part", "before", "doc_ids", "bytes")
    decoded = read.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    found = decoded.join(F.broadcast(firsts), "part")
    return found.select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, block_ids: int = 1 << 20) -> DataFrame:
    spark = docs.sparkSession
    path = new_path(spark, "token-blocks")
    write_blocks(docs, path, tokenizer, end_id, block_ids)
    return read_blocks(spark, path)
