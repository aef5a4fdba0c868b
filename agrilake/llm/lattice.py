"""Likelihood of texts by a subword lattice, all segmentations summed.

A text is its words and an end. A word, with the sign of a word's beginning before it, is spelled by pieces of a public
vocabulary; each piece has a weight, its log10 probability, and the probability of a word is the sum over all its
segmentations, found by the forward recursion in log space. Characters without a piece are spelled by their bytes'
pieces, so every text has a probability. A training word also has an arc of its own over the whole lattice.

Weights come from the training texts only. Words are counted in Spark; the vocabulary's own order, or scores, segments
every distinct training word once, and the pieces are counted once per distinct word, as they have to spell words that
were never seen. An unseen word takes the mass of all words that were seen once (Good and Turing); the whole-word arcs
share the rest by their counts.

Words above a COMMON-th of all tokens are at most COMMON, and short: their figures are sent to every task. Of the rarer
ones, a task sends each distinct word once with a packed list of the documents that have it and how often. The word's
count meets that list by a join on the word, its lattice is walked there, once, and the sums come back packed, to the
chunk of documents (at most CHUNK) that sent the word.

Cases: a null text is an empty one, which still has its end; equal rows are scored one by one; a table without training
rows gives uniform weights; words of any length are read whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

BEGIN = "▁"
COMMON, COMMON_BYTES = 100_000, 48
REMEMBERED = 400_000  # distinct words a task holds before it sends them
CHUNK = 1 << 16  # documents of a chunk at most
_SUMS = np.dtype([("doc", "<u4"), ("figures", "<f8", 4)])
SUMMED = 1 << 21  # places of words added up at a time
LONGEST_PIECE = 32  # characters; longer pieces are not used
LN10 = math.log(10)


def words_of(text: str | None) -> list[str]:
    return [w.decode() for w in _words(text)]


def _words(text: str | None) -> list[bytes]:
    """Words in UTF-8; bytes are lower-cased only from A to Z, and cut only at ASCII's white space."""
    return text.encode().lower().split() if text else []


class Vocabulary:
    """Pieces of a sentencepiece file: the ordinary ones, and one for every byte."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        n = self.processor.get_piece_size()
        self.pieces = [self.processor.id_to_piece(i) for i in range(n)]
        self.byte = {i: int(self.pieces[i][3:5], 16) for i in range(n) if self.processor.is_byte(i)}
        self.usable = [
            i for i in range(n) if i in self.byte or not (self.processor.is_control(i) or self.processor.is_unknown(i))
        ]

    def count(self, words: list[str]) -> Counter[int]:
        """Pieces of the words' best segmentations; words with the sign of a beginning inside are left out."""
        found: Counter[int] = Counter()
        for ids in self.processor.encode([w for w in words if BEGIN not in w], num_threads=1):
            found.update(ids)
        return found


@dataclass
class Weights:
    """Natural logs of probabilities: of pieces by their text, and of single bytes."""

    piece: dict[str, float]
    byte: list[float]

    def __post_init__(self) -> None:
        # letter by letter; a node's weight stands under the empty text
        self.root: dict = {}
        for text, weight in self.piece.items():
            node = self.root
            for char in text:
                node = node.setdefault(char, {})
            node[""] = weight

    def __reduce__(self) -> tuple:
        return Weights, (self.piece, self.byte)


def weights_from(counts: dict[int, float], vocabulary: Vocabulary, smooth: float = 0.1) -> Weights:
    total = sum(counts.get(i, 0) for i in vocabulary.usable) + smooth * len(vocabulary.usable)
    log = {i: math.log((counts.get(i, 0) + smooth) / total) for i in vocabulary.usable}
    byte = [0.0] * 256
    for i, b in vocabulary.byte.items():
        byte[b] = log[i]
    pieces = {vocabulary.pieces[i]: p for i, p in log.items() if i not in vocabulary.byte}
    return Weights({t: p for t, p in pieces.items() if len(t) <= LONGEST_PIECE}, byte)


def word_log(word: str, weights: Weights) -> float:
    """Natural log of the summed probability of all segmentations of BEGIN + word."""
    text = BEGIN + word.replace(BEGIN, "\x00") if BEGIN in word else BEGIN + word
    n = len(text)
    root, exp, log1p = weights.root, math.exp, math.log1p
    alpha: list[float | None] = [None] * (n + 1)
    alpha[0] = 0.0
    for i in range(n):
        here = alpha[i]
        if here is None:
            continue
        spelled, node, j = False, root, i
        for char in text[i : i + LONGEST_PIECE]:
            node = node.get(char)
            if node is None:
                break
            j += 1
            weight = node.get("")
            if weight is not None:
                if j == i + 1:
                    spelled = True
                new, old = here + weight, alpha[j]
                if old is None:
                    alpha[j] = new
                elif new > old:
                    alpha[j] = new + log1p(exp(old - new))
                else:
                    alpha[j] = old + log1p(exp(new - old))
        if not spelled:  # no piece for this character: its bytes
            char = BEGIN if text[i] == "\x00" and word[i - 1] == BEGIN else text[i]
            new = here + sum(weights.byte[b] for b in char.encode("utf-8", "surrogatepass"))
            old = alpha[i + 1]
            alpha[i + 1] = new if old is None else max(old, new) + log1p(exp(-abs(old - new)))
    return alpha[n] or 0.0


def count_words(docs: DataFrame, trains: Column) -> DataFrame:
    """word and c, its occurrences in texts for which `trains` holds; words of other texts alone have 0.

    Map tasks add up their own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught: Counter[bytes] = Counter()
        other: set[bytes] = set()

        def rows() -> pa.RecordBatch:
            alone = list(other.difference(taught))
            words = pa.array([*taught, *alone], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([*taught.values(), *[0] * len(alone)], pa.int64())], ["word", "n"])

        for batch in batches:
            for text, teaches in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                (taught if teaches else other).update(_words(text.as_py()))
                if len(taught) + len(other) > REMEMBERED:
                    yield rows()
                    taught.clear(), other.clear()
        if taught or other:
            yield rows()

    shown = docs.select("text", F.coalesce(trains, F.lit(False)).alias("teaches"))
    return shown.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def spelled(words: DataFrame, shared) -> DataFrame:
    """word, c and spelled: the log10 probability of the word's lattice, walked once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            logs = [word_log(w, weights) / LN10 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(logs, pa.float64())], ["word", "c", "spelled"])

    return words.select("word", "c").mapInArrow(run, "word string, c long, spelled double")


def count_pieces(words: DataFrame, path: str) -> dict[int, float]:
    """How often the pieces spell the distinct words; one number per piece of the vocabulary comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held = Vocabulary(path), Counter()
        for batch in batches:
            held.update(vocabulary.count(batch.column("word").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int32()), pa.array(held.values(), pa.int64())], ["id", "n"])

    counted = words.select("word").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: float(r["n"]) for r in counted.collect()}


def score_texts(docs: DataFrame, trains: Column, path: str) -> DataFrame:
    """Base and lattice log10 probabilities of every row of `docs`; rows for which `trains` holds teach.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and lattice_score, which leaves the
    whole-word arcs out.
    """
    spark = docs.sparkSession
    counts = stored(count_words(docs, trains), "word-counts")
    ends = docs.where(trains).count()
    known = (F.col("c") > 0).cast("long")
    once = (F.col("c") == 1).cast("long")
    sums = counts.agg(F.sum("c").alias("n"), F.sum(known).alias("v"), F.sum(once).alias("once")).first()
    n, v = (sums["n"] or 0) + ends, (sums["v"] or 0) + (ends > 0)
    least = max(1, -(-n // COMMON))
    is_common = (F.col("c") >= least) & (F.octet_length("word") <= COMMON_BYTES)
    weights = weights_from(count_pieces(counts.where("c > 0"), path), Vocabulary(path))
    shared_weights = spark.sparkContext.broadcast(weights)
    # mass of words that weren't seen, by those seen once; at least one such
    unseen = min(0.5, ((sums["once"] or 0) + 1) / (n + 2))
    # the first COMMON words by count, if that many reach the limit: n / least is at most COMMON
    common = {r["word"]: (r["c"], r["spelled"]) for r in spelled(counts.where(is_common), shared_weights).collect()}
    shared = spark.sparkContext.broadcast(common)

    def figures(c: np.ndarray, spelled: np.ndarray) -> list[np.ndarray]:
        """Per word: 1 if known, base, score and lattice logs."""
        base = np.log10(c + 0.1) - math.log10(n + 0.1 * (v + 1))
        fresh = math.log10(unseen) + spelled
        seen = np.log10(np.maximum(c, 1) / max(n, 1)) + math.log10(1 - unseen)
        top = np.maximum(seen, fresh)
        either = top + np.log10(10 ** (seen - top) + 10 ** (fresh - top))
        return [(c > 0).astype(np.float64), base, np.where(c > 0, either, fresh), spelled]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per rarer word with its places, and a row per document with the sums of its common words."""
        common = shared.value
        index = {w.encode(): i for i, w in enumerate(common)}
        per_word = figures(*np.array(list(common.values()), np.float64).reshape(-1, 2).T)
        rare: dict[bytes, int] = {}
        who: list[int] = []  # number of each place's rare word
        what: list[int] = []  # its document in the chunk and how often, 16 bits each
        first = TaskContext.get().partitionId() << 36
        size = 0  # documents of the chunk

        def places() -> pa.RecordBatch:
            words = pa.array(rare.keys(), pa.binary()).cast(pa.string())
            order = np.argsort(np.array(who, np.uint32), kind="stable")
            sizes = np.bincount(np.array(who, np.uint32), minlength=len(rare))
            offsets = np.concatenate([[0], np.cumsum(4 * sizes)]).astype(np.int32)
            data = np.array(what, "<u4")[order]
            packed = pa.Array.from_buffers(pa.binary(), len(rare), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            rows = len(rare)
            columns = [words, pa.array(np.full(rows, first)), packed, pa.nulls(rows, pa.int32()), pa.nulls(rows, ids_type)]
            columns += [pa.nulls(rows, pa.bool_()), pa.nulls(rows, pa.int64()), *[pa.nulls(rows, pa.float64())] * 4]
            return pa.RecordBatch.from_arrays(columns, names)

        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                ids = batch.column("doc_id")
                ids_type = ids.type
                if size + batch.num_rows > CHUNK or len(rare) > REMEMBERED:
                    yield places()
                    first, size = first + size, 0
                    rare.clear(), who.clear(), what.clear()
                words_at: list[int] = []
                times_at: list[int] = []
                doc_sizes, n_tokens = [], []
                for text in batch.column("text"):
                    tokens = Counter(_words(text.as_py()))
                    n_tokens.append(tokens.total() + 1)
                    before = len(words_at)
                    for word, times in tokens.items():
                        k = index.get(word)
                        if k is not None:
                            words_at.append(k)
                            times_at.append(times)
                            continue
                        k = rare.setdefault(word, len(rare))
                        while times:  # more than 16 bits hold are several places
                            part = min(times, 0xFFFF)
                            who.append(k)
                            what.append(size << 16 | part)
                            times -= part
                    doc_sizes.append(len(words_at) - before)
                    size += 1
                doc = np.repeat(np.arange(len(doc_sizes)), doc_sizes)
                at, times = np.array(words_at, np.int64), np.array(times_at, np.float64)
                end = [float(ends > 0), math.log10(ends + 0.1) - math.log10(n + 0.1 * (v + 1)), math.log10(max(ends, 0.1) / max(n, 1))]
                sums = [np.bincount(doc, f[at] * times, len(doc_sizes)) + e for f, e in zip(per_word, [*end, end[2]], strict=True)]
                spots = np.arange(size - len(doc_sizes), size, dtype=np.int32)
                # such a word can't occur, as it has a space; it deals documents' own rows evenly
                own = pa.array([f" {first + k}" for k in spots.tolist()], pa.string())
                columns = [own, pa.array(np.full(len(spots), first)), pa.nulls(len(spots), pa.binary()), pa.array(spots)]
                columns += [ids, batch.column("held_out"), pa.array(n_tokens, pa.int64()), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, names)
        if rare:
            yield places()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents' own rows as they are; the words' places of a chunk, added up, in one row for many of them."""
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def summed() -> pa.RecordBatch:
            chunk, doc, times, c, spelled = (np.concatenate(x) for x in zip(*held, strict=True))
            # chunks' numbers are at least as far apart as they have documents
            _, at, place = np.unique(chunk + doc, return_index=True, return_inverse=True)
            sums = np.zeros(len(at), _SUMS)
            sums["doc"] = doc[at]
            for k, f in enumerate(figures(c, spelled)):
                sums["figures"][:, k] = np.bincount(place, f * times, len(at))
            chunk = chunk[at]
            cuts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            packed = [part.tobytes() for part in np.split(sums, cuts[1:])]
            columns = [pa.array(chunk[cuts]), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(cuts), t) for t in types[2:]]], out_names)

        for batch in batches:
            types = [batch.schema.field(name).type for name in out_names]
            is_own = batch.column("places").is_null()
            own = batch.filter(is_own)
            if own.num_rows:
                yield own.select(out_names)
            words = batch.filter(pc.invert(is_own))
            if not words.num_rows:
                continue
            packed = words.column("places")
            offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            data = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u4")
            row = np.repeat(np.arange(len(packed)), np.diff(offsets) // 4)
            doc, times = (data >> 16).astype(np.int64), (data & 0xFFFF).astype(np.float64)
            c, spelled = (words.column(name).to_numpy(zero_copy_only=False) for name in ("c", "spelled"))
            held.append((words.column("chunk").to_numpy()[row], doc, times, c[row].astype(np.float64), spelled[row]))
            size += len(row)
            if size > SUMMED:
                yield summed()
                held, size = [], 0
        if held:
            yield summed()

    def finish(table: pa.Table) -> pa.Table:
        """The documents of a chunk, with the sums of their rarer words added."""
        is_own = table.column("places").is_null()
        own, parts = table.filter(is_own), table.filter(pc.invert(is_own)).column("places")
        spot = own.column("spot").to_numpy()
        sums = np.frombuffer(b"".join(x.as_py() for x in parts), _SUMS)
        more = [np.bincount(sums["doc"], sums["figures"][:, k], CHUNK)[spot] for k in range(4)]
        columns = [own.column(name) for name in ("doc_id", "held_out", "n_tokens")]
        columns += [pa.array(own.column(name).to_numpy() + x) for name, x in zip(figure_names, more, strict=True)]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", *figure_names])

    figure_names = ["n_known", "base", "score", "lattice"]
    out_names = ["chunk", "places", "spot", "doc_id", "held_out", "n_tokens", *figure_names]
    names = ["word", *out_names]
    kind = dict(docs.dtypes)["doc_id"]
    figure_schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known double, base double, score double, lattice double"
    row_schema = f"chunk long, places binary, spot int, {figure_schema}"
    rows = docs.select("doc_id", "text", F.coalesce(~trains, F.lit(True)).alias("held_out"))
    scattered = rows.mapInArrow(scatter, f"word string, {row_schema}")
    met = scattered.join(spelled(counts.where(~is_common), shared_weights), "word", "left")
    # the sums of a chunk come in place of its words' places
    gathered = met.select("c", "spelled", *out_names).mapInArrow(gather, row_schema)
    total = gathered.groupBy("chunk").applyInArrow(finish, figure_schema)
    return total.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        F.col("lattice").alias("lattice_score"),
    )
