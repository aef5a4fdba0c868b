"""Substring deduplication: windows of words that start earlier too, by compressed FM-indexes over shards of the corpus.

Dealing. A window of 20 words belongs to the least hash of its 16 inner runs of five words, its anchor. Equal windows have
equal anchors, and neighbouring windows mostly share one, so a text falls into segments: at most 16 windows, 35 words,
of one place of an anchor, in which no window occurs twice. A shard gets all segments of its anchors, which is all that their windows must be compared with; work grows
with the input, not with shards times documents.

1. Anchors are counted. Segments whose anchor occurs once are done: a bit map of the repeated ones, of bounded size, spares
   sending them (a false bit only costs traffic). Windows of an anchor with very many different segments belong to the
   hash of all their words instead, and are counted again. So a phrase that a third of all documents share doesn't fill a shard.
2. Map tasks send every distinct segment with its earliest place. All other places of the same segment are repeats.
3. A shard numbers its words, sorts the suffixes of its segments, and keeps the Burrows-Wheeler transform as a wavelet
   matrix of packed bits, with the borders of suffixes that share 19 and 20 words. Segments are streamed through it from
   the right, many at once: a backward step extends the match by one word, a match at two places or more is a repeat, and
   at 20 words the window's earliest place is read from its range; the match is then cut back to 19 words and goes on.
4. The intervals come back to their documents, whose other words are kept.

A window is a repeat if an equal one has a smaller (doc_id, start).

Cases: null and empty texts and such of fewer words than a window lose nothing; rows of one doc_id count as one document,
so that equal windows at the same start of such rows both stay; rows without a doc_id come after all others, as one document; equal rows
have equal results; an empty table gives an empty result; other columns, whatever their names, are left out; long
texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

WORDS = 20  # of a window
GRAM = 5  # words of an anchor
WINDOWS = WORDS - GRAM + 1  # windows of a segment at most
GROUP = 1 << 18  # bytes of text hashed at a time; a longer text makes a group of its own
HELD = 32 << 20  # bytes of segments a map task holds before it sends them
PER_SHARD = 30_000  # segments of a shard, about
BITS = 29  # of the bit map of repeated anchors at most: 64 MB
HOT = 1_000_000  # hot anchors at most: 8 MB
#: Different segments that make an anchor hot: a share of all, between these.
HOT_SEGMENTS = (1_000, 20_000)

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans_hash(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[b:e] for all spans, from running sums of a polynomial."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(len(values), _BASE))
    back = np.cumprod(np.full(len(values) + 1, _BACK))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers)])
    return _mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def joined_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single spaces, a space behind each; where they begin and end there; which bytes stayed."""
    data = np.frombuffer(text + b" ", np.uint8)
    blank = _BLANK[data]
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # the first blank behind a word stays
    joined = np.where(blank, np.uint8(32), data)[kept]
    end = np.flatnonzero(joined == 32)
    begin = np.concatenate([np.zeros(min(1, len(end)), np.int64), end[:-1] + 1])
    return joined.tobytes(), begin, end, kept


class Segments:
    """Segments of a group of texts: per segment its text, first word (in the group), number of windows, and anchor."""

    def __init__(self, texts: list[bytes], hot: np.ndarray):
        self.joined, self.begin, self.end, kept = joined_words(b"\n".join(texts))
        n = len(self.begin)
        self.hashes = np.empty(n, np.uint64)
        # hashed block by block, at words, so that sums take memory for a block only
        letters = np.frombuffer(self.joined, np.uint8)
        cuts = np.unique(np.searchsorted(self.begin, np.arange(0, len(letters) + GROUP, GROUP)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = self.begin[a], self.end[b - 1]
            block = letters[low:high].astype(np.uint64) + np.uint64(1)
            self.hashes[a:b] = _spans_hash(block, self.begin[a:b] - low, self.end[a:b] - low)
        sizes = np.array([len(t) + 1 for t in texts])
        stayed = np.cumsum(np.add.reduceat(kept, np.cumsum(sizes) - sizes, dtype=np.int64))
        self.first = np.append(0, np.searchsorted(self.end, stayed))  # each text's first word, and the end
        self._cut(self.hashes, hot)

    def _cut(self, words: np.ndarray, hot: np.ndarray) -> None:
        n = len(words)
        self.text = self.start = self.windows = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n < WORDS:
            return
        total = np.zeros(n - GRAM + 1, np.uint64)
        for k in range(GRAM):
            total = total * _BASE + words[k : n - GRAM + 1 + k]
        gram = _mixed(total)
        least, size = gram, 1
        while size < WINDOWS:  # least of 2, 4, 8, 16 neighbours
            step = min(size, WINDOWS - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        inside = np.zeros(n + 1, np.int64)
        windows = np.maximum(np.diff(self.first) - WORDS + 1, 0)
        np.add.at(inside, self.first[:-1], windows > 0)
        np.add.at(inside, self.first[:-1] + windows, -(windows > 0).astype(np.int64))
        starts = np.flatnonzero(np.cumsum(inside)[: len(least)])
        if not len(starts):
            return
        anchor = least[starts]
        leaves = gram[starts] == anchor  # the anchor's first place is the window's first word: the next window has another
        if len(hot):
            alone = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor)
            whole = np.zeros(len(alone), np.uint64)
            for k in range(WORDS):
                whole = whole * _BASE + words[starts[alone] + k]
            anchor[alone] = _mixed(whole)
            leaves[alone] = True
        text = np.searchsorted(self.first, starts, "right") - 1
        new = np.ones(len(starts), bool)
        new[1:] = leaves[:-1] | (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1) | (text[1:] != text[:-1])
        opens = np.flatnonzero(new)
        self.windows = np.diff(np.append(opens, len(starts)))
        self.text, self.start, self.anchor = text[opens], starts[opens], anchor[opens]

    def content(self) -> np.ndarray:
        return _spans_hash(self.hashes, self.start, self.start + self.windows + WORDS - 1)


def _grouped(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about GROUP bytes."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        if size and size + len(t) > GROUP:
            yield a, b
            a, size = b, 0
        size += len(t) + 1
    if a < len(texts):
        yield a, len(texts)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def anchor_counts(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(anchor, n) of anchors that occur at least twice; n: different segments, told apart within a task."""

    def counted(anchors: np.ndarray, contents: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((contents, anchors))
        anchors, contents = anchors[order], contents[order]
        opens = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        other = np.append(True, (anchors[1:] != anchors[:-1]) | (contents[1:] != contents[:-1]))
        different = np.add.reduceat(other.astype(np.int64), opens)
        several = np.minimum(np.diff(np.append(opens, len(anchors))), 2)
        names = ["anchor", "n"]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors[opens].view(np.int64)), pa.array(np.maximum(different, several).astype(np.int32))], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            texts = _texts(batch.column(0))
            for a, b in _grouped(texts):
                found = Segments(texts[a:b], hot)
                if len(found.anchor):
                    held.append((found.anchor, found.content()))
                    size += len(found.anchor)
                if size > 1_000_000:
                    yield counted(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            yield counted(*(np.concatenate(x) for x in zip(*held, strict=True)))

    found = docs.select(F.col("text").cast("binary")).mapInArrow(run, "anchor long, n int")
    return found.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > 1)


def _bit_map(anchors: DataFrame, bits: int) -> np.ndarray:
    """Bytes with the bit of every anchor set, by its last `bits` bits; put together by Spark, 2^bits bits in all."""
    place = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    parts = (
        anchors.select((place + 1).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for bucket, packed in parts.toLocalIterator():
        at = (bucket - 1) * len(packed)  # buckets begin at 1 and hold 32768 bits each
        out[at : at + len(packed)] = np.frombuffer(bytes(packed), np.uint8)[: len(out) - at]
    return out


_SENT = "shard int, doc_id long, row_hash long, start long, words long, windows int, content binary"
_SPANS = "doc_id long, row_hash long, start long, words long"
_NUMBERS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_NAMES = ["shard", "doc_id", "row_hash", "start", "words", "windows", "content"]


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NUMBERS, strict=True)], names=_NAMES)


def repeated_segments(docs: DataFrame, bit_map: np.ndarray, bits: int, hot: np.ndarray, shards: int) -> DataFrame:
    """Segments of anchors that may occur again, each once a task with its earliest place; the task's other places as spans.

    Spans (no content) go to any shard, so a hot segment's places are spread."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earliest: dict[bytes, tuple] = {}
        spans: list[list] = []
        out: list[tuple] = []
        size = 0

        def repeat(doc: tuple, start: int, end: int) -> None:
            if spans and spans[-1][0] is doc and spans[-1][1] <= start <= spans[-1][2]:
                spans[-1][2] = max(end, spans[-1][2])
            else:
                spans.append([doc, start, end])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            out.extend((s, d[1], d[2], a, None, w, c) for c, (d, a, s, w) in earliest.items())
            out.extend(((d[2] + a) % shards, d[1], d[2], a, b - a, None, None) for d, a, b in spans)
            for k in range(0, len(out), 20_000):
                yield _sent(out[k : k + 20_000])
            earliest.clear(), spans.clear(), out.clear()
            size = 0

        for batch in batches:
            texts = _texts(batch.column(1))
            docs_of = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for a, b in _grouped(texts):
                found = Segments(texts[a:b], hot)
                if not len(found.anchor):
                    continue
                low = found.anchor & mask
                again = np.flatnonzero(bit_map[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                if not len(again):
                    continue
                names = [((i is None, i or 0), i, h) for i, h in docs_of[a:b]]
                text, start, windows = found.text[again], found.start[again], found.windows[again]
                till = start + windows + WORDS - 1
                places = (start - found.first[text]).tolist()
                dealt = (found.anchor[again] % np.uint64(shards)).tolist()
                edges = zip(found.begin[start].tolist(), found.end[till - 1].tolist(), strict=True)
                joined = found.joined
                for t, at, s, w, (x, y) in zip(text.tolist(), places, dealt, windows.tolist(), edges, strict=True):
                    doc, content = names[t], joined[x:y]
                    before = earliest.get(content)
                    if before is None:
                        earliest[content] = (doc, at, s, w)
                        size += y - x + 200
                        continue
                    here, there = (doc[0], at), (before[0][0], before[1])
                    if here > there:
                        repeat(doc, at, at + w + WORDS - 1)
                    elif here < there:
                        repeat(before[0], before[1], before[1] + w + WORDS - 1)
                        earliest[content] = (doc, at, s, w)
                    elif doc[2] != before[0][2]:  # another row of the same doc_id: judged for itself
                        out.append((s, doc[1], doc[2], at, None, w, content))
                        size += y - x + 200
                if size + 100 * len(spans) > HELD:
                    yield from flush()
        if earliest or spans or out:
            yield from flush()

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), F.xxhash64("text"))
    return columns.mapInArrow(run, _SENT)


class WaveletMatrix:
    """Ranks of symbols in a sequence, from one packed bit a symbol and level and a count per 64 bits."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), "<u8")
            self.words.append(words)
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32))
            self.zeros.append(len(sequence) - int(counts.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        every = np.arange(symbols)
        self.origin = self._descend(every, np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[k][word] + np.bitwise_count(self.words[k][word] & below)
            place = np.where(symbol >> level & 1, self.zeros[k] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._descend(symbol, place) - self.origin[symbol]


def suffix_order(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Begins of the sorted suffixes, by doubling; every suffix must end at a symbol of its own."""
    bits = max(1, int(alphabet).bit_length())
    held = max(1, min(4, 63 // bits))
    n = len(symbols)
    key = np.zeros(n, np.int64)
    for k in range(held):
        key <<= bits
        key[: n - k] |= symbols[k:]
    order = np.argsort(key)
    ranked = key[order]
    opens = np.append(True, ranked[1:] != ranked[:-1])
    group = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    open_at = np.flatnonzero(~(opens & np.append(opens[1:], True)))  # places of groups with several members
    while len(open_at):
        members = order[open_at]
        key = rank[members] * (n + 1) + rank[members + held]
        inner = np.argsort(key)
        members, key = members[inner], key[inner]
        order[open_at] = members
        opens = np.append(True, key[1:] != key[:-1])
        group = open_at[np.maximum.accumulate(np.where(opens, np.arange(len(open_at)), 0))]
        rank[members] = group
        open_at = open_at[~(opens & np.append(opens[1:], True))]
        held *= 2
    return order


class FmIndex:
    """Segments of numbered words (1 and above), each ended by 0, behind one another in `text`.

    Holds a wavelet matrix of the Burrows-Wheeler transform, the smaller symbols' counts, and where suffixes stop sharing
    WORDS - 1 and WORDS words."""

    def __init__(self, text: np.ndarray, alphabet: int):
        n = len(text)
        ends = text == 0
        many = int(ends.sum())
        order = suffix_order(np.where(ends, np.cumsum(ends) - 1, text + (many - 1)), many + alphabet)
        self.n = n
        self.matrix = WaveletMatrix(text[order - 1], alphabet)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        alive = np.arange(1, n)
        for k in range(WORDS):
            a, b = text[order[alive - 1] + k], text[order[alive] + k]
            alive = alive[(a == b) & (a > 0)]
            if k == WORDS - 2:
                self.shorter = self._opens(alive)
        self.window = self._opens(alive)
        self.order = order

    def _opens(self, shared: np.ndarray) -> np.ndarray:
        border = np.ones(self.n, bool)
        border[shared] = False
        return np.append(np.flatnonzero(border), self.n)

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with the word before a match, from the match's ranges."""
        found = self.smaller[np.concatenate([word, word])] + self.matrix.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        return found[: len(word)], found[len(word) :]

    def shortened(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the first WORDS - 1 words of the suffixes at `low`."""
        k = np.searchsorted(self.shorter, low, "right") - 1
        return self.shorter[k], self.shorter[k + 1]

    def least(self, values: np.ndarray) -> np.ndarray:
        """Least of a value per text position over each range of equal windows, in order of the ranges."""
        return np.minimum.reduceat(values[self.order], self.window[:-1])


def repeated_windows(index: FmIndex, text: np.ndarray, begin: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, window, range) of all windows that occur twice or more, by matching statistics of the streamed segments.

    Words that all windows of a segment share are matched first; most segments end there."""
    last = begin + WORDS - 1
    core = begin + windows - 1
    which = np.arange(len(begin))
    at = last.copy()
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), index.n)
    passed = []
    while len(which):
        low, high = index.step(text[at], low, high)
        more = high - low > 1
        done = more & (at == core[which])
        passed.append(which[done])
        on = more & ~done
        which, at, low, high = which[on], at[on] - 1, low[on], high[on]
    which = np.sort(np.concatenate(passed)) if passed else which
    at = begin[which] + windows[which] + WORDS - 2
    depth = np.zeros(len(which), np.int64)
    low, high = np.zeros(len(which), np.int64), np.full(len(which), index.n)
    found: list[tuple[np.ndarray, ...]] = []
    while len(which):
        new_low, new_high = index.step(text[at], low, high)
        more = new_high - new_low > 1
        full = more & (depth == WORDS - 1)
        if full.any():
            found.append((which[full], at[full] - begin[which[full]], new_low[full]))
            new_low[full], new_high[full] = index.shortened(new_low[full])
        # without a match, the next windows end before the word that ended this one
        at = np.where(more, at - 1, at + depth - 1)
        depth = np.where(more, np.minimum(depth + 1, WORDS - 1), 0)
        low, high = np.where(more, new_low, 0), np.where(more, new_high, index.n)
        on = (at >= begin[which]) & (at + depth >= last[which])
        which, at, depth, low, high = which[on], at[on], depth[on], low[on], high[on]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    segment, window, place = (np.concatenate(x) for x in zip(*found, strict=True))
    return segment, window, np.searchsorted(index.window, place, "right") - 1


def _judged(table: pa.Table) -> pa.Table:
    """Spans of a shard's rows: those it was sent, and the repeated windows of its segments."""
    content = table.column("content").combine_chunks()
    if isinstance(content, pa.ChunkedArray):
        content = pa.concat_arrays(content.chunks)
    is_segment = np.asarray(pc.is_valid(content))
    ids = table.column("doc_id").to_pandas()
    unnamed = ids.isna().to_numpy()
    ids = ids.fillna(0).to_numpy().astype(np.int64)
    start = table.column("start").to_numpy()
    names = ["doc_id", "row_hash", "start", "words"]
    passed = table.filter(pa.array(~is_segment)).select(names)
    rows = np.flatnonzero(is_segment)
    if not len(rows):
        return passed
    coded = content.filter(pa.array(is_segment)).dictionary_encode()
    kind = coded.indices.to_numpy().astype(np.int64)
    split = pc.split_pattern(coded.dictionary.cast(pa.string()), " ")
    words = pc.list_flatten(split).dictionary_encode()
    lengths = pc.list_value_length(split).to_numpy().astype(np.int64)
    # one number for (doc_id, start), in its order
    order = np.lexsort((ids[rows], unnamed[rows]))
    sorted_ids, sorted_unnamed = ids[rows][order], unnamed[rows][order]
    new = np.append(False, (sorted_ids[1:] != sorted_ids[:-1]) | (sorted_unnamed[1:] != sorted_unnamed[:-1]))
    doc = np.empty(len(rows), np.int64)
    doc[order] = np.cumsum(new)
    age = (doc << 40) + start[rows]
    earliest = np.full(len(lengths), np.iinfo(np.int64).max)
    np.minimum.at(earliest, kind, age)

    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(begin[-1], np.int64)
    place = np.ones(begin[-1], bool)
    place[begin[1:] - 1] = False
    text[place] = words.indices.to_numpy().astype(np.int64) + 1
    segment_of = np.repeat(np.arange(len(lengths)), lengths + 1)
    index = FmIndex(text, len(words.dictionary) + 1)
    ages = earliest[segment_of] + (np.arange(len(text)) - begin[segment_of])
    first = index.least(ages)
    segment, window, range_of = repeated_windows(index, text, begin[:-1], lengths - WORDS + 1)
    late = first[range_of] < earliest[segment] + window
    segment, window = segment[late], window[late]
    order = np.lexsort((window, segment))
    segment, window = segment[order], window[order]
    # neighbouring windows make one span
    opens = np.flatnonzero(np.append(True, (segment[1:] != segment[:-1]) | (window[1:] != window[:-1] + 1))[: len(segment)])
    closes = np.append(opens[1:], len(segment)) - 1
    span_segment, span_from = segment[opens], window[opens]
    span_words = window[closes] - span_from + WORDS if len(opens) else span_from

    out_row, out_from, out_words = [], [], []
    is_first = age == earliest[kind]
    later = np.flatnonzero(~is_first)  # the same segment starts earlier: all of it is repeated
    out_row.append(later), out_from.append(np.zeros(len(later), np.int64)), out_words.append(lengths[kind[later]])
    heads = np.flatnonzero(is_first)
    a = np.searchsorted(span_segment, kind[heads], "left")
    many = np.searchsorted(span_segment, kind[heads], "right") - a
    which = np.repeat(a, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    out_row.append(np.repeat(heads, many)), out_from.append(span_from[which]), out_words.append(span_words[which])
    row, offset = rows[np.concatenate(out_row)], np.concatenate(out_from)
    judged = pa.table(
        {
            "doc_id": pa.array(ids[row], mask=unnamed[row]),
            "row_hash": table.column("row_hash").to_numpy()[row],
            "start": start[row] + offset,
            "words": np.concatenate(out_words),
        },
        schema=passed.schema,
    )
    return pa.concat_tables([passed, judged])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, start, words): intervals of words that windows with an earlier equal cover; they may overlap."""
    anchors = stored(anchor_counts(docs, np.zeros(0, np.uint64)), "fm-anchors")
    total, many = anchors.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    lowest, highest = HOT_SEGMENTS
    limit = min(max(total // 20_000, lowest), highest)
    hot = anchors.where(F.col("n") > limit).orderBy(F.desc("n"), "anchor").limit(HOT).select("anchor")
    hot_anchors = np.sort(np.array([r[0] for r in hot.collect()], np.int64).view(np.uint64))
    if len(hot_anchors):
        anchors = stored(anchor_counts(docs, hot_anchors), "fm-anchors")
        total, many = anchors.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bits = min(max(20, (16 * many).bit_length()), BITS)
    bit_map = _bit_map(anchors, bits)
    shards = max(1, -(-total // PER_SHARD))
    sent = repeated_segments(docs, bit_map, bits, hot_anchors, shards)
    return sent.groupBy("shard").applyInArrow(_judged, _SPANS)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, words), kept (UTF-8 bytes of the other words, one space between)."""
    spans = repeated_spans(docs).groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    spans = stored(spans, "fm-spans").select(F.col("doc_id").alias("span_id"), F.col("row_hash").alias("span_hash"), "spans")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), F.xxhash64("text").alias("row_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("row_hash") == F.col("span_hash"))
    joined = rows.join(spans, same, "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,words:long>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words, _, end, _ = joined_words(text.as_py() or b"")
                n_words.append(len(end))
                gone = 0
                if found:
                    change = np.zeros(len(end) + 1, np.int64)
                    np.add.at(change, [s["start"] for s in found], 1)
                    np.add.at(change, [s["start"] + s["words"] for s in found], -1)
                    stays = np.cumsum(change[:-1]) == 0
                    gone = len(end) - int(stays.sum())
                    letters = np.repeat(stays, np.diff(np.append(-1, end)))  # each word with the space behind it
                    words = np.frombuffer(words, np.uint8)[: len(letters)][letters].tobytes()
                n_removed.append(gone)
                kept.append(words[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch.column(2), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return joined.mapInArrow(run, schema)
