"""Similarity join on word shingles by adaptive multi-match prefixes, down to connected groups.

A text's set holds the 64-bit hashes of its runs of five words. Two sets link if their Jaccard similarity is at least
3/4. All shingles have one order: rare ones first. Two similar sets must then share a shingle within their prefixes of
n - ceil(3n/4) + 1, and m shingles within prefixes m - 1 longer. Every set chooses the m that its estimated cost
asks for, the postings of the prefix against the candidates they may lead to; a pair must share the smaller of both m.

1. Texts with equal sets form a class, which takes part once.
2. Shingles that only one class has come first in the order. A class with fewer than ceil(3n/4) others has nothing but
   them in its prefix, and links with nothing. To find these, map tasks send their shingles, packed, to buckets; a shingle
   that several classes of one batch share goes there once, so a common passage costs a record per batch. Buckets answer
   with the owners of shared shingles. Where there are copies, the classes that are left go through it once more, one row
   each, as a copy in another batch makes a class seem to share all it has. Only those then left get postings.
3. Candidates come from the prefix's lists. A list's members are first compared with a pivot, another one each round,
   which joins groups of near copies with one pair per member; lists all of whose members are joined are done. Pairs of
   members that are still apart are then compared throughout, if they share enough. So no link between groups is lost,
   and no list of copies is expanded into pairs.

Cases: null texts and such without words are linked with nothing; fewer than five words are one shingle; texts without a
doc_id get no component; repeated rows are in one class; an empty table gives an empty result; other columns are
ignored; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored
from agrilake.llm.tokens import forget_encoder

SIZE = 5
MOST = 4  # largest m
BATCH = 2000  # texts of a batch, fewer than 65535
STEP = 500  # texts that are read at a time
PER_BUCKET = 1_000_000  # shingles of a bucket, about
GROUP = 1 << 18  # bytes of text whose shingles are made at a time
PIVOTS = 8  # rounds with pivots at most, before all pairs that are left
#: Key tables of at most so many rows are sent to every task; larger ones are joined by a shuffle.
SENT = 200_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_NOBODY = 0xFFFF


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (with the end).

    Running sums are taken over blocks of words of about GROUP bytes, so that a long text takes memory for one block."""
    data = np.frombuffer(b"\n".join(t.lower() for t in texts) + b"\n", np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    hashes = np.empty(len(begin), np.uint64)
    cuts = np.unique(np.searchsorted(begin, np.arange(0, len(data) + GROUP, GROUP)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        low, high = begin[a], end[b - 1]
        sums = np.cumprod(np.full(high - low, _BASE))
        sums *= data[low:high].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sums, out=sums)])
        inverse = np.cumprod(np.full(high - low, _BACK))
        first, last = begin[a:b] - low, end[a:b] - low
        hashes[a:b] = _mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    sizes = np.array([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes)]))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted hashes of every text's distinct shingles."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def read() -> None:
        hashes, first = word_hashes(group)
        n = max(0, len(hashes) - SIZE + 1)
        runs = np.zeros(n, np.uint64)
        for k in range(SIZE):
            runs += hashes[k : k + n] * _PLACE[k]
        runs = _mixed(runs)
        for i in range(len(group)):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= SIZE:
                out.append(np.unique(runs[a : b - SIZE + 1]))
            elif b > a:
                short = hashes[a:b] * _PLACE[: b - a]
                out.append(_mixed(np.array([short.sum() + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))

    for text in texts:
        group.append((text or "").encode())
        size += len(group[-1])
        if size > GROUP:
            read()
            group, size = [], 0
    if group:
        read()
    return out


def signature(own: np.ndarray) -> bytes | None:
    return blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _need(n):
    """Shingles that a set of n must share with any set it links with: ceil(3n/4)."""
    return (3 * n + 3) // 4


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and sig, equal for equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoder()
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                batch = whole.slice(i, BATCH)
                sets = shingle_sets(batch.column("text").to_pylist())
                columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                columns.append(pa.array([signature(s) for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, sig binary")


def key_bits(total: int) -> int:
    """Bits of a shingle's key among `total` shingles: fewer than one in 256 has the key of another by chance."""
    return min(48, max(32, int(total).bit_length() + 8))


def packed(records: np.ndarray) -> bytes:
    """Sorted records, a key over 16 bits of owner: gaps between keys and owners by bytes, those that are mostly zero compressed."""
    gaps = np.diff(records >> np.uint64(16), prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    owners = (records & np.uint64(_NOBODY)).astype("<u2").view(np.uint8).reshape(-1, 2)
    full = gaps[:, 0].tobytes() + gaps[:, 1].tobytes() + owners[:, 0].tobytes()
    return full + pa.compress(gaps[:, 2:6].T.tobytes() + owners[:, 1].tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of n packed records."""
    rest = np.frombuffer(pa.decompress(data[3 * n :], decompressed_size=5 * n, codec="zstd", asbytes=True), np.uint8).reshape(5, n)
    full = np.frombuffer(data, np.uint8, 3 * n).reshape(3, n)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :2], gaps[:, 2:6] = full[:2].T, rest[:4].T
    owners = np.stack([full[2], rest[4]], axis=1)
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64), owners.view("<u2").ravel()


def sent_shingles(sets: DataFrame, total: int) -> DataFrame:
    """What map tasks send to the buckets: for each batch a row of kind 1, its classes, and rows of kind 0, packed records."""
    buckets, bits = max(16, -(-total // PER_BUCKET)), np.uint64(64 - key_bits(total))
    # a bucket is a range of keys, so that a batch's sorted records fall into one piece for each
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64) >> bits << np.uint64(16)
    names = ["kind", "bucket", "batch", "n", "sigs", "data"]
    column = "text" if "text" in sets.columns else "hashes"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if column == "text":
                yield from shingle_sets(batch.column(0).to_pylist())
            else:
                for own in batch.column(0):
                    yield own.values.to_numpy(zero_copy_only=False).view(np.uint64)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, np.ndarray]]:
        """Classes of BATCH texts at a time, however few rows come at once."""
        found: dict[bytes, np.ndarray] = {}
        parts = (b.slice(i, STEP) for b in batches for i in range(0, b.num_rows, STEP))
        for number, own in enumerate(read(parts), 1):
            if len(own):
                found.setdefault(signature(own), own)
            if number % BATCH == 0 and found:
                yield found
                found = {}
        if found:
            yield found

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoder()
        number = TaskContext.get().partitionId() << 24
        for found in together(batches):
            number += 1
            sizes = np.array([len(s) for s in found.values()], np.uint32)
            owner = np.repeat(np.arange(len(found), dtype=np.uint64), sizes)
            # the key sorts first: a shingle's records stand together
            records = np.concatenate(list(found.values())) >> bits << np.uint64(16) | owner
            records.sort()
            keys = records >> np.uint64(16)
            same = np.concatenate([[False], keys[1:] == keys[:-1]])
            first = ~same & np.concatenate([same[1:], [False]])
            shared = same | first
            local = np.bincount((records[shared] & np.uint64(_NOBODY)).astype(np.int64), minlength=len(found)).astype(np.uint32)
            records[first] |= np.uint64(_NOBODY)
            records = records[~same]
            rows = [(1, number % buckets, number, 0, b"".join(found), sizes.tobytes() + local.tobytes())]
            for b, part in enumerate(np.split(records, np.searchsorted(records, edges))):
                if len(part):
                    rows.append((0, b, number, len(part), b"", packed(part)))
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    some = sets.select(column).where((F.length if column == "text" else F.size)(column) > 0)
    return some.mapInArrow(send, "kind int, bucket int, batch long, n int, sigs binary, data binary")


def sharing_classes(sets: DataFrame, total: int) -> DataFrame:
    """sig of the classes that have enough shingles which other classes have as well.

    `sets` has a column `text` or `hashes`, `total` shingles in all. Rows of one class in different batches count as
    classes of their own, as telling them apart would take a signature for each class, batch and bucket.
    """

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        passed, sent = rows[rows["kind"] == 1], rows[rows["kind"] == 0]
        out = [(1, b, s, d) for b, s, d in zip(passed["batch"], passed["sigs"], passed["data"], strict=True)]
        if len(sent):
            parts = [unpacked(d, n) for d, n in zip(sent["data"], sent["n"], strict=True)]
            keys, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times = np.diff(np.append(start, len(keys)))
            # shared: several batches have it, or a batch says so by a record of nobody
            nobody = owner[order] == _NOBODY
            shared = (times > 1) | np.logical_or.reduceat(nobody, start)
            hit = np.sort(order[np.repeat(shared, times) & ~nobody])
            cuts = np.searchsorted(hit, np.cumsum(sent["n"].to_numpy())[:-1])
            for batch, own in zip(sent["batch"], np.split(owner[hit], cuts), strict=True):
                if len(own):
                    out.append((0, batch, b"", np.sort(own).tobytes()))
        return pd.DataFrame(out, columns=["kind", "batch", "sigs", "data"])

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        base = rows[rows["kind"] == 1].iloc[0]
        sizes, local = np.frombuffer(base["data"], np.uint32).reshape(2, -1).astype(np.int64)
        told = b"".join(rows.loc[rows["kind"] == 0, "data"])
        local = local + np.bincount(np.frombuffer(told, "<u2"), minlength=len(sizes))
        sigs = np.frombuffer(base["sigs"], "V16")
        return pd.DataFrame({"sig": [bytes(sigs[i]) for i in np.flatnonzero(local >= _need(sizes))]}, columns=["sig"])

    answers = sent_shingles(sets, total).groupBy("bucket").applyInPandas(answer, "kind int, batch long, sigs binary, data binary")
    return answers.groupBy("batch").applyInPandas(decide, "sig binary").distinct()


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SENT else df


def sets_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """k, rep, n and hashes of the chosen classes (sig, rep), each from its representative's text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(_sized(chosen.select("rep").distinct()), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist())
            columns = [pa.array([signature(s) for s in sets], pa.binary()), batch.column("rep")]
            columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["sig", "rep", "n", "hashes"])

    read = texts.select("rep", "text").mapInArrow(run, "sig binary, rep long, n long, hashes array<long>")
    # one row of a class: rows that repeat its representative are dropped
    once = read.join(_sized(chosen.select("sig", "rep")), ["sig", "rep"], "left_semi")
    found = stored(once.select(F.xxhash64("sig").alias("k"), "rep", "n", "hashes"), "shingle-sets")
    return found if found.count() == found.select("k").distinct().count() else stored(found.dropDuplicates(["k"]), "shingle-sets")


def prefixes(sets: DataFrame) -> DataFrame:
    """token, pos, k, n, m and weight: the shared shingles within every set's adaptive prefix, and their places in it.

    The weight, how common the set's shingles are on average, is largest for what copies have been made of.
    """
    each = sets.select("k", "n", F.explode("hashes").alias("token"))
    times = each.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    ordered = each.join(times, "token").groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    need = F.floor((3 * F.col("n") + 3) / 4).cast("int")
    # shingles of one class stand before those in t
    within = lambda m: F.greatest(F.size("t") - need + m, F.lit(0))
    options = []
    for m in range(1, MOST + 1):
        postings = F.aggregate(F.slice("t", F.lit(1), within(m)), F.lit(0).cast("long"), lambda a, x: a + x["df"] - 1)
        cost = postings * (1 + 2.0 / m)  # reading the lists, and comparing those found m times
        options.append(F.when((need >= m) & (within(m) >= m), F.struct(cost.alias("cost"), F.lit(m).alias("m"))))
    best = ordered.withColumn("m", F.array_min(F.filter(F.array(*options), lambda x: x.isNotNull()))["m"]).where(F.col("m").isNotNull())
    weight = F.aggregate("t", F.lit(0.0), lambda a, x: a + F.log2(x["df"].cast("double"))) / F.col("n")
    alone = (F.col("n") - F.size("t")).alias("alone")
    cut = best.select("k", "n", "m", alone, weight.cast("float").alias("weight"), F.slice("t", F.lit(1), F.greatest(F.size("t") - need + F.col("m"), F.lit(0))).alias("t"))
    return cut.select(F.posexplode("t.token").alias("at", "token"), "alone", "k", "n", "m", "weight").select(
        "token", (F.col("alone") + F.col("at") + 1).alias("pos"), "k", "n", "m", "weight"
    )


def _close(a: str, b: str):
    return (4 * F.least(a, b)) >= (3 * F.greatest(a, b))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose similarity is 3/4 or more."""
    pairs = stored(pairs.select("a", "b"), "set-pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    sets = sets.join(_sized(asked), "k", "left_semi")
    left = sets.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    both = pairs.join(left, "a").join(right, "b")
    common = both.withColumn("common", F.size(F.array_intersect("ha", "hb")))
    return common.where(100 * F.col("common") >= 75 * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (k, label) after joining the groups that the links (a, b) connect; the smallest label wins."""
    of = lambda name, to: labels.select(F.col("k").alias(name), F.col("label").alias(to))
    edges = links.join(of("a", "x"), "a").join(of("b", "y"), "b").where(F.col("x") != F.col("y")).select("x", "y")
    edges = stored(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "group-links")
    if edges.isEmpty():
        return labels
    to = stored(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("to")), "group-labels")
    while True:
        # the smallest label among the neighbours' and one's own, then the label of that label
        seen = edges.join(to.select(F.col("x").alias("y"), F.col("to").alias("theirs")), "y").groupBy("x").agg(F.min("theirs").alias("theirs"))
        less = to.join(seen, "x").select("x", "to", F.least("to", "theirs").alias("new"))
        jump = to.select(F.col("x").alias("new"), F.col("to").alias("further"))
        after = less.join(jump, "new", "left").select("x", F.col("to").alias("old"), F.least("new", F.coalesce("further", "new")).alias("to"))
        after = stored(after, "group-labels")
        to = after.select("x", "to")
        if after.where(F.col("old") != F.col("to")).isEmpty():
            break
    moved = labels.join(to.select(F.col("x").alias("label"), "to"), "label", "left")
    return stored(moved.select("k", F.coalesce("to", "label").alias("label")), "set-labels")


def groups(sets: DataFrame) -> DataFrame:
    """k and label of every set that has postings: equal labels for connected sets."""
    lists = stored(prefixes(sets), "prefixes")
    labels = stored(lists.select("k").distinct().select("k", F.col("k").alias("label")), "set-labels")
    barren = 0
    for turn in range(PIVOTS + 1):
        # lists whose members aren't all joined yet
        mixed = lists.join(_sized(labels), "k").groupBy("token").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
        lists = stored(lists.join(mixed.where("l0 <> l1").select("token"), "token", "left_semi"), "prefixes")
        if lists.isEmpty():
            break
        marked = lists.join(_sized(labels), "k")
        if turn == PIVOTS or barren == 2:
            return merged(labels, stored(verified(_all_apart(marked), sets), "set-links"))
        links = stored(verified(_with_pivots(marked, turn), sets), "set-links")
        barren = barren + 1 if links.isEmpty() else 0
        labels = merged(labels, links)
    return labels


def _with_pivots(marked: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of sets and pivots of their lists: for each set those three that it shares most lists with.

    The first pivot of a list is its most central set; later ones are drawn, central ones more often.
    """
    luck = F.pow((F.pmod(F.xxhash64("k", F.lit(turn)), F.lit(1 << 20)) + 0.5) / float(1 << 20), F.lit(0.5 if turn else 0.0))
    chosen = F.max(F.struct((F.col("weight") * luck).alias("h"), "k", "n", "label")).alias("p")
    pivots = marked.groupBy("token").agg(chosen).select("token", "p.*")
    pivots = pivots.select("token", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    asked = marked.join(pivots, "token").where((F.col("label") != F.col("lb")) & _close("n", "nb"))
    counted = asked.groupBy(F.col("k").alias("a"), "b").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("c"), "b"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= 3).select("a", "b")


def _all_apart(marked: DataFrame) -> DataFrame:
    """All pairs (a, b) of sets in different groups that share enough of both prefixes.

    Similar sets share 3/7 of the sum of their sizes or more. If a shingle is the first that they share, they share no
    more than what follows it in either; some shingle of a pair must pass this. Beyond the prefix that ends first in the
    order, a pair can share no more than that set's rest: so much must come from the prefixes, and as much as the
    smaller m.
    """
    columns = ("k", "n", "m", "label", "pos")
    left = marked.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = marked.select("token", *[F.col(c).alias(f"{c}_b") for c in columns])
    least = F.ceil(3 * (F.col("n_a") + F.col("n_b")) / 7)
    apart = (F.col("k_a") < F.col("k_b")) & (F.col("label_a") != F.col("label_b")) & _close("n_a", "n_b")
    apart = apart & (F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) + 1 >= least)
    key = ["k_a", "k_b", "n_a", "n_b", "m_a", "m_b"]
    pairs = left.join(right, "token").where(apart).select(*key).distinct()
    # tokens whose lists aren't all joined: any that two sets of different groups share is among them
    own = stored(marked.groupBy("k").agg(F.collect_list("token").alias("t")), "mixed-prefixes")
    pairs = pairs.join(own.select(F.col("k").alias("k_a"), F.col("t").alias("t_a")), "k_a")
    pairs = pairs.join(own.select(F.col("k").alias("k_b"), F.col("t").alias("t_b")), "k_b")
    rest = F.greatest(*[F.floor((3 * F.col(f"n_{x}") + 3) / 4) - F.col(f"m_{x}") for x in "ab"])
    enough = F.greatest(F.least("m_a", "m_b").cast("long"), least - rest)
    kept = pairs.where(F.size(F.array_intersect("t_a", "t_b")) >= enough)
    return kept.select(F.col("k_a").alias("a"), F.col("k_b").alias("b"))


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row."""
    rows = stored(described(docs), "shingle-rows")
    classes = rows.where(F.col("sig").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(classes.groupBy("sig").agg(F.min("doc_id").alias("rep")), "shingle-classes")
    total, described_rows = rows.agg(F.sum("n_shingles"), F.count("sig")).first()
    chosen = stored(classes.join(sharing_classes(docs, total or 0), "sig", "left_semi"), "sharing-classes")
    sets = sets_of(docs, chosen)
    if described_rows > classes.count():  # rows of one class may have passed for different ones; now each class is one row
        total = sets.agg(F.sum("n")).first()[0] or 0
        passed = stored(sharing_classes(sets, total).select(F.xxhash64("sig").alias("k")), "sharing-sets")
        sets = sets.join(_sized(passed), "k", "left_semi")
    labels = groups(sets).join(sets.select("k", "rep"), "k")
    named = labels.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = labels.join(named, "label").select("k", "component_id")
    known = classes.withColumn("k", F.xxhash64("sig")).join(of_class, "k", "left")
    known = known.select("sig", F.coalesce("component_id", "rep").alias("component_id"))
    found = rows.join(known, "sig", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return found.select("doc_id", "n_shingles", own)
