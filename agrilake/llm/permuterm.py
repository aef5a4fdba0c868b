"""Spelling variants by sorted rotations of words.

A word of L letters with a terminator behind it has L + 1 rotations. Let w = a x b with an edited letter x. The rotation
that ends in x begins with b$a, whatever x is; a word that lacks x has b$a as a whole rotation. So all words that differ
from w in the place of x lie in one range of the sorted rotations, those with the prefix b$a that go on by one letter at most:

- two rotations that go on by different letters belong to words with one replaced letter,
- the rotation that ends there belongs to the word without the letter: an insertion or deletion.

Rotations are dealt to tasks by their prefix, sorted there, and ranges are scanned. A range has at most one member a
letter of the alphabet and one more. It emits one record a member with the number of its neighbours there and the best
of them, never pairs; the word itself comes back out of the rotation. Of a run of equal letters only the first may be
left out, so every pair of words meets exactly once.

Forms point to words ten times as frequent, so chains are short; their ends are found by doubling.

Cases: null and empty texts have no words; a row without a doc_id draws with an empty number; repeated rows count twice;
ties in n go to the smallest word in code-point order; an empty table gives an empty result; other columns are left out;
long texts are read whole and counted piece by piece.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

#: Distinct words a task counts before it sends them on.
COUNTED = 200_000
END = "$"

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(text: str, least: int) -> Counter[str]:
    """Lower-cased runs of at least `least` letters. A greedy match of a run takes all of it."""
    return Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", text.translate(_UPPER)))


def misspelt(run: str, prefix_crc: int, every: int) -> str:
    """The run without one of its letters if its hash, continued from the document's, is divisible by `every`."""
    h = crc32(run.encode(), prefix_crc)
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run


def word_counts(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """(word, n) of all distinct results; tasks count before anything is sent, so a hot word costs a record a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in runs_of(text.as_py() or "", least).items():
                    found = misspelt(word, start, every)
                    if len(found) >= least:
                        counts[found] += n
                if len(counts) >= COUNTED:
                    yield sent()
        if counts:
            yield sent()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(range, letter, first, n): every rotation cut before its last letter, and every whole one (letter empty).

    `first`: leaving the letter out is told from leaving out its left neighbour."""
    size = F.length("word")

    def cut(i: Column) -> Column:  # the letter at i (from 1) is the last of this rotation
        letter = F.substr("word", i, F.lit(1))
        rest = F.concat(F.substr("word", i + 1, size), F.lit(END), F.substr("word", F.lit(1), i - 1))
        first = (i == 1) | (letter != F.substr("word", i - 1, F.lit(1)))
        return F.struct(rest.alias("range"), letter.alias("letter"), first.alias("first"))

    def whole(i: Column) -> Column:  # the rotation that begins with the letter at i
        turned = F.concat(F.substr("word", i, size), F.lit(END), F.substr("word", F.lit(1), i - 1))
        return F.struct(turned.alias("range"), F.lit("").alias("letter"), F.lit(True).alias("first"))

    cuts = F.transform(F.sequence(F.lit(1), size), cut)
    wholes = F.transform(F.sequence(F.lit(1), size + 1), whole)
    return words.select("n", F.inline(F.concat(cuts, wholes)))


def _turned(rotation: Column, letter: Column) -> Column:
    """The word of a rotation: what follows the terminator, the letter, what goes before the terminator."""
    parts = F.split(rotation, "[$]")
    return F.concat(parts[1], letter, parts[0])


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of all words with a near word; best: (order: -n, best) of the near word of largest n."""
    ranged = rotations(words).withColumn("members", F.count("*").over(Window.partitionBy("range")))

    def member(m: Column) -> Column:
        return F.struct((-m["n"]).alias("order"), _turned(F.col("range"), m["letter"]).alias("word"), m["letter"], m["first"])

    ranges = (
        ranged.where(F.col("members") > 1)
        .groupBy("range")
        .agg(F.collect_list(F.struct("n", "letter", "first")).alias("m"))
        .select(F.sort_array(F.transform("m", member)).alias("m"))
    )

    def near(x: Column) -> Column:
        def meets(y: Column) -> Column:
            replaced = (x["letter"] != "") & (y["letter"] != "") & (x["letter"] != y["letter"])
            inserted = ((x["letter"] == "") & (y["letter"] != "") & y["first"]) | (
                (y["letter"] == "") & (x["letter"] != "") & x["first"]
            )
            return replaced | inserted

        found = F.filter(F.col("m"), meets)  # sorted, so the best comes first
        best = F.get(found, F.lit(0))
        return F.struct(x["word"].alias("word"), F.size(found).cast("long").alias("k"), best["order"].alias("order"), best["word"].alias("best"))

    emitted = ranges.select(F.inline(F.transform("m", near))).where(F.col("k") > 0)
    return emitted.groupBy("word").agg(F.sum("k").alias("n_near"), F.min(F.struct("order", "best")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: each round takes the root of the root, so k rounds follow 2^k forms."""
    links = stored(forms.select("word", F.col("form").alias("root")), "permuterm-forms")
    largest = forms.agg(F.max("form_n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(2.0, math.log10(largest) + 1)))):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = stored(
            links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "permuterm-roots"
        )
    return links


def variants(docs: DataFrame, least: int = 7, every: int = 31, twice: int = 2, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words with at least `twice` occurrences."""
    words = stored(word_counts(docs, least, every).where(F.col("n") >= twice), "permuterm-words")
    judged = words.join(neighbours(words), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.order") >= factor * F.col("n"), F.col("best.best")).alias("form"),
        F.when(-F.col("best.order") >= factor * F.col("n"), -F.col("best.order")).alias("form_n"),
    )
    judged = stored(judged, "permuterm-judged")
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
