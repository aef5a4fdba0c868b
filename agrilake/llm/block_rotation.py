"""Fill-in-the-middle texts by rotating blocks in place.

A text is scanned for the byte offsets of two cuts, sentinels are put before its three parts in one bytearray, and two
neighbouring blocks change places by three reversals: the middle and the suffix block (order prefix, suffix, middle), or
the first two blocks and the suffix block (order suffix, prefix, middle). The same rotation with the blocks' sizes
exchanged undoes it, after which the sentinels come out again. The work on texts is done on UTF-8 bytes; positions are code points.

Everything is derived from doc_id and the text's length, so a lost task gives the same rows again.

Cases: null texts are empty and stay plain, as do texts that hold a sentinel; cuts may coincide or lie at the ends; rows
without a doc_id are cut by the hash of the bare seed; repeated rows and ties give equal rows; an empty table gives an
empty result; other columns, whatever their names, are left out; long texts are taken whole, three copies of one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes exchanged at a time; bounds what a reversal copies.
STEP = 1 << 16


@dataclass(frozen=True)
class Plan:
    """Sentinels, the seed of all draws, and per cent of texts to transform and, of these, to begin with the suffix."""

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"
    seed: str = "1"
    transformed: int = 90
    suffix_first: int = 20

    def draws(self, doc_id: int | None) -> list[int]:
        named = "" if doc_id is None else str(doc_id)
        hexed = sha256(f"{self.seed}:{named}".encode()).hexdigest()
        return [int(hexed[k : k + 8], 16) for k in range(0, 32, 8)]


def code_points(text: bytes) -> np.ndarray:
    """Byte offset of every code point, and the end."""
    begins = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return np.append(begins, len(text))


def reverse(block: np.ndarray) -> None:
    """Turns a block of bytes round where it lies, exchanging its ends piece by piece."""
    a, b = 0, len(block)
    while b - a > 1:
        k = min(STEP, (b - a) // 2)
        left = block[a : a + k].copy()
        block[a : a + k] = block[b - k : b][::-1]
        block[b - k : b] = left[::-1]
        a, b = a + k, b - k


def rotate(buffer: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchanges buffer[begin:cut] and buffer[cut:end]: each is reversed, then both together."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view[begin:cut])
    reverse(view[cut:end])
    reverse(view[begin:end])


def transform(text: bytes, doc_id: int | None, plan: Plan) -> tuple[bytes, str, int, int | None, int | None]:
    """Output, form, code points, and those of prefix and middle (null in plain form)."""
    offsets = code_points(text)
    n = len(offsets) - 1
    h1, h2, h3, h4 = plan.draws(doc_id)
    if not n or h3 % 100 >= plan.transformed or any(s in text for s in (plan.prefix, plan.suffix, plan.middle)):
        return text, "plain", n, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = int(offsets[first]), int(offsets[second])
    buffer = bytearray(plan.prefix)
    buffer += memoryview(text)[:a]
    second_block = len(buffer)
    buffer += plan.middle
    buffer += memoryview(text)[a:b]
    third_block = len(buffer)
    buffer += plan.suffix
    buffer += memoryview(text)[b:]
    form = "spm" if h4 % 100 < plan.suffix_first else "psm"
    rotate(buffer, 0 if form == "spm" else second_block, third_block, len(buffer))
    return bytes(buffer), form, n, first, second - first


def restore(output: bytes, form: str, plan: Plan) -> bytes:
    """The text, from an output and its form alone."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    middle = output.index(plan.middle)
    if form == "psm":  # <P>prefix | <S>suffix | <M>middle
        begin, cut = output.index(plan.suffix), middle
    else:  # <S>suffix | <P>prefix <M>middle
        begin, cut = 0, output.index(plan.prefix)
    rotate(buffer, begin, cut, len(buffer))
    for sentinel in (plan.suffix, plan.middle, plan.prefix):  # from the end, so that earlier places stay
        at = buffer.rindex(sentinel)
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def fill_in_middle(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:  # noqa: B008 - frozen
    """doc_id, n, form, prefix_chars, middle_chars, output (UTF-8 bytes) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = (x.as_py() or b"" for x in batch.column(1))
            rows = [transform(t, i, plan) for i, t in zip(ids, texts, strict=True)]
            output, form, n, prefix, middle = zip(*rows, strict=True) if rows else ((),) * 5
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()),
                ],
                names=names,
            )

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, schema)


def restored(transformed: DataFrame, plan: Plan = Plan()) -> DataFrame:  # noqa: B008 - frozen
    """The rows of `fill_in_middle` with one more column, `restored`: the text rebuilt from output and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, outputs = batch.column("form").to_pylist(), batch.column("output")
            texts = [restore(o.as_py(), f, plan) for o, f in zip(outputs, forms, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "restored"]
            )

    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary"
    return transformed.select(*columns).mapInArrow(run, schema)
