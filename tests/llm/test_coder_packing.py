from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrilake.llm import swap_packing, token_coder
from agrilake.llm.queries import _vocabulary
from agrilake.llm.tokens import WordEncoder, as_ids

WORD, BYTE = _vocabulary("word_bpe_49k.json"), _vocabulary("byte_bpe_50k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 499), max_size=400), max_size=8))
def test_block_round_trip(documents):
    documents = [np.array(d, "<u4") for d in documents]
    back = token_coder.decode_block(token_coder.encode_block(documents, 500))
    assert [d.tolist() for d in back] == [d.tolist() for d in documents]


def test_blocks_compress_and_notice_damage():
    draw = np.random.default_rng(1)
    ids = draw.choice(40, 60_000, p=np.arange(1, 41) / 820).astype("<u4")
    ids[20_000:40_000] = ids[:20_000]
    block = token_coder.encode_block([ids], 50_000)
    assert len(block) < len(ids)
    assert np.array_equal(token_coder.decode_block(block)[0], ids)
    for broken in (block[:10], block[:-2], block[:50] + bytes([block[50] ^ 1]) + block[51:]):
        with pytest.raises(ValueError):
            token_coder.decode_block(broken)


def test_reader_knows_the_id_of_every_frequency_without_a_search():
    models = token_coder._Models(50, 1, reads=True)
    for ids in ([3] * 500 + [7] * 40, list(range(50)) * 20):
        models.mix(1)
        at = np.arange(1 << token_coder.COUNTS, dtype=np.uint64)
        assert np.array_equal(models.holder, np.searchsorted(models.below, at, side="right") - 1)
        np.add.at(models.counts, ids, 1)
        models.seen, models.due = models.seen + len(ids), 0


ODD = ["", " ", "a ", " a", "  a", "a\n b", "a \nb", "\n\n x", "a  b", "x\t\ty  z\n \n", "don't it's", "<|endoftext|> x", "É é １２"]


@pytest.mark.parametrize(("path", "joined"), [(WORD, False), (BYTE, True)])
def test_encoder_equals_whole_texts(path, joined):
    encoder = WordEncoder(path, joined)
    assert encoder.encode(ODD) == [encoder._whole([t])[0] for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.text("abA' \n\t.,!é　1", max_size=30))
def test_encoder_equals_whole_texts_everywhere(text):
    for path, joined in ((WORD, False), (BYTE, True)):
        encoder = _ENCODERS.setdefault(path, WordEncoder(path, joined))
        assert encoder.encode([text]) == encoder._whole([text])


_ENCODERS: dict[str, WordEncoder] = {}


def test_coder_query_equals_plain_encoding(corpus, nothing):
    encoder = WordEncoder(WORD, False)
    rows = sorted(corpus.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = np.append(as_ids(encoder._whole([text or ""])[0]), 2).astype("<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_coder.round_trip(corpus, WORD, block_ids=500).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert token_coder.round_trip(nothing, WORD).count() == 0


def test_packing_query(corpus, nothing):
    encoder = WordEncoder(BYTE, True)
    rows = swap_packing.pack_documents(corpus, BYTE).collect()
    ids = {
        r["doc_id"]: np.append(as_ids(encoder._whole([r["text"] or ""])[0]), 0).astype("<u4") for r in corpus.collect()
    }
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["length"] == len(own) and r["ids_crc32"] == zlib.crc32(own.tobytes())
        assert r["length"] == 2048 or r["piece"] == 0
    assert sum(r["length"] for r in rows) == sum(len(ids[r["doc_id"]]) for r in corpus.collect())
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert swap_packing.pack_documents(nothing, BYTE).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_local_search_keeps_all_and_never_adds_bins(lengths):
    lengths = np.array(lengths, np.int64)
    bin_of, offset = swap_packing.packed(lengths, 100)
    fill = np.bincount(bin_of, lengths) if len(lengths) else np.zeros(0)
    assert (fill <= 100).all() and len(set(bin_of.tolist())) == len(fill)
    assert len(fill) <= sum(1 for x in swap_packing.best_fit(lengths, 100).items if x)


def test_local_search_empties_a_bin_by_exchanges():
    bins = swap_packing._Bins(10)
    lengths = np.array([6, 3, 5, 4, 2])
    for items in ([0, 1], [2, 3], [4]):  # fills 9, 9, 2: no move fits, exchanges do
        at = bins.open()
        bins.items[at] = list(items)
        bins.place(at, int(lengths[items].sum()))
    swap_packing.local_search(bins, lengths)
    assert sorted(f for f in bins.fill if f) == [10, 10]
