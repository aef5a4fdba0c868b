from __future__ import annotations

import hashlib
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrilake.llm import block_rotation, fm_index, permuterm

PLAN = block_rotation.Plan()


# fill in the middle


def _middle(doc_id, text):
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24))
    text, n = text or "", len(text or "")
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_middles_equal_brute_force_and_come_back(spark, corpus, nothing):
    more = spark.createDataFrame(
        [(i, "é\U0001f600 <P> x" if i % 3 == 0 else "ab\U0001f600é" * (i % 5)) for i in range(100, 160)], "doc_id long, text string"
    )
    docs = corpus.unionByName(more, allowMissingColumns=True)
    rows = docs.collect()
    found = block_rotation.restored(block_rotation.fill_in_middle(docs)).collect()
    expected = [(*_middle(r["doc_id"], r["text"]), r["text"] or "") for r in rows]
    got = [(*r[:5], bytes(r["output"]).decode(), bytes(r["restored"]).decode()) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert block_rotation.restored(block_rotation.fill_in_middle(nothing)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM>aé\U0001f600\n", max_size=40), st.integers(-5, 10_000))
def test_every_text_comes_back(text, doc_id):
    output, form, *_ = block_rotation.transform(text.encode(), doc_id, PLAN)
    assert output.decode() == _middle(doc_id, text)[5]
    assert block_rotation.restore(output, form, PLAN) == text.encode()


@pytest.mark.parametrize("sizes", [(0, 0), (0, 5), (5, 0), (1, 1), (7, 3), (3 * block_rotation.STEP, 2 * block_rotation.STEP + 1)])
def test_rotation_exchanges_blocks(sizes):
    a, b = (np.random.default_rng(n).integers(0, 256, n, np.uint8).tobytes() for n in sizes)
    buffer = bytearray(b"xy" + a + b + b"z")
    block_rotation.rotate(buffer, 2, 2 + len(a), 2 + len(a) + len(b))
    assert bytes(buffer) == b"xy" + b + a + b"z"


# spelling variants


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_variants_equal_all_pairs(spark, corpus, nothing):
    texts = [
        "aabbccdd " * 300 + "abbccdd " * 20 + "aabccdd " * 20 + "bbccdd " * 3 + "aaabbccdd xabbccdd " * 2,
        "Straße STRASSE strasse straßen " * 30 + "straßens straßems " * 2 + "ÀÉÎÕÜÝß àéîõüýß " * 4,
        "qwertyuiop " * 1000 + "qwertyuioq " * 80 + "qwertyuixq " * 7 + "zzzzzzzz " * 30 + "zzzzzzz zzzzzzzzz " * 2,  # a chain of forms
        "abcdefg×abcdefg÷ ab-cdefgh " * 3,
    ]
    docs = spark.createDataFrame([(50 + i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    docs = corpus.unionByName(docs, allowMissingColumns=True).repartition(3)
    expected = _variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = permuterm.variants(docs).collect()
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, expected))
    assert any(r["root"] not in (r["word"], r["form"]) for r in found)
    assert permuterm.variants(nothing).count() == 0


# repeated windows


def _kept(rows):
    order = lambda i: (i is None, i or 0)
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - 19):
            gram, place = tuple(w[s : s + 20]), (order(i), s)
            first[gram] = min(first.get(gram, place), place)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (order(i), s):
                gone.update(range(s, s + 20))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def _found(docs):
    return [(r[0], r[1], r[2], bytes(r["kept"]).decode()) for r in fm_index.without_repeats(docs).collect()]


def _passages(spark):
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(0, 400)}"
    shared = [[word() for _ in range(n)] for n in (20, 21, 60, 19)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(30)]
        for k in rng.integers(0, 4, 2):
            text += shared[k] + [word() for _ in range(rng.integers(0, 4))]
        rows.append((int(rng.integers(0, 55)), ("\n" if i % 2 else "  ").join(text)))
    rows += [(None, rows[0][1]), (None, rows[1][1] + " more"), (70, "same " * 90), (71, "a b " * 50), (72, "a\tb " * 45)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_repeats_equal_brute_force(spark, corpus, nothing):
    docs = corpus.unionByName(_passages(spark), allowMissingColumns=True).repartition(4)
    expected = _kept([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(str, _found(docs))) == sorted(map(str, expected))
    assert fm_index.without_repeats(nothing).count() == 0


def test_many_shards_and_hot_anchors_change_nothing(spark, monkeypatch):
    docs = _passages(spark).repartition(5)
    expected = _kept([(r["doc_id"], r["text"]) for r in docs.collect()])
    monkeypatch.setattr(fm_index, "PER_SHARD", 20)
    monkeypatch.setattr(fm_index, "HOT_SEGMENTS", (3, 3))
    assert sorted(map(str, _found(docs))) == sorted(map(str, expected))


def test_spans_cover_exactly_the_removed_words(spark):
    docs = _passages(spark)
    for r in fm_index.without_repeats(docs).collect():
        covered = {k for s in r["spans"] or [] for k in range(s["start"], s["start"] + s["words"])}
        assert len(covered) == r["n_removed"] and max(covered, default=0) < max(1, r["n_words"])


def test_wavelet_ranks_and_suffix_order():
    rng = np.random.default_rng(5)
    sequence = rng.integers(0, 37, 1000)
    matrix = fm_index.WaveletMatrix(sequence, 37)
    symbols, places = rng.integers(0, 37, 300), rng.integers(0, 1001, 300)
    assert matrix.rank(symbols, places).tolist() == [int((sequence[:p] == s).sum()) for s, p in zip(symbols, places, strict=True)]
    text = np.append(rng.integers(1, 3, 400), 0)
    assert fm_index.suffix_order(text, 3).tolist() == sorted(range(401), key=lambda i: text[i:].tolist())
