from __future__ import annotations

import math
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from agrilake.llm import lattice, string_svm, tag_paths
from agrilake.llm.queries import _vocabulary, fold
from agrilake.llm.tokens import Memory, WordEncoder, as_ids

PIECES = _vocabulary("piece_bpe_32k.model")


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<font>a</x>" * 50_000, "<p><b>x</i>" * 50_000, "<ul><li>x" * 50_000])
def test_deep_and_unclosed_pages_take_linear_time(page):
    started = time.perf_counter()
    tag_paths.main_text(page[: len(page) // 10])
    small = time.perf_counter() - started
    started = time.perf_counter()
    assert tag_paths.main_text(page)
    assert time.perf_counter() - started < 40 * max(small, 0.05)


def test_pages_on_empty_tables_and_clashing_columns(spark):
    rows = [(1, "u", "<article><p>One. </p><p>Two</p></article>", "kept out", 7)] * 2 + [(2, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    found = sorted(map(tuple, tag_paths.extract(pages).collect()), key=str)
    assert found == sorted([(1, "u", "One.\n\nTwo", 9)] * 2 + [(2, None, "", 0)], key=str)
    assert tag_paths.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("toxic, clean", [("vile gronk", ""), ("", "fine words"), ("", "")])
def test_machine_of_sides_without_words(spark, toxic, clean):
    docs = spark.createDataFrame([(i, toxic if i % 2 else clean) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    machine = string_svm.fit(docs, labels, fold(5) != 0)
    scores = [r["score"] for r in string_svm.score(docs, machine).collect()]
    assert len(scores) == 60 and all(0 <= s <= 1 for s in scores)
    assert string_svm.score(docs.limit(0), machine).count() == 0


def _ways(text, weights):
    """Sum over all segmentations, enumerated from the left."""
    if not text:
        return 1.0
    total = sum(math.exp(w) * _ways(text[len(p) :], weights) for p, w in weights.piece.items() if text.startswith(p))
    if text[0] not in weights.piece:
        total += math.exp(sum(weights.byte[b] for b in text[0].encode())) * _ways(text[1:], weights)
    return total


def test_scores_equal_enumerated_segmentations(spark, monkeypatch):
    monkeypatch.setattr(lattice, "COMMON", 4)  # some words are sent, others joined
    texts = ["red fox red fox red", "red dog é", "the unseen word", None, "", "red " * 70_000, "fox dog dog"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    trains = fold(10) != 0
    found = {r["doc_id"]: r for r in lattice.score_texts(docs, trains, PIECES).collect()}
    taught = [t or "" for i, t in enumerate(texts) if crc32(str(i).encode()) % 10]
    counts = Counter(w for t in taught for w in lattice.words_of(t))
    n, ends = sum(counts.values()) + len(taught), len(taught)
    vocabulary = lattice.Vocabulary(PIECES)
    weights = lattice.weights_from(dict(vocabulary.count(list(counts))), vocabulary)
    unseen = min(0.5, (sum(c == 1 for c in counts.values()) + 1) / (n + 2))
    for i, text in enumerate(texts):
        score = spelled = math.log10(ends / n)
        for word, times in Counter(lattice.words_of(text)).items():
            ways = _ways("▁" + word, weights)
            seen = (1 - unseen) * counts[word] / n
            score += times * math.log10(seen + unseen * ways)
            spelled += times * math.log10(ways)
        assert found[i]["score"] == pytest.approx(score, rel=1e-9)
        assert found[i]["lattice_score"] == pytest.approx(spelled, rel=1e-9)


ODD = [
    "don't I'LL we've 's'tx 12ab3 ÀÉx×÷y z\x1cq a\x85b\tc\nd  e ª º İx ſt 日本 naïve—dash <|endoftext|> x",
    "", " ", "  ", "'S 'Re ẞ ß Ÿ", " a", "a ", "\n", "x́ é́", "a" * 5000,
]


@pytest.mark.parametrize("name, joined", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_equal_the_plain_tokenizer(spark, sf_dir, name, joined):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(_vocabulary(name))
    plain.encode_special_tokens = True
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()] + ODD
    encoder = WordEncoder(_vocabulary(name), joined)
    encoder.known = Memory(20_000)  # so small that generations change
    for _ in range(2):
        got = [x for k in range(0, len(texts), 8) for x in encoder.encode(texts[k : k + 8])]
        for text, ids in zip(texts, got, strict=True):
            assert as_ids(ids).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded_and_keeps_what_is_met():
    memory = Memory(10_000)
    for k in range(1000):
        for part in memory.missing({f"w{k}", "hot"}):
            memory.add({part: b"\0\0"})
            assert part != "hot" or k == 0
    assert len(memory.young) + len(memory.old) < 120


CLASHING = "doc_id long, text string, lang string, source string, score double, lang_pred string, row string, `__row` int, `a.b` int"


@pytest.fixture(scope="module")
def clashing(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    own = [(*r, -7.5, "xx", "mine", 4, 5) for r in rows]
    own += [(None, rows[3]["text"], "en", "s", -7.5, "xx", "mine", 4, 5), (-1, None, None, None, -7.5, "xx", "mine", 4, 5), (-2, "", "en", "s", -7.5, "xx", "mine", 4, 5)]
    return spark.createDataFrame([*own, own[5]], CLASHING)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_carry_columns_of_any_name(spark, sf_dir, clashing, name, stage):
    kept = stage(spark, clashing, sf_dir)
    assert kept.schema.simpleString() == clashing.schema.simpleString()
    values = kept.select("score", "lang_pred", "row", "__row", "`a.b`").distinct().collect()
    assert [tuple(r) for r in values] == [(-7.5, "xx", "mine", 4, 5)]
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} <= {(r["doc_id"], r["text"]) for r in clashing.collect()}
    assert stage(spark, clashing.limit(0), sf_dir).count() == 0


def test_packing_takes_clashing_columns(spark, sf_dir, clashing):
    found = corpus_pipeline.packing(spark, clashing, sf_dir).collect()
    ids = np.array([-5 if r["doc_id"] is None else r["doc_id"] for r in found if r["piece"] == 0])
    assert sorted(ids) == sorted(-5 if r["doc_id"] is None else r["doc_id"] for r in clashing.collect())
    assert corpus_pipeline.packing(spark, clashing.limit(0), sf_dir).count() == 0


def test_every_stage_reads_texts_in_small_batches(spark, corpus, sf_dir):
    setting, before = corpus_pipeline.ROWS_SETTING, spark.conf.get(corpus_pipeline.ROWS_SETTING)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(setting, 10_000)
            stage(spark, corpus.limit(0), sf_dir)
            assert int(spark.conf.get(setting)) <= 1000
        spark.conf.set(setting, 200)
        corpus_pipeline.language_id(spark, corpus.limit(0), sf_dir)
        assert int(spark.conf.get(setting)) == 200
    finally:
        spark.conf.set(setting, before)
