from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agrilake.llm import byte_gru, divergence, hash_tree, lattice, string_svm, tag_paths
from agrilake.llm.queries import GROWN, QUERIES, TREE, _vocabulary, fold

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = _vocabulary("piece_bpe_32k.model")


def _remainder(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of if doc_id is not None else 0


def test_lattice_base_and_columns(corpus, nothing):
    found = lattice.score_texts(corpus, fold(10) != 0, PIECES).collect()
    rows = corpus.collect()
    assert len(found) == len(rows)
    tokens = lambda t: lattice.words_of(t) + [None]
    train = Counter(w for r in rows if _remainder(r["doc_id"], 10) for w in tokens(r["text"]))
    n, v = sum(train.values()), len(train)
    expected = []
    for r in rows:
        t = tokens(r["text"])
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        expected.append((r["doc_id"], _remainder(r["doc_id"], 10) == 0, len(t), sum(train[w] > 0 for w in t), n, round(base, 4)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert all(r["score"] < 0 and r["lattice_score"] < 0 for r in found)
    assert lattice.score_texts(nothing, fold(10) != 0, PIECES).count() == 0
    assert lattice.score_texts(corpus.where("doc_id IS NULL"), fold(10) != 0, PIECES).count() == 1


def test_lattice_sums_all_segmentations():
    weights = lattice.Weights({"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -1.5, "▁a": -3.0, "▁ab": -4.0}, [-9.0] * 256)
    ways = [-1 - 2 - 2.5, -1 - 1.5, -3 - 2.5, -4]
    assert lattice.word_log("ab", weights) == pytest.approx(math.log(sum(map(math.exp, ways))))
    assert lattice.word_log("é", weights) == pytest.approx(-1 - 18)
    assert lattice.word_log("a" * 5000, weights) < -5000


def test_quality_figures(corpus, nothing):
    found = divergence.judge(corpus).collect()
    expected = []
    for r in corpus.collect():
        text = r["text"] or ""
        w = SPACE.findall(text)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        times, hit = Counter(grams), set()
        for k, g in enumerate(grams):
            if times[g] > 1:
                hit.update(range(k, k + 5))
        lines, dup = set(), 0
        for line in text.split("\n"):
            if SPACE.search(line):
                dup += line in lines
                lines.add(line)
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        expected.append((r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed))
    assert sorted(map(str, (tuple(r)[:7] for r in found))) == sorted(map(str, expected))
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert divergence.judge(nothing).count() == 0


def test_quality_verdicts(spark):
    clean = "the cat and the dog of this house was in a garden as it is to be for that with on are\n"
    docs = [(i, f"{clean} number{i} " + " ".join(f"word{i}x{k} the of" for k in range(30)), "en") for i in range(40)]
    docs.append((100, " ".join(f"#{k}$$ *%{k * 7}& |<{k}>" for k in range(60)), "en"))
    docs.append((101, "the word the word the word the word " * 20, "en"))
    kept = {r["doc_id"]: r["kept"] for r in divergence.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(40)) and not kept[100] and not kept[101]


def test_quality_by_common_words(spark):
    rare = lambda i, k: f"lorem{chr(97 + i % 26)} ipsum{chr(97 + k % 26)} dolor{chr(97 + (i + k) % 26)}"
    docs = [(i, " ".join(f"{rare(i, k)} {'the of and to in'.split()[k % 5]}" for k in range(40)), "en") for i in range(40)]
    docs.append((100, " ".join(rare(7, k * k + k // 26) for k in range(25)), "en"))  # letters as in any other text, no common word
    docs.append((101, " ".join(rare(7, k) for k in range(16)), None))  # too short to be judged by its words
    found = {r["doc_id"]: r for r in divergence.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(found[i]["kept"] for i in range(40)) and found[101]["kept"]
    assert not found[100]["base_failed"] and found[100]["class_distance"] < 0.1 and found[100]["word_distance"] < 0.55
    assert not found[100]["kept"]
    assert divergence.words_limit([0.0, 5.0]) == 1.0 and divergence.words_limit([5.0, 0.0], 1.0) == pytest.approx(1.0)


def test_recurrent_gradients():
    draw = np.random.default_rng(3)
    windows, targets = draw.integers(0, 256, (6, 9)).astype(np.uint8), np.array([0, 1, 2] * 2)
    net = byte_gru.new_network(["a", "b", "c"], hidden=4)
    for p, g in zip(net.parameters(), byte_gru.loss_and_gradients(net, windows, targets)[1], strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, losses = p[at], []
        for d in (0.01, -0.01):
            p[at] = old + d
            losses.append(byte_gru.loss_and_gradients(net, windows, targets)[0])
        p[at] = old
        assert (losses[0] - losses[1]) / 0.02 == pytest.approx(g[at], rel=0.05, abs=1e-3)


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = QUERIES["op3_byte_gru"](spark, sf_dir).collect()
    assert len(found) == len(lang) and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_language_of_hard_rows(corpus, nothing):
    net = byte_gru.fit(corpus, fold(4) != 2)
    rows = byte_gru.predict(corpus, net).collect()
    assert len(rows) == corpus.count()
    for r in rows:
        silent = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == silent
    assert byte_gru.fit(nothing, fold(4) != 2) is None
    assert {r["lang_pred"] for r in byte_gru.predict(corpus, None).collect()} == {"und"}


def test_windows_cover_whole_texts():
    net = byte_gru.new_network(["a", "b"])
    text = bytes(range(97, 123)) * 7
    w, n = byte_gru.windows_of(text)
    p = byte_gru.label_positions(net, w, n)
    alone = [byte_gru.label_positions(net, w[i : i + 1, : n[i]], n[i : i + 1])[:, :, 0].sum(axis=0) for i in range(len(w))]
    assert np.allclose(byte_gru.pooled(net, [text])[0], sum(alone) / len(text), atol=1e-5)
    assert p.shape == (64, 2, len(w))


def _toxic(spark):
    draw = np.random.default_rng(4)
    plain = ["".join(draw.choice(["ka", "lo", "mi", "re", "tu", "sen", "bor"], 3)) for _ in range(300)]
    bad = ["grumpf", "snorkwit", "blatzig"]
    docs, labels = [], []
    for i in range(240):
        w = list(draw.choice(plain, 40))
        toxic = i % 3 == 0
        if toxic:
            w[5] = bad[i // 3 % 3]
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_and_bent_words(spark):
    docs, labels = _toxic(spark)
    docs += [(900, "kalomi grumxpf retusen"), (901, None), (902, ""), (903, "kalomi re-tu-sen " * 3000), (904, "mi g r u m p f lo")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    machine = string_svm.fit(frame, known, fold(5) != 0)
    scores = {r["doc_id"]: r["score"] for r in string_svm.score(frame, machine).collect()}
    held = [(i, t) for i, _, t in labels if _remainder(i, 5) == 0]
    assert sum((scores[i] >= 0.5) == bool(t) for i, t in held) >= 0.95 * len(held)
    clean = max(scores[i] for i, _, t in labels if not t)
    assert scores[900] > clean and scores[904] >= 0.5 and scores[903] < 0.5
    assert scores[901] == scores[902] < 0.5
    assert string_svm.fit(frame, known.where("toxic = 0"), fold(5) != 0) is None
    assert {r["score"] for r in string_svm.score(frame, None).collect()} == {0.0}


def test_kernel_rows_fold_into_the_same_margins():
    words = ["idiot", "idxiot", "garden"]
    machine = string_svm._fit(["idiot", "garden", "window"], ["idiot"], np.array([1.0]), ["garden", "window"])
    margins = machine.margins(words)
    assert margins[0] > margins[1] > margins[2]


def test_hash_tree_law(corpus, nothing, spark, sf_dir):
    for rows in (hash_tree.shard_documents(corpus, TREE, GROWN).collect(), QUERIES["op6_hash_tree"](spark, sf_dir).collect()):
        assert all(r["grown_shard"] in (r["shard"], 8) for r in rows)
        for shard in {r["shard"] for r in rows}:
            slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
            assert slots == list(range(len(slots)))
    by_row = {(r["doc_id"], r["text"]): r for r in corpus.collect()}
    sizes = Counter(len((t or "").encode()) + 1 for _, t in by_row)
    assert sizes.keys() == {r["size"] for r in hash_tree.shard_documents(corpus, TREE, GROWN).collect()}
    assert hash_tree.shard_documents(nothing, TREE, GROWN).count() == 0


def test_hash_tree_shares_follow_weights(spark):
    tree = {"a": {"r": {0: 1.0, 1: 2.0}}, "b": {"s": {2: 3.0}}}
    more = {"a": {"r": {0: 1.0, 1: 2.0}}, "b": {"s": {2: 4.0}}}
    rows = hash_tree.with_shards(spark.range(6000), F.col("id"), {"x": tree, "y": more}).collect()
    share = Counter(r["x"] for r in rows)
    assert abs(share[0] / 6000 - 1 / 6) < 0.03 and abs(share[2] / 6000 - 1 / 2) < 0.03
    assert all(r["x"] == r["y"] or r["y"] == 2 for r in rows)
    with pytest.raises(ValueError):
        hash_tree.leaves({"a": {"r": {0: 0.0}}})


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy now.</div>
{open}<h1>Title &amp; more</h1><p><b>First   para, with
text.<br>Line two.<p>Second para, long enough to be content.</p><div class="ad-box">Ad.</div><p>Short.</p>{close}
<aside>Aside.</aside><div id="comments"><p>Reader says, this is a long comment, really.</p></div><form>Name</form>
<footer>&copy; Site</footer></body></html>"""
TEXT = "Title & more\n\nFirst para, with text. Line two.\n\nSecond para, long enough to be content.\n\nShort."


@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"', "section"])
def test_pages(tag):
    page = PAGE.replace("{open}", f"<{tag}>").replace("{close}", f"</{tag.split()[0]}>")
    assert tag_paths.main_text(page) == TEXT


def test_page_rows(spark, sf_dir):
    odd = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "bare text"), (None, "u", "<div><p>a<p>b</div>" * 2000), (4, "u", "bare text")]
    found = tag_paths.extract(spark.createDataFrame(odd, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in found][:4] == ["", "", "", "bare text"] and len(found) == 6
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op10_tag_paths"](spark, sf_dir).collect():
        inside = re.sub(r"<[^>]+>", " ", (pages[r["page_id"]] or "").partition("<article>")[2].partition("</article>")[0])
        import html

        assert "".join(r["text"].split()) == "".join(html.unescape(inside).split())


def test_pipeline_keeps_clean_rows_and_drops_the_rest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = corpus_pipeline.language_id(spark, docs, sf_dir)
    assert known.columns == docs.columns and known.count() >= 0.95 * docs.count()
    judged = {r["doc_id"] for r in divergence.judge(docs).collect() if r["kept"]}
    assert {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, sf_dir).collect()} == judged
    linked = QUERIES["op8_adaptive_join"](spark, sf_dir).collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in linked}
    leaks = {r["doc_id"] for r in QUERIES["op4_phrase_index"](spark, sf_dir).collect() if r["contaminated"]}
    rest = {r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, sf_dir).collect()}
    assert leaks and rest == {r["doc_id"] for r in docs.collect()} - leaks


def test_near_duplicates_go_by_row(spark, sf_dir):
    text = lambda name, end: " ".join([f"{name}{i} {name}x{i} gamma delta" for i in range(40)] + [end])
    rows = [(0, text("a", "one")), (1, text("a", "two")), (1, text("b", "alone"))]  # the second row of 1 is a text of its own
    rows += [(5, text("c", "one")), (5, text("c", "two")), (None, text("d", "one")), (None, text("d", "two"))]
    rows += [(None, text("e", "one")), (9, text("e", "two")), (7, text("f", "")), (7, text("f", "")), (8, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()]
    sure = [rows[0], rows[2], rows[8], rows[9], rows[11], rows[12]]
    assert all(kept.count(r) == 1 for r in sure) and len(kept) == len(sure) + 2
    assert sum(r in kept for r in rows[3:5]) == 1 and sum(r in kept for r in rows[5:7]) == 1


def test_pipeline_runs(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


def _drawn(key, path, weight):
    bits = int(hashlib.md5("/".join(map(str, (key, *path))).encode()).hexdigest()[:13], 16)
    return -math.log((bits + 0.5) / (1 << 52)) / weight


def _total(node):
    return sum(map(_total, node.values())) if isinstance(node, dict) else node


def _descended(node, key, path=()):
    if not isinstance(node, dict):
        return path[-1]
    best = min(node, key=lambda name: _drawn(key, (*path, name), _total(node[name])))
    return _descended(node[best], key, (*path, best))


def test_hash_tree_equals_brute_force(corpus, spark, sf_dir):
    for docs in (corpus, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        expected = []
        for r in docs.select("doc_id", "text").collect():
            key, text = "no key" if r["doc_id"] is None else r["doc_id"], (r["text"] or "").encode()
            expected.append((r["doc_id"], len(text) + 1, zlib.crc32(text), _descended(TREE, key), _descended(GROWN, key)))
        found = hash_tree.shard_documents(docs, TREE, GROWN)
        rows = found.select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot").collect()
        assert sorted(map(str, (tuple(r)[:5] for r in rows))) == sorted(map(str, expected))
        for shard in range(8):
            slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
            assert slots == list(range(len(slots)))


def test_hash_tree_moves_only_where_weights_change(spark):
    """A heavier leaf: keys come into its region, and inside it into its rack; nothing else moves."""
    tree = {"a": {"r": {0: 1.0, 1: 1.0}, "s": {2: 1.0, 3: 1.0}}, "b": {"t": {4: 1.0}, "u": {5: 1.0}}}
    heavy = {"a": {"r": {0: 3.0, 1: 1.0}, "s": {2: 1.0, 3: 1.0}}, "b": tree["b"]}
    flat = {"a": {"r": {0: 1.0}}, "b": {"r": {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0}}}
    rows = hash_tree.with_shards(spark.range(6000), F.col("id"), {"x": tree, "y": heavy, "z": flat}).collect()
    moved = {(r["x"], r["y"]) for r in rows if r["x"] != r["y"]}
    # from the other region's shards to any of this one, from rack s into rack r, inside rack r into 0
    assert moved <= {(x, y) for x in (4, 5) for y in (0, 1, 2, 3)} | {(x, y) for x in (2, 3) for y in (0, 1)} | {(1, 0)}
    assert {x for x, _ in moved} == {1, 2, 3, 4, 5}
    share = sum(r["y"] in (0, 1, 2, 3) for r in rows) / 6000
    assert abs(share - 6 / 8) < 0.03
    # the same leaves grouped in another way are other draws
    assert sum(r["x"] != r["z"] for r in rows) > 3000
    # a region is won by its weight, whatever is inside
    assert abs(sum(r["z"] == 0 for r in rows) / 6000 - 1 / 6) < 0.03


def _gapped(word):
    """All subsequences of three and four letters within a reach, by enumeration: {letters: decayed count}."""
    letters = [0, *(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 5 for c in word), 0]
    found = Counter()
    for size in (3, 4):
        for at in itertools.combinations(range(len(letters)), size):
            if at[-1] - at[0] < string_svm.REACH:
                found[tuple(letters[i] for i in at)] += string_svm.DECAY ** (at[-1] - at[0] - size + 1)
    return found


def test_subsequences_and_kernel_equal_enumeration():
    words = ["ab", "idiot", "id1iot", "i", "", "straße", "aaaaaaaaa", "mississippi"]
    for word in words:
        found = Counter()
        for features, _, weight in string_svm.subsequences([word]):
            for feature in features.tolist():
                size, number = (4, feature - string_svm.THREE) if feature >= string_svm.THREE else (3, feature)
                found[tuple(number >> 5 * (size - 1 - k) & 31 for k in range(size))] += weight
        expected = _gapped(word)
        assert found.keys() == expected.keys()
        assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)

    landmark = _gapped("idiot")
    row_of = np.zeros(string_svm.FEATURES, np.int32)
    rows = np.zeros((len(landmark) + 1, 1), np.float32)
    for i, (letters, value) in enumerate(landmark.items(), start=1):
        number = 0
        for code in letters:
            number = number * 32 + code
        row_of[number + (string_svm.THREE if len(letters) == 4 else 0)] = i
        rows[i, 0] = value
    values = string_svm.kernel_features(words, row_of, rows)[:, 0]
    norms = string_svm._norms(np.array([len(w) for w in words]))
    products = [sum(_gapped(w)[k] * v for k, v in landmark.items()) for w in words]
    assert np.allclose(values, np.array(products) / norms, rtol=1e-4, atol=1e-4)
    # a letter put in between costs a part of the likeness, not all
    assert values[1] > values[2] > values[7]
