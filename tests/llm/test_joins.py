from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrilake.llm import adaptive_join, phrase_index
from agrilake.llm.oracle import ORACLE
from agrilake.llm.queries import QUERIES


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def _components(docs):
    sets = {i: _shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_join_equals_brute_force_on_hard_rows(corpus, nothing):
    found = adaptive_join.link(corpus).collect()
    expected = _components([(r["doc_id"], r["text"]) for r in corpus.collect() if r["doc_id"] is not None])
    assert len(found) == corpus.count()
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
    assert adaptive_join.link(nothing).count() == 0


def test_join_equals_brute_force_on_chains(spark):
    """Near copies in chains, a passage in all texts, a group of copies with a third of all rows."""
    passage = " ".join(f"common{i}" for i in range(60))
    docs = []
    for i in range(60):
        own = [f"group{i // 12} word{(i // 12) * 7 + k}" for k in range(40)]
        for k in range(i % 12):
            own[(k * 3) % 40] = f"edit{k}"
        docs.append((i, passage + " " + " ".join(own)))
    docs += [(1000 + i, "same text again and again in many rows " * 3) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in adaptive_join.link(frame).collect()}
    assert found == _components(docs)


@pytest.mark.parametrize("n", [1, 2, 3000])
def test_records_packed_and_back(n):
    draw = np.random.default_rng(n)
    keys, owners = draw.integers(0, 1 << 48, n, np.uint64), draw.integers(0, 1 << 16, n, np.uint64)
    records = np.sort(keys << np.uint64(16) | owners)
    found = adaptive_join.unpacked(adaptive_join.packed(records), n)
    assert (found[0] == records >> np.uint64(16)).all() and (found[1] == records & np.uint64(0xFFFF)).all()


def test_more_buckets_send_no_more_than_records(spark, monkeypatch):
    """What is sent grows with the shingles, not with batches times buckets times the texts of a batch."""
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(400)]
    docs, total = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), 400 * 56
    size = F.sum(F.length("data") + F.length("sigs"))
    for per_bucket in (1000, 100):
        monkeypatch.setattr(adaptive_join, "PER_BUCKET", per_bucket)
        assert adaptive_join.sent_shingles(docs, total).agg(size).first()[0] < 7 * total


def test_batches_of_the_join_span_those_of_arrow(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of these") for i in range(4500)], "doc_id long, text string").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, 400)
        assert adaptive_join.sent_shingles(docs, 4500).where("kind = 1").count() == 3
    finally:
        spark.conf.set(setting, before)


def test_copies_in_other_batches_make_no_class_share(spark, monkeypatch):
    monkeypatch.setattr(adaptive_join, "BATCH", 3)
    monkeypatch.setattr(adaptive_join, "PER_BUCKET", 50)
    own = [" ".join(f"own{i}x{k}" for k in range(30)) for i in range(4)]
    docs = [(10 * i + c, text) for c in range(4) for i, text in enumerate(own)]
    docs += [(100, own[0] + " more"), (101, own[1] + " " + own[2])]  # alone: only the copies of own[3]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in adaptive_join.link(frame).collect()}
    assert found == _components(docs)
    listed = []
    monkeypatch.setattr(adaptive_join, "prefixes", lambda sets, f=adaptive_join.prefixes: f(listed.append(sets) or sets))
    adaptive_join.link(frame).count()
    assert {r["rep"] for r in listed[0].collect()} == {0, 10, 20, 100, 101}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = connection.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, expected.fetchall()))


def test_phrases_on_hard_rows(spark, corpus, nothing):
    items = spark.createDataFrame(
        [(1, "TWO"), (2, "gamma delta alpha1"), (3, None), (4, "..."), (5, "nowhere at all"), (6, "two"), (7, "w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13")],
        "item_id long, text string",
    )
    found = phrase_index.decontaminate(corpus, items).collect()
    assert len(found) == corpus.count()
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    windows = defaultdict(set)
    for r in items.collect():
        w = words(r["text"])
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(r["item_id"])
    expected = []
    for r in corpus.collect():
        w, hit, its = words(r["text"]), set(), set()
        for gram, ids in windows.items():
            for k in range(len(w) - len(gram) + 1):
                if tuple(w[k : k + len(gram)]) == gram:
                    hit.update(range(k, k + len(gram)))
                    its |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, its))).encode()).hexdigest()
        expected.append((r["doc_id"], len(w), len(hit), len(its), digest, bool(hit)))
    assert sorted(map(str, (tuple(r)[:6] for r in found))) == sorted(map(str, expected))
    assert phrase_index.decontaminate(nothing, items).count() == 0
    assert phrase_index.decontaminate(corpus, items.limit(0)).where("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x fox"), (2, "fox red"), (3, "red x x x x x x fox"), (4, "red")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "red fox")], "item_id long, text string")
    index = phrase_index.build_index(docs, items.selectExpr("explode(split(text, ' ')) AS word"))
    found = phrase_index.proximity_matches(index, phrase_index.phrase_windows(items, 10), span=4)
    names = index.where("doc_id IS NOT NULL").select("key", "doc_id")
    assert {r["doc_id"] for r in found.join(names, "key").collect()} == {1, 2}
