"""Clustering, lexical search and removal of repeats against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward import COLUMNS, EDGES, prose, row

from ledgerweave.llm import common, heap_clusters, lexical_search, repeated_spans

VECTORS = "vec_id long, embedding array<float>, label int, cluster string"


# Clustering ---------------------------------------------------------------------------


def brute_clusters(rows, clusters, rounds, size, scale=256, seed=2):
    kept = []
    for vec_id, vector, *_ in rows:
        if vector and len(vector) == size and None not in vector and np.isfinite(vector).all():
            kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector]))
    marks = sorted(
        (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None
    )
    centroids = [v for _, v in marks[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), o in zip(kept, own) if o == n]
            if members:
                centroids[n] = [sum(c) // len(members) for c in zip(*members)]
    return Counter((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centroids


def vectors_of(n, size, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = [(i, (centres[i % 6] + rng.normal(size=size) * 0.4).tolist()) for i in range(n)]
    # A third are one vector; some lie exactly between others.
    rows += [(n + i, rows[0][1]) for i in range(n // 2)]
    rows += [(2 * n + i, [0.0] * size) for i in range(5)]
    return [(i, v, 0, "x") for i, v in rows]


@pytest.mark.parametrize("block, clusters", [(7, 9), (1024, 9), (16, 1)])
def test_clusters_equal_brute_force(spark, monkeypatch, block, clusters):
    monkeypatch.setattr(heap_clusters, "BLOCK", block)
    rows = vectors_of(120, 8)
    df = spark.createDataFrame(rows, VECTORS)
    got, centroids = heap_clusters.cluster(df, clusters, 4, 8)
    want, final = brute_clusters(rows, clusters, 4, 8)
    assert Counter(map(tuple, got.collect())) == want
    assert centroids.tolist() == final


def test_heaps_pop_only_expired_gaps():
    heaps = heap_clusters.Heaps.fresh(3, 2)
    drift = np.zeros(2)
    assert sorted(heaps.expired(drift)) == [0, 1, 2]
    heaps.put(np.arange(3), np.array([[0, 100], [25, 36], [4, 4]]), drift)
    assert heaps.owner.tolist() == [0, 0, 0]  # ties go to the first
    again = heap_clusters.Heaps.unpacked(*heaps.packed(), 2)
    assert again.expired(np.array([0.5, 0.5])).tolist() == [2]
    assert again.expired(np.array([1.5, 1.5])).tolist() == [1]
    assert again.expired(np.array([9.0, 9.0])).tolist() == []


def test_few_vectors_are_measured_again(spark, monkeypatch):
    asked = []
    expired = heap_clusters.Heaps.expired

    def counted(self, drift):
        rows = expired(self, drift)
        asked.append(len(rows))
        return rows

    monkeypatch.setattr(heap_clusters.Heaps, "expired", counted)
    rng = np.random.default_rng(1)
    vectors = (rng.integers(0, 4, (400, 1)) * 900 + rng.integers(0, 50, (400, 8))).astype(np.int32)
    centroids = vectors[[0, 1, 2, 3, 4]].astype(np.int64)
    heaps, drift = heap_clusters.Heaps.fresh(400, 5), np.zeros(5)
    for _ in range(6):
        rows = heaps.expired(drift)
        heaps.put(rows, heap_clusters.squared_distances(vectors[rows], centroids), drift)
        exact = heap_clusters.squared_distances(vectors, centroids).argmin(1)
        assert (heaps.owner == exact).all()
        means = np.array(
            [vectors[exact == c].mean(0) if (exact == c).any() else centroids[c] for c in range(5)]
        ).astype(np.int64)
        drift = drift + heap_clusters.drifts(centroids, means)
        centroids = means
    assert asked[0] == 400 and sum(asked[-2:]) < 400


def test_clusters_of_awkward_vectors(spark):
    nan, big = float("nan"), 3e38
    rows = [
        (1, [1.0, 0.0]), (2, None), (3, []), (4, [nan, 0.0]), (5, [None, 1.0]), (6, [1.0]),
        (7, [big, -big]), (None, [0.5, 0.5]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [float("inf"), 0.0]),
    ]
    df = spark.createDataFrame([(*r, 0, "c") for r in rows], VECTORS)
    out = heap_clusters.cluster_report(df, size=2).collect()
    assert Counter(r["vec_id"] for r in out) == Counter([1, 7, None, 8, 8])
    # Fewer vectors than centroids; those too large count as the largest integers.
    assert {r["distance"] for r in out if r["vec_id"] in (1, 7, 8)} == {0}
    # In the end the row without an id has the centroid that equal ones have left to it.
    assert {r["inertia"] for r in out} == {0}
    for none in (df.limit(0), df.where("vec_id = 2")):
        assert heap_clusters.cluster_report(none, size=2).count() == 0


# Lexical search -----------------------------------------------------------------------


def brute_search(docs, items, top=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return Counter(pattern.findall((text or "").translate(lower)))

    counted = [(i, terms(t)) for i, t in docs]
    number = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc_id, c in counted:
            n, score = sum(c.values()), 0
            for term, times in wanted.items():
                if c[term]:
                    weight = math.floor(1000 * math.log((2 * number + 2) / (2 * holding[term] + 1)))
                    m = 100 - 75 + (75 * n * number) // length
                    score += times * weight * ((1000000000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, doc_id, -score))
    return Counter(out)


@pytest.mark.parametrize("shard, leaf, blocks", [(4 << 20, 256, False), (3000, 4, False), (3000, 0, True)])
def test_search_equals_brute_force(spark, monkeypatch, shard, leaf, blocks):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    if blocks:  # all terms indexed, several passes
        monkeypatch.setattr(lexical_search, "VOCABULARY_BYTES", 10)
        monkeypatch.setattr(lexical_search, "QUERY_BYTES", 900)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Éa", "été", "中文", "x9"]
    docs = [
        (i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(1, 90))))
        for i in range(300)
    ]
    docs += [(1000 - i, docs[7][1].upper()) for i in range(40)]  # many equal scores
    docs += [(3, docs[3][1]), (None, docs[7][1]), (2000, None), (2001, "!!! ---")]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(9)]
    items += [(20, docs[7][1]), (21, None), (22, "nowhere"), (3, "w1 w1 w2"), (None, "x9 x9")]
    got = lexical_search.search(
        spark.createDataFrame([row(i, t) for i, t in docs], COLUMNS),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"),
    )
    assert Counter(map(tuple, got.collect())) == brute_search(docs, items)


def test_range_maxima():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 0, 37, 5])
    values = rng.integers(0, 50, sizes.sum())
    places = np.concatenate([np.arange(s) for s in sizes])
    postings = lexical_search.Postings(places, values, sizes, 40)
    for first in range(1, 38):
        for end in range(first + 1, 39):
            at = postings.greatest(np.array([first]), np.array([end]))[0]
            assert first <= at < end and values[at] == values[first:end].max()


def test_search_in_little(spark, edges, no_docs):
    items = spark.createDataFrame([(1, "one naïve text")], "item_id long, text string")
    docs = [(r[0], r[1]) for r in EDGES]
    got = lexical_search.search(edges, items)
    assert Counter(map(tuple, got.collect())) == brute_search(docs, [(1, "one naïve text")])
    assert lexical_search.search(no_docs, items).count() == 0
    assert lexical_search.search(edges, items.limit(0)).count() == 0


# Repeats ------------------------------------------------------------------------------


def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return Counter(out)


def repeating_texts():
    rng = random.Random(11)
    passage, other = prose(120, 900), prose(90, 901)
    rows = [(i, prose(rng.randrange(5, 200), i)) for i in range(60)]
    for i in range(100, 140):  # one passage in many texts, at many places
        rows.append((i, prose(i % 9, i) + passage + prose(i % 13, 2 * i)))
    rows += [(200, passage[30:] + other), (201, other[:450]), (202, "é" * 900), (203, "x" + "é" * 300)]
    rows += [(300 + i, " " * (399 + 50 * i) + str(i)) for i in range(4)]
    rows += [(400, "ab" * 1000), (401, "ba" * 250), (402, "line\n" * 300), (403, prose(60, 7) * 3)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (501, rows[3][1]), (None, rows[5][1]), (None, None)]
    return rows + [(600, ""), (601, "a" * 400), (602, "a" * 399), (603, "\0" * 500)]


@pytest.mark.parametrize("most, block, piece", [(4096, 1 << 22, 1 << 22), (3, 2000, 1 << 22), (1, 5000, 1500)])
def test_repeats_equal_brute_force(spark, monkeypatch, most, block, piece):
    monkeypatch.setattr(repeated_spans, "MOST", most)
    monkeypatch.setattr(repeated_spans, "BLOCK", block)
    monkeypatch.setattr(repeated_spans, "SLICE", piece)
    rows = repeating_texts()
    docs = spark.createDataFrame([row(i, t) for i, t in rows], COLUMNS)
    got = Counter(map(tuple, repeated_spans.without_repeats(docs).collect()))
    assert got == brute_repeats(rows, 400)


@pytest.mark.parametrize("seed", range(6))
def test_block_order_finds_every_repeat(seed):
    rng = np.random.default_rng(seed)
    letters = [b"ab", b"abcdefgh", bytes(range(256))][seed % 3]
    parts = [bytes(rng.choice(list(letters), rng.integers(5, 300))) for _ in range(12)]
    strings = []
    for _ in range(15):
        strings.append(b"".join(parts[k] for k in rng.integers(0, 12, 6)) + b"z" * 40)
    strings += [b"a" * 500, b"a" * 430]
    windows = [len(s) - 99 for s in strings]
    got = repeated_spans.repeated_windows(strings, windows, 100)
    times = Counter(s[i : i + 100] for s in strings for i in range(len(s) - 99))
    want = [times[s[i : i + 100]] > 1 for s in strings for i in range(len(s) - 99)]
    assert got.tolist() == want


def test_repeats_write_few_files(spark, monkeypatch, tmp_path):
    """Files start processes, which count as their executor's memory: few, and none by partition."""
    monkeypatch.setattr(repeated_spans, "MOST", 3)
    monkeypatch.setattr(
        common, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}")
    )
    many = {
        "spark.sql.shuffle.partitions": "30",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in many}
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    try:
        for name, value in many.items():
            spark.conf.set(name, value)
        rows = repeating_texts()
        docs = spark.createDataFrame([row(i, t) for i, t in rows], COLUMNS)
        result = repeated_spans.without_repeats(docs)
        assert Counter(map(tuple, result.collect())) == brute_repeats(rows, 400)
        cores = spark.sparkContext.defaultParallelism
        assert result.rdd.getNumPartitions() <= cores
        files = {p.name: len(list(p.glob("part-*"))) for p in tmp_path.iterdir()}
        assert {n.split("-")[0] for n in files} >= {"shared", "classes", "cuts", "changed"}
        assert all(n <= cores * (4 if "stretches" in name else 1) for name, n in files.items())
        assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_bytes_of_stretches_come_in_small_batches(monkeypatch):
    monkeypatch.setattr(repeated_spans, "SLICE", 5000)
    text = prose(400, 3)
    rows = [(7, i, 1, 0, 1) for i in range(1000)]
    fields = [dict(zip(["trigger", "start", "windows", "at", "copies"], r)) for r in rows]
    batch = pa.RecordBatch.from_pydict({"key": [b"k"], "text": [text], "rows": [fields]})
    out = list(repeated_spans.bytes_of(iter([batch]), 400))
    assert max(sum(map(len, b.column("bytes").to_pylist())) for b in out) < 5400
    got = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert got == [(b"k", *r, text.encode()[r[1] : r[1] + 400]) for r in rows]


def test_repeats_of_awkward_texts(edges, no_docs):
    got = Counter(map(tuple, repeated_spans.without_repeats(edges).collect()))
    assert got == brute_repeats([(r[0], r[1]) for r in EDGES], 400)
    assert repeated_spans.without_repeats(no_docs).count() == 0
