"""Cases that once failed: repeated ids, long runs of white space, rare languages; and plain
replays of what SQL can't state."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from awkward import COLUMNS, prose, row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerweave.llm import langid, license_scan, near_vectors, ngram_join, packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def changed(text, word):
    words = text.split()
    words[len(words) // 2] = word
    return " ".join(words)


def test_texts_of_one_id_have_links_of_their_own(spark):
    c, d, unique = prose(300, 1), prose(300, 2), prose(300, 3)
    rows = [
        (3, c), (3, d), (9, changed(c, "other")), (10, changed(d, "other")), (2, unique),
        (2, changed(prose(300, 4), "x")), (1, prose(300, 4)), (3, c), (None, c),
    ]
    docs = spark.createDataFrame([row(i, t) for i, t in rows], COLUMNS)
    got = Counter(map(tuple, ngram_join.near_duplicates(docs).collect()))
    assert got == Counter(
        [
            (3, 3, 2, True), (3, 3, 2, True), (9, 3, 2, False), (3, 3, 1, True), (10, 3, 1, False),
            (2, 2, 0, True), (2, 1, 1, False), (1, 1, 1, True), (None, None, 0, True),
        ]
    )
    kept = ngram_join.one_of_each_class(docs)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(3, c), (3, d), (2, unique), (1, prose(300, 4)), (None, c)]
    )
    assert kept.columns == docs.columns


def test_an_id_on_two_texts_of_one_class_is_kept_once(spark):
    text = prose(300, 1)
    rows = [(5, text), (5, changed(text, "other")), (6, changed(text, "more"))]
    docs = spark.createDataFrame([row(i, t) for i, t in rows], COLUMNS)
    kept = [r["doc_id"] for r in ngram_join.one_of_each_class(docs).collect()]
    assert kept == [5]


@pytest.mark.parametrize("letter", [" ", "\n", "a"])
def test_very_long_runs_are_packed_with_the_librarys_ids(spark, tmp_path, letter):
    text = letter * 2_000_000
    docs = spark.createDataFrame([row(1, text), row(2, "short"), row(3, None)], COLUMNS)
    ids = [*Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids, 1]
    want = {
        start: zlib.crc32(np.array(ids[start : start + 2048], "<u4").tobytes())
        for start in range(0, len(ids), 2048)
    }
    for out in (packing.pack(docs, TOKENIZER), dict(corpus_pipeline.STAGES)["packing"](spark, docs, str(tmp_path))):
        pieces = {r["start"]: r["ids_crc32"] for r in out.where("doc_id = 1").collect()}
        assert pieces == want
        assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {1, 2, 3}


def language_rows(plenty, rare):
    def text(alphabet, i):
        rng = np.random.default_rng([len(alphabet), i])
        return " ".join("".join(rng.choice(list(alphabet), 5)) for _ in range(12))

    rows = [(i, text("abcdefg", i), "aa") for i in range(plenty)]
    rows += [(plenty + i, text("abcxyzw", 10**6 + i), "bb") for i in range(plenty // 2)]
    return rows + [(2 * plenty + i, text("opqrst", 10**7 + i), "cc") for i in range(rare)]


def test_a_rare_language_is_learned(spark):
    rows = language_rows(8_000, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, 200)
    assert model.names == ["aa", "bb", "cc"]
    found = langid.identify(docs, model).where("lang_pred = 'cc'")
    ids = {r["doc_id"] for r in found.collect()}
    assert len(ids & set(range(16_000, 16_012))) == 12 and len(ids) < 40


def test_the_sample_holds_every_language(spark):
    docs = spark.createDataFrame(language_rows(4_000, 12), "doc_id long, text string, lang string")
    counts = {r[0]: r[1] for r in langid.sample_languages(docs, 600, 50).groupBy("lang").count().collect()}
    assert counts["cc"] == 12
    assert 300 < counts["aa"] < 500 and 140 < counts["bb"] < 260


def test_frequencies_cover_all_rows(spark):
    rows = language_rows(300, 7) + [(9_001, None, "aa"), (9_002, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    present, documents = langid.document_frequencies(docs.repartition(5))
    want = np.zeros(1 << langid.BITS)
    for _, text, _ in rows:
        want[np.flatnonzero(langid.gram_counts(text or ""))] += 1
    assert (present == want).all() and documents == 457


def test_follow_the_leader_equals_a_dense_replay():
    rng = np.random.default_rng(3)
    size, classes = (1 << langid.BITS) + 1, 3
    rows, labels = [], rng.integers(0, classes, 30)
    for _ in range(30):
        slots = np.sort(rng.choice(size - 1, 6, replace=False))
        rows.append((np.append(slots, size - 1), np.append(rng.random(6), 1.0)))
    weights, bias = langid.follow_leader(rows, labels, classes)
    z, n = np.zeros((classes, size)), np.zeros((classes, size))
    w = np.zeros((classes, size))
    order = np.random.default_rng(1)
    for _ in range(langid.EPOCHS):
        for i in order.permutation(len(rows)):
            x = np.zeros(size)
            x[rows[i][0]] = rows[i][1]
            for c in range(classes):
                for k in np.flatnonzero(x):
                    # Each weight in closed form from the sums so far, one by one.
                    small = abs(z[c, k]) <= langid.L1
                    rate = (langid.BETA + n[c, k] ** 0.5) / langid.ALPHA + langid.L2
                    w[c, k] = 0 if small else -(z[c, k] - np.sign(z[c, k]) * langid.L1) / rate
            raised = np.exp(w @ x - (w @ x).max())
            gap = raised / raised.sum() - (np.arange(classes) == labels[i])
            for c in range(classes):
                for k in np.flatnonzero(x):
                    gradient = gap[c] * x[k]
                    sigma = ((n[c, k] + gradient**2) ** 0.5 - n[c, k] ** 0.5) / langid.ALPHA
                    z[c, k] += gradient - sigma * w[c, k]
                    n[c, k] += gradient**2
    rate = (langid.BETA + np.sqrt(n)) / langid.ALPHA + langid.L2
    final = np.where(np.abs(z) <= langid.L1, 0, -(z - np.sign(z) * langid.L1) / rate)
    assert np.allclose(weights, final[:, :-1]) and np.allclose(bias, final[:, -1])


@pytest.mark.parametrize("seed", range(4))
def test_the_packing_plan_is_near_the_best_one(seed):
    rng = np.random.default_rng(seed)
    capacity = 12
    demand = np.zeros(capacity, np.int64)
    for size in rng.choice(capacity, 4, replace=False):
        demand[size] = rng.integers(1, 6)
    sizes = [s + 1 for s in range(capacity) for _ in range(demand[s])]

    def fewest(left, rooms, best):
        """Exact bin packing by enumeration, largest piece first."""
        if len(rooms) >= best:
            return best
        if not left:
            return len(rooms)
        for b in {room: b for b, room in enumerate(rooms) if room >= left[0]}.values():
            best = min(best, fewest(left[1:], (*rooms[:b], rooms[b] - left[0], *rooms[b + 1 :]), best))
        return min(best, fewest(left[1:], (*rooms, capacity - left[0]), best))

    exact = fewest(tuple(sorted(sizes, reverse=True)), (), len(sizes) + 1)
    plan = packing.cutting_stock(demand, capacity)
    covered = sum(pattern * times for pattern, times in plan)
    assert (covered >= demand).all()
    assert all((pattern * np.arange(1, capacity + 1)).sum() <= capacity for pattern, _ in plan)
    assert exact <= sum(times for _, times in plan) <= exact + np.count_nonzero(demand)


# license scan: texts full of notices ---------------------------------------------------


def edited(text: str, edits: int, rng: random.Random) -> str:
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        chars[at : at + (kind != 1)] = [["#"], ["#"], []][kind]
    return "".join(chars)


def spans_by_brute_force(notices: license_scan.Notices, text: str) -> list:
    """The best match around every place, without seeds, filters or sorted neighbours."""
    found = set()
    for notice, label, edits, pattern in notices.notices:
        for at in range(-edits, len(text)):
            begin, stop = max(0, at - edits), min(len(text), at + len(notice) + edits)
            pieces = (len(notice) * i // (edits + 1) for i in range(edits + 1))
            ends = [len(notice) * (i + 1) // (edits + 1) for i in range(edits + 1)]
            if any(
                at + a >= 0 and text.startswith(notice[a:b], at + a) for a, b in zip(pieces, ends)
            ):
                match = pattern.search(text, begin, stop)
                if match:
                    score = 1 - sum(match.fuzzy_counts) / len(notice)
                    found.add((match.start(), match.end(), label, score))
    kept = []
    for span in sorted(found, key=lambda s: (-s[3], s[0] - s[1], s)):
        if all(span[1] <= k[0] or span[0] >= k[1] for k in kept):
            kept.append(span)
    return sorted(kept)


def test_notices_side_by_side_equal_brute_force():
    rng, notices = random.Random(5), license_scan.Notices()
    short = [n for n in license_scan.NOTICES if len(n) < 50]
    for _ in range(12):
        many = [edited(rng.choice(short), rng.randrange(4), rng) for _ in range(rng.randrange(4))]
        text = rng.choice(["", " ", "\n"]).join(many)
        assert notices.spans(text) == spans_by_brute_force(notices, text)


@pytest.mark.parametrize("edits", [0, 2])
def test_thousands_of_notices_take_no_quadratic_time(edits):
    rng, notices = random.Random(6), license_scan.Notices()
    names = [*license_scan.NOTICES]
    texts = [edited(rng.choice(names), edits, rng) for _ in range(4000)]
    started = time.monotonic()
    spans = notices.spans(" ".join(texts))
    assert time.monotonic() - started < 10  # under a second where it was written
    assert len(spans) > 3990
    assert len(license_scan.NOTICES) >= 24


# near vectors: recall that was measured -----------------------------------------------


def sparse_pairs(spark, n: int, pairs: int, partitions: int = 8):
    """Unrelated vectors, of which the first have one partner each at a cosine of 0.93."""
    rng = np.random.default_rng(11)
    units = rng.normal(size=(n, 32))
    units /= np.linalg.norm(units, axis=1)[:, None]
    side = rng.normal(size=(pairs, 32))
    a = units[:pairs]
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    units[n - pairs :] = 0.93 * a + np.sqrt(1 - 0.93**2) * side
    rows = pd.DataFrame({"vec_id": np.arange(n), "embedding": units.tolist()})
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(partitions)


def test_sparse_pairs_are_found_and_the_recall_rests_on_links(spark):
    n, pairs = 20_000, 120
    report, audit = near_vectors.search_vectors(sparse_pairs(spark, n, pairs))
    got = report.toPandas().set_index("vec_id")
    found = sum(got.component_id[n - pairs + i] == i for i in range(pairs))
    assert found >= 0.9 * pairs
    assert audit.reached and audit.links >= 100


def test_recall_without_links_is_unknown_unless_all_were_audited(spark, monkeypatch):
    assert near_vectors.search_vectors(sparse_pairs(spark, 200, 0))[1] == (1.0, 0, 200)
    monkeypatch.setattr(near_vectors, "AUDITED", 20)
    monkeypatch.setattr(near_vectors, "MOST_AUDITED", 40)
    report, audit = near_vectors.search_vectors(sparse_pairs(spark, 400, 0))
    assert audit.recall is None and audit.links == 0
    assert report.where("n_links > 0 or not kept").count() == 0


def test_a_fresh_draw_tells_links_that_were_missed(spark):
    nodes = [(i, i // 2 * 2 if i < 100 else i) for i in range(400)]
    located = spark.createDataFrame(nodes, "node long, component long")
    rows = [(i, i + 1) for i in range(0, 400, 2)] + [(1, 0)]
    edges = spark.createDataFrame(rows, "node long, joined long")
    audit, new = near_vectors.recaptured(edges, located, 400)
    assert (audit, new) == ((0.25, 200, 400), 150)
    few = edges.where("node < 50")
    assert near_vectors.recaptured(few, located, 400)[0].recall is None
