"""The operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerweave.llm import (
    char_tagger,
    chat_format,
    exact_dedup,
    langid,
    license_scan,
    mixing,
    near_vectors,
    ngram_join,
    packing,
    pii,
    toxicity,
)
from awkward import COLUMNS, prose, row

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# n-gram join --------------------------------------------------------------------------


def brute_links(texts: dict[int, str]):
    sets = {}
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0d]+", t.encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = {i: [] for i in texts}
    for a in sets:
        for b in sets:
            if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0:
                links[a].append(b)
    return links


def classes_of(links):
    out = {}
    for i in sorted(links):
        todo = [] if i in out else [i]
        while todo:
            at = todo.pop()
            if at not in out:
                out[at] = i
                todo += links[at]
    return out


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", block)
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", block)
    rng, texts = random.Random(3), {}
    for group in range(12):
        base = prose(60 + 40 * (group % 3), group).split()
        for _ in range(40 if group == 0 else 4):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(words)
    texts[900] = texts[3]
    docs = spark.createDataFrame([row(i, t) for i, t in texts.items()], COLUMNS)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(docs).collect()}
    links = brute_links(texts)
    classes = classes_of(links)
    assert got == {i: (classes[i], len(links[i])) for i in texts}


def test_pruning_keeps_what_it_must():
    needed = ngram_join.required_matches()
    rng = np.random.default_rng(0)
    lost = 0
    for _ in range(2000):
        equal = rng.random(ngram_join.HASHES) < 0.85
        lost += any(equal[:k].sum() < m for k, m in needed.items())
    assert lost == 0
    assert needed[25] >= 8 and needed[125] >= 75


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    signed = ngram_join.signatures(np.concatenate([a, b]), np.array([1000, 1000]))
    assert abs((signed[0] == signed[1]).mean() - 800 / 1200) < 0.15


# toxicity -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_rows(given):
    docs, labels = given("documents"), given("labels")
    return toxicity.score(docs, labels).join(labels, "doc_id").toPandas()


def test_toxicity_on_held_out_rows(toxic_rows):
    held = toxic_rows[toxic_rows.held_out]
    assert len(held) > 30
    assert (held.predicted == held.toxic).mean() > 0.9
    # Marked documents that don't differ from others can't be told; clean ones are left alone.
    assert held[held.toxic == 0].predicted.mean() < 0.03


def test_toxicity_never_learns_from_held_out_labels(spark, given, toxic_rows):
    labels = given("labels").withColumn(
        "toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    again = toxicity.score(given("documents"), labels).toPandas().set_index("doc_id").score
    before = toxic_rows.set_index("doc_id").score
    assert (again[before.index] == before).all()


def test_words_see_through_signs():
    data = np.frombuffer(b"id!ot I.D.I.O.T $cum clown! plain", np.uint8)
    hashes, _, _, _ = toxicity.words_in(data, np.array([0, len(data)]))
    assert list(toxicity.is_in(hashes, toxicity.hashes_of("idiot scum clown"))) == [True] * 4 + [False]


def test_isotonic_rises_and_boosting_learns():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    base, *trees = toxicity.boost(x, y)
    model = toxicity.Model(np.zeros(0), base, *trees, np.zeros(1), np.zeros(1))
    model.margin, model.probability = toxicity.isotonic(model.raw(x), y)
    assert (np.diff(model.probability) >= 0).all()
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.97


# vectors ------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [256, 16])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(500, 24))
    for i in range(0, 200, 2):
        vectors[i + 1] = vectors[i] + rng.normal(size=24) * 0.15
    vectors[300:380] = vectors[300] + rng.normal(size=(80, 24)) * 0.2
    vectors = vectors.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    close = units @ units.T >= 0.9
    links = {i: [j for j in np.flatnonzero(close[i]) if j != i] for i in range(500)}
    got = near_vectors.near_vectors(df).toPandas().set_index("vec_id")
    found = sum(got.n_links[i] for i in links)
    total = sum(map(len, links.values()))
    assert 0.95 * total <= found <= total
    assert all(got.n_links[i] <= len(links[i]) for i in links)
    classes = classes_of(links)
    assert np.mean([got.component_id[i] == classes[i] for i in links]) > 0.95


def close_classes(spark, vectors):
    """What near_vectors returns for rows of a matrix, and the links by brute force."""
    df = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"
    )
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    close = units @ units.T >= 0.9
    links = {i: [j for j in np.flatnonzero(close[i]) if j != i] for i in range(len(vectors))}
    return near_vectors.near_vectors(df).toPandas().set_index("vec_id"), links


@pytest.mark.parametrize("jitter", [0, 0.004])
def test_linked_groups_of_copies_are_one_component(spark, jitter):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(300, 32))
    for first in (0, 40, 80):
        a = vectors[first] / np.linalg.norm(vectors[first])
        side = rng.normal(size=32)
        side -= side @ a * a
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * side / np.linalg.norm(side)
        vectors[first : first + 12], vectors[first + 12 : first + 30] = a, b
    vectors += jitter * rng.normal(size=vectors.shape)
    got, links = close_classes(spark, vectors)
    classes = classes_of(links)
    assert all(got.n_links[i] == len(links[i]) for i in links)
    assert all(got.component_id[i] == classes[i] for i in links)
    assert {i for i in links if got.kept[i]} == set(classes.values())


def test_a_pair_at_the_threshold_meets_with_one_chance_at_any_size():
    for bits in range(1, 31):
        missed = (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** near_vectors.table_count(bits)
        assert missed <= 0.01


def test_audit_sees_lost_pairs_beside_a_large_group(spark):
    # 60 vectors of one cluster, all found, and 20 pairs, none of which is.
    rng = np.random.default_rng(3)
    units = rng.normal(size=(100, 48))
    units[:60] = units[0] + 0.01 * rng.normal(size=(60, 48))
    units[61::2] = units[60::2] + 0.01 * rng.normal(size=(20, 48))
    units /= np.linalg.norm(units, axis=1)[:, None]
    rows = [(i, bytearray(u.tobytes()), 0 if i < 60 else i) for i, u in enumerate(units)]
    located = spark.createDataFrame(rows, "node long, unit binary, component long")
    assert near_vectors.audit(located, 100) == (0, 60 * 59 + 40, 100)
    assert near_vectors.audit(located.where("component = 0"), 60).recall == 1


# chat ---------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@cases(st.text(st.sampled_from("<|\\im_end>a\n")))
def test_escaping_is_undone(text):
    assert "<|" not in chat_format.escape(text)
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert "\n" not in chat_format.escape_role(text)
    assert chat_format.unescape_role(chat_format.escape_role(text)) == text


def test_parts_are_flattened_in_order(spark):
    part = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
    parts = [
        ("text", "see ", None, None, None, None, None),
        ("image", None, "a.png", 57, 28, None, None),
        ("text", "<|image:0|>", None, None, None, None, None),
        ("audio", None, "b.wav", None, None, 1.5, None),
        ("document", None, "c.pdf", None, None, None, 2),
    ]
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{part}>")
    got = chat_format.format_turns(df).first()
    inside = got["formatted"][got["loss_start"] : got["loss_end"]]
    assert inside == "see <|image:0|><\\|image:0|><|audio:1|><|document:2|>"
    assert [tuple(a) for a in got["attachments"]] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 1200),
    ]
    with pytest.raises(ValueError):
        chat_format.Flattener().visit({"kind": "video"})


# personal data ------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@settings(max_examples=300, deadline=None)
@cases(st.text(st.sampled_from("a.@1+ 25-(0)é"), max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    plain = [
        (k, m.start(), m.end())
        for k, p in PATTERNS.items()
        for m in re.finditer(p, text)
        if k == "email" or pii.valid(k, m[0])
    ]
    assert pii.base_spans(text) == plain


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000 + ".", "1." * 100_000, "@" * 200_000, "+1(" * 60_000):
        pii.base_spans(text)


def test_gradients_of_the_tagger_are_right():
    rng = np.random.default_rng(4)
    h, labels = char_tagger.HIDDEN, char_tagger.LABELS
    shapes = {"in_l": (char_tagger.CLASSES, 4 * h), "rec_l": (h, 4 * h), "in_r": (char_tagger.CLASSES, 4 * h),
              "rec_r": (h, 4 * h), "out": (2 * h, labels), "bias": (labels,), "trans": (labels, labels)}
    p = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
    x, y = rng.integers(0, 20, (3, 7)), rng.integers(0, labels, (3, 7))
    _, grads = char_tagger.gradients(p, x, y)
    for name in p:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        sides = []
        for step in (0.01, -0.01):
            moved = {k: v.copy() for k, v in p.items()}
            moved[name][at] += step
            sides.append(char_tagger.gradients(moved, x, y)[0])
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 0.02, rel=0.03)


def test_tagger_adds_other_notations_only(spark, given):
    docs = given("documents")
    tagger = pii.learn(docs)
    texts = {
        "write to john.doe @ mail.example.com today": "email:9:36",
        "call +1 (372) 555-3866 now": "phone:5:22",
        "password=12beecadf6bd90a107 and 1200 of 5,000 in 2019": "",
        "Licensed under CC BY-NC 4.0.": "",
        "no digits at all": "",
    }
    df = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], COLUMNS)
    got = pii.find_pii(df, tagger).orderBy("doc_id").collect()
    assert [r["spans"] for r in got][1:] == list(texts.values())[1:]
    assert got[0]["spans"] in ("", "email:9:36")
    kept = pii.find_pii(docs, tagger).toPandas()
    for r in kept.itertuples():
        base = [s for s in r.spans.split(",") if s]
        assert len(base) >= r.n_email + r.n_ip + r.n_card + r.n_phone


def test_windows_are_reconciled():
    found = [(0, 5, "ip", 1.0), (3, 9, "ip", 2.0), (8, 20, "phone", 1.5), (25, 30, "card", 1.0)]
    assert pii.reconciled(found) == [(0, 9, "ip", 2.0), (25, 30, "card", 1.0)]
    text = "x" * 50 + "1" * 300 + "y" * 90
    covered = set()
    for start, part in pii.windows(text):
        covered |= set(range(start, start + len(part)))
    assert covered == set(range(18, 382))


def test_added_addresses_are_whole_however_long():
    class Spaced:
        def decode(self, parts, window):
            found = re.compile(r"[a-z.]+ @ [a-z.]+")
            return [
                [(m.start(), m.end(), "email", 1.0) for m in found.finditer(part)] for part in parts
            ]

    for local, domain in ((3, 50), (60, 20), (60, 150)):
        name, host = "n" * local, "d" * (domain - 4) + ".com"
        text = f"write to {name} @ {host}, or not"
        assert pii.added_spans([text], [[]], Spaced()) == [
            [("email", 9, 9 + local + 3 + domain)]
        ]


# exact dedup --------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 5, 100, 3000])
def test_the_hash_is_perfect_and_minimal(n):
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    seeds, slots = exact_dedup.perfect_hash(keys)
    assert sorted(slots) == list(range(n))
    assert (exact_dedup.slots_of(keys, seeds, n) == slots).all()
    others = [hashlib.sha256(f"x{i}".encode()).digest() for i in range(500)]
    assert set(exact_dedup.slots_of(others, seeds, n)) <= set(range(n))


@pytest.mark.parametrize("history", ["doc_id < 500", "true", "false", "doc_id % 3 = 0"])
def test_exact_dedup_for_any_history(given, history):
    docs = given("documents")
    got = {r["doc_id"]: tuple(r)[:4] for r in exact_dedup.exact_dedup(docs, F.expr(history)).collect()}
    by_text: dict[bytes, list[int]] = {}
    for r in docs.select("doc_id", "text").collect():
        by_text.setdefault((r["text"] or "").encode().lower(), []).append(r["doc_id"])
    want = {i: (i, max(g), len(g), i == max(g)) for g in by_text.values() for i in g}
    assert got == want


# packing ------------------------------------------------------------------------------


def test_ids_equal_the_tokenizer_library(given):
    tokenizer, encoding = Tokenizer.from_file(TOKENIZER), packing.load_encoding(TOKENIZER)
    texts = [r["text"] for r in given("documents").limit(60).collect()]
    texts += ["", "  \n\n x", "<|endoftext|> a <|endoftext|>", "naïve \U0001f600 12345'll  \t"]
    for text in texts:
        assert encoding.encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_covers_every_id_once(given):
    got = packing.pack(given("documents"), TOKENIZER).toPandas()
    for _, doc in got.groupby("doc_id"):
        doc = doc.sort_values("start")
        assert (doc.start.values == np.concatenate([[0], doc.length.cumsum()[:-1]])).all()
        assert doc.length.sum() == doc.doc_tokens.iloc[0]
    used = got.groupby("sequence_id").length.sum()
    assert used.max() <= packing.SEQUENCE
    assert used.sum() / (len(used) * packing.SEQUENCE) > 0.98
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()


@settings(max_examples=40, deadline=None)
@cases(st.lists(st.integers(0, 60), min_size=24, max_size=24))
def test_cutting_stock_covers_the_demand(demand):
    demand = np.array(demand)
    plan = packing.cutting_stock(demand, 24)
    sizes = np.arange(1, 25)
    assert all(p @ sizes <= 24 for p, _ in plan)
    made = sum((p * n for p, n in plan), np.zeros(24, int))
    assert (made >= demand).all()
    bins = sum(n for _, n in plan)
    large = demand[12:].sum()  # two of them never share a bin
    assert bins <= max(np.ceil(demand @ sizes / 24), large) * 1.2 + 12
    taken: Counter = Counter()
    for size, first, end, _, each in packing.intervals(plan):
        assert first == taken[size] and (end - first) % each == 0
        taken[size] = end


# license ------------------------------------------------------------------------------


def test_base_phrases_equal_words_counted_plainly(spark, given):
    extra = [
        row(5001, "CC BY cc-by ccby cc  BY, all RIGHTS\nreserved. General Public Licenses"),
        row(5002, "É general public license ünd all rights reserved"),
    ]
    docs = given("documents").select("doc_id", "text").union(
        spark.createDataFrame(extra, COLUMNS).select("doc_id", "text")
    )
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in docs.collect():
        low = r["text"].translate({c: c + 32 for c in range(65, 91)})
        words = word.findall(low)
        hits = [
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        mine = got[r["doc_id"]]
        places = [i for i, _ in hits]
        assert (mine["n_words"], mine["n_base"]) == (len(words), len(hits))
        assert (mine["first_word"], mine["last_word"]) == (min(places, default=None), max(places, default=None))
        assert mine["base_labels"] == ",".join(sorted({label for _, label in hits}))
        assert set(filter(None, mine["base_labels"].split(","))) <= set(mine["labels"].split(","))


def test_seeds_lose_no_notice_within_its_edits():
    rng, notices = random.Random(8), license_scan.Notices()
    for notice, label, edits, _ in notices.notices:
        for _ in range(6):
            chars = list(notice)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(chars))
                kind = rng.randrange(3)
                if kind == 0:
                    chars[at] = "#"
                elif kind == 1:
                    chars.insert(at, "#")
                else:
                    del chars[at]
            text = "lorem ipsum " * 20 + "".join(chars) + " dolor sit" * 20
            plain = regex.compile(f"(?:{regex.escape(notice)}){{e<={edits}}}", regex.BESTMATCH)
            assert plain.search(text)
            spans = notices.spans(text)
            assert spans and any(s[0] <= 245 and s[1] >= 235 + len(chars) for s in spans), (label, text)
    assert notices.spans("lorem ipsum dolor " * 500) == []


def test_fuzzy_notices_on_neighbouring_lines_are_all_found():
    notice = "permission is hereby granted, free of charge, to any person obtaining a copy"
    lines = [notice.replace("hereby", "herby")] * 5 + [notice]
    text, at, want = "\n".join(lines), 0, []
    for line in lines:
        want.append((at, at + len(line), "mit", 1 - (line != notice) / len(notice)))
        at += len(line) + 1
    assert license_scan.Notices().spans(text) == want


# mixing -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutations_are_permutations(n):
    image = mixing.permuted(np.arange(n), n, (1, 2, 3))
    assert sorted(image) == list(range(n))
    if n > 100:
        assert (image != np.arange(n)).mean() > 0.9
        assert (image != mixing.permuted(np.arange(n), n, (1, 2, 4))).any()


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.integers(0, 10**6), min_size=1, max_size=12))
def test_targets_share_the_whole_within_their_bounds(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    targets = mixing.water_fill(sizes, weights)
    assert sum(targets) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-6 for t, s in zip(targets, sizes))
    free = [t / w for t, s, w in zip(targets, sizes, weights) if t < 3 * s - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


def test_the_mix_meets_its_targets_and_repeats(given):
    docs = given("documents")
    first = mixing.mix_report(docs, shard_blocks=64).toPandas().sort_values("doc_id")
    again = mixing.mix_report(docs.repartition(5), shard_blocks=64).toPandas().sort_values("doc_id")
    assert (first.values == again.values).all()
    assert (first.taken <= 3 * first["size"]).all()
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect()}
    assert all(words[i] == n for i, n in zip(first.doc_id, first["size"]))
    for target, rows in first.groupby(first.source_size):
        assert rows.taken.sum() == pytest.approx(rows.target.iloc[0], rel=0.03)


def test_the_mixed_rows_hold_what_was_drawn(given):
    docs = given("documents")
    taken = mixing.mix_report(docs).toPandas().set_index("doc_id").taken
    rows = mixing.mixed_documents(docs).toPandas()
    words = rows.text.str.findall(r"[^\x20\x09-\x0D]+").str.len()
    assert (words.groupby(rows.doc_id).sum().reindex(taken.index, fill_value=0) == taken).all()
    assert rows.doc_id.value_counts().max() <= 3
    assert (rows.n_chars == rows.text.str.len()).all()


# language -----------------------------------------------------------------------------


def test_languages_of_held_out_rows(given):
    docs = given("documents")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 100
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()
    assert held.score.mean() == pytest.approx((held.lang == held.lang_pred).mean(), abs=0.05)


def test_the_penalty_makes_weights_sparse():
    rows = [(np.array([i % 7, 7 + i % 50, 1 << langid.BITS]), np.array([1.0, 0.2, 1.0])) for i in range(200)]
    weights, _ = langid.follow_leader(rows, np.array([i % 7 % 2 for i in range(200)]), 2)
    assert 0 < np.count_nonzero(weights) < 0.02 * weights.size


def test_texts_without_letters_are_unknown(edges):
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(edges).collect()}
    assert got[1] == got[2] == got[3] == got[9] == "und"
    assert got[6] != "und"
