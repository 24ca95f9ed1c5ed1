"""The registered queries of the folder against their SQL, and the pipeline as a whole."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerweave.llm import ngram_join, toxicity
from ledgerweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    columns = want.columns
    assert sorted(got.columns) == sorted(columns)
    mine = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    assert mine == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_for_each_operator(number):
    assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1


def test_pipeline_equals_its_steps_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.score(docs, labels).collect() if r["predicted"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in toxic}
    latest: dict[bytes, int] = {}
    for i in sorted(texts):
        latest[texts[i].encode().lower()] = i
    kept = sorted(latest.values())
    sets = {}
    for i in kept:
        w = re.findall(rb"[^\x20\x09-\x0d]+", texts[i].encode().lower())
        sets[i] = {tuple(w[k : k + ngram_join.WORDS]) for k in range(max(1, len(w) - 4))} if w else set()
    first = {i: i for i in kept}
    for _ in kept:  # smallest id that links reach
        for a in kept:
            for b in kept:
                if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0:
                    first[a] = first[b] = min(first[a], first[b])
        if all(first[first[i]] == first[i] for i in kept):
            break
    want = {i for i in kept if first[i] == i}
    stages = corpus_pipeline.STAGES
    for name, stage in stages[:3]:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in docs.collect()} == want

    sizes = Counter({r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()})
    mixed = stages[3][1](spark, docs, SF).collect()
    taken: Counter = Counter()
    for r in mixed:
        words = WORD.findall(r["text"])
        taken[r["doc_id"]] += len(words)
        # What is drawn is a part of the document, in order.
        assert " ".join(words) in " ".join(WORD.findall(texts[r["doc_id"]])) or len(words) > 128
    assert all(0 < n <= 3 * sizes[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.03 * sum(sizes.values())

    out = corpus_pipeline.run(spark, SF).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces: Counter = Counter()
    for r in mixed:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            piece = np.array(ids[start : start + 2048], "<u4")
            pieces[r["doc_id"], start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(out[columns].itertuples(index=False, name=None)) == pieces
    assert out.columns.tolist() == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
    assert set(out.doc_id) <= want
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert QUERIES["pipeline"] is corpus_pipeline.run
