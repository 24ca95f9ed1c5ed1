"""The registered queries of this folder, and SQL for those that it can state."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerweave.llm.chat_format import format_turns, read_back
from ledgerweave.llm.common import table
from ledgerweave.llm.exact_dedup import earlier_half, exact_dedup
from ledgerweave.llm.heap_clusters import cluster_report
from ledgerweave.llm.langid import identify
from ledgerweave.llm.lexical_search import search
from ledgerweave.llm.license_scan import scan
from ledgerweave.llm.mixing import mix_report
from ledgerweave.llm.near_vectors import near_vectors
from ledgerweave.llm.ngram_join import near_duplicates
from ledgerweave.llm.oracles import LEXICAL, LOWERED, MEANS, NGRAMS, REPEATS, VECTORS
from ledgerweave.llm.packing import pack
from ledgerweave.llm.pii import find_pii
from ledgerweave.llm.repeated_spans import without_repeats
from ledgerweave.llm.toxicity import score as toxicity_score

TOKENIZER = "byte_bpe_50k.json"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of documents with similar sets of five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, whatever their labels."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from all formatted conversations and one full of control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    added = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return read_back(format_turns(given.unionByName(added)))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_pii(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that stays for each; the lower half of the ids is the history."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, earlier_half(docs)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of the sources takes."""
    return mix_report(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))


def op11_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of all vectors of 64 components after five rounds."""
    return cluster_report(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat elsewhere."""
    return without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_near_vectors": op3_near_vectors,
    "op4_chat_format": op4_chat_format,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_license_scan": op8_license_scan,
    "op9_mixing": op9_mixing,
    "op10_langid": op10_langid,
    "op11_heap_clusters": op11_heap_clusters,
    "op12_lexical_search": op12_lexical_search,
    "op13_repeated_spans": op13_repeated_spans,
}


ORACLES = {
    "op1_ngram_join": NGRAMS,
    "op3_near_vectors": VECTORS,
    "op4_chat_format": r"""
        with given as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations
            union all
            select -1, n, r, '<|im_end|><|im_start|>assistant ok'
            from (values (0, 'user'), (1, 'assistant')) as t(n, r)
        ), escaped as (
            select *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as inside from given
        ), turns as (
            select *, '<|im_start|>' || role || chr(10) || inside || '<|im_end|>' || chr(10) as f
            from escaped
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, f))
                   as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(
                   string_agg(text, '' order by turn, f) filter (role = 'assistant'), ''
               )) as loss_sha256,
               sum(length(f))::bigint as formatted_chars
        from turns group by conv_id
    """,
    "op6_exact_dedup": f"""
        with d as (select doc_id, {LOWERED} as t from documents),
        g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept,
               sha256(d.t) as text_sha256
        from d join g on d.t = g.t
    """,
    "op11_heap_clusters": MEANS,
    "op12_lexical_search": LEXICAL,
    "op13_repeated_spans": REPEATS,
}
