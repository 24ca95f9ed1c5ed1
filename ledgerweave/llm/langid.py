"""Language ID: sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import chunks, held_out, learnable

#: About so many labelled documents train the model, however many there are: each language in
#: proportion, but LEAST of its documents, or all if it has fewer.
SAMPLE, LEAST = 4000, 100
BITS = 14
ORDERS = (1, 2, 3)
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def gram_counts(text: str) -> np.ndarray:
    """How often each hashed character n-gram stands in a lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(1 << BITS, np.int64)
    mixed = np.zeros(len(points), np.uint32)
    for n in ORDERS:
        if len(points) < n:
            break
        later = points[n - 1 :]
        mixed = (mixed[: len(later)] ^ (later + np.uint32(n))) * FACTORS[n - 1]
        mixed ^= mixed >> np.uint32(15)
        slots = (mixed * FACTORS[1]) >> np.uint32(32 - BITS)
        total += np.bincount(slots, minlength=1 << BITS)
    return total


@dataclass
class Model:
    """Language names, weights that hold the inverse document frequencies, temperature."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """Calibrated chances; one row per text."""
        norm = np.sqrt((counts * counts) @ (self.idf**2))
        logits = (counts @ self.weights) / np.maximum(norm, 1e-12)[:, None] + self.bias
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    """Shares of each row's exponentials."""
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int):
    """Weights by follow-the-regularised-leader with elastic-net penalties, row by row.

    The last slot is the bias, which bears no penalty on its size.
    """
    z = np.zeros((classes, (1 << BITS) + 1))
    n = np.zeros_like(z)

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    rng = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            slots, values = rows[i]
            held, seen = z[:, slots], n[:, slots]
            weights = solved(held, seen)
            error = softmax((weights @ values)[None, :])[0]
            error[labels[i]] -= 1
            gradient = error[:, None] * values[None, :]
            grown = seen + gradient**2
            z[:, slots] = held + gradient - (np.sqrt(grown) - np.sqrt(seen)) / ALPHA * weights
            n[:, slots] = grown
    weights = solved(z, n)
    return weights[:, :-1], weights[:, -1]


def sample_languages(usable: DataFrame, size: int, least: int = LEAST) -> DataFrame:
    """About ``size`` rows by a hash of their ids, each language with its share or ``least``."""
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one per language
    total = sum(r["n"] for r in counts)
    shares = [(r["lang"], min(1.0, max(size * r["n"] / total, least) / r["n"])) for r in counts]
    named = usable.sparkSession.createDataFrame(shares, "lang string, _share double")
    drawn = F.pmod(F.xxhash64(F.lit(4), F.col("doc_id")), F.lit(1 << 40))
    chosen = usable.join(F.broadcast(named), "lang").where(drawn < F.col("_share") * (1 << 40))
    return chosen.select(*usable.columns)


def document_frequencies(usable: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all rows each slot's n-grams stand, and how many have any.

    Each task sums its own rows; what comes back is one number per slot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((1 << BITS) + 1, np.int64)
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                used = np.flatnonzero(gram_counts(text or ""))
                sums[used] += 1
                sums[-1] += len(used) > 0
        slots = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(sums[slots])], ["slot", "n"])

    each = usable.select("text").mapInArrow(run, "slot long, n long")
    out = np.zeros((1 << BITS) + 1)
    for slot, n in each.groupBy("slot").agg(F.sum("n")).collect():  # at most one per slot
        out[slot] = n
    return out[:-1], int(out[-1])


def train(docs: DataFrame, sample_size: int = SAMPLE) -> Model:
    """Fit on about ``sample_size`` whole documents with a language, whose ids training may use.

    Executors count the n-grams; only the sample's sparse counts come to the driver.  Document
    frequencies are those of all rows with a language that training may use.  Four fifths of
    the sample train the weights, the rest the temperature.
    """
    usable = docs.where(learnable() & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")
    )
    sample = sample_languages(usable, sample_size)
    present, documents = document_frequencies(usable)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            slots, numbers = [], []
            for text in batch.column("text").to_pylist():
                counts = gram_counts(text or "")
                used = np.flatnonzero(counts)
                slots.append(used.astype(np.uint16).tobytes())
                numbers.append(counts[used].astype(np.uint32).tobytes())
            columns = [batch.column("doc_id"), batch.column("lang")]
            columns += [pa.array(slots, pa.binary()), pa.array(numbers, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "slots", "numbers"])

    schema = "doc_id long, lang string, slots binary, numbers binary"
    fitted = sample.mapInArrow(run, schema).collect()  # bounded by the sample
    fitted = [r for r in fitted if len(r["slots"])]
    fitted.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["slots"])))
    names = sorted({r["lang"] for r in fitted})
    labels = np.array([names.index(r["lang"]) for r in fitted], int)
    slots = [np.frombuffer(bytes(r["slots"]), np.uint16).astype(int) for r in fitted]
    numbers = [np.frombuffer(bytes(r["numbers"]), np.uint32).astype(float) for r in fitted]
    idf = np.log((1 + documents) / (1 + present)) + 1
    if len(names) < 2:
        shape = (1 << BITS, len(names))
        return Model(names, np.zeros(shape), np.zeros(len(names)), idf, 1.0)
    rows = []
    for s, c in zip(slots, numbers):
        values = c * idf[s]
        values /= np.linalg.norm(values)
        rows.append((np.append(s, 1 << BITS), np.append(values, 1.0)))
    split = np.arange(len(rows)) % 5 == 4 if len(rows) >= 20 else np.zeros(len(rows), bool)
    kept = [rows[i] for i in np.flatnonzero(~split)]
    weights, bias = follow_leader(kept, labels[~split], len(names))
    check = split if split.any() else ~split
    logits = np.array([weights[:, s[:-1]] @ v[:-1] + bias for (s, v), c in zip(rows, check) if c])
    return Model(names, (weights * idf).T, bias, idf, best_temperature(logits, labels[check]))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of logits with the least log loss."""
    tried = np.exp(np.linspace(-3, 3, 121))
    right = np.arange(len(labels))
    losses = [-np.log(softmax(logits / t)[right, labels] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    A null text and one without a letter are ``und`` with score 0, and so is every text where
    there was nothing to learn from.  Repeated rows get equal results.
    """
    model = model or train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if t and model.names and LETTER.search(t)]
            names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first in range(0, len(known), 64):
                part = known[first : first + 64]
                counts = np.stack([gram_counts(texts[i]) for i in part]).astype(float)
                chances = model.probabilities(counts)
                for i, row in zip(part, chances):
                    names[i], best[i] = model.names[int(row.argmax())], row.max()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(best)],
                ["doc_id", "lang_pred", "score"],
            )

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
