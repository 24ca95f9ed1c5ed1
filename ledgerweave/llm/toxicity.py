"""Toxicity: boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import (
    LOWER,
    WHITE,
    append_columns,
    byte_class,
    chunks,
    free_name,
    hash_sample,
    held_out,
    learnable,
    mix,
    per_text,
    runs,
    text_bytes,
    word_hashes,
    written,
)

#: About so many labelled documents train the model, however many there are.
SAMPLE = 30_000
LEXICON_SIZE = 2000
PREFIXES = (4, 5, 6)
NEAR = 5

# Insults, and words that address the reader.
INSULTS = (
    "idiot idiots moron morons stupid pathetic worthless trash scum loser losers clown disgusting "
    "dumb fool garbage imbecile jerk creep filth vermin bastard bitch asshole shit fuck cunt "
    "dummkopf trottel depp arschloch abschaum schwachkopf dumm widerlich "
    "imbécile crétin connard salaud abruti débile ordure "
    "estúpido imbécil basura asqueroso gilipollas cabrón"
)
ADDRESS = "you your youre yours yourself u du dich dir dein deine tu te toi ton vous votre usted ti"

LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
UPPER = byte_class((0x41, 0x5A))
PUNCTUATION = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
# Signs that stand for a letter when a letter follows.
STANDS_FOR = np.zeros(256, np.uint8)
for _sign, _letter in zip(b"@4310!$5", b"aaeioiss"):
    STANDS_FOR[_sign] = _letter


def hashes_of(words: str) -> np.ndarray:
    """Sorted hashes of words, as ``words_in`` makes them."""
    data = " ".join(words.split()).encode()
    buffer = np.frombuffer(data, np.uint8)
    starts, ends = runs(~WHITE[buffer], np.array([0, len(buffer)]))
    return np.unique(word_hashes(buffer, starts, ends))


def words_in(data: np.ndarray, offsets: np.ndarray):
    """Words with signs undone: hashes, hashes of their beginnings, first byte, texts' edges.

    A word is a run without white space; signs between its letters are read as the letter
    they stand for, or left out.
    """
    solid = ~WHITE[data]
    starts, _ = runs(solid, offsets)
    letter = LETTER[data]
    follows = np.zeros(len(data), bool)
    follows[:-1] = letter[1:]
    if len(data):
        follows[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
    disguised = (STANDS_FOR[data] > 0) & follows
    kept = np.flatnonzero(letter | disguised)
    text = np.where(disguised, STANDS_FOR[data], LOWER[data])[kept]
    word = np.searchsorted(starts, kept, side="right") - 1
    first = np.flatnonzero(np.diff(word, prepend=-1))
    last = np.append(first[1:], len(kept))[: len(first)]
    hashes = word_hashes(text, first, last)
    begins = []
    for size in PREFIXES:
        # A beginning is hashed with its length, so it never equals a word.
        end = np.minimum(first + size, last)
        begin = mix(word_hashes(text, first, end) + np.uint64(size))
        begins.append(np.where(last - first > size, begin, hashes))
    return hashes, begins, kept[first], per_text(kept[first], offsets)


def is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if len(among) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Totals between one edge and the next."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[edges[1:]] - total[edges[:-1]]).astype(float)


def features(batch: pa.RecordBatch, learned: np.ndarray) -> np.ndarray:
    """One row of dense features per text; all zero for an empty text."""
    data, offsets = text_bytes(batch.column("text"))
    hashes, begins, _, edges = words_in(data, offsets)
    insult = is_in(hashes, hashes_of(INSULTS))
    marked = is_in(hashes, learned)
    for begin in begins:
        marked |= is_in(begin, learned)
    address = is_in(hashes, hashes_of(ADDRESS))
    words = np.maximum(1, np.diff(edges)).astype(float)
    # Second person within a few words of an insult, in the same text.
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    hit, persons = np.flatnonzero(insult | marked), np.flatnonzero(address)
    near = np.zeros(len(hashes), bool)
    if len(persons) and len(hit):
        at = np.searchsorted(persons, hit)
        for side in (np.minimum(at, len(persons) - 1), np.maximum(at - 1, 0)):
            other = persons[side]
            near[hit] |= (np.abs(other - hit) <= NEAR) & (owner[other] == owner[hit])
    letter = LETTER[data]
    between = np.zeros(len(data), bool)
    if len(data) > 2:
        between[1:-1] = letter[:-2] & letter[2:] & ~letter[1:-1] & ~WHITE[data[1:-1]]
        between[1:-1] &= data[1:-1] != 0x27
        begin = offsets[:-1][offsets[:-1] < offsets[1:]]
        between[begin] = False
    repeat = np.zeros(len(data), bool)
    repeat[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & ~WHITE[data[2:]]
    length = np.maximum(1, np.diff(offsets)).astype(float)
    letters = np.maximum(1, sums(letter, offsets))
    return np.stack(
        [
            sums(insult, edges) / words,
            np.log1p(sums(insult, edges)),
            sums(marked, edges) / words,
            np.log1p(sums(marked, edges)),
            sums(address, edges) / words,
            sums(near, edges) / words,
            sums(UPPER[data], offsets) / letters,
            sums(PUNCTUATION[data], offsets) / length,
            sums(data == 0x21, offsets) / length,
            sums(between, offsets) / words,
            sums(repeat, offsets) / length,
        ],
        axis=1,
    )


# Training ----------------------------------------------------------------------------


@dataclass
class Model:
    """Lexicon hashes, trees of depth three as arrays, and the calibration's steps."""

    learned: np.ndarray
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    margin: np.ndarray
    probability: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated chance that a text is toxic."""
        return np.clip(np.interp(self.raw(rows), self.margin, self.probability), 0, 1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """The trees' sum."""
        total = np.full(len(rows), self.base)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), int)
            for _ in range(3):
                right = rows[np.arange(len(rows)), feature[node]] > threshold[node]
                node = 2 * node + 1 + right
            total += leaf[node - 7]
        return total


def learn_lexicons(sample: DataFrame) -> list[np.ndarray]:
    """Hashes of words and beginnings of words that mark toxic documents.

    Three lexicons: from the parts 0-4 of the sample, from the parts 5-9, and from all.

    A term counts once per document.  It is taken if at least four toxic documents have it,
    its share among them is twenty times that among the others, and its G statistic is 20.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            hashes, begins, _, edges = words_in(data, offsets)
            toxic = np.asarray(batch.column("toxic").to_pylist(), bool)
            owner = np.repeat(np.arange(len(toxic)), np.diff(edges))
            part = batch.column("part").to_numpy()
            terms = np.concatenate([hashes, *begins])
            owners = np.tile(owner, 1 + len(begins))
            # Once per document, then counted by half and kind.
            pairs = np.unique(np.stack([terms, owners.astype(np.uint64)]), axis=1)
            own = pairs[1].astype(int)
            for half in (0, 5):
                mine = (part[own] >= 5) == (half == 5)
                term, index, total = np.unique(
                    pairs[0][mine], return_inverse=True, return_counts=True
                )
                bad = np.bincount(index, toxic[own[mine]], len(term)).astype(np.int64)
                arrays = [pa.array(term.view(np.int64)), pa.array(np.full(len(term), half))]
                arrays += [pa.array(bad), pa.array(total - bad)]
                yield pa.RecordBatch.from_arrays(arrays, ["term", "part", "toxic", "clean"])

    halves = [F.col("part") < 5, F.col("part") >= 5]
    count = lambda value, which: F.coalesce(
        F.sum(F.when(which, value)), F.lit(0)
    )
    sizes = sample.agg(
        *(count(v, h) for h in halves for v in (F.col("toxic"), 1 - F.col("toxic")))
    ).first()
    counted = sample.select("text", "toxic", "part").mapInArrow(
        run, "term long, part long, toxic long, clean long"
    )
    sums_of = [count(F.col(v), h) for h in halves for v in ("toxic", "clean")]
    terms = counted.groupBy("term").agg(*(c.alias(f"n{i}") for i, c in enumerate(sums_of)))
    out = []
    for of in ((0, 1), (2, 3), None):
        if of is None:
            bad, good = sizes[0] + sizes[2], sizes[1] + sizes[3]
            toxic, clean = F.col("n0") + F.col("n2"), F.col("n1") + F.col("n3")
        else:
            bad, good = (sizes[i] for i in of)
            toxic, clean = (F.col(f"n{i}") for i in of)
        out.append((_marks(toxic, clean, bad, good), toxic))
    flagged = terms.select("term", *(m.alias(f"m{i}") for i, (m, _) in enumerate(out)))
    best = flagged.where("m0 > 0 or m1 > 0 or m2 > 0")
    best = best.orderBy(F.desc(F.greatest("m0", "m1", "m2")), "term").limit(LEXICON_SIZE)
    rows = best.collect()
    return [
        np.sort(np.array([r[0] for r in rows if r[i] > 0], np.int64).view(np.uint64))
        for i in (1, 2, 3)
    ]


def _marks(toxic: Column, clean: Column, bad: int, good: int) -> Column:
    """A term's G statistic if it marks toxic documents, else 0."""
    if not bad or not good:
        return F.lit(0.0)
    rate = bad / (bad + good)
    gain = toxic * F.log(F.greatest(toxic, F.lit(1)) / (toxic + clean) / rate) * 2
    ratio = (toxic / bad) / ((clean + 0.5) / good)
    return F.when((toxic >= 4) & (ratio >= 20) & (gain >= 20), gain).otherwise(0.0)


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2) -> tuple:
    """Trees of depth three on the logistic loss, split at quantiles."""
    share = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    cuts = [np.unique(np.quantile(f, np.linspace(0, 1, 34)[1:-1])) for f in x.T]
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), int)
        feature, threshold = np.zeros(7, int), np.full(7, np.inf)
        for n in range(7):
            mine = np.flatnonzero(node == n)
            best = 1e-6
            total, weight = gradient[mine].sum(), hessian[mine].sum()
            for f in range(x.shape[1]) if len(mine) >= 8 else ():
                bins = np.searchsorted(cuts[f], x[mine, f])  # bin b: above b cuts
                g = np.bincount(bins, gradient[mine], len(cuts[f]) + 1)[::-1].cumsum()[::-1][1:]
                h = np.bincount(bins, hessian[mine], len(cuts[f]) + 1)[::-1].cumsum()[::-1][1:]
                if len(g) == 0:
                    continue
                gain = g**2 / (h + 1) + (total - g) ** 2 / (weight - h + 1)
                gain = gain - total**2 / (weight + 1)
                if gain.max() > best:
                    best, feature[n] = gain.max(), f
                    threshold[n] = cuts[f][gain.argmax()]
            node[mine] = 2 * n + 1 + (x[mine, feature[n]] > threshold[n])
        inside = [node == k for k in range(7, 15)]
        leaf = np.array([rate * gradient[i].sum() / (hessian[i].sum() + 1) for i in inside])
        margin += leaf[node - 7]
        trees.append((feature, threshold, leaf))
    return base, *(np.array(part) for part in zip(*trees))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising steps as points for linear interpolation."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, least and greatest margin
    for m, v in zip(margin[order], y[order]):
        blocks.append([float(v), 1.0, float(m), float(m)])
        while len(blocks) > 1 and (
            blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] >= blocks[-1][2]
        ):
            a, b = blocks[-2], blocks.pop()
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1], a[3] = a[1] + b[1], b[3]
    points = [p for b in blocks for p in ((b[2], b[0]), (b[3], b[0]))]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE) -> Model:
    """Fit on about ``sample_size`` labelled documents whose ids training may use.

    Each half's features use the lexicon of the other half, so the trees see it as it does on
    new texts; they learn on eight tenths and the calibration on the rest.  The model keeps the
    lexicon of all.  Several labels of a document count as
    toxic if one is; null labels are ignored; copies of a text count once.
    """
    usable = labels.where(learnable() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_sample(usable, "doc_id", sample_size, usable.count(), seed=2)
    chosen = chosen.withColumnRenamed("doc_id", "label_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    joined = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["label_id"])
    part = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(10)).alias("part")
    joined = joined.select("text", "toxic", part, F.xxhash64("text").alias("key"))
    sample = written(joined.dropDuplicates(["key"]), "toxic-sample")
    lexicons = learn_lexicons(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            of_other = [features(batch, lexicons[1 - half]) for half in (0, 1)]
            part = batch.column("part").to_numpy()
            rows = np.where((part < 5)[:, None], *of_other)
            listed = pa.array(list(rows), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("part"), batch.column("toxic"), listed],
                ["key", "part", "toxic", "row"],
            )

    schema = "key long, part long, toxic int, row array<double>"
    fitted = sample.mapInArrow(run, schema).collect()  # bounded by the sample
    fitted.sort(key=lambda r: r["key"])
    x = np.array([r["row"] for r in fitted], float)
    y = np.array([r["toxic"] for r in fitted], float)
    first = np.array([r["part"] % 5 < 4 for r in fitted], bool)
    if not first.any() or first.all() or y[first].min() == y[first].max():
        share = np.array([y.mean() if len(y) else 0.0])
        none, leaves = np.zeros((0, 7)), np.zeros((0, 8))
        return Model(lexicons[2], 0.0, none.astype(int), none, leaves, np.zeros(1), share)
    base, feature, threshold, leaf = boost(x[first], y[first])
    model = Model(lexicons[2], base, feature, threshold, leaf, np.zeros(1), np.zeros(1))
    model.margin, model.probability = isotonic(model.raw(x[~first]), y[~first])
    return model


def scores(model: Model, batch: pa.RecordBatch) -> pa.Array:
    """Scores of a batch's texts."""
    return pa.array(model.score(features(batch, model.learned)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null or empty text is scored as a text without words.  Repeated rows score alike.
    Without labels of both kinds the score is the toxic share of what there is, or 0.
    """
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), scores(model, batch)], ["doc_id", "score"]
            )

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double"
    )
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    model = train(docs, labels)
    name = free_name(docs, "_score")
    scored = append_columns(docs, lambda batch: [scores(model, batch)], [name], ["double"])
    return scored.where(F.col(name) < 0.5).drop(name)
