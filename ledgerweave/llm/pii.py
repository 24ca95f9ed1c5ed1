"""Personal data: exact patterns, and a character BiLSTM with CRF transitions that adds spans."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.char_tagger import KINDS, Tagger, train_tagger
from ledgerweave.llm.common import chunks, hash_sample

# The patterns of the kinds.  An address is looked for around each @ instead,
# with the same result in linear time; a number within digits can't begin an ip.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The rest of a domain's or a local part's run; a space may stand beside the @.
MORE_DOMAIN = re.compile(r"[A-Za-z0-9-]*(\.[A-Za-z0-9-]+)*")
ANCHOR = re.compile(r"[0-9@]")
NOT_DIGIT = re.compile(r"[^0-9]")

#: About so many documents give the tagger its labelled windows.
SAMPLE = 6000
REACH = 32
WINDOW, STRIDE = 96, 48


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses that don't overlap."""
    out, begin = [], 0
    at = text.find("@")
    while at >= 0:
        if at >= begin:
            local = text[begin:at]
            first = begin + len(local.rstrip(LOCAL))
            match = DOMAIN.match(text, at + 1) if first < at else None
            if match:
                out.append((first, match.end()))
            begin = match.end() if match else at + 1
        at = text.find("@", at + 1)
    return out


def valid(kind: str, found: str) -> bool:
    """Whether a match has the numbers that its kind asks for."""
    if kind == "ip":
        # int() of a very long part is refused, and such a part is too large anyway.
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in found.split("."))
    digits = NOT_DIGIT.sub("", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of the patterns, by kind and then by start."""
    if not ANCHOR.search(text):
        return []
    out = [("email", a, b) for a, b in emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        out += [
            (kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m[0])
        ]
    return out


def around_at(text: str, at: int) -> tuple[int, int]:
    """From the first to the last address character on both sides of an @."""
    a = at - (text[at - 1 : at] == " ")
    while a and text[a - 1] in LOCAL:
        a -= 1
    b = at + 1 + (text[at + 1 : at + 2] == " ")
    return a, MORE_DOMAIN.match(text, b).end()


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text near a digit or @, with the whole of an address around an @.

    Every span of the four kinds has one, so a tag elsewhere could only be wrong.
    """
    out: list[list[int]] = []
    for match in ANCHOR.finditer(text):
        a, b = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if match[0] == "@":
            first, last = around_at(text, match.start())
            a, b = min(a, first), max(b, last)
        while out and a <= out[-1][1]:
            before = out.pop()
            a, b = min(a, before[0]), max(b, before[1])
        out.append([a, b])
    return [(a, b) for a, b in out]


def windows(text: str) -> list[tuple[int, str]]:
    """Overlapping windows over the stretches, with their first place."""
    out = []
    for a, b in stretches(text):
        start = a
        while True:
            out.append((start, text[start : min(b, start + WINDOW)]))
            if start + WINDOW >= b:
                break
            start += STRIDE
    return out


def whole(text: str, span: tuple[int, int, str, float]) -> tuple[int, int, str, float]:
    """A tagged span, an address to the ends of its characters where a window cut it."""
    a, b, kind, score = span
    if kind == "email" and text.count("@", a, b) == 1:
        first, last = around_at(text, text.index("@", a, b))
        a, b = min(a, first), max(b, last)
    return a, b, kind, score


def reconciled(found: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """One set of spans from those of overlapping windows.

    Overlapping spans of one kind are parts of one, which windows cut, and are united.  Of
    overlapping spans of different kinds those with the greatest total score stay.
    """
    united: list[list] = []
    for kind in KINDS:
        for start, end, _, score in sorted(s for s in found if s[2] == kind):
            last = united[-1] if united and united[-1][2] == kind else None
            if last and start < last[1]:
                last[1], last[3] = max(end, last[1]), max(score, last[3])
            else:
                united.append([start, end, kind, score])
    spans = sorted(united, key=lambda s: s[1])
    ends = [s[1] for s in spans]
    totals, choice = [0.0], []
    for i, (start, _, _, score) in enumerate(spans):
        before = int(np.searchsorted(ends[:i], start, side="right"))
        taken = totals[before] + score
        choice.append((before, taken > totals[i]))
        totals.append(max(taken, totals[i]))
    out, i = [], len(spans)
    while i:
        before, taken = choice[i - 1]
        if taken:
            out.append(tuple(spans[i - 1]))
        i = before if taken else i - 1
    return out[::-1]


def added_spans(
    texts: list[str], base: list[list[tuple[str, int, int]]], tagger: Tagger | None
) -> list[list[tuple[str, int, int]]]:
    """What the tagger adds: spans that meet their kind's numbers and touch no base span."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if tagger is None:
        return out
    places = [(i, start, part) for i, t in enumerate(texts) for start, part in windows(t)]
    tagged = tagger.decode([part for _, _, part in places], WINDOW)
    found: dict[int, list] = {}
    for (i, start, _), spans in zip(places, tagged):
        moved = ((a + start, b + start, k, s) for a, b, k, s in spans)
        found.setdefault(i, []).extend(whole(texts[i], span) for span in moved)
    for i, spans in found.items():
        for a, b, kind, _ in reconciled(spans):
            part = texts[i][a:b]
            a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
            if any(a < e and s < b for _, s, e in base[i]) or not plausible(kind, texts[i][a:b]):
                continue
            out[i].append((kind, a, b))
    return out


def plausible(kind: str, found: str) -> bool:
    """Whether an added span has the parts of its kind, in some other notation."""
    if kind == "email":
        name, _, domain = found.partition("@")
        return bool(name.strip()) and "." in domain.strip(" .")
    if kind == "ip":
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and valid("ip", ".".join(parts))
    return valid(kind, found)


def learn(docs: DataFrame, sample_size: int = SAMPLE) -> Tagger | None:
    """Train the tagger on the windows of about ``sample_size`` whole documents.

    The labelled spans are the patterns' own; executors cut the windows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = hash_sample(texts, "doc_id", sample_size, texts.count(), seed=6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                for start, part in windows(text or ""):
                    end = start + len(part)
                    touching = [s for s in spans if s[1] < end and s[2] > start]
                    if any(a < start or b > end for _, a, b in touching):
                        continue  # a span is cut, so its characters have no right label
                    inside = [
                        {"kind": k, "start": a - start, "end": b - start} for k, a, b in touching
                    ]
                    rows.append({"part": part, "spans": inside})
            yield pa.RecordBatch.from_pylist(rows, labelled)

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    labelled = pa.schema([("part", pa.string()), ("spans", pa.list_(span))])
    schema = "part string, spans array<struct<kind: string, start: long, end: long>>"
    rows = sample.mapInArrow(run, schema).distinct().collect()  # windows of a bounded sample
    examples = sorted((r["part"], [tuple(s) for s in r["spans"]]) for r in rows)
    return train_tagger(examples, WINDOW)


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by kind and start."""
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find_pii(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Personal data in every whole text, in code points.

    Returns doc_id, n_email, n_ip, n_card and n_phone of the patterns, base_sha256 over their
    spans, and ``spans``: those and the tagger's.  Null counts as empty.  Repeated rows get
    equal results.  A table in which no pattern occurs gives no tagger and no added spans.
    """
    tagger = tagger or learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, tagger)
            kinds = [[s[0] for s in spans] for spans in base]
            counts = [pa.array([found.count(k) for found in kinds], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(listed(s).encode()).hexdigest() for s in base]
            every = [listed([*s, *more]) for s, more in zip(base, added)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digests), pa.array(every)],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string"
    )
