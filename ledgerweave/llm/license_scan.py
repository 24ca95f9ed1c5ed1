"""License scans: short notices found with a bounded number of edits."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import byte_class, chunks, per_text, runs, text_bytes

# Phrases whose words have to stand consecutively, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices, lower-cased, and the labels that they get.
NOTICES = {
    "licensed under cc by-nc 4.0": "cc-by-nc",
    "licensed under cc by-sa 4.0": "cc-by-sa",
    "licensed under the apache license, version 2.0": "apache-2.0",
    "licensed under the gnu general public license, version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "released under the mit license": "mit",
    "permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use, copy, modify, and/or distribute this software": "isc",
    "the author has waived all copyright and related or neighboring rights": "cc0",
    "gnu affero general public license": "agpl",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "redistributions of source code must retain the above copyright notice": "bsd",
    "distributed under the boost software license, version 1.0": "bsl-1.0",
    "licensed under a creative commons attribution 4.0 international license": "cc-by-4.0",
    "creative commons attribution-noncommercial": "cc-by-nc",
    "creative commons attribution-sharealike": "cc-by-sa",
    "made available under the terms of the eclipse public license": "epl",
    "licensed under the european union public licence": "eupl",
    "modify it under the terms of the gnu general public license": "gpl",
    'the software is provided "as is", without warranty of any kind': "mit",
    "no part of this publication may be reproduced": "no-reproduction",
    "this software is provided 'as-is', without any express or implied warranty": "zlib",
}
#: One edit for so many characters of a notice.
CHARACTERS_PER_EDIT = 12
#: An edit touches so many grams of a notice at most, so a window lacking more holds no match.
GRAM = 4
WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_WORD = rb"[0-9a-z\x80-\xff]"


def phrase_patterns() -> list[tuple[bytes, re.Pattern[bytes], str]]:
    """A word to look for first, the pattern of the phrase in lower-cased bytes, its label."""
    out = []
    for phrase, label in PHRASES.items():
        words = phrase.encode().split()
        between = rb"[^0-9a-z\x80-\xff]+"
        pattern = rb"(?<!%s)%s(?!%s)" % (_WORD, between.join(words), _WORD)
        out.append((max(words, key=len), re.compile(pattern), label))
    return out


class Notices:
    """Seeds of all notices in one automaton, and the pattern that verifies each.

    A notice within k edits keeps at least one of k + 1 pieces whole, so every such place
    has an exact seed.
    """

    def __init__(self) -> None:
        self.seeds = ahocorasick.Automaton()
        self.notices, self.grams = [], []
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate(NOTICES.items()):
            edits = len(notice) // CHARACTERS_PER_EDIT
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                found.setdefault(notice[a:b], []).append((number, a))
            pattern = regex.compile(
                f"(?:{regex.escape(notice)}){{e<={edits}}}", regex.BESTMATCH | regex.VERSION1
            )
            grams = [notice[i : i + GRAM] for i in range(len(notice) - GRAM + 1)]
            self.notices.append((notice, label, edits, pattern))
            self.grams.append(grams)
        for seed, places in found.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, score) of the notices in a lower-cased text."""
        exact: set[tuple[int, int]] = set()
        others: set[tuple[int, int]] = set()
        for end, (size, places) in self.seeds.iter(text):
            for number, at in places:
                place = (number, end + 1 - size - at)
                if place not in exact and place not in others:
                    begin = place[1]
                    whole = begin >= 0 and text.startswith(self.notices[number][0], begin)
                    (exact if whole else others).add(place)
        out = set()
        for number, begin in exact:
            notice, label, _, _ = self.notices[number]
            out.add((begin, begin + len(notice), label, 1.0))
        # Each by itself: a window holds one place at most, and the best match of a longer
        # stretch would hide the places before it.
        for number, begin in others:
            notice, label, edits, pattern = self.notices[number]
            # A notice without an edit inside the window is its best match.
            if any((number, begin + d) in exact for d in range(-edits, edits + 1)):
                continue
            stop = min(len(text), begin + len(notice) + edits)
            window = text[max(0, begin - edits) : stop]
            if sum(gram not in window for gram in self.grams[number]) > GRAM * edits:
                continue
            match = pattern.search(text, max(0, begin - edits), stop)
            if match:
                made = sum(match.fuzzy_counts)
                out.add((match.start(), match.end(), label, 1 - made / len(notice)))
        # Notices resemble one another: of spans that overlap the best one counts.  Those kept
        # lie apart, so only the neighbours of a new one can meet it.
        kept: list[tuple[int, int, str, float]] = []
        for span in sorted(out, key=lambda s: (-s[3], s[0] - s[1], s)):
            at = bisect.bisect(kept, span)
            before = at == 0 or kept[at - 1][1] <= span[0]
            if before and (at == len(kept) or span[1] <= kept[at][0]):
                kept.insert(at, span)
        return kept


def scan(docs: DataFrame) -> DataFrame:
    """License phrases and notices in every whole text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    spans, an array of (start, end, label, score) in code points.  A-Z is lower-cased first.
    ``score`` is 1 with a phrase, else that of the best notice, else 0.  Null counts as
    empty.  Repeated rows get equal results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices, phrases = Notices(), phrase_patterns()
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            starts, _ = runs(WORD_BYTES[data], offsets)
            edges = per_text(starts, offsets)
            rows = []
            for i in range(batch.num_rows):
                low = data[offsets[i] : offsets[i + 1]].tobytes().lower()
                own = starts[edges[i] : edges[i + 1]] - offsets[i]
                places, base = [], set()
                for needle, pattern, label in phrases:
                    if needle in low:
                        hits = [m.start() for m in pattern.finditer(low)]
                        places += hits
                        base |= {label} if hits else set()
                words = np.searchsorted(own, places) if places else None
                spans = notices.spans(low.decode())
                labels = base | {s[2] for s in spans}
                rows.append(
                    {
                        "n_words": len(own),
                        "n_base": len(places),
                        "first_word": int(words.min()) if places else None,
                        "last_word": int(words.max()) if places else None,
                        "base_labels": ",".join(sorted(base)),
                        "labels": ",".join(sorted(labels)),
                        "score": 1.0 if places else max((s[3] for s in spans), default=0.0),
                        "spans": [dict(zip(("start", "end", "label", "score"), s)) for s in spans],
                    }
                )
            table = pa.Table.from_pylist(rows, found)
            for part in table.combine_chunks().to_batches():
                columns = [batch.column("doc_id"), *part.columns]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *part.schema.names])

    places = [("start", pa.int64()), ("end", pa.int64())]
    span = pa.struct([*places, ("label", pa.string()), ("score", pa.float64())])
    longs = [(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
    found = pa.schema(
        [*longs, ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
         ("spans", pa.list_(span))]
    )
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, "
        "spans array<struct<start: long, end: long, label: string, score: double>>"
    )
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, schema
    )
