"""Small documents with every awkward case."""

from __future__ import annotations

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "digest string, size string, _score string, _plan string, Node string"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def prose(n: int, seed: int = 0) -> str:
    """n words that hardly repeat in runs."""
    return " ".join(f"{WORDS[(i * 7 + seed) % 15]}{(i * i + seed * 31) % 97}" for i in range(n))


def row(doc_id, text, lang="en", source="web"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "p", "q")


EDGES = [
    row(1, None, None, None),
    row(2, ""),
    row(3, " \n\t "),
    row(4, "one"),
    row(5, "ONE", source="news"),
    row(6, prose(40, 1)),
    row(7, prose(40, 1).upper(), source=None),
    row(8, prose(39, 1) + " changed"),
    row(9, "12345 !!! 678", lang=None),
    row(10, prose(30_000, 2), source="news"),
    row(11, "x" * 100_000),
    row(12, "naïve café ÉCOLE 中文 \U0001f600 end", lang="fr"),
    row(12, "naïve café ÉCOLE 中文 \U0001f600 end", lang="fr"),
    row(13, "naïve café école 中文 \U0001f600 end", lang="fr"),
    row(13, "another text of the same id"),
    row(None, "a text without an id"),
]
