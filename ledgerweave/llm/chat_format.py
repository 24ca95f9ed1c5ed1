"""Chat formatting with typed content parts, and reading the output back."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: Pixels on a side, seconds and pages that one token stands for.
PIXELS, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 600
ATTACHMENT = "struct<place: long, kind: string, ref: string, tokens: long>"
TURN_SCHEMA = (
    "conv_id long, turn long, formatted string, loss_start long, loss_end long, "
    f"attachments array<{ATTACHMENT}>"
)
REPORT_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """A text without control strings: one backslash more between < and |."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    """What ``escape`` was given."""
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    """What ``escape_role`` was given."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visits a turn's parts in order; each kind has its own method.

    Text is escaped.  The other kinds leave a placeholder with the number of the attachment
    and add its kind, reference and the tokens that it expands to.
    """

    def __init__(self) -> None:
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> str:
        kind = part.get("kind") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of content part: {kind!r}")
        return method(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        sides = (max(1, part.get(side) or 1) for side in ("width", "height"))
        return self._attach("image", part, math.prod(math.ceil(s / PIXELS) for s in sides))

    def visit_audio(self, part: dict) -> str:
        seconds = part.get("seconds") or 0
        return self._attach("audio", part, math.ceil(seconds * TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part, (part.get("pages") or 1) * TOKENS_PER_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> str:
        place = len(self.attachments)
        self.attachments.append(
            {"place": place, "kind": kind, "ref": part.get("ref"), "tokens": tokens}
        )
        return f"<|{kind}:{place}|>"


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: its formatted text, the part under the loss mask, its attachments.

    ``conversations`` has conv_id, turn, role and text, or in place of text ``parts``, an
    array of structs with kind, text, ref, width, height, seconds, pages (any may be absent).
    A conversation's output is its turns' texts one after the other.  loss_start and loss_end
    are code points within the turn, null except for assistant turns.  Null roles and texts
    count as empty.  Repeated rows are turns of their own.
    """
    typed = "parts" in conversations.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                parts = (row["parts"] or []) if typed else [{"text": row["text"]}]
                visitor = Flattener()
                content = "".join(visitor.visit(p) for p in parts)
                role = row["role"] or ""
                head = f"{START}{escape_role(role)}\n"
                trained = role == TRAINED
                rows.append(
                    {
                        "conv_id": row["conv_id"],
                        "turn": row["turn"],
                        "formatted": f"{head}{content}{END}\n",
                        "loss_start": len(head) if trained else None,
                        "loss_end": len(head) + len(content) if trained else None,
                        "attachments": visitor.attachments,
                    }
                )
            yield from pa.Table.from_pylist(rows, _arrow_schema()).combine_chunks().to_batches()

    content = F.col("parts") if typed else F.col("text").cast("string").alias("text")
    chosen = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        content,
    )
    return chosen.mapInArrow(run, TURN_SCHEMA)


def _arrow_schema() -> pa.Schema:
    attachment = pa.struct(
        [("place", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]
    )
    longs = [("loss_start", pa.int64()), ("loss_end", pa.int64())]
    ids = [("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string())]
    return pa.schema([*ids, *longs, ("attachments", pa.list_(attachment))])


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn; placeholders of attachments stay as they are."""
    head, _, rest = formatted.removeprefix(START).partition("\n")
    return unescape_role(head), unescape(rest[: rest.index(END)])


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted turns alone.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.  Turns
    are taken by number, ties by their formatted text.  Rows stream through running digests,
    so a conversation of any length takes the memory of a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != key:
                    if state is not None:
                        done.append(_finished(key, state))
                    key, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = row["formatted"]
                role, text = read_turn(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if row["loss_start"] is not None:
                    trained = unescape(formatted[row["loss_start"] : row["loss_end"]])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += len(formatted)
            yield _report(done)
        yield _report([] if state is None else [_finished(key, state)])

    order = ["conv_id", "turn", "formatted"]
    rows = turns.select(*order, "loss_start", "loss_end")
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, REPORT_SCHEMA)


def _finished(key: int | None, state: list) -> dict:
    values = (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
    names = (c.split()[0] for c in REPORT_SCHEMA.split(", "))
    return dict(zip(names, values))


def _report(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in REPORT_SCHEMA.split(", ")])
    return pa.RecordBatch.from_pylist(rows, schema)
