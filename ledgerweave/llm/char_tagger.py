"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
HIDDEN = 16
BATCH = 256
SIGNS = "@._%+-() \n:/=\"',;|#*$&!?"
CLASSES = 3 + 26 + 1 + len(SIGNS)  # padding, other ASCII, beyond ASCII, letters, digit, signs

_CLASS_OF = np.ones(129, np.int64)
_CLASS_OF[128] = 2
for _i in range(26):
    _CLASS_OF[ord("a") + _i] = _CLASS_OF[ord("A") + _i] = 3 + _i
_CLASS_OF[ord("0") : ord("9") + 1] = 29
for _i, _sign in enumerate(SIGNS):
    _CLASS_OF[ord(_sign)] = 30 + _i

Parameters = dict[str, np.ndarray]
Spans = list[tuple[int, int, str, float]]


def encoded(texts: list[str], width: int) -> np.ndarray:
    """Classes of the characters, padded on the right."""
    out = np.zeros((len(texts), width), np.int64)
    for row, text in zip(out, texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        row[: len(points)] = _CLASS_OF[np.minimum(points, 128)]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def run_forward(x: np.ndarray, inputs: np.ndarray, recur: np.ndarray, keep: list | None = None):
    """Hidden states of one direction: (batch, time, HIDDEN)."""
    count, steps = x.shape
    hidden, cell = np.zeros((count, HIDDEN), np.float32), np.zeros((count, HIDDEN), np.float32)
    out = np.empty((count, steps, HIDDEN), np.float32)
    for t in range(steps):
        gates = inputs[x[:, t]] + hidden @ recur
        squashed = sigmoid(gates[:, : 3 * HIDDEN])
        i, f, o = np.split(squashed, 3, axis=1)
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, hidden_before = cell, hidden
        cell = f * cell + i * g
        top = np.tanh(cell)
        hidden = o * top
        out[:, t] = hidden
        if keep is not None:
            keep.append((i, f, o, g, before, top, hidden_before))
    return out


def run_backward(x: np.ndarray, grads: np.ndarray, recur: np.ndarray, keep: list):
    """Gradients of the input table and the recurrent weights, back through time."""
    d_inputs = np.zeros((CLASSES, 4 * HIDDEN), np.float32)
    d_recur = np.zeros_like(recur)
    d_hidden = np.zeros((len(x), HIDDEN), np.float32)
    d_cell = np.zeros_like(d_hidden)
    for t in range(x.shape[1] - 1, -1, -1):
        i, f, o, g, before, top, hidden_before = keep[t]
        d_hidden = d_hidden + grads[:, t]
        d_cell = d_cell + d_hidden * o * (1 - top**2)
        d_gates = np.concatenate(
            [
                d_cell * g * i * (1 - i),
                d_cell * before * f * (1 - f),
                d_hidden * top * o * (1 - o),
                d_cell * i * (1 - g**2),
            ],
            axis=1,
        )
        np.add.at(d_inputs, x[:, t], d_gates)
        d_recur += hidden_before.T @ d_gates
        d_hidden = d_gates @ recur.T
        d_cell = d_cell * f
    return d_inputs, d_recur


def emissions(p: Parameters, x: np.ndarray, keep: tuple[list, list] | None = None):
    """Scores of the labels at every character, and the states they come from."""
    left = run_forward(x, p["in_l"], p["rec_l"], keep and keep[0])
    right = run_forward(x[:, ::-1], p["in_r"], p["rec_r"], keep and keep[1])[:, ::-1]
    states = np.concatenate([left, right], axis=2)
    return states @ p["out"] + p["bias"], states


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, trans: np.ndarray, y: np.ndarray):
    """Mean negative log likelihood of the labels, and its gradients."""
    count, steps, labels = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0]
    for t in range(1, steps):
        alpha[:, t] = scores[:, t] + log_sum(alpha[:, t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        beta[:, t] = log_sum(trans + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = log_sum(alpha[:, -1], 1)
    d_scores = np.exp(alpha + beta - total[:, None, None])
    d_trans = np.zeros_like(trans)
    for t in range(1, steps):
        pair = alpha[:, t - 1][:, :, None] + trans + (scores[:, t] + beta[:, t])[:, None, :]
        d_trans += np.exp(pair - total[:, None, None]).sum(0)
    rows = np.arange(count)[:, None]
    gold = scores[rows, np.arange(steps), y].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
    d_scores[rows, np.arange(steps), y] -= 1
    np.add.at(d_trans, (y[:, :-1], y[:, 1:]), -1)
    return float((total - gold).mean()), d_scores / count, d_trans / count


def gradients(p: Parameters, x: np.ndarray, y: np.ndarray) -> tuple[float, Parameters]:
    """Loss and gradients of all parameters on a batch."""
    keep: tuple[list, list] = ([], [])
    scores, states = emissions(p, x, keep)
    loss, d_scores, d_trans = crf_gradient(scores, p["trans"], y)
    d_states = d_scores @ p["out"].T
    out: Parameters = {"trans": d_trans, "bias": d_scores.sum((0, 1))}
    out["out"] = np.tensordot(states, d_scores, ([0, 1], [0, 1]))
    left, right = d_states[:, :, :HIDDEN], d_states[:, ::-1, HIDDEN:]
    out["in_l"], out["rec_l"] = run_backward(x, left, p["rec_l"], keep[0])
    out["in_r"], out["rec_r"] = run_backward(x[:, ::-1], right, p["rec_r"], keep[1])
    return loss, out


@dataclass
class Tagger:
    """Trained parameters."""

    p: Parameters

    def decode(self, texts: list[str], width: int) -> list[Spans]:
        """The best tagging's spans in each text: start, end, kind, mean margin over outside."""
        out: list[Spans] = []
        for first in range(0, len(texts), BATCH):
            part = texts[first : first + BATCH]
            scores, _ = emissions(self.p, encoded(part, width))
            tags = viterbi(scores, self.p["trans"])
            out += [spans_of(t[: len(s)], m) for t, s, m in zip(tags, part, scores)]
        return out


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best label sequences."""
    count, steps, labels = scores.shape
    best = scores[:, 0]
    back = np.empty((count, steps, labels), np.int8)
    for t in range(1, steps):
        reached = best[:, :, None] + trans
        back[:, t] = reached.argmax(1)
        best = reached.max(1) + scores[:, t]
    out = np.empty((count, steps), np.int64)
    out[:, -1] = best.argmax(1)
    rows = np.arange(count)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[rows, t, out[:, t]]
    return out


def spans_of(tags: np.ndarray, scores: np.ndarray) -> Spans:
    """Runs of one kind: begin or inside, then inside."""
    out: Spans = []
    start = None
    for t in range(len(tags) + 1):
        tag = int(tags[t]) if t < len(tags) else 0
        goes_on = start is not None and tag == int(tags[start] - 1) // 2 * 2 + 2
        if start is not None and not goes_on:
            kind = int(tags[start] - 1) // 2
            rows = np.arange(start, t)
            margin = float((scores[rows, tags[rows]] - scores[rows, 0]).mean())
            out.append((start, t, KINDS[kind], margin))
            start = None
        if start is None and tag:
            start = t
    return out


def tags_of(spans: list[tuple[str, int, int]], width: int) -> np.ndarray:
    """Labels of a window's characters; of overlapping spans the longest counts."""
    out = np.zeros(width, np.int64)
    for kind, start, end in sorted(spans, key=lambda s: s[1] - s[2]):
        if not out[start:end].any():
            out[start:end] = 2 * KINDS.index(kind) + 2
            out[start] -= 1
    return out


def other_notations(text: str, spans: list[tuple[str, int, int]]):
    """A labelled window once more, in a notation that the patterns miss."""
    if len(spans) != 1:
        return None
    kind, start, end = spans[0]
    found = text[start:end]
    if kind == "email":
        new = found.replace("@", " @ ")
    elif kind == "phone":
        new = found.lstrip("+0123456789").strip() or found
    elif kind == "card":
        digits = "".join(c for c in found if c.isdigit())
        new = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    else:
        new = found.replace(".", " . ")
    text = text[:start] + new + text[end:]
    return text, [(kind, start, start + len(new))]


def train_tagger(
    examples: list[tuple[str, list[tuple[str, int, int]]]],
    width: int,
    steps: int = 500,
    batch: int = 32,
    rate: float = 0.01,
) -> Tagger | None:
    """Fit on windows with labelled spans by Adam; None if no window has a span.

    Every third window with one span comes a second time in another notation.
    """
    if not any(spans for _, spans in examples):
        return None
    more = [other_notations(*e) for e in examples if e[1]][::3]
    examples = examples + [m for m in more if m and len(m[0]) <= width]
    x = encoded([text for text, _ in examples], width)
    y = np.stack([tags_of(spans, width) for _, spans in examples])
    rng = np.random.default_rng(11)
    shapes = {
        "in_l": (CLASSES, 4 * HIDDEN), "rec_l": (HIDDEN, 4 * HIDDEN), "in_r": (CLASSES, 4 * HIDDEN),
        "rec_r": (HIDDEN, 4 * HIDDEN), "out": (2 * HIDDEN, LABELS), "bias": (LABELS,),
        "trans": (LABELS, LABELS),
    }
    p = {k: rng.normal(0, 0.2, s).astype(np.float32) for k, s in shapes.items()}
    for side in ("in_l", "in_r"):
        p[side][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        _, grads = gradients(p, x[rows], y[rows])
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            scale = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6
            slower = rate * (1 - step / (steps + 1))
            p[k] = (p[k] - slower * mean[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return Tagger(p)
