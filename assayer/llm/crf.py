"""Lines of a text as a sequence with two labels: features, and a linear-chain conditional
random field in numpy (training, Viterbi path, marginals).

Label 1 is the good one (content).  A line's features are byte statistics of the line and
of the lines before and after it.  Lines without a word are skipped.  Sequences of several
texts are worked on side by side; the loop is over positions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

CLASSES = np.full(256, 8, np.int64)
for _k, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"#*$%&", b"|", b"<>{}[]=_\\/", b"!")
):
    CLASSES[list(_chars)] = _k
CLASSES[list(b".,;:?'\"()-")] = 9
CLASSES[128:] = 10
N_CLASSES = 11
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Lines:
    """Lines with a word of several texts, one after the other: ``text`` their text's
    number, ``bytes`` their length, ``words`` their number of words, ``x`` the features."""

    text: np.ndarray
    bytes: np.ndarray
    words: np.ndarray
    x: np.ndarray


def lines_of(texts: Sequence[str]) -> Lines:
    raw = [t.encode("utf-8", "replace") for t in texts]
    joined = b"\n".join(raw)
    b = np.frombuffer(joined, np.uint8)
    ends = b == 10
    line = np.cumsum(ends) - ends
    n = int(line[-1]) + 1 if len(b) else len(raw)
    if len(b) and ends[-1]:
        n += 1
    counts = np.bincount(line * N_CLASSES + CLASSES[b], minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(float)
    counts[:, 8] -= np.bincount(line[ends], minlength=n)  # the line ends themselves
    space = SPACE[b]
    starts = ~space & np.concatenate([[True], space[:-1]]) if len(b) else np.zeros(0, bool)
    words = np.bincount(line[starts], minlength=n).astype(float)
    length = counts.sum(1)
    per_text = np.array([r.count(b"\n") + 1 for r in raw], np.int64)
    of = np.repeat(np.arange(len(raw)), per_text)
    if not len(raw):
        of = np.zeros(n, np.int64)
    first = np.concatenate([[0], np.flatnonzero(ends) + 1]) if len(b) else np.zeros(n, np.int64)
    last = np.concatenate([np.flatnonzero(ends), [len(b)]]) - 1 if len(b) else np.zeros(n, np.int64)
    if len(b):
        stop = np.isin(b[np.clip(last, 0, len(b) - 1)], list(b".!?")) & (length > 0)
        upper = CLASSES[b[np.clip(first, 0, len(b) - 1)]] == 1
    else:
        stop = upper = np.zeros(n, bool)
    seen: list[bool] = []
    for r in raw:
        had: set[bytes] = set()
        for piece in r.split(b"\n"):
            seen.append(piece in had)
            had.add(piece)
    own = np.column_stack(
        [counts / np.maximum(length, 1)[:, None], np.log1p(length), np.log1p(words),
         length / np.maximum(words, 1) / 10, stop, upper & (length > 0), np.array(seen[:n] or [False] * n, float)]
    )
    keep = words > 0
    own, of = own[keep], of[keep]
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own):
        same = of[1:] == of[:-1]
        before[1:][same], after[:-1][same] = own[:-1][same], own[1:][same]
    x = np.column_stack([own, before, after, np.ones(len(own))])
    return Lines(of, length[keep], words[keep], x)


def _steps(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts by falling number of lines: their order, first lines and numbers of lines."""
    sizes = np.bincount(of, minlength=n)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    return order, (np.cumsum(sizes) - sizes)[order], sizes[order]


def _add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


@dataclass
class Model:
    """``mean`` and ``scale`` of the features, ``w`` (features x 2), ``move`` (from x to)."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    move: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w

    def forward_backward(self, of: np.ndarray, e: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Marginals (lines x 2) and expected moves (2 x 2)."""
        order, first, sizes = _steps(of, n)
        alpha, beta, moves = e.copy(), np.zeros_like(e), np.zeros((2, 2))
        alive = len(order)
        live = []
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            while alive and sizes[alive - 1] <= t:
                alive -= 1
            live.append(alive)
            at = first[:alive] + t
            alpha[at] = e[at] + _add(alpha[at - 1][:, :, None] + self.move, 1)
        for t in range(len(live), 0, -1):
            at = first[: live[t - 1]] + t
            ahead = self.move + (e[at] + beta[at])[:, None, :]
            beta[at - 1] = _add(ahead, 2)
            both = alpha[at - 1][:, :, None] + ahead
            both -= _add(both.reshape(-1, 4), 1)[:, None, None]
            moves += np.exp(both).sum(0)
        both = alpha + beta
        return np.exp(both - _add(both, 1)[:, None]), moves

    def viterbi(self, of: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
        """The likeliest label of every line; of equal paths the one with more 1s at the end."""
        order, first, sizes = _steps(of, n)
        best, back = e.copy(), np.zeros(e.shape, np.int64)
        alive, live = len(order), []
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            while alive and sizes[alive - 1] <= t:
                alive -= 1
            live.append(alive)
            at = first[:alive] + t
            come = best[at - 1][:, :, None] + self.move
            back[at] = come[:, 1] >= come[:, 0]
            best[at] = e[at] + come.max(1)
        path = np.zeros(len(e), np.int64)
        end = first + sizes - 1
        path[end] = best[end, 1] >= best[end, 0]
        for t in range(len(live), 0, -1):
            at = first[: live[t - 1]] + t
            path[at - 1] = back[at, path[at]]
        return path


def train(texts: Sequence[str], labels: Sequence[int], *, rounds: int = 120, decay: float = 1e-3) -> Model | None:
    """Fits the field to texts whose lines all carry the text's label, by gradient ascent
    (Adam) of the conditional likelihood.  None without lines of both labels."""
    lines = lines_of(texts)
    if not len(lines.x):
        return None
    y = np.asarray(labels, np.int64)[lines.text]
    if len(set(y.tolist())) < 2:
        return None
    mean, scale = lines.x.mean(0), lines.x.std(0) + 1e-6
    mean[-1], scale[-1] = 0, 1
    model = Model(mean, scale, np.zeros((lines.x.shape[1], 2)), np.zeros((2, 2)))
    x = (lines.x - mean) / scale
    want = np.eye(2)[y]
    same = lines.text[1:] == lines.text[:-1]
    wanted_moves = np.zeros((2, 2))
    np.add.at(wanted_moves, (y[:-1][same], y[1:][same]), 1)
    total = len(x)
    state = [np.zeros_like(model.w), np.zeros_like(model.w), np.zeros((2, 2)), np.zeros((2, 2))]
    for k in range(1, rounds + 1):
        marginals, moves = model.forward_backward(lines.text, x @ model.w, len(texts))
        grads = (x.T @ (want - marginals) / total - decay * model.w, (wanted_moves - moves) / total - decay * model.move)
        for i, (g, p) in enumerate(zip(grads, (model.w, model.move), strict=True)):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return model


def in_parts(texts: Sequence[str | None], size: int = 2_000_000) -> list[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters together; a longer text is one range."""
    parts, begin, have = [], 0, 0
    for i, t in enumerate(texts):
        if have and have + len(t or "") > size:
            parts.append((begin, i))
            begin, have = i, 0
        have += len(t or "")
    if begin < len(texts):
        parts.append((begin, len(texts)))
    return parts
