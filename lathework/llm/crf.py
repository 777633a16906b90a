"""A small linear-chain conditional random field: training, and decoding without NumPy."""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np

Features = Sequence[Sequence[str]]  # of every token its features


class Crf:
    """State weights by feature and label, and transition weights between labels."""

    def __init__(self, labels: Sequence[str], state: dict[str, list[float]], trans: list[list[float]], start: list[float]) -> None:
        self.labels, self.state, self.trans, self.start = list(labels), state, trans, start

    def as_dict(self) -> dict:
        return {"labels": self.labels, "state": self.state, "trans": self.trans, "start": self.start}

    @classmethod
    def from_dict(cls, raw: dict) -> Crf:
        return cls(raw["labels"], raw["state"], raw["trans"], raw["start"])

    def constrain(self, label: str, after: Sequence[str]) -> Crf:
        """Forbid ``label`` at the start and after any label but those in ``after``."""
        k = self.labels.index(label)
        self.start[k] = -1e9
        for j, other in enumerate(self.labels):
            if other not in after:
                self.trans[j][k] = -1e9
        return self

    def decode(self, features: Features) -> list[str]:
        """The likeliest labels of a sequence (Viterbi)."""
        size = len(self.labels)
        span = range(size)
        get = self.state.get
        back: list[list[int]] = []
        best: list[float] = []
        for at, own in enumerate(features):
            scores = [0.0] * size
            for name in own:
                row = get(name)
                if row is not None:
                    for k in span:
                        scores[k] += row[k]
            if at == 0:
                best = [self.start[k] + scores[k] for k in span]
                continue
            now, came = [], []
            for k in span:
                j = max(span, key=lambda j: best[j] + self.trans[j][k])  # noqa: B023
                now.append(best[j] + self.trans[j][k] + scores[k])
                came.append(j)
            best = now
            back.append(came)
        if not best:
            return []
        k = max(span, key=best.__getitem__)
        path = [k]
        for came in reversed(back):
            k = came[k]
            path.append(k)
        return [self.labels[k] for k in reversed(path)]


def train(
    samples: Sequence[tuple[Features, Sequence[str]]], labels: Sequence[str], epochs: int = 12, rate: float = 0.3, decay: float = 1e-5, seed: int = 7
) -> Crf:
    """Weights by stochastic gradient of the log-likelihood (AdaGrad), in a fixed order of samples."""
    names = sorted({f for x, _ in samples for own in x for f in own})
    place = {n: i for i, n in enumerate(names)}
    index = {label: k for k, label in enumerate(labels)}
    size = len(labels)
    state, trans, start = np.zeros((len(names), size)), np.zeros((size, size)), np.zeros(size)
    squares = [np.full_like(w, 1e-2) for w in (state, trans, start)]
    data = [([np.array([place[f] for f in own]) for own in x], np.array([index[t] for t in y])) for x, y in samples if len(x)]
    order = list(range(len(data)))
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for at in order:
            x, y = data[at]
            n = len(x)
            local = np.array([state[own].sum(axis=0) for own in x])
            ahead, behind = np.zeros((n, size)), np.zeros((n, size))
            ahead[0] = local[0] + start
            for i in range(1, n):
                m = ahead[i - 1][:, None] + trans
                top = m.max(axis=0)
                ahead[i] = top + np.log(np.exp(m - top).sum(axis=0)) + local[i]
            for i in range(n - 2, -1, -1):
                m = trans + local[i + 1] + behind[i + 1]
                top = m.max(axis=1)
                behind[i] = top + np.log(np.exp(m - top[:, None]).sum(axis=1))
            top = ahead[-1].max()
            whole = top + np.log(np.exp(ahead[-1] - top).sum())
            belief = np.exp(ahead + behind - whole)
            slope = -belief
            slope[np.arange(n), y] += 1.0
            moved = np.zeros((size, size))
            for i in range(1, n):
                moved -= np.exp(ahead[i - 1][:, None] + trans + local[i] + behind[i] - whole)
                moved[y[i - 1], y[i]] += 1.0
            for i, own in enumerate(x):
                step = slope[i] - decay * state[own]
                squares[0][own] += step**2
                state[own] += rate * step / np.sqrt(squares[0][own])
            squares[1] += moved**2
            trans += rate * moved / np.sqrt(squares[1])
            squares[2] += slope[0] ** 2
            start += rate * slope[0] / np.sqrt(squares[2])
    kept = {n: [round(float(v), 3) for v in state[i]] for n, i in place.items() if np.abs(state[i]).max() >= 0.02}
    return Crf(list(labels), kept, [[round(float(v), 3) for v in row] for row in trans], [round(float(v), 3) for v in start])
