"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax.

Word ids 1.. are the shortlist in order of frequency, 0 is any other word.
Classes are runs of ``CLASS`` ids, with 0 a class of its own, so a word's
probability is that of its class times that of the word within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HIDDEN, CLASS = 16, 32
#: Parallel streams and steps of a training window; steps of a scoring window.
STREAMS, STEPS, WINDOW = 512, 16, 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Recurrent:
    """Parameters by name; ``E`` holds each word's input to the three gates."""

    def __init__(self, words: int, seed: int = 5):
        g = np.random.default_rng(seed)
        self.words = words
        classes = 1 + -(-(words - 1) // CLASS)
        scale = 1 / np.sqrt(HIDDEN)
        self.p = {k: (g.standard_normal(s) * scale).astype(np.float32) for k, s in (
            ("E", (words, 3 * HIDDEN)), ("U", (HIDDEN, 3 * HIDDEN)), ("C", (HIDDEN, classes)), ("W", (words, HIDDEN)))}
        self.p["c"] = np.zeros(classes, np.float32)
        self.p["w"] = np.zeros(words, np.float32)

    def prime(self, counts: np.ndarray) -> None:
        """Start the biases at the unigram model of the given counts."""
        logs = np.log(counts + 1.0)
        cls = class_of(np.arange(self.words))
        total = np.bincount(cls, counts + 1.0)
        self.p["c"] = np.log(total).astype(np.float32)
        self.p["w"] = (logs - np.log(total)[cls]).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> Recurrent:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at:at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n
        return self

    def step(self, token: np.ndarray, h: np.ndarray):
        x, u = self.p["E"][token], h @ self.p["U"]
        gates = _sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        return h + z * (c - h), (h, u, z, r, c)

    def _words(self, h: np.ndarray, target: np.ndarray):
        """Rows grouped by the target's class: class, rows, softmax within the class, place in it."""
        cls = class_of(target)
        order = np.argsort(cls, kind="stable")
        edge = np.searchsorted(cls[order], np.arange(len(self.p["c"]) + 1))
        for k in range(1, len(edge) - 1):
            rows = order[edge[k]:edge[k + 1]]
            if len(rows):
                a, b = 1 + (k - 1) * CLASS, min(1 + k * CLASS, self.words)
                logit = h[rows] @ self.p["W"][a:b].T + self.p["w"][a:b]
                logit -= logit.max(axis=1, keepdims=True)
                np.exp(logit, out=logit)
                total = logit.sum(axis=1, keepdims=True)
                yield a, b, rows, logit / total, target[rows] - a

    def log_prob(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after the state in its row."""
        logit = h @ self.p["C"] + self.p["c"]
        top = logit.max(axis=1)
        out = logit[np.arange(len(h)), class_of(target)] - top - np.log(np.exp(logit - top[:, None]).sum(axis=1))
        out = out.astype(np.float64)
        for _, _, rows, soft, place in self._words(h, target):
            out[rows] += np.log(soft[np.arange(len(rows)), place])
        return out

    def score(self, tokens: np.ndarray, off: np.ndarray, end: int) -> np.ndarray:
        """Natural log probability of each text; the state is carried from window to window."""
        size = np.diff(off)
        order = np.argsort(-size, kind="stable")
        size, first = size[order], off[:-1][order]
        total = np.zeros(len(size))
        h = np.zeros((len(size), HIDDEN), np.float32)
        for at in range(0, int(size[0]) if len(size) else 0, WINDOW):
            states, rows, targets = [], [], []
            for t in range(at, min(at + WINDOW, int(size[0]))):
                n = int(np.searchsorted(-size, -t, "left"))     # texts longer than t, which stand first
                before = tokens[first[:n] + t - 1] if t else np.full(n, end)
                h[:n], _ = self.step(before, h[:n])
                states.append(h[:n].copy())
                rows.append(np.arange(n))
                targets.append(tokens[first[:n] + t])
            total += np.bincount(np.concatenate(rows), self.log_prob(np.concatenate(states), np.concatenate(targets)), len(size))
        out = np.empty(len(size))
        out[order] = total
        return out

    def gradient(self, before: np.ndarray, target: np.ndarray, h: np.ndarray, end: int):
        """Mean loss of a window (steps x streams), its gradients, and the last state; an end resets a stream's state."""
        steps, n = target.shape
        kept, hidden = [], np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            h = np.where((before[t] == end)[:, None], 0, h).astype(np.float32)
            h, memory = self.step(before[t], h)
            kept.append(memory)
            hidden[t] = h
        flat, goal = hidden.reshape(-1, HIDDEN), target.ravel()
        share = np.float32(1 / len(goal))
        logit = flat @ self.p["C"] + self.p["c"]
        logit -= logit.max(axis=1, keepdims=True)
        soft = np.exp(logit)
        soft /= soft.sum(axis=1, keepdims=True)
        row, cls = np.arange(len(goal)), class_of(goal)
        loss = -np.log(soft[row, cls]).sum()
        soft[row, cls] -= 1
        soft *= share
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["C"], g["c"] = flat.T @ soft, soft.sum(axis=0)
        back = soft @ self.p["C"].T
        for a, b, rows, inner, place in self._words(flat, goal):
            at = np.arange(len(rows))
            loss -= np.log(inner[at, place]).sum()
            inner[at, place] -= 1
            inner *= share
            g["W"][a:b] += inner.T @ flat[rows]
            g["w"][a:b] += inner.sum(axis=0)
            back[rows] += inner @ self.p["W"][a:b]
        back = back.reshape(steps, n, HIDDEN)
        later = np.zeros((n, HIDDEN), np.float32)
        into = np.empty((steps, n, 3 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h0, u, z, r, c = kept[t]
            d = back[t] + later
            dc = d * z * (1 - c * c)
            x = into[t]
            x[:, :HIDDEN] = d * (c - h0) * z * (1 - z)
            x[:, HIDDEN:2 * HIDDEN] = dc * u[:, 2 * HIDDEN:] * r * (1 - r)
            x[:, 2 * HIDDEN:] = dc
            du = x.copy()
            du[:, 2 * HIDDEN:] *= r
            g["U"] += h0.T @ du
            later = d * (1 - z) + du @ self.p["U"].T
            later[before[t] == end] = 0
        token = before.ravel()
        order = np.argsort(token, kind="stable")
        edge = np.flatnonzero(np.append(True, token[order][1:] != token[order][:-1]))
        g["E"][token[order][edge]] = np.add.reduceat(into.reshape(-1, 3 * HIDDEN)[order], edge)
        return loss / len(goal), g, h

    def train(self, texts: Iterator[np.ndarray], end: int, rate: float = 0.1) -> int:
        """One pass of Adagrad over token arrays (whole texts, each closed by ``end``); the tokens seen."""
        seen = 0
        square = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.p.items()}
        for tokens in texts:
            streams = max(1, min(STREAMS, len(tokens) // STEPS))
            length = len(tokens) // streams
            if not length:
                continue
            grid = tokens[:streams * length].reshape(streams, length).T.astype(np.int64)
            start = np.concatenate([[end], tokens[np.arange(1, streams) * length - 1]])
            h = np.zeros((streams, HIDDEN), np.float32)
            for at in range(0, length, STEPS):
                target = grid[at:at + STEPS]
                before = np.concatenate([(grid[at - 1] if at else start)[None], target[:-1]])
                _, g, h = self.gradient(before, target, h, end)
                for k, v in g.items():
                    square[k] += v * v
                    self.p[k] -= rate * v / np.sqrt(square[k])
                seen += target.size
        return seen


def class_of(word: np.ndarray) -> np.ndarray:
    return (word + CLASS - 1) // CLASS
