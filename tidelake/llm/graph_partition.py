"""Balanced partitioning of a sample's neighbour graph, and the classifier that learns it."""

from __future__ import annotations

import numpy as np


def neighbours(x: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """Indexes of the ``k`` rows with the largest inner product for each row, itself excluded."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), block):
        s = x[lo:lo + block] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        top = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.zeros((len(s), 0), np.int64)
        order = np.take_along_axis(s, top, axis=1).argsort(axis=1)[:, ::-1]
        out[lo:lo + len(s)] = np.take_along_axis(top, order, axis=1)
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 15, slack: float = 1.1,
                   seed: int = 7) -> np.ndarray:
    """Assign rows to ``parts`` of nearly equal size with few neighbour edges between parts:
    capacity-bound seeds by direction, then rounds that move a row to the part of most of its
    neighbours while there is room."""
    rng = np.random.default_rng(seed)
    n, room = len(x), int(np.ceil(slack * len(x) / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    for _ in range(8):
        sim = x @ (centre / np.maximum(1e-12, np.linalg.norm(centre, axis=1, keepdims=True))).T
        part = _fill(sim, room)
        centre = np.stack([x[part == p].mean(axis=0) if (part == p).any() else x[rng.integers(n)] for p in range(parts)])
    source = np.repeat(np.arange(n), near.shape[1])
    both = np.concatenate([source, near.ravel()]), np.concatenate([near.ravel(), source])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (both[0], part[both[1]]), 1.0)
        votes[np.arange(n), part] += 0.5
        part, before = _fill(votes + 1e-3 * sim, room), part
        if (part == before).all():
            break
    return part


def _fill(score: np.ndarray, room: int) -> np.ndarray:
    """Best part of each row under a capacity: rows with the clearest preference choose first."""
    order = np.argsort(score, axis=1)[:, ::-1]
    top = np.take_along_axis(score, order[:, :2], axis=1)
    clear = top[:, 0] - top[:, -1]
    left = np.full(score.shape[1], room)
    part = np.empty(len(score), np.int64)
    for i in np.argsort(-clear, kind="stable").tolist():
        for p in order[i].tolist():
            if left[p] > 0:
                left[p] -= 1
                part[i] = p
                break
    return part


class Router:
    """One hidden layer and a softmax over parts."""

    def __init__(self, w1, b1, w2, b2):
        self.w1, self.b1, self.w2, self.b2 = w1, b1, w2, b2

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0.0) @ self.w2 + self.b2


def train_router(x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 40,
                 rate: float = 3e-3, seed: int = 7) -> Router:
    """Cross-entropy against the parts of each row and its neighbours, by Adam."""
    rng = np.random.default_rng(seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1] + 1),
                       part[np.hstack([np.arange(len(x))[:, None], near])].ravel()), 1.0)
    target /= target.sum(axis=1, keepdims=True)
    scale = 1.0 / max(1e-12, float(np.sqrt((x**2).sum(axis=1).mean())))
    p = [rng.normal(0, 1, (x.shape[1], hidden)) * np.sqrt(2.0) * scale, np.zeros(hidden),
         rng.normal(0, 1, (hidden, parts)) * np.sqrt(1.0 / hidden), np.zeros(parts)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            at = mixed[lo:lo + 256]
            a = x[at] @ p[0] + p[1]
            h = np.maximum(a, 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - target[at]) / len(at)
            dh = (dz @ p[2].T) * (a > 0)
            grads = [x[at].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)
