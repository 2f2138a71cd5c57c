"""Words of a batch of texts as numpy arrays: no Python object per word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_P = 0x100000001B3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(1 << 16)], bool)


@lru_cache(maxsize=1)
def _blanks() -> np.ndarray:
    t = np.zeros(1 << 16, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each followed by a blank, and where each text starts."""
    flat = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    start = np.cumsum([0] + [len(t) + 1 for t in texts])
    return flat, start.astype(np.int64)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def letters(codes: np.ndarray) -> np.ndarray:
    return _letters()[np.minimum(codes, 0xFFFF)]


def blanks(codes: np.ndarray) -> np.ndarray:
    return _blanks()[np.minimum(codes, 0xFFFF)]


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    return np.array([pow(_P, k, 1 << 64) for k in range(64)], np.uint64)


def hashes(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every run [first, last); runs must be in order and not touch."""
    if not len(first):
        return np.zeros(0, np.uint64)
    n = last - first
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    c = codes[at + np.repeat(first, n)].astype(np.uint64) + np.uint64(1)
    # Positions repeat after 64 characters; the block number keeps them apart.
    c *= _powers()[at & 63] + (at >> 6).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.add.reduceat(c, np.cumsum(n) - n) + n.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Adam:
    """Adam steps on a dict of arrays, in place."""

    def __init__(self, params: dict, rate: float):
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in params.items()}
        self.v = {k: np.zeros_like(x) for k, x in params.items()}

    def step(self, grads: dict) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m = self.m[k] / (1 - 0.9 ** self.t)
            v = self.v[k] / (1 - 0.999 ** self.t)
            self.p[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps, lightly regularised."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        w = p * (1 - p) + 1e-6
        ga, gb = ((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum()
        haa, hab, hbb = (w * x * x).sum() + 1e-2, (w * x).sum(), w.sum() + 1e-6
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -5, 5)
    return float(a), float(b)
