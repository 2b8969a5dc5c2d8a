"""A small character convolutional network in numpy: one layer, max-pooled, logistic."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

WIDTH = 5
_CHARS = 98  # printable ASCII from 1, other ASCII, anything else; 0 is padding
SYMBOLS = 2 * _CHARS  # the same again for characters inside the candidate
CELLS = 1 << 14  # positions convolved at once
BATCH = 32


def symbols(text: str, start: int, end: int, context: int) -> np.ndarray:
    """Symbol of each character of the candidate and ``context`` characters on both sides."""
    low, high = max(0, start - context), min(len(text), end + context)
    codes = np.frombuffer(text[low:high].encode("utf-32-le"), np.uint32).astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, np.where(codes < 127, 96, 97))
    out[start - low : end - low] += _CHARS
    return out.astype(np.uint8)


def padded(windows: list[np.ndarray]) -> np.ndarray:
    longest = max(map(len, windows)) + WIDTH - 1
    out = np.zeros((len(windows), longest), np.uint8)
    for row, window in zip(out, windows):
        row[WIDTH // 2 : WIDTH // 2 + len(window)] = window
    return out


def blocks(windows: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(numbers of windows, their padded symbols, positions left in each), at most CELLS positions at once.

    Windows of like length go together; a longer one comes alone and in several blocks.
    """
    parts: list[list[int]] = []
    for i in sorted(range(len(windows)), key=lambda i: len(windows[i])):
        if not parts or (len(parts[-1]) + 1) * len(windows[i]) > CELLS:
            parts.append([])
        parts[-1].append(i)
    for part in parts:
        x, left = padded([windows[i] for i in part]), np.array([len(windows[i]) for i in part])
        for a in range(0, x.shape[1] - WIDTH + 1, CELLS):
            yield part, x[:, a : a + CELLS + WIDTH - 1], left - a


class CharCnn:
    def __init__(self, filters: int = 24, seed: int = 3):
        random = np.random.default_rng(seed)
        self.kernel = random.normal(0, 0.1, (WIDTH, SYMBOLS, filters))
        self.kernel[:, 0] = 0
        self.shift = np.zeros(filters)
        self.out = random.normal(0, 0.3, filters)
        self.bias = np.zeros(1)
        self.speed = [np.zeros_like(p) for p in self._parts()]
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5

    def _parts(self) -> list[np.ndarray]:
        return [self.kernel, self.shift, self.out, self.bias]

    def state(self) -> np.ndarray:
        """Weights and their rates as one vector; vectors of nets may be averaged."""
        return np.concatenate([p.ravel() for p in (*self._parts(), *self.speed)])

    def load(self, state: np.ndarray) -> CharCnn:
        at = 0
        for p in (*self._parts(), *self.speed):
            p[...] = state[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def _pool(self, windows: list[np.ndarray]):
        """Highest value of each filter over a window's own positions, and the symbols it was found at."""
        filters = len(self.out)
        pooled = np.full((len(windows), filters), -np.inf)
        seen = np.zeros((len(windows), filters, WIDTH), np.uint8)
        for part, x, left in blocks(windows):
            span = x.shape[1] - WIDTH + 1
            total = sum(self.kernel[w][x[:, w : w + span]] for w in range(WIDTH))
            total[np.arange(span) >= left[:, None]] = -np.inf
            at = total.argmax(axis=1)
            best = np.take_along_axis(total, at[:, None, :], axis=1)[:, 0]
            found = x[np.arange(len(part))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
            more = best > pooled[part]
            pooled[part] = np.where(more, best, pooled[part])
            seen[part] = np.where(more[:, :, None], found, seen[part])
        return pooled + self.shift, seen

    def raw(self, windows: list[np.ndarray]) -> np.ndarray:
        """Scores before calibration; that of a window does not depend on the others."""
        out = np.zeros(len(windows))
        for a in range(0, len(windows), 4096):
            pooled, _ = self._pool(windows[a : a + 4096])
            out[a : a + 4096] = (np.maximum(pooled, 0) * self.out).sum(axis=1) + self.bias
        return out

    def step(self, windows: list[np.ndarray], y: np.ndarray, weight: np.ndarray | float = 1.0, rate: float = 0.02) -> None:
        """One step on a batch, with adaptive rates."""
        pooled, seen = self._pool(windows)
        active = np.maximum(pooled, 0)
        miss = weight * (sigmoid(active @ self.out + self.bias) - y) / len(windows)
        back = miss[:, None] * self.out[None, :] * (pooled > 0)
        kernel = np.zeros_like(self.kernel)
        filters = np.broadcast_to(np.arange(len(self.out)), back.shape)
        for w in range(WIDTH):
            np.add.at(kernel[w], (seen[:, :, w], filters), back)
        kernel[:, 0] = 0
        grads = [kernel, back.sum(axis=0), active.T @ miss, miss.sum()]
        for part, speed, g in zip(self._parts(), self.speed, grads):
            speed += g * g
            part -= rate * g / (np.sqrt(speed) + 1e-6)

    def train(self, windows: list[np.ndarray], y: np.ndarray, epochs: int = 4, rate: float = 0.02, batch: int = BATCH) -> None:
        random = np.random.default_rng(11)
        for _ in range(epochs):
            order = random.permutation(len(windows))
            for part in (order[i : i + batch] for i in range(0, len(order), batch)):
                self.step([windows[i] for i in part], y[part], rate=rate)

    def calibrate(self, windows: list[np.ndarray], y: np.ndarray, recall: float) -> None:
        """Platt scaling, then the largest threshold that keeps ``recall`` of the positives."""
        raw = self.raw(windows)
        sums = lambda tries, high, low: [platt_sums(raw, np.where(y > 0, high, low), 1, *x) for x in tries]
        self.slope, self.offset = platt(sums, int(y.sum()), int(len(y) - y.sum()))
        found = np.sort(self.score(windows)[y > 0])
        self.threshold = float(found[int((1 - recall) * len(found))]) if len(found) else 1.0

    def calibrated(self, raw):
        return sigmoid(self.slope * raw + self.offset)

    def score(self, windows: list[np.ndarray]) -> np.ndarray:
        """Calibrated probability of each window."""
        return self.calibrated(self.raw(windows))


def platt_sums(raw: np.ndarray, target: np.ndarray, n: np.ndarray | int, slope: float, offset: float) -> tuple[float, ...]:
    """Log loss, its slopes and its curvature at one scale, summed over rows that stand ``n`` times."""
    z = np.clip(slope * raw + offset, -40, 40)
    p = sigmoid(z)
    w, miss = p * (1 - p) + 1e-9, p - target
    terms = np.log1p(np.exp(z)) - target * z, miss * raw, miss, w * raw * raw, w * raw, w
    return tuple(float((n * t).sum()) for t in terms)


def platt(
    sums: Callable[[list[tuple[float, float]], float, float], Sequence], yes: int, no: int
) -> tuple[float, float]:
    """(slope, offset) of least log loss, by Newton steps of which the best of four lengths is taken.

    ``sums(tries, high, low)`` gives the ``platt_sums`` over all rows at each (slope, offset),
    with the target ``high`` for positives and ``low`` for the others.
    """
    high, low, prior = (yes + 1) / (yes + 2), 1 / (no + 2), (yes + 1) / (yes + no + 2)
    tries, best = [(1.0, float(np.log(prior / (1 - prior))))], None
    for _ in range(40):
        costs = [(s[0] + 5e-4 * (t[0] - 1) ** 2, t, s) for t, s in zip(tries, sums(tries, high, low))]
        cost, at, s = min(costs, key=lambda c: c[0])
        if best is not None and cost >= best[0] - 1e-12 * abs(best[0]):
            break
        best = cost, at
        g = np.array([s[1] + 1e-3 * (at[0] - 1), s[2]])
        h = np.array([[s[3] + 1e-3, s[4]], [s[4], s[5]]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        tries = [(float(at[0] - a * step[0]), float(at[1] - a * step[1])) for a in (1, 0.5, 0.125, 1 / 64)]
    return best[1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
