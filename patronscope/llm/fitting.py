"""Small model fits in numpy, on samples whose size the caller bounds."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 200,
             tolerance: float = 1e-5, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking for a smooth convex loss that returns (value, gradient)."""
    x = start.astype(float)
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(slope).max() <= tolerance:
            break
        q, kept = slope.copy(), []
        for s, y, r in reversed(moves):
            a = r * (s @ q)
            kept.append(a)
            q -= a * y
        if moves:
            s, y, _ = moves[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(moves, reversed(kept)):
            q += s * (a - r * (y @ q))
        down = -q
        along = slope @ down
        if along >= 0:
            moves, down, along = [], -slope, -(slope @ slope)
        step = 1.0 if moves else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-12))
        for _ in range(40):
            other, other_slope = loss(x + step * down)
            if other <= value + 1e-4 * step * along:
                break
            step /= 2
        else:
            break
        s, y = step * down, other_slope - slope
        if s @ y > 1e-12:
            moves = [*moves[-(memory - 1):], (s, y, 1.0 / (s @ y))]
        x, value, slope = x + s, other, other_slope
    return x


class Rows:
    """Sparse rows: sizes of the rows, then column numbers and values end to end."""

    def __init__(self, sizes: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.count, self.width = len(sizes), width
        self.row = np.repeat(np.arange(self.count, dtype=np.int32), sizes)
        self.column, self.value = columns, values

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.count)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * per_row[self.row], self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logistic(rows: Rows, target: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic regression; targets may be probabilities."""
    total = weight.sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, score = x[:-1], rows.times(x[:-1]) + x[-1]
        miss = weight * (sigmoid(score) - target) / total
        value = (weight * (np.logaddexp(0, score) - target * score)).sum() / total + ridge * (w @ w) / 2
        return value, np.append(rows.back(miss) + ridge * w, miss.sum())

    x = minimise(loss, np.zeros(rows.width + 1))
    return x[:-1], float(x[-1])


def platt(score: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn raw scores into calibrated log-odds, with smoothed targets."""
    yes, no = target.sum(), len(target) - target.sum()
    goal = np.where(target > 0, (yes + 1) / (yes + 2), 1 / (no + 2))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = x[0] * score + x[1]
        miss = (sigmoid(z) - goal) / len(score)
        return (np.logaddexp(0, z) - goal * z).mean() + 1e-6 * (x @ x), np.array([miss @ score, miss.sum()]) + 2e-6 * x

    slope, shift = minimise(loss, np.array([1.0, 0.0]))
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)
