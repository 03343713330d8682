"""The minimum of any score, without derivatives and without a pass per candidate.

A score is any aggregate of target and prediction. Candidates lie on a lattice; one scan of the rows
scores all unseen neighbours of the best one so far, on two step lengths at once. The best candidate
becomes the centre; when it is the centre already the step is halved. The end is a point of the finest
lattice whose neighbours are all worse or equal: the minimum over the lattice for scores with one valley.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe import config

MAX_SCORES = 64        # candidates of a scan


@dataclass
class Minimum:
    """`values` at the minimum, its score, and the scans it took."""

    values: list[float]
    score: float
    scans: int


def _neighbours(at: tuple[int, ...], step: int) -> list[tuple[int, ...]]:
    """The points around `at`: all corners up to three values, else along the axes."""
    if len(at) <= 3:
        return [tuple(a + m * step for a, m in zip(at, move, strict=True)) for move in product((-1, 0, 1), repeat=len(at))]
    moves = [at]
    for i in range(len(at)):
        moves += [(*at[:i], at[i] + m * step, *at[i + 1:]) for m in (-1, 1)]
    return moves


def lattice_minimum(df: DataFrame, predict: Callable[[Sequence[float]], Column], score: Callable[[Column, Column], Column],
                    start: Sequence[float], unit: float = 1e-3, reach: int = 256,
                    bounds: Sequence[tuple[float, float]] | None = None, target: str = config.TARGET,
                    max_scans: int = 200) -> Minimum:
    """The values near `start` for which `score(target, predict(values))` is least.

    `reach` is the first step in units, a power of two. `bounds` limits each value; without rows, or
    with a null score everywhere, the start is returned with score infinity. An equal score is no reason
    to leave the centre.
    """
    limits = bounds or [(float("-inf"), float("inf"))] * len(start)
    known: dict[tuple[int, ...], float] = {}
    at, step, scans = (0,) * len(start), reach, 0

    def values(point: tuple[int, ...]) -> list[float]:
        return [s + p * unit for s, p in zip(start, point, strict=True)]

    def allowed(point: tuple[int, ...]) -> bool:
        return all(low - unit / 2 <= v <= high + unit / 2 for v, (low, high) in zip(values(point), limits, strict=True))

    while scans < max_scans:
        near = [p for p in _neighbours(at, step) if allowed(p)]
        finer = _neighbours(at, step // 2) if step > 1 else []
        wanted = list(dict.fromkeys(p for p in [*near, *finer] if allowed(p) and p not in known))[:MAX_SCORES]
        if wanted:
            row = df.agg(*[score(F.col(target), predict(values(p))).alias(f"s{i}") for i, p in enumerate(wanted)]).first()
            known.update((p, float("inf") if row[i] is None else float(row[i])) for i, p in enumerate(wanted))
            scans += 1
        best = min((p for p in near if p in known), key=lambda p: (known[p], p), default=at)
        if known[best] < known[at]:
            at = best
        elif step > 1:
            step //= 2
        else:
            break
    return Minimum(values(at), known.get(at, float("inf")), scans)


def best_blend(df: DataFrame, models: list[str], score: Callable[[Column, Column], Column],
               target: str = config.TARGET, unit: float = 1e-3, reach: int = 256) -> tuple[dict[str, float], Minimum]:
    """Weights of sum 1 that minimise any score of the blend; they may be negative. The search starts
    from equal weights, rounded to the unit."""
    even = round(1 / len(models) / unit) * unit

    def predict(free: Sequence[float]) -> Column:
        weights = [*free, 1.0 - sum(free)]
        terms = [F.lit(float(w)) * F.col(m) for w, m in zip(weights, models, strict=True)]
        return sum(terms[1:], terms[0])
    found = lattice_minimum(df, predict, score, [even] * (len(models) - 1), unit, reach, target=target)
    return dict(zip(models, [*found.values, 1.0 - sum(found.values)], strict=True)), found


def best_stretch(df: DataFrame, prediction: str, centre: float, score: Callable[[Column, Column], Column],
                 bounds: tuple[float, float] = config.CALIBRATION_BOUNDS, target: str = config.TARGET,
                 unit: float = 1e-3) -> Minimum:
    """The factor by which predictions are stretched around the centre for the least score."""
    from riskframe.operators.ensemble import calibrated

    return lattice_minimum(df, lambda v: calibrated(F.col(prediction), centre, v[0]), score, [1.0], unit, 1024,
                           [bounds], target)
