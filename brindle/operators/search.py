"""Searches over a function that can only be evaluated: a renderer, a scorer, a simulation.

Each row is a search of its own. All rows of an Arrow batch take their steps together, so an objective is called once a
step with arrays; it gets the rows and one value for each. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

Objective = Callable[[pd.DataFrame, np.ndarray], np.ndarray]


def _added(df: DataFrame, **kinds) -> StructType:
    return StructType([*(f for f in df.schema.fields if f.name not in kinds), *(StructField(n, k) for n, k in kinds.items())])


def _run(df: DataFrame, step: Callable[[pd.DataFrame], dict], **kinds) -> DataFrame:
    schema = _added(df, **kinds)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            yield rows.assign(**step(rows))[schema.names]

    return df.mapInPandas(batches, schema)


def scored(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.Series]], name: str) -> DataFrame:
    """Adds what a scorer says of each row. `load` is called once for each task, so a model is read once, and the scorer gets one Arrow batch after another: the border to renderers and neural scores."""
    schema = _added(df, **{name: DoubleType()})

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = load()
        for rows in parts:
            yield rows.assign(**{name: np.asarray(score(rows), float)})[schema.names]

    return df.mapInPandas(batches, schema)


RESULT = {"distance": DoubleType(), "ratio": DoubleType(), "evaluations": IntegerType(), "passes": BooleanType()}


def farthest_passing(df: DataFrame, objective: Objective, near: str, far: str, target: float, evaluations: int = 8, hint: str | None = None) -> DataFrame:
    """The largest distance between `near` and `far` at which a falling ratio is still at least the target, by bisection.

    far passes: far. near fails: whichever of the two has the larger ratio, marked as not passing. Else the bracket is
    halved until the evaluations are used up, and its passing end is the result. hint: a distance to look at first.
    """

    def step(rows: pd.DataFrame) -> dict:
        low, high = rows[near].to_numpy(float).copy(), rows[far].to_numpy(float).copy()
        high_ratio = np.asarray(objective(rows, high), float)
        used = np.ones(len(rows), int)
        open_ = high_ratio < target
        low_ratio = np.where(open_, np.asarray(objective(rows, low), float), np.nan)
        used += open_
        ends = open_ & (low_ratio < target)
        open_ &= ~ends
        distance, ratio = np.where(open_ | (ends & (low_ratio > high_ratio)), low, high), np.where(open_ | (ends & (low_ratio > high_ratio)), low_ratio, high_ratio)
        passes = ratio >= target
        bottom, top = low, high
        first = rows[hint].to_numpy(float) if hint else None
        while (open_ & (used < evaluations)).any():
            middle = (bottom + top) / 2
            if first is not None:
                middle, first = np.where((first > bottom) & (first < top), first, middle), None
            found = np.asarray(objective(rows, middle), float)
            go = open_ & (used < evaluations)
            good = go & (found >= target)
            distance, ratio = np.where(good, middle, distance), np.where(good, found, ratio)
            bottom, top = np.where(good, middle, bottom), np.where(go & ~good, middle, top)
            used = used + go
        return {"distance": distance, "ratio": ratio, "evaluations": used, "passes": passes}

    return _run(df, step, **RESULT)


def shrinking(df: DataFrame, objective: Objective, near: str, far: str, target: float, evaluations: int = 6, steps: tuple[float, float] = (0.5, 0.9)) -> DataFrame:
    """Moves in from `far` until the ratio reaches the target: each step multiplies the distance by the root of what is lacking, within `steps`. Stops at `near`, and keeps the best ratio if none passes."""

    def step(rows: pd.DataFrame) -> dict:
        floor, distance = rows[near].to_numpy(float), rows[far].to_numpy(float).copy()
        ratio, used = np.asarray(objective(rows, distance), float), np.ones(len(rows), int)
        best, best_ratio, at = distance.copy(), ratio.copy(), distance.copy()
        while (go := (best_ratio < target) & (used < evaluations) & (at > floor)).any():
            moved = np.maximum(floor, at * np.clip(np.sqrt(np.maximum(ratio, 0) / target), *steps))
            at = np.where(go, moved, at)
            ratio = np.where(go, np.asarray(objective(rows, at), float), ratio)
            better = go & (ratio > best_ratio)
            best, best_ratio = np.where(better, at, best), np.where(better, ratio, best_ratio)
            used = used + go
        return {"distance": best, "ratio": best_ratio, "evaluations": used, "passes": best_ratio >= target}

    return _run(df, step, **RESULT)


FIT = {"distance": DoubleType(), "coverage": DoubleType(), "background": DoubleType(), "score": DoubleType(), "met": BooleanType()}


def fitted(df: DataFrame, evaluate: Callable[[pd.DataFrame, np.ndarray], tuple[np.ndarray, np.ndarray]], near: str, far: str, target: float, least_coverage: float, most_background: float, iterations: int = 12) -> DataFrame:
    """Halves the range from `near` to `far` so often, towards the centre while the coverage is short of the target or the background too large, and keeps the distance with the best score: the distance from the target, and twice what misses either limit. `met`: does it keep to both limits? evaluate gives coverage and largest background."""

    def step(rows: pd.DataFrame) -> dict:
        low, high = rows[near].to_numpy(float).copy(), rows[far].to_numpy(float).copy()
        best = {k: np.full(len(rows), np.inf if k == "score" else np.nan) for k in ("distance", "coverage", "background", "score")}
        for _ in range(iterations):
            middle = (low + high) / 2
            coverage, background = (np.asarray(x, float) for x in evaluate(rows, middle))
            score = np.abs(coverage - target) + 2 * np.maximum(0, background - most_background) + 2 * np.maximum(0, least_coverage - coverage)
            better = score < best["score"]
            best = {k: np.where(better, v, best[k]) for k, v in (("distance", middle), ("coverage", coverage), ("background", background), ("score", score))}
            closer = (coverage < target) | (background > most_background)
            low, high = np.where(closer, low, middle), np.where(closer, middle, high)
        return best | {"met": (best["coverage"] >= least_coverage) & (best["background"] <= most_background)}

    return _run(df, step, **FIT)


def damped(df: DataFrame, penalty: Callable[[pd.DataFrame, np.ndarray], np.ndarray], attempts: int = 4) -> DataFrame:
    """Halves a motion's size from 1 on until its penalty is 0, `attempts` times at most; without success the size with the least penalty, the first of equal ones, is kept. Adds `size`, `penalty`, `attempts` and `met`."""

    def step(rows: pd.DataFrame) -> dict:
        size, used = np.ones(len(rows)), np.zeros(len(rows), int)
        best, least = size.copy(), np.full(len(rows), np.inf)
        for _ in range(attempts):
            go = least > 0
            found = np.asarray(penalty(rows, size), float)
            better = go & (found < least)
            best, least, used = np.where(better, size, best), np.where(better, found, least), used + go
            size = np.where(go, size / 2, size)
        return {"size": best, "penalty": least, "attempts": used, "met": least <= 0}

    return _run(df, step, size=DoubleType(), penalty=DoubleType(), attempts=IntegerType(), met=BooleanType())


def corrected(df: DataFrame, objective: Objective, distance: str, near: str, target: float, evaluations: int = 3, factor: float = 0.98) -> DataFrame:
    """A distance found at one resolution, tried at another: moved in by a factor, down to `near`, as long as the ratio there is short of the target. Adds `distance` (moved), `ratio`, `evaluations` and `passes`."""

    def step(rows: pd.DataFrame) -> dict:
        at, floor = rows[distance].to_numpy(float).copy(), rows[near].to_numpy(float)
        ratio, used = np.asarray(objective(rows, at), float), np.ones(len(rows), int)
        while (go := (ratio < target) & (used < evaluations) & (at > floor)).any():
            at = np.where(go, np.maximum(floor, at * factor), at)
            ratio = np.where(go, np.asarray(objective(rows, at), float), ratio)
            used = used + go
        return {"distance": at, "ratio": ratio, "evaluations": used, "passes": ratio >= target}

    return _run(df, step, **RESULT)


#: Strategies by name, each a function of (candidates, objective, near, far, target).
STRATEGIES: dict[str, Callable[..., DataFrame]] = {"bracket": farthest_passing, "shrink": shrinking}


def refine(df: DataFrame, loss: Callable[[pd.DataFrame, np.ndarray], np.ndarray], parameters: list[str], key: str, scale: float, rounds: int = 40, shrink: float = 0.93, seed: int = 0) -> DataFrame:
    """Local search: proposals about the best point so far, with a reach that shrinks; one is taken if its loss is lower. A row's random numbers depend on its whole-number key and the seed alone. Replaces the parameters and adds `loss`."""

    def step(rows: pd.DataFrame) -> dict:
        best = rows[parameters].to_numpy(float)
        value = np.asarray(loss(rows, best), float)
        rngs = [np.random.default_rng([seed, int(k) & 0xFFFFFFFF, int(k) >> 32 & 0xFFFFFFFF]) for k in rows[key]]
        reach = scale
        for _ in range(rounds):
            moved = best + reach * np.array([r.normal(size=len(parameters)) for r in rngs])
            found = np.asarray(loss(rows, moved), float)
            better = found < value
            best, value = np.where(better[:, None], moved, best), np.where(better, found, value)
            reach *= shrink
        return {p: best[:, i] for i, p in enumerate(parameters)} | {"loss": value}

    return _run(df, step, **dict.fromkeys(parameters, DoubleType()), loss=DoubleType())
