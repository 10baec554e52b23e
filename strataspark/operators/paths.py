"""Several best ways through candidates of ordered stages, with broken moves allowed at a price."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import collected, in_order, pieces, runs

BLOCK = 1_000_000  # sums of options and candidates looked at together


@dataclass(frozen=True)
class PathLimits:
    """Limits of ``k_best_sequences``; fixed values of the method, in the unit of the positions."""

    paths: int = 3  # options that survive at every candidate, and ways returned
    weight: float = 0.5  # price of a unit of move
    reach: float = 20.0  # of an unbroken move
    seam: float = 15.0  # price of a move beyond that
    most: float = 2.0  # between stages of one run


def survivors(total: np.ndarray, at: np.ndarray, now: np.ndarray, limits: PathLimits) -> tuple[np.ndarray, np.ndarray]:
    """For each position of ``now`` the numbers of its best options and their totals before its own cost, best first, ties to the smaller number; in blocks of bounded size."""
    k, whole_no, whole_sum = min(limits.paths, len(total)), [], []
    width = max(1, BLOCK // len(total))
    for b in range(0, len(now), width):
        apart = np.abs(at[None, :] - now[b: b + width, None])
        sums = total[None, :] + np.where(apart <= limits.reach, limits.weight * apart, limits.seam)
        edge = np.partition(sums, k - 1, axis=1)[:, k - 1: k]
        for row, e in zip(sums, edge):
            near = np.flatnonzero(row <= e)  # in order of number
            best = near[np.argsort(row[near], kind="stable")[:k]]
            whole_no.append(best)
            whole_sum.append(row[best])
    return np.array(whole_no), np.array(whole_sum)


def k_best_sequences(cands: DataFrame, key: str, stage: str, position: str, cost: str, limits: PathLimits = PathLimits()) -> DataFrame:
    """(key, run, path, stage, id, total, seam): the ``paths`` cheapest ways of each run that take one candidate (id, position, cost) a stage, numbered from the cheapest; fewer if there are fewer.

    A way costs its candidates' costs and its moves: ``weight`` times the distance within ``reach``, else ``seam``, where the way is broken (``seam``). Stages more than ``most`` apart begin
    a new run. Ties go to the smaller id, then to the better option. Rows with a null or NaN take no part; ids should be unique in a stage. Any way among the best
    of its run is made of options among the best at every candidate, so the result is exact. Stages are read one after the other, forward and then back, so a task holds the options
    of two stages of a key; looking for them takes time as the product of two stages' candidates.
    """
    def forward(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        whose = None
        for p in pieces(batches, [key, "run", stage]):
            now, own, n = p[position].astype(float), p[cost].astype(float), len(p["id"])
            if whose == (p[key][0], p["run"][0]):
                back, sums = survivors(total, at, now, limits)
                ways = back.shape[1]
                seams = np.abs(at[back] - now[:, None]) > limits.reach
                sums = sums + own[:, None]
            else:
                ways, back, sums, seams = 1, np.full((n, 1), -1), own[:, None], np.zeros((n, 1), bool)
            whose, at, total = (p[key][0], p["run"][0]), np.repeat(now, ways), sums.ravel()
            yield {c: np.repeat(p[c], ways) for c in (key, "run", stage, "id")} | {"option": np.arange(n * ways), "back": back.ravel(), "total": total, "seam": seams.ravel()}

    def backward(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        whose = None
        for p in pieces(batches, [key, "run", stage]):
            if whose != (p[key][0], p["run"][0]):
                whose = (p[key][0], p["run"][0])
                at = np.argsort(p["total"], kind="stable")[: limits.paths]
                ends = p["total"][at]
            yield {c: p[c][at] for c in (key, "run", stage, "id", "seam")} | {"path": np.arange(1, len(at) + 1), "total": ends}
            at = p["back"][at]

    kinds = dict(cands.dtypes)
    head = f"{key} {kinds[key]}, run long, {stage} {kinds[stage]}, id long"
    whole = cands.select(key, stage, "id", position, cost).dropna()
    rows = in_order(runs(whole, key, stage, limits.most), key, stage, "id")
    ways = rows.mapInPandas(lambda it: collected(forward(it)), f"{head}, option long, back long, total double, seam boolean")
    back = ways.sortWithinPartitions(key, F.col(stage).desc(), "option")  # a key's rows are still in one task
    return back.mapInPandas(lambda it: collected(backward(it)), f"{head}, seam boolean, path long, total double").select(key, "run", "path", stage, "id", "total", "seam")
