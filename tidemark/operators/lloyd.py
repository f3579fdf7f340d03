"""k-means with every number of clusters and every start at once: one pass over the points moves all centres.

A pass gives each point to the nearest centre of each model still moving, and hands over one row per task and cluster:
points, their sum and their cost. So fifty fits take as many passes as the slowest of them, not as all together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Points that starting centres are picked from: a documented sample; every pass goes over all points.
START_POINTS = 2000


@dataclass
class Fit:
    """Centres, the cost of all points by them, and the passes it took to settle."""

    centres: np.ndarray
    cost: float
    passes: int


def starting_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k points of the sample, each one likelier the farther it lies from those before (squared distance)."""
    pick = np.random.default_rng([seed, k])
    centres = [sample[pick.integers(len(sample))]]
    while len(centres) < k:
        apart = ((sample[:, None, :] - np.array(centres)[None]) ** 2).sum(2).min(1)
        total = apart.sum()
        centres.append(sample[pick.choice(len(sample), p=apart / total if total > 0 else None)])
    return np.array(centres)


def fit_all(
    points: DataFrame,
    vector: str,
    tie_break: str,
    ks: list[int],
    restarts: int,
    seed: int,
    squared_shift: float,
    max_passes: int = 300,
) -> dict[tuple[int, int], Fit]:
    """A fit for every number of clusters and start; ``vector`` is an array column without missing values.

    A model has settled when the squared moves of its centres sum to ``squared_shift`` at most. An empty cluster stays
    where it is. ``points`` is read in every pass: pass a staged table. No points give no fits.
    """
    chosen = points.select(vector).orderBy(F.xxhash64(tie_break), tie_break).limit(START_POINTS).toArrow()
    if not chosen.num_rows:
        return {}
    sample = np.array(chosen.column(0).to_pylist(), float)
    moving = {(k, i): starting_centres(sample, k, seed + i) for k in ks for i in range(restarts)}
    done: dict[tuple[int, int], Fit] = {}
    for passes in range(1, max_passes + 1):
        found = _pass(points.select(vector), moving)
        for model, (count, sums, cost) in found.items():
            old = moving[model]
            new = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], old)
            if passes == max_passes or ((new - old) ** 2).sum() <= squared_shift:
                done[model] = Fit(old, cost, passes)
                del moving[model]
            else:
                moving[model] = new
        if not moving:
            break
    return done


def _pass(
    points: DataFrame, models: dict[tuple[int, int], np.ndarray]
) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray, float]]:
    """Points, coordinate sums and cost of every cluster of every model."""
    names = list(models)
    centres = np.concatenate([models[m] for m in names])
    ends = np.cumsum([len(models[m]) for m in names])
    starts = ends - [len(models[m]) for m in names]
    clusters, width = centres.shape
    schema = "cluster int, n double, cost double, " + ", ".join(f"s{i} double" for i in range(width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        n, cost, sums = np.zeros(clusters), np.zeros(clusters), np.zeros((clusters, width))
        size = (centres**2).sum(1)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            near = size - 2 * x @ centres.T  # up to the point's own square, which is the same for all centres
            for start, end in zip(starts, ends):
                label = start + near[:, start:end].argmin(1)
                n += np.bincount(label, minlength=clusters)
                cost += np.bincount(label, ((x - centres[label]) ** 2).sum(1), minlength=clusters)
                for i in range(width):
                    sums[:, i] += np.bincount(label, x[:, i], minlength=clusters)
        kept = [pa.array(np.arange(clusters, dtype=np.int32)), pa.array(n), pa.array(cost), *[pa.array(sums[:, i].copy()) for i in range(width)]]
        yield pa.RecordBatch.from_arrays(kept, names=[c.split()[0] for c in schema.split(", ")])

    columns = ["n", "cost", *[f"s{i}" for i in range(width)]]
    rows = points.mapInArrow(run, schema).groupBy("cluster").agg(*[F.sum(c).alias(c) for c in columns])
    rows = sorted(rows.collect(), key=lambda r: r["cluster"])  # one row per cluster of all models
    table = np.array([[r[c] for c in columns] for r in rows])
    return {m: (table[s:e, 0], table[s:e, 2:], float(table[s:e, 1].sum())) for m, s, e in zip(names, starts, ends)}
