"""Many ridge-penalised logistic fits over one table, from the same scans.

The fits share rows and features and differ in the label and weight that each (group, label) cell of the
data gets. One Newton step of all fits is one Spark aggregation, so a grid of fits reads the data as
often as a single fit does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.operators.linear import LinearFit


def _pass(table: DataFrame, features: Sequence[str], betas: np.ndarray, label: np.ndarray, factor: np.ndarray):
    """Loss, gradient and Hessian of every fit at its coefficients; one row per fit and entry is summed."""
    names = list(features)
    m, q = betas.shape
    upper = np.triu_indices(q)
    width = 1 + q + len(upper[0])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((m, width))
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), batch[names].to_numpy(dtype="float64")])
            cell, n = batch["cell"].to_numpy(), batch["n"].to_numpy()
            eta = x @ betas.T
            for k in range(m):
                w, y, e = n * factor[k][cell], label[k][cell], eta[:, k]
                p = 1.0 / (1.0 + np.exp(-np.clip(e, -700, 700)))
                hess = x.T @ (x * (w * p * (1.0 - p))[:, None])
                sums[k, 0] += float(np.sum(w * (np.logaddexp(0.0, e) - y * e)))
                sums[k, 1 : q + 1] += x.T @ (w * (y - p))
                sums[k, q + 1 :] += hess[upper]
        yield pd.DataFrame(
            {
                "fit": np.repeat(np.arange(m, dtype="int32"), width),
                "entry": np.tile(np.arange(width, dtype="int32"), m),
                "value": sums.ravel(),
            }
        )

    rows = (
        table.select(*names, "cell", "n")
        .mapInPandas(fold, "fit int, entry int, value double")
        .groupBy("fit", "entry")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    sums = np.zeros((m, width))
    sums[rows["fit"], rows["entry"]] = rows["value"]
    hess = np.zeros((m, q, q))
    for k in range(m):
        hess[k][upper] = sums[k, q + 1 :]
        hess[k] = hess[k] + np.triu(hess[k], 1).T
    return sums[:, 0], sums[:, 1 : q + 1], hess


def ridge_grid(
    table: DataFrame,
    features: Sequence[str],
    label: np.ndarray,
    factor: np.ndarray,
    c: float | Sequence[float] = 1.0,
    tol: float = 1e-8,
    limit: int = 50,
) -> list[LinearFit]:
    """Fits of ``label[k][cell]`` with weight ``n * factor[k][cell]`` for a table (features, cell, n).

    Penalty ``|w|² / 2`` against ``c`` times the loss, one ``c`` for all fits or one for each; intercept free. A fit whose weighted cells all carry
    one label is the constant of that label. A step that does not lower the loss is halved. Fits that are still
    moving after ``limit`` passes are an error.
    """
    fits, q = len(label), len(features) + 1
    seen = factor > 0
    fixed = {k: set(label[k][seen[k]]) for k in range(fits)}
    betas, steps = np.zeros((fits, q)), np.zeros((fits, q))
    value = np.full(fits, np.inf)
    penalties = [np.diag(np.r_[0.0, np.ones(q - 1)]) / v for v in np.broadcast_to(np.asarray(c, float), fits)]
    open_ = [k for k in range(fits) if len(fixed[k]) == 2]
    for _ in range(limit):
        if not open_:
            break
        loss, slope, hess = _pass(table, features, betas[open_], label[open_], factor[open_])
        still = []
        for i, k in enumerate(open_):
            penalty = penalties[k]
            total = loss[i] + 0.5 * float(betas[k] @ penalty @ betas[k])
            if total > value[k] + 1e-12 * abs(total):
                steps[k] = steps[k] / 2.0
                betas[k] = betas[k] - steps[k]
                still.append(k)
                continue
            value[k] = total
            gradient = slope[i] - penalty @ betas[k]
            move = np.linalg.solve(hess[i] + penalty + 1e-12 * np.eye(q), gradient)
            if float(gradient @ move) > tol:
                steps[k] = move
                betas[k] = betas[k] + move
                still.append(k)
        open_ = still
    if open_:
        raise RuntimeError(f"{len(open_)} of {fits} fits have not converged in {limit} passes")
    out = []
    for k in range(fits):
        b = betas[k] if len(fixed[k]) == 2 else np.r_[50.0 if 1.0 in fixed[k] else -50.0, np.zeros(q - 1)]
        out.append(LinearFit(float(b[0]), dict(zip(features, b[1:].tolist()))))
    return out
