"""Logistic regression with a random intercept per cluster, by maximum Laplace likelihood.

The rows are first reduced to counts of covariate patterns per cluster, which loses nothing. The patterns of whole
clusters are packed into blocks of a bounded size, stored once. An evaluation of the likelihood is then one pass over
the blocks: a task solves the modes of a block's clusters, adds up what they contribute to the value, the gradient
and the information, and hands on sums whose size depends on the number of terms only. Nothing per cluster
reaches the driver, however many clusters there are. A cluster with more patterns than a block holds is spread
over several; its mode is then solved in passes of its own, with the modes in a Spark table.

Several models are fitted in the same passes: each is a coroutine that asks for evaluations, and a pass answers all.
"""

from __future__ import annotations

import functools
from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.columns import binary_label, logistic
from natalis.operators.filters import complete_rows
from natalis.operators.hypothesis import likelihood_ratio, wald_table
from natalis.sources.store import cut_lineage

_MIN_LOG_SIGMA = -7.0
_START_SIGMAS = (0.05, 0.15, 0.4, 1.0, 2.5)
INTERCEPT = "(Intercept)"
BLOCK_PATTERNS = 20_000  # patterns of a block, about
MOST_PATTERNS = 100_000  # patterns of a cluster that stays in one block
_MODE_TOL, _MODE_ROUNDS = 1e-9, 60


@dataclass
class MixedFit:
    """Fixed effects with their covariance, the random intercept's deviation, and the log-likelihood."""

    terms: tuple[str, ...]
    beta: np.ndarray
    vcov: np.ndarray
    sigma: float
    loglik: float
    n_rows: int
    n_groups: int
    passes: int
    converged: bool
    means: Mapping[str, float]

    @property
    def n_parameters(self) -> int:
        return len(self.beta) + 1

    def table(self, spark: SparkSession) -> DataFrame:
        """Coefficients with odds ratio, interval, z and p."""
        errors = np.sqrt(np.maximum(np.diag(self.vcov), 0.0))
        rows = [(t, float(b), float(e)) for t, b, e in zip(self.terms, self.beta, errors)]
        return wald_table(spark.createDataFrame(rows, "term string, estimate double, std_error double"))


def expand_terms(df: DataFrame, terms: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Resolve ``a*b`` to ``a``, ``b`` and the product column ``a:b``."""
    names: list[str] = []
    products: dict[str, Column] = {}
    crossed = []
    for term in terms:
        parts = term.split("*")
        names += [p for p in parts if p not in names]
        if len(parts) == 2:
            crossed.append(":".join(parts))
            products[crossed[-1]] = F.col(parts[0]).cast("double") * F.col(parts[1]).cast("double")
    return (df.withColumns(products) if products else df), names + crossed


@dataclass
class Model:
    """What is fitted: ``outcome ~ terms + (1 | cluster)`` on the complete rows of ``df``."""

    df: DataFrame
    outcome: str
    terms: Sequence[str]


@dataclass
class _Ask:
    """Parameter sets (fixed effects, log deviation or None for no random intercept) that a fit wants evaluated."""

    points: list[tuple[np.ndarray, float | None]]
    cross: bool = False


class _Sums:
    """What one evaluation of a model gives."""

    def __init__(self, v: np.ndarray, q: int):
        self.value, self.excess, self.curvature, slope_tau = v[:4]
        self.gradient = np.r_[v[4 : 4 + q], slope_tau]
        self.slope = v[4 + q : 4 + 2 * q]
        self.information = np.zeros((q, q))
        if len(v) > 4 + 2 * q:
            self.information[np.triu_indices(q)] = v[4 + 2 * q :]
            self.information += np.triu(self.information, 1).T


def _cluster_sums(x, s, n, starts, code, beta, u, cross: bool) -> np.ndarray:
    """Per cluster: residual, weight, third derivative, log-likelihood, their products with the covariates, and on
    request the weighted cross products."""
    upper = np.triu_indices(x.shape[1])
    eta = x @ beta + u[code]
    p = 1.0 / (1.0 + np.exp(-eta))
    w = n * p * (1.0 - p)
    r = s - n * p
    w3 = w * (1.0 - 2.0 * p)
    parts = [np.column_stack([r, w, w3, s * eta - n * np.logaddexp(0.0, eta)]), r[:, None] * x, w[:, None] * x, w3[:, None] * x]
    if cross:
        parts.append(w[:, None] * x[:, upper[0]] * x[:, upper[1]])
    return np.add.reduceat(np.hstack(parts), starts, axis=0)


def _contributions(stats: np.ndarray, q: int, tau: float | None, u: np.ndarray) -> np.ndarray:
    """Sums over clusters at their modes, in the order of ``_Sums``."""
    r, w, w3, ll = stats[:, 0], stats[:, 1], stats[:, 2], stats[:, 3]
    rx, wx, w3x = (stats[:, 4 + i * q : 4 + (i + 1) * q] for i in range(3))
    full = stats[:, 4 + 3 * q :].sum(axis=0)
    excess = np.sum(r * r - w)  # slope of the likelihood in the variance, at variance 0
    if tau is None:
        return np.r_[np.sum(ll), excess, 0.0, 0.0, rx.sum(axis=0), rx.sum(axis=0), full]
    var = float(np.exp(2.0 * tau))
    curve = w + 1.0 / var
    shrink = var / (1.0 + var * w)
    du_beta, du_tau = -wx / curve[:, None], 2.0 * u / var / curve
    value = np.sum(ll - u * u / (2.0 * var) - 0.5 * np.log1p(var * w))
    g_beta = rx.sum(axis=0) - 0.5 * (shrink[:, None] * (w3x + w3[:, None] * du_beta)).sum(axis=0)
    g_tau = np.sum(u * u / var - shrink * w - 0.5 * shrink * w3 * du_tau)
    if len(full):
        full = full - ((wx / curve[:, None]).T @ wx)[np.triu_indices(q)]
    return np.r_[value, excess, np.sum((w / (1.0 + var * w)) ** 2), g_tau, g_beta, rx.sum(axis=0), full]


def _mode_step(r: np.ndarray, w: np.ndarray, u: np.ndarray, tau: float) -> np.ndarray:
    precision = np.exp(-2.0 * tau)
    return np.clip((r - u * precision) / (w + precision), -2.0, 2.0)


def _modes(x, s, n, starts, code, beta, tau: float) -> np.ndarray:
    eta, u = x @ beta, np.zeros(len(starts))
    for _ in range(_MODE_ROUNDS):
        p = 1.0 / (1.0 + np.exp(-(eta + u[code])))
        step = _mode_step(np.add.reduceat(s - n * p, starts), np.add.reduceat(n * p * (1.0 - p), starts), u, tau)
        u = u + step
        if np.max(np.abs(step)) < _MODE_TOL:
            return u
    raise RuntimeError(f"cluster modes have not converged in {_MODE_ROUNDS} rounds")


def _packed(table: pa.Table, shift: Mapping[int, np.ndarray], scale: Mapping[int, np.ndarray]) -> tuple:
    """Sizes of the clusters, covariates with a leading 1, events and rows of one block, in a fixed order."""
    fit = table["fit"][0].as_py()
    x = np.array(table["x"].to_pylist(), float).reshape(table.num_rows, -1)
    code = table["g"].combine_chunks().dictionary_encode()
    place = np.argsort(np.argsort(np.array(code.dictionary.to_pylist(), object)))
    code = place[code.indices.to_numpy()]
    order = np.lexsort((*x.T, code))
    x = np.column_stack([np.ones(len(x)), (x[order] - shift[fit]) / scale[fit]])
    return np.bincount(code).astype("<i8"), x, table["s"].to_numpy()[order], table["n"].to_numpy()[order]


_BLOCK = "fit int, g string, sizes binary, x binary, s binary, n binary"


class _Likelihood:
    """Laplace likelihoods of several models; ``run`` is one distributed pass for all evaluations asked for."""

    def __init__(self, patterns: DataFrame, terms: Sequence[int], shift: Mapping[int, np.ndarray], scale: Mapping[int, np.ndarray]):
        self.width, self.passes = [t + 1 for t in terms], 0
        per_cluster = patterns.groupBy("fit", "g").agg(F.count("*").alias("p"))
        head = {r["fit"]: r for r in per_cluster.groupBy("fit").agg(F.sum("p").alias("p"), F.max("p").alias("most"), F.count("*").alias("groups")).collect()}
        self.groups = [head[i]["groups"] if i in head else 0 for i in range(len(terms))]
        of = F.element_at(F.array(*[F.lit(max(1, -(-head[i]["p"] // BLOCK_PATTERNS)) if i in head else 1) for i in range(len(terms))]), F.col("fit") + 1)
        self.large = None
        if any(r["most"] > MOST_PATTERNS for r in head.values()):
            sizes = per_cluster.filter(F.col("p") > MOST_PATTERNS)
            spread = patterns.join(sizes, ["fit", "g"]).withColumn("b", F.pmod(F.xxhash64("x"), F.ceil(F.col("p") / BLOCK_PATTERNS)))
            self.large = cut_lineage(self._blocks(spread, ["fit", "g", "b"], shift, scale))
            patterns = patterns.join(sizes, ["fit", "g"], "left_anti")
        self.blocks = cut_lineage(self._blocks(patterns.withColumn("b", F.pmod(F.xxhash64("g"), of)), ["fit", "b"], shift, scale))

    @staticmethod
    def _blocks(patterns: DataFrame, keys: Sequence[str], shift, scale) -> DataFrame:
        def pack(table: pa.Table) -> pa.Table:
            sizes, *rest = _packed(table, shift, scale)
            row = [table["fit"][:1], table["g"][:1], *([v.tobytes()] for v in (sizes, *rest))]
            return pa.table([pa.array(r, t) if isinstance(r, list) else r for r, t in zip(row, (None, None, *[pa.binary()] * 4), strict=True)], ["fit", "g", "sizes", "x", "s", "n"])

        return patterns.groupBy(*keys).applyInArrow(pack, _BLOCK)

    def run(self, asks: Mapping[int, _Ask]) -> dict[int, list[_Sums]]:
        """The sums that each model asks for."""
        found = self._added(self.blocks.mapInPandas(_fold_blocks(dict(asks), self.width), "fit int, k int, slot int, value double"))
        if self.large is not None:
            for key, v in self._of_large(asks).items():
                found[key] = found.get(key, 0.0) + v
        self.passes += 1
        return {i: [_Sums(found[i, k], self.width[i]) for k in range(len(a.points))] for i, a in asks.items()}

    @staticmethod
    def _added(sums: DataFrame) -> dict[tuple[int, int], np.ndarray]:
        # one long row per sum: a wide aggregate would be planned and compiled at several times the cost
        rows = sums.groupBy("fit", "k", "slot").agg(F.sum("value").alias("value")).toPandas().sort_values("slot")
        return {key: part["value"].to_numpy() for key, part in rows.groupby(["fit", "k"])}

    def _of_large(self, asks: Mapping[int, _Ask]) -> dict[tuple[int, int], np.ndarray]:
        """The same for clusters that are spread over blocks; modes are rows of a table."""
        points = [(i, k, None if tau is None else float(tau)) for i, a in asks.items() for k, (_, tau) in enumerate(a.points)]
        wanted = self.large.sparkSession.createDataFrame(points, "fit int, k int, tau double")
        state = cut_lineage(self.large.select("fit", "g").distinct().join(wanted, "fit").withColumn("u", F.lit(0.0)))

        def joined(cross: bool) -> DataFrame:
            own = state.groupBy("fit", "g").agg(F.collect_list(F.struct("k", "u")).alias("at"))
            fold = _fold_spread(dict(asks), self.width, cross)
            return self.large.join(own, ["fit", "g"]).mapInPandas(fold, "fit int, g string, k int, slot int, value double")

        precision = F.exp(-2.0 * F.col("tau"))
        for _ in range(_MODE_ROUNDS):
            sums = joined(False).groupBy("fit", "g", "k").agg(
                F.sum(F.when(F.col("slot") == 0, F.col("value"))).alias("r"), F.sum(F.when(F.col("slot") == 1, F.col("value"))).alias("w")
            )
            step = (F.col("r") - F.col("u") * precision) / (F.col("w") + precision)
            step = F.when(F.col("tau").isNull(), 0.0).otherwise(F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step)))
            state = cut_lineage(state.join(sums, ["fit", "g", "k"]).select("fit", "g", "k", "tau", (F.col("u") + step).alias("u"), step.alias("step")))
            if state.agg(F.max(F.abs("step"))).first()[0] < _MODE_TOL:
                break
            state = state.drop("step")
        else:
            raise RuntimeError(f"cluster modes have not converged in {_MODE_ROUNDS} passes")
        sums = joined(True).groupBy("fit", "g", "k", "slot").agg(F.sum("value").alias("value"))
        each = sums.groupBy("fit", "g", "k").agg(F.sort_array(F.collect_list(F.struct("slot", "value"))).alias("v"))
        return self._added(each.join(state, ["fit", "g", "k"]).mapInPandas(_contribute(self.width), "fit int, k int, slot int, value double"))


def _arrays(row, q: int) -> tuple:
    sizes = np.frombuffer(row.sizes, "<i8")
    x = np.frombuffer(row.x, float).reshape(-1, q)
    starts = np.cumsum(sizes) - sizes
    return x, np.frombuffer(row.s, float), np.frombuffer(row.n, float), starts, np.repeat(np.arange(len(sizes)), sizes)


def _rows(totals: Mapping[tuple, np.ndarray], names: list[str]) -> pd.DataFrame:
    rows = [(*key, slot, float(value)) for key, v in totals.items() for slot, value in enumerate(v)]
    return pd.DataFrame(rows, columns=[*names, "slot", "value"])


def _fold_blocks(asks: dict[int, _Ask], width: list[int]):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.fit in asks:
                    ask, q = asks[row.fit], width[row.fit]
                    data = _arrays(row, q)
                    for k, (beta, tau) in enumerate(ask.points):
                        u = np.zeros(len(data[3])) if tau is None else _modes(*data, beta, tau)
                        own = _contributions(_cluster_sums(*data, beta, u, ask.cross), q, tau, u)
                        totals[row.fit, k] = totals.get((row.fit, k), 0.0) + own
        yield _rows(totals, ["fit", "k"])

    return fold


def _fold_spread(asks: dict[int, _Ask], width: list[int], whole: bool):
    """Sums of the blocks of large clusters at given modes: all of them, or the residual and the weight only."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ask = asks[row.fit]
                data = _arrays(row, width[row.fit])
                totals = {}
                for at in row.at:
                    beta = ask.points[at["k"]][0]
                    stats = _cluster_sums(*data, beta, np.full(1, at["u"]), ask.cross and whole)[0]
                    totals[row.fit, row.g, at["k"]] = stats if whole else stats[:2]
                yield _rows(totals, ["fit", "g", "k"])

    return fold


def _contribute(width: list[int]):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                stats = np.array([[v["value"] for v in row.v]])
                own = _contributions(stats, width[row.fit], None if np.isnan(row.tau) else row.tau, np.array([row.u]))
                totals[row.fit, row.k] = totals.get((row.fit, row.k), 0.0) + own
        yield _rows(totals, ["fit", "k"])

    return fold


_Asking = Generator[_Ask, list[_Sums], tuple]


def _scoring(beta: np.ndarray, tau: float | None, rounds: int = 30, tol: float = 1e-9, strict: bool = True) -> _Asking:
    """Scoring of the fixed effects at a fixed deviation, with modes solved; without one plain logistic regression.

    Returns the fixed effects and the sums there. If ``strict``, not to converge is an error; otherwise the result
    is a starting point only.
    """
    for _ in range(rounds):
        sums = (yield _Ask([(beta, tau)], True))[0]
        move = np.linalg.solve(sums.information, sums.slope)
        if float(sums.slope @ move) < tol:
            break
        beta = beta + move
    else:
        if strict:
            raise RuntimeError(f"the scoring has not converged in {rounds} passes")
    return beta, sums


def _maximise(theta: np.ndarray, curvature: np.ndarray, limit: int, tol: float) -> _Asking:
    """Quasi-Newton ascent; the inverse curvature starts at the information of the starting point."""
    inverse = np.linalg.inv(curvature)
    now = (yield _Ask([(theta[:-1], theta[-1])]))[0]
    for _ in range(limit):
        pinned = theta[-1] <= _MIN_LOG_SIGMA + 1e-9 and now.gradient[-1] < 0
        slope = now.gradient.copy()
        if pinned:
            slope[-1] = 0.0
        direction = inverse @ slope
        if pinned:
            direction[-1] = 0.0
        gain = float(slope @ direction)
        if gain < tol:
            return theta, now.value, True
        length = min(1.0, 2.0 / max(np.max(np.abs(direction)), 1e-12))
        for _ in range(30):
            trial = theta + length * direction
            trial[-1] = max(trial[-1], _MIN_LOG_SIGMA)
            new = (yield _Ask([(trial[:-1], trial[-1])]))[0]
            if new.value >= now.value + 1e-4 * length * gain - 1e-10:
                break
            length *= 0.4
        else:
            return theta, now.value, gain < 1e-4
        s, y = trial - theta, now.gradient - new.gradient
        sy = float(s @ y)
        if sy > 1e-12:
            rho = 1.0 / sy
            left = np.eye(len(s)) - rho * np.outer(s, y)
            inverse = left @ inverse @ left.T + rho * np.outer(s, s)
        theta, now = trial, new
    return theta, now.value, False


def _curvature(theta: np.ndarray, free: list[int], h: float = 1e-3) -> _Asking:
    """Negative Hessian from central differences of the gradient, all points in the same pass."""
    shifted = [theta + sign * h * np.eye(len(theta))[i] for i in free for sign in (1.0, -1.0)]
    found = yield _Ask([(t[:-1], t[-1]) for t in shifted])
    hess = np.array([(found[2 * i].gradient - found[2 * i + 1].gradient)[free] / (2.0 * h) for i in range(len(free))])
    return -(hess + hess.T) / 2.0


def _fitting(q: int, share: float, max_iter: int, tol: float) -> _Asking:
    """(fixed effects, covariance, deviation, log-likelihood, converged) on standardised covariates."""
    plain = np.zeros(q)
    plain[0] = np.log(share / (1.0 - share))
    beta, flat = yield from _scoring(plain, None)
    # The likelihood may fall at variance 0 and rise later, so a few deviations are tried in the same pass.
    tried = yield _Ask([(beta, np.log(s)) for s in _START_SIGMAS])
    best = int(np.argmax([t.value for t in tried]))
    if flat.excess <= 0.0 and tried[best].value <= flat.value:
        return beta, np.linalg.inv(flat.information), 0.0, flat.value, True
    tau = float(np.log(_START_SIGMAS[best]))
    beta, sums = yield from _scoring(beta, tau, rounds=8, tol=1e-3, strict=False)
    curvature = np.zeros((q + 1, q + 1))
    curvature[:q, :q] = sums.information
    curvature[q, q] = 2.0 * np.exp(4.0 * tau) * sums.curvature + 1e-3
    theta, value, converged = yield from _maximise(np.r_[beta, tau], curvature, max_iter, tol)
    singular = theta[-1] <= _MIN_LOG_SIGMA + 0.5
    free = list(range(q if singular else q + 1))
    covariance = np.linalg.inv((yield from _curvature(theta, free)))[:q, :q]
    return theta[:q], covariance, 0.0 if singular else float(np.exp(theta[-1])), value, converged


def _pattern_counts(models: Sequence[Model], group: str) -> tuple[DataFrame, list[list[str]]]:
    """(fit, g, x, s, n): events and rows per model, cluster and covariate pattern, stored; and each model's terms."""
    parts, names = [], []
    for i, model in enumerate(models):
        expanded, own = expand_terms(model.df, model.terms)
        used = expanded.selectExpr(f"CAST(`{group}` AS STRING) AS g", f"`{model.outcome}` AS y", *[f"CAST(`{t}` AS DOUBLE) AS `x{j}`" for j, t in enumerate(own)])
        used = complete_rows(used, used.columns)
        x = [f"x{j}" for j in range(len(own))]
        counts = used.groupBy("g", *x).agg(F.sum(F.col("y").cast("double")).alias("s"), F.count("*").cast("double").alias("n"))
        parts.append(counts.select(F.lit(i).alias("fit"), "g", F.array(*x).alias("x") if x else F.expr("CAST(array() AS array<double>)").alias("x"), "s", "n"))
        names.append(own)
    return cut_lineage(functools.reduce(DataFrame.unionByName, parts)), names


def log_likelihoods(models: Sequence[Model], points: Sequence[tuple[Sequence[float], float]], group: str = "data_partner_id") -> list[float]:
    """Laplace log-likelihood of each model at given coefficients (intercept first) and a given positive deviation."""
    patterns, names = _pattern_counts(models, group)
    zeros, ones = ({i: np.full(len(t), v) for i, t in enumerate(names)} for v in (0.0, 1.0))
    lik = _Likelihood(patterns, [len(t) for t in names], zeros, ones)
    found = lik.run({i: _Ask([(np.array(beta, dtype=float), float(np.log(sigma)))]) for i, (beta, sigma) in enumerate(points)})
    return [float(found[i][0].value) for i in range(len(models))]


def log_likelihood(
    df: DataFrame, outcome: str, terms: Sequence[str], beta: Sequence[float], sigma: float, group: str = "data_partner_id"
) -> float:
    return log_likelihoods([Model(df, outcome, terms)], [(beta, sigma)], group)[0]


def fit_models(models: Sequence[Model], group: str = "data_partner_id", max_iter: int = 100, tol: float = 1e-9) -> list[MixedFit]:
    """Fit several models ``outcome ~ terms + (1 | group)`` in the same passes.

    ``a*b`` in a term adds both columns and their product. Rows with a missing value in any used column are left out.
    A constant term, or an outcome that never or always occurs, is an error.
    """
    patterns, names = _pattern_counts(models, group)
    rows = {r["fit"]: r for r in patterns.groupBy("fit").agg(F.sum("n").alias("rows"), F.sum("s").alias("events")).collect()}
    at = patterns.select("fit", "n", F.posexplode("x").alias("j", "v")).groupBy("fit", "j")
    moments = at.agg(F.sum(F.col("n") * F.col("v")).alias("m"), F.sum(F.col("n") * F.col("v") * F.col("v")).alias("q"), (F.max("v") - F.min("v")).alias("w"))
    moments = {(r["fit"], r["j"]): r for r in moments.collect()}  # a row per term
    means, scales = {}, {}
    for i, own in enumerate(names):
        if i not in rows or not 0 < rows[i]["events"] < rows[i]["rows"]:
            raise ValueError(f"{models[i].outcome} does not vary")
        mean, square = (np.array([moments[i, j][c] / rows[i]["rows"] for j in range(len(own))]) for c in ("m", "q"))
        width = np.array([moments[i, j]["w"] for j in range(len(own))])
        # only conditions the iteration; the result is mapped back exactly
        spread = np.sqrt(np.maximum(square - mean**2, 0.0))
        means[i], scales[i] = mean, np.where(spread > 1e-6 * width, spread, width)
        constant = [t for t, s in zip(own, scales[i]) if not s > 0]
        if constant:
            raise ValueError(f"constant terms cannot be fitted: {constant}")
    lik = _Likelihood(patterns, [len(t) for t in names], means, scales)
    fits = {i: _fitting(len(own) + 1, rows[i]["events"] / rows[i]["rows"], max_iter, tol) for i, own in enumerate(names)}
    asks, done = {i: next(fit) for i, fit in fits.items()}, {}
    while asks:
        found = lik.run(asks)
        asks = {}
        for i, sums in found.items():
            try:
                asks[i] = fits[i].send(sums)
            except StopIteration as end:
                done[i] = end.value
    out = []
    for i, own in enumerate(names):
        beta, covariance, sigma, value, converged = done[i]
        # back from standardised to raw covariates
        back = np.eye(len(own) + 1)
        back[1:, 1:] = np.diag(1.0 / scales[i])
        back[0, 1:] = -means[i] / scales[i]
        out.append(
            MixedFit(
                terms=(INTERCEPT, *own),
                beta=back @ beta,
                vcov=back @ covariance @ back.T,
                sigma=sigma,
                loglik=float(value),
                n_rows=int(rows[i]["rows"]),
                n_groups=lik.groups[i],
                passes=lik.passes,
                converged=converged,
                means=dict(zip(own, means[i].tolist())),
            )
        )
    return out


def score_moments(models: Sequence[Model], fits: Sequence[MixedFit], group: str = "data_partner_id") -> list[dict[str, float]]:
    """Fitted side of the score equations of each model, per term.

    At the maximum of the Laplace likelihood it equals the observed sum of y·x, as its slope in a fixed effect is zero.
    """
    patterns, names = _pattern_counts(models, group)
    sums = patterns.select("fit", "s", F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("j", "v"))
    seen = {(r["fit"], r["j"]): r["o"] for r in sums.groupBy("fit", "j").agg(F.sum(F.col("s") * F.col("v")).alias("o")).collect()}
    zeros, ones = ({i: np.full(len(t), v) for i, t in enumerate(names)} for v in (0.0, 1.0))
    lik = _Likelihood(patterns, [len(t) for t in names], zeros, ones)
    found = lik.run({i: _Ask([(f.beta, float(np.log(f.sigma)) if f.sigma > 0 else None)]) for i, f in enumerate(fits)})
    return [{t: float(seen[i, j] - found[i][0].gradient[j]) for j, t in enumerate(fit.terms)} for i, fit in enumerate(fits)]


def fit_mixed(
    df: DataFrame,
    outcome: str,
    terms: Sequence[str],
    group: str = "data_partner_id",
    max_iter: int = 100,
    tol: float = 1e-9,
) -> MixedFit:
    """Fit one model; see ``fit_models``."""
    return fit_models([Model(df, outcome, terms)], group, max_iter, tol)[0]


def predicted_curve(
    df: DataFrame, fit: MixedFit, focal: str = "age", exposure: str | None = None, levels: Sequence[float] = (0, 1)
) -> DataFrame:
    """Population-level probability with interval at every observed ``focal`` value and exposure level.

    Other covariates stand at their mean and the random intercept at 0; products follow their factors.
    """
    grid = df.select(F.col(focal).cast("double").alias("x")).dropna().distinct()
    grid = grid.withColumn("level", F.explode(F.array(*[F.lit(float(v)) for v in levels])))

    def at(term: str) -> Column:
        if term == INTERCEPT:
            return F.lit(1.0)
        if term == focal:
            return F.col("x")
        if term == exposure:
            return F.col("level")
        if ":" in term:
            a, b = term.split(":")
            return at(a) * at(b)
        return F.lit(float(fit.means[term]))

    values = [at(t) for t in fit.terms]
    eta = sum((v * F.lit(float(b)) for v, b in zip(values, fit.beta)), F.lit(0.0))
    variance = F.lit(0.0)
    for i, a in enumerate(values):
        inner = sum((b * F.lit(float(fit.vcov[i, j])) for j, b in enumerate(values)), F.lit(0.0))
        variance = variance + a * inner
    half = F.lit(1.96) * F.sqrt(F.greatest(F.col("_var"), F.lit(0.0)))
    return grid.withColumns({"_eta": eta, "_var": variance}).select(
        "x",
        binary_label("level").alias("group"),
        logistic(F.col("_eta")).alias("predicted"),
        logistic(F.col("_eta") - half).alias("conf_low"),
        logistic(F.col("_eta") + half).alias("conf_high"),
    )


def compare_nested(
    df: DataFrame, outcomes: Mapping[str, str], reduced: Sequence[str], full: Sequence[str], group: str = "data_partner_id"
) -> DataFrame:
    """Likelihood-ratio test of the full against the reduced model, one row per outcome label.

    Both models see the rows that are complete for the full one.
    """
    models = []
    for outcome in outcomes.values():
        needed = [outcome, group, *dict.fromkeys(p for t in (*reduced, *full) for p in t.split("*"))]
        complete = complete_rows(df.select(*needed), needed)
        models += [Model(complete, outcome, reduced), Model(complete, outcome, full)]
    fits = fit_models(models, group)
    rows = [
        (label, small.loglik, large.loglik, large.n_parameters - small.n_parameters)
        for label, small, large in zip(outcomes, fits[::2], fits[1::2])
    ]
    return likelihood_ratio(
        df.sparkSession.createDataFrame(rows, "dv_label string, loglik_reduced double, loglik_full double, df_diff int")
    )
