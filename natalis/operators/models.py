"""Classifiers on MLlib. Only coefficients and result rows ever reach the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.columns import flag, hash_uniform, ratio
from natalis.operators.filters import complete_rows
from natalis.operators.linear import LinearFit
from natalis.operators.metrics import auc, classification_report, confusion_matrix, macro_scores
from natalis.operators.newton import ridge_grid
from natalis.operators.ordering import number_rows
from natalis.sources.store import cut_lineage

FEATURES = "features"
LEAST_PENALTY = 1e-6


def with_split(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """``train`` or ``test`` from a hash of the key: the same for any partitioning of the data."""
    return df.withColumn("split", F.when(hash_uniform(F.col(key), seed=seed) < train_share, "train").otherwise("test"))


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(complete_rows(df, features))


def patterns(df: DataFrame, columns: Sequence[str], weight: str | None = None, out: str = "n") -> DataFrame:
    """Distinct value combinations with their counts (or summed weights).

    Indicator data has far fewer combinations than rows, every likelihood here depends on the rows only
    through these counts, and the count combines map-side. Rows with a missing value are left out.
    """
    rows = complete_rows(df, columns)
    total = F.sum(weight) if weight else F.count("*")
    return rows.groupBy(*columns).agg(total.cast("double").alias(out))


def ridge_logistic(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    weight: str | None = None,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
    solver: str = "newton",
) -> LinearFit:
    """Logistic regression with the penalty ``|w|² / 2`` against ``c`` times the summed loss.

    The ``newton`` solver takes a handful of passes and holds a square matrix of the features; ``lbfgs`` is
    MLlib's, which keeps only vectors. MLlib averages the loss over the summed weight, so that its
    ``regParam`` is 1 / (c · total weight), the penalty on the raw scale and the intercept free.
    """
    columns = [*features, target, *([weight] if weight else [])]
    rows = complete_rows(df.select(*columns), columns)
    if solver not in ("newton", "lbfgs"):
        raise ValueError(f"unknown solver: {solver}")
    if solver == "newton":
        cells = rows.select(
            *features,
            F.col(target).cast("int").alias("cell"),
            (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("n"),
        )
        return ridge_grid(cut_lineage(cells), features, np.array([[0.0, 1.0]]), np.ones((1, 2)), c)[0]
    total = rows.agg(F.sum(weight) if weight else F.count("*")).first()[0]
    model = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=target,
        maxIter=max_iter,
        tol=tol,
        regParam=1.0 / (c * float(total)),
        elasticNetParam=0.0,
        standardization=False,
        **({"weightCol": weight} if weight else {}),
    ).fit(assemble(rows, features))
    return LinearFit(float(model.intercept), dict(zip(features, (float(x) for x in model.coefficients))))


def binomial_glm(
    df: DataFrame, features: Sequence[str], target: str, weight: str | None = None, max_iter: int = 50
) -> LinearFit:
    """Unpenalised logistic regression by iteratively reweighted least squares, with standard errors."""
    rows = assemble(df.select(*features, target, *([weight] if weight else [])), features)
    model = GeneralizedLinearRegression(
        featuresCol=FEATURES,
        labelCol=target,
        family="binomial",
        link="logit",
        maxIter=max_iter,
        tol=1e-10,
        regParam=0.0,
        **({"weightCol": weight} if weight else {}),
    ).fit(rows)
    errors = dict(zip([*features, "(Intercept)"], (float(e) for e in model.summary.coefficientStandardErrors)))
    return LinearFit(float(model.intercept), dict(zip(features, (float(x) for x in model.coefficients))), errors)


def propensity_scores(
    df: DataFrame, exposure: str, covariates: Sequence[str], out: str = "distance"
) -> tuple[LinearFit, DataFrame]:
    """Probability of the exposure given the covariates, fitted on the counts of covariate patterns."""
    counts = patterns(df, [*covariates, exposure])
    fit = binomial_glm(counts, covariates, exposure, weight="n")
    return fit, df.withColumn(out, fit.probability())


def evaluation(test: DataFrame, target: str, score: str = "score", pred: str = "y_pred") -> dict[str, DataFrame]:
    """Report tables of a scored test set: matrix, per-class report, macro scores, area under the curve."""
    return {
        "confusion": confusion_matrix(test, target, pred),
        "report": classification_report(test, target, pred),
        "macro": macro_scores(test, target, pred),
        "auc": auc(test, target, score),
    }


def fit_and_score(
    df: DataFrame, features: Sequence[str], target: str, key: str, prediction: str | None = None
) -> tuple[LinearFit, DataFrame]:
    """Fit on the train part; return all rows with split, score and predicted class."""
    marked = with_split(df, key)
    train = patterns(marked.filter(F.col("split") == "train"), [*features, target])
    fit = ridge_logistic(train, features, target, weight="n")
    return fit, fit.transform(marked, prediction or f"predicted_{target}")


# --- non-linear models ------------------------------------------------------------------------------


@dataclass
class VectorFit:
    """A fitted MLlib classifier over named feature columns."""

    model: Model
    features: Sequence[str]

    def transform(self, df: DataFrame, prediction: str = "y_pred", probability: str | None = "score") -> DataFrame:
        scored = self.model.transform(assemble(df, self.features))
        columns = {prediction: F.col("prediction").cast("int")}
        if probability:
            name = "probability" if "probability" in scored.columns else "rawPrediction"
            columns[probability] = vector_to_array(name)[1]
        return scored.withColumns(columns).select(*df.columns, *columns)


def _vector_fit(estimator, df: DataFrame, features: Sequence[str], target: str) -> VectorFit:
    rows = assemble(df.select(*features, F.col(target).cast("double").alias(target)), features)
    return VectorFit(estimator.setFeaturesCol(FEATURES).setLabelCol(target).fit(rows), list(features))


def neural_network(
    df: DataFrame, features: Sequence[str], target: str, hidden: Sequence[int] = (32,), max_iter: int = 100, seed: int = 42
) -> VectorFit:
    layers = [len(features), *hidden, 2]
    return _vector_fit(
        MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed, blockSize=128), df, features, target
    )


def random_forest(
    df: DataFrame, features: Sequence[str], target: str, trees: int = 100, depth: int = 8, seed: int = 42
) -> VectorFit:
    return _vector_fit(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed), df, features, target)


def gradient_boosting(
    df: DataFrame, features: Sequence[str], target: str, rounds: int = 50, depth: int = 5, seed: int = 42
) -> VectorFit:
    return _vector_fit(GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed), df, features, target)


def linear_svm(df: DataFrame, features: Sequence[str], target: str, penalty: float = 0.01, max_iter: int = 100) -> VectorFit:
    return _vector_fit(LinearSVC(maxIter=max_iter, regParam=penalty), df, features, target)


def fold_of(key: str, folds: int, seed: int = 42) -> Column:
    """Fold of a row, by a hash of its key."""
    return F.floor(hash_uniform(F.col(key), seed=seed) * folds).cast("int")


@dataclass
class FoldFits:
    """A fit for each penalty and fold, on the rows of the other folds, and the counts that all of them share."""

    fits: dict[tuple[float, int], LinearFit]
    pulls: dict[tuple[float, int], dict[str, float]]  # what the penalty adds to a fit's score equations, per feature
    counts: DataFrame  # (features, target, fold, n)


def fit_folds(
    df: DataFrame, features: Sequence[str], target: str, key: str, penalties: Sequence[float], folds: int = 3, seed: int = 42
) -> FoldFits:
    """Logistic fits for all penalties and folds in the same Newton passes over one table of pattern counts.

    The fold is a cell of the counts, and a fit gives its own fold's cells no weight. The penalty is on the mean loss and on
    features divided by their standard deviation; at least ``LEAST_PENALTY``, which keeps separable folds finite.
    """
    rows = df.select(*features, target, fold_of(key, folds, seed).alias("fold"))
    counts = cut_lineage(patterns(rows, [*features, target, "fold"]))
    n, sizes = F.col("n"), counts.groupBy("fold").agg(F.sum("n").alias("n")).collect()
    size = {r["fold"]: r["n"] for r in sizes}  # a row per fold
    total = sum(size.values())
    moments = counts.agg(*[F.sum(n * F.col(f)).alias(f"m{i}") for i, f in enumerate(features)], *[F.sum(n * F.col(f) * F.col(f)).alias(f"q{i}") for i, f in enumerate(features)]).first()
    spread = [np.sqrt(max(moments[f"q{i}"] / total - (moments[f"m{i}"] / total) ** 2, 0.0)) for i in range(len(features))]
    scale = np.array([v if v > 1e-9 else 1.0 for v in spread])
    scaled = counts.select(
        *[(F.col(f) / F.lit(float(v))).alias(f) for f, v in zip(features, scale)], (F.col("fold") * 2 + F.col(target)).cast("int").alias("cell"), "n"
    )
    wanted = [(p, k) for p in penalties for k in range(folds)]
    label = np.tile([0.0, 1.0], (len(wanted), folds))
    factor = np.array([[0.0 if cell // 2 == k else 1.0 for cell in range(2 * folds)] for _, k in wanted])
    strength = [max(p, LEAST_PENALTY) * (total - size.get(k, 0.0)) for p, k in wanted]
    fits, pulls = {}, {}
    for at, pull, fit in zip(wanted, strength, ridge_grid(scaled, features, label, factor, c=[1.0 / max(v, 1e-300) for v in strength])):
        weights = {f: fit.weights[f] / v for f, v in zip(features, scale)}
        fits[at] = LinearFit(fit.intercept, weights)
        pulls[at] = {f: pull * weights[f] * v * v for f, v in zip(features, scale)}
    return FoldFits(fits, pulls, counts)


def fold_moments(found: FoldFits, target: str) -> DataFrame:
    """Fitted side of the score equations, (penalty, fold, term, moment); at the maximum the sum of y·x over the other folds."""
    out = []
    for (p, k), fit in found.fits.items():
        others = F.when(F.col("fold") != k, F.col("n")).otherwise(0.0) * fit.probability()
        out += [(p, k, "(Intercept)", F.sum(others))]
        out += [(p, k, f, F.sum(others * F.col(f)) + F.lit(float(found.pulls[p, k][f]))) for f in fit.weights]
    rows = []
    for at in dict.fromkeys((p, k) for p, k, _, _ in out):  # an aggregate of the features' width for each fit
        own = [(t, e) for p, k, t, e in out if (p, k) == at]
        row = found.counts.agg(*[e.alias(t) for t, e in own]).unpivot([], [t for t, _ in own], "term", "moment")
        rows.append(row.select(F.lit(float(at[0])).alias("penalty"), F.lit(at[1]).alias("fold"), "term", "moment"))
    return reduce(DataFrame.unionByName, rows)


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    penalties: Sequence[float] = (0.0, 0.01, 0.1),
    folds: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Mean area under the curve over folds for each penalty, (penalty, mean_auc); folds come from a hash of the key."""
    found = fit_folds(df, features, target, key, penalties, folds, seed)
    held = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("penalty"),
                reduce(lambda e, k, p=p: F.when(F.col("fold") == k, found.fits[p, k].eta()).otherwise(e), range(folds), F.lit(None).cast("double")).alias("score"),
            )
            for p in penalties
        ]
    )
    scored = found.counts.select("fold", F.col(target).alias("y"), "n", F.explode(held).alias("h")).select("fold", "y", "n", "h.*")
    areas = auc(scored, by=["penalty", "fold"], weight="n")
    return areas.groupBy("penalty").agg(F.avg("auc").alias("mean_auc"))


def feature_importance(fit: LinearFit | VectorFit, spark: SparkSession) -> DataFrame:
    """Long table (feature, importance): impurity shares of a tree model, |weight| of a linear one."""
    if isinstance(fit, LinearFit):
        rows = [(k, abs(float(v))) for k, v in fit.weights.items()]
    else:
        rows = [(k, float(v)) for k, v in zip(fit.features, fit.model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(
    df: DataFrame, fit: LinearFit | VectorFit, target: str, key: str, features: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Loss of accuracy when one feature is replaced by its value on another row, (feature, importance).

    Rows and donors are both numbered by hash, and a row receives the value of the row before it in that order, so donors
    are attached by one join for all features. A linear score is then corrected by the difference of the two values.
    Any other model scores the exchanged copies of a row, which are made in the same task and never shuffled.
    """
    inputs = list(fit.weights if isinstance(fit, LinearFit) else fit.features)
    features = list(features or inputs)
    rows = complete_rows(df.select(key, target, *inputs), [target, *inputs])
    numbered = number_rows(rows, key, out="_no", seed=seed)
    total = rows.count()
    donors = numbered.select(
        F.pmod(F.col("_no") + 1, F.lit(total)).alias("_no"), *[F.col(c).alias(f"_d_{c}") for c in features]
    )
    rows = numbered.join(donors, "_no")
    if isinstance(fit, LinearFit):
        shifted = {c: fit.eta() + (F.col(f"_d_{c}") - F.col(c)) * F.lit(float(fit.weights[c])) for c in features}
        hits = {c: F.avg(flag(flag(e > 0) == F.col(target))) for c, e in {"_base": fit.eta(), **shifted}.items()}
        table = rows.agg(*[e.alias(c) for c, e in hits.items()]).unpivot(["_base"], features, "feature", "_acc")
    else:
        copies = F.array(
            *[
                F.struct(F.lit(k).alias("_k"), *[F.col(f"_d_{c}" if c == new else c).alias(c) for c in inputs])
                for k, new in enumerate([None, *features])
            ]
        )
        scored = fit.transform(rows.select(F.col(target).alias("_y"), F.explode(copies).alias("_c")).select("_y", "_c.*"), "_hat", None)
        accuracy = scored.groupBy("_k").agg(F.avg(flag(F.col("_hat") == F.col("_y"))).alias("_acc"))
        # a row per feature is left
        whole = accuracy.agg(F.max(F.when(F.col("_k") == 0, F.col("_acc"))).alias("_base"), F.collect_list(F.struct("_k", "_acc")).alias("_all"))
        each = whole.select("_base", F.explode("_all").alias("_one")).select("_base", "_one.*").filter(F.col("_k") > 0)
        table = each.withColumn("feature", F.get(F.array(*[F.lit(c) for c in features]), F.col("_k") - 1))
    return table.select("feature", (F.col("_base") - F.col("_acc")).alias("importance"))


# --- leakage audit --------------------------------------------------------------------------------------


def leakage_table(df: DataFrame, prediction: str, sensitive: str) -> DataFrame:
    """Counts of the sensitive attribute by predicted label, and the best guess of it from the label.

    An adversary that sees only the predicted label can learn nothing beyond this table, so its accuracy
    is the share of rows in the majority cells.
    """
    cells = df.groupBy(prediction).agg(
        F.count_if(F.col(sensitive) == 0).alias("n_0"), F.count_if(F.col(sensitive) == 1).alias("n_1")
    )
    return cells.withColumns(
        {
            "best_guess": flag(F.col("n_1") > F.col("n_0")),
            "guess_accuracy": ratio(F.greatest("n_0", "n_1"), F.col("n_0") + F.col("n_1")),
        }
    )


def leakage_audit(
    df: DataFrame, prediction: str, sensitive: str, key: str, hidden: Sequence[int] = (32,), max_iter: int = 50
) -> tuple[VectorFit, DataFrame]:
    """Second network that predicts the sensitive attribute from the predicted label, scored on its test part."""
    marked = with_split(df.select(key, prediction, sensitive), key)
    fit = neural_network(marked.filter(F.col("split") == "train"), [prediction], sensitive, hidden, max_iter)
    return fit, fit.transform(marked.filter(F.col("split") == "test"), "sensitive_pred", None)
