"""Named queries that fit models, match units or resample; registered next to the others."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis import oracle
from natalis.functions.columns import hash_uniform
from natalis.operators import balance, boosting, fairness, features, filters, hypothesis, imbalance, matching, metrics, mitigate, mixed, models
from natalis.plans import chains
from natalis.plans import clinical as cl
from natalis.queries import _groups, _summary, query, rounded
from natalis.sources import fixtures as fx
from natalis.sources.store import cut_lineage

LUNG_FEATURES = ["age", *[c for c in cl.COMORBIDITIES if c != cl.LUNG], cl.MORTALITY, "sex_privilege", "race_privilege"]
MORTALITY_FEATURES = ["age", *cl.COMORBIDITIES, "sex_privilege", "race_privilege"]


def _model_table(spark, base) -> DataFrame:
    return cut_lineage(chains.model_table(_summary(spark, base)))


def _moments(train: DataFrame, fit: models.LinearFit, penalty: float) -> DataFrame:
    """Fitted side of the score equations: sum of p·x plus the penalty's pull, per term.

    At the maximum it equals the observed sum of y·x, which fixes the coefficients uniquely.
    """
    p = fit.probability()
    sums = [F.sum(p).alias("(Intercept)")]
    sums += [(F.sum(p * F.col(f)) + F.lit(penalty * w)).alias(f) for f, w in fit.weights.items()]
    row = train.agg(*sums)
    return rounded(row.unpivot([], ["(Intercept)", *fit.weights], "term", "moment"), 1)


@query
def hash_split(spark, base):
    return metrics.split_sizes(models.with_split(_groups(spark, base), "person_id"))


@query
def lr_lung(spark, base):
    train = _groups(spark, base)
    fit = models.ridge_logistic(models.patterns(train, [*LUNG_FEATURES, cl.LUNG]), LUNG_FEATURES, cl.LUNG, weight="n")
    return _moments(train, fit, 1.0)


@query
def lr_mortality(spark, base):
    train = _groups(spark, base)
    counts = models.patterns(train, [*MORTALITY_FEATURES, cl.MORTALITY])
    fit = models.ridge_logistic(counts, MORTALITY_FEATURES, cl.MORTALITY, weight="n")
    return _moments(train, fit, 1.0)


@query
def propensity(spark, base):
    table = chains.model_table(_summary(spark, base))
    fit, _ = models.propensity_scores(table, cl.EXPOSURE, cl.MATCH_COVARIATES)
    return _moments(table, fit, 0.0)


def _scored_patients(spark, base) -> tuple[DataFrame, list[str]]:
    """The scaled and selected matrix with split, score and prediction of the lung model."""
    keep = ["person_id", cl.LUNG, "sex_privilege", "race_privilege"]
    matrix = cut_lineage(features.scale_and_select(_groups(spark, base), protect=keep))
    names = [c for c in matrix.columns if c not in ("person_id", cl.LUNG)]
    _, scored = models.fit_and_score(matrix, names, cl.LUNG, "person_id", prediction="y_pred")
    return scored.withColumn("y", F.col(cl.LUNG)), names


@query
def lr_lung_predictions(spark, base):
    scored, _ = _scored_patients(spark, base)
    return rounded(scored.select("person_id", "split", "y", "y_pred", "score"))


@query
def lr_lung_report(spark, base):
    scored, _ = _scored_patients(spark, base)
    return rounded(metrics.classification_report(scored.filter(F.col("split") == "test")))


@query
def lr_lung_fairness(spark, base):
    scored, _ = _scored_patients(spark, base)
    return rounded(fairness.fairness_overview(scored))


@query
def lr_mortality_report(spark, base):
    groups = _groups(spark, base)
    _, scored = models.fit_and_score(groups, MORTALITY_FEATURES, cl.MORTALITY, "person_id", prediction="y_pred")
    test = scored.filter(F.col("split") == "test").withColumn("y", F.col(cl.MORTALITY))
    both = metrics.macro_scores(test).withColumn("_one", F.lit(1)).join(metrics.auc(test).withColumn("_one", F.lit(1)), "_one")
    return rounded(both.drop("_one"))


@query
def lr_mortality_roc(spark, base):
    """ROC points of the mortality model on the test rows."""
    groups = _groups(spark, base)
    _, scored = models.fit_and_score(groups, MORTALITY_FEATURES, cl.MORTALITY, "person_id", prediction="y_pred")
    return rounded(metrics.roc_points(scored.filter(F.col("split") == "test").withColumn("y", F.col(cl.MORTALITY))))


def _network(spark, base, hidden) -> DataFrame:
    groups = models.with_split(_groups(spark, base), "person_id")
    names = [c for c in LUNG_FEATURES if c != "race_privilege"]
    scaled = cut_lineage(features.zscore(groups, ["age"], ddof=0, replace=True))
    fit = models.neural_network(scaled.filter(F.col("split") == "train"), names, cl.LUNG, hidden)
    return fit.transform(scaled).withColumn("y", F.col(cl.LUNG))


@query
def mlp(spark, base):
    scored = _network(spark, base, (32,))
    return rounded(metrics.classification_report(scored.filter(F.col("split") == "test")))


@query
def deep_network(spark, base):
    scored = _network(spark, base, (32, 16))
    return rounded(metrics.macro_scores(scored.filter(F.col("split") == "test")))


@query
def leakage_audit(spark, base):
    scored = _network(spark, base, (32,))
    _, audited = models.leakage_audit(scored, "y_pred", "race_privilege", "person_id")
    return metrics.confusion_matrix(audited, "race_privilege", "sensitive_pred")


@query
def leakage_table(spark, base):
    return rounded(models.leakage_table(fx.scored_documents(spark, base), "y_pred", "race_privilege"))


def _trees(spark, base, fit_fn) -> DataFrame:
    groups = models.with_split(_groups(spark, base), "person_id")
    fit = fit_fn(groups.filter(F.col("split") == "train"), LUNG_FEATURES, cl.LUNG)
    test = fit.transform(groups.filter(F.col("split") == "test")).withColumn("y", F.col(cl.LUNG))
    return rounded(metrics.macro_scores(test))


@query
def random_forest(spark, base):
    return _trees(spark, base, models.random_forest)


@query
def gradient_boosting(spark, base):
    return _trees(spark, base, models.gradient_boosting)


@query
def boosted_first_gains(spark, base):
    """Second-order gain of every stated cut of the first tree's root."""
    edges = oracle.stated_edges(LUNG_FEATURES)
    return rounded(boosting.first_gains(_groups(spark, base), LUNG_FEATURES, cl.LUNG, edges), 5)


@query
def boosted_trees(spark, base):
    """Nodes of three second-order trees over the stated cuts."""
    edges = oracle.stated_edges(LUNG_FEATURES)
    fit = boosting.fit_boosted(_groups(spark, base), LUNG_FEATURES, cl.LUNG, rounds=3, depth=2, edges=edges)
    return rounded(fit.table(spark).drop("missing_first"), 5)


@query
def boosted_report(spark, base):
    """Macro scores of second-order boosting on the test rows, cuts at equal shares of the training rows."""
    groups = cut_lineage(models.with_split(_groups(spark, base), "person_id"))
    fit = boosting.fit_boosted(groups.filter(F.col("split") == "train"), LUNG_FEATURES, cl.LUNG, rounds=10, depth=3)
    test = fit.transform(groups.filter(F.col("split") == "test")).withColumn("y", F.col(cl.LUNG))
    return rounded(metrics.macro_scores(test))


@query
def linear_svm(spark, base):
    return _trees(spark, base, models.linear_svm)


@query
def cross_validation(spark, base):
    groups = cut_lineage(_groups(spark, base))
    return rounded(models.cross_validate(groups, LUNG_FEATURES, cl.LUNG, "person_id"), 4)


@query
def cross_validation_moments(spark, base):
    """Score equations of the fit of each penalty and fold, on the rows of the other folds."""
    found = models.fit_folds(_groups(spark, base), LUNG_FEATURES, cl.LUNG, "person_id", oracle.CHECKED_PENALTIES)
    return models.fold_moments(found, cl.LUNG).withColumn("moment", F.round("moment", 1) + 0.0)


@query
def tree_importance(spark, base):
    fit = models.random_forest(_groups(spark, base), LUNG_FEATURES, cl.LUNG)
    return rounded(models.feature_importance(fit, spark))


@query
def permutation_importance(spark, base):
    groups = cut_lineage(_groups(spark, base))
    counts = models.patterns(groups, [*LUNG_FEATURES, cl.LUNG])
    fit = models.ridge_logistic(counts, LUNG_FEATURES, cl.LUNG, weight="n")
    return rounded(models.permutation_importance(groups, fit, cl.LUNG, "person_id"))


@query
def permutation_stated(spark, base):
    """Permutation importance of a score with stated weights."""
    fit = models.LinearFit(oracle.STATED_INTERCEPT, oracle.stated_weights(LUNG_FEATURES))
    return rounded(models.permutation_importance(_groups(spark, base), fit, cl.LUNG, "person_id"))


@query
def permutation_forest(spark, base):
    """Permutation importance of a random forest: fitted on the training rows, measured on the test rows."""
    groups = models.with_split(_groups(spark, base), "person_id")
    fit = models.random_forest(groups.filter(F.col("split") == "train"), LUNG_FEATURES, cl.LUNG)
    return rounded(models.permutation_importance(groups.filter(F.col("split") == "test"), fit, cl.LUNG, "person_id"))


# --- imbalance and bias ------------------------------------------------------------------------------


def _made(df: DataFrame) -> DataFrame:
    """The synthetic rows only."""
    return rounded(df.filter("synthetic").drop("synthetic"))


@query
def smote(spark, base):
    return _made(imbalance.smote(_groups(spark, base), LUNG_FEATURES, cl.LUNG))


@query
def smote_by_group(spark, base):
    names = [c for c in LUNG_FEATURES if c != "race_privilege"]
    return _made(imbalance.smote(_groups(spark, base), names, cl.LUNG, group="race_privilege"))


@query
def smote_embeddings(spark, base):
    """New points that bring the embedding vectors of every class to the size of the largest class."""
    vectors = fx.read_table(spark, base, "embeddings")
    wide = vectors.selectExpr("label", *[f"embedding[{i}] AS {n}" for i, n in enumerate(oracle.EMBEDDING_NAMES)])
    return _made(imbalance.smote(wide, oracle.EMBEDDING_NAMES, "label"))


def _oversampled(spark, base) -> DataFrame:
    """All rows with split and the prediction of the lung model trained on the over-sampled train part."""
    marked = cut_lineage(models.with_split(_groups(spark, base), "person_id"))
    made = imbalance.smote(marked.filter(F.col("split") == "train"), LUNG_FEATURES, cl.LUNG)
    fit = models.ridge_logistic(models.patterns(made, [*LUNG_FEATURES, cl.LUNG]), LUNG_FEATURES, cl.LUNG, weight="n")
    return fit.transform(marked).withColumn("y", F.col(cl.LUNG))


@query
def smote_predictions(spark, base):
    return rounded(_oversampled(spark, base).select("person_id", "split", "y", "y_pred", "score"))


@query
def smote_report(spark, base):
    return rounded(metrics.classification_report(_oversampled(spark, base).filter(F.col("split") == "test")), 4)


def _reweighted(spark, base) -> tuple[mitigate.ReweightedFit, DataFrame]:
    marked = cut_lineage(models.with_split(_groups(spark, base), "person_id"))
    train = marked.filter(F.col("split") == "train")
    return mitigate.reweighted_logistic(train, LUNG_FEATURES, cl.LUNG, ["sex_privilege", "race_privilege"]), marked


@query
def reweight_grid(spark, base):
    return rounded(_reweighted(spark, base)[0].table)


@query
def reweight_predictions(spark, base):
    """Predictions of the chosen fit for all rows."""
    fit, marked = _reweighted(spark, base)
    return fit.best.transform(marked, probability=None).select("person_id", "split", F.col(cl.LUNG).alias("y"), "y_pred")


@query
def reweight_report(spark, base):
    """Test report of the chosen fit."""
    fit, marked = _reweighted(spark, base)
    test = fit.best.transform(marked.filter(F.col("split") == "test")).withColumn("y", F.col(cl.LUNG))
    return rounded(metrics.classification_report(test))


def _equalized(spark, base) -> tuple[mitigate.OddsRule, DataFrame]:
    scored = cut_lineage(_scored_patients(spark, base)[0])
    rule = mitigate.equalized_odds_rule(scored.filter(F.col("split") == "train"), "y", "score", "race_privilege")
    return rule, rule.apply(scored, "score", "person_id")


@query
def equalized_odds(spark, base):
    done = _equalized(spark, base)[1]
    return rounded(fairness.before_after(done.filter(F.col("split") == "test"), "race_privilege"))


@query
def equalized_odds_rule(spark, base):
    """Thresholds and chances per group."""
    return rounded(_equalized(spark, base)[0].table(spark))


@query
def equalized_odds_predictions(spark, base):
    """Predictions before and after the rule for all rows."""
    return _equalized(spark, base)[1].select("person_id", "split", "y", "y_pred", "y_pred_post")


@query
def before_after(spark, base):
    docs = fx.scored_documents(spark, base).withColumn("y_pred_post", (F.col("score") >= 0.6).cast("int"))
    return rounded(fairness.before_after(docs, "race_privilege"))


# --- matching and weighting ----------------------------------------------------------------------------


def _points() -> Column:
    """Whole-number risk points: a fixed score with many ties, so that equal distances do occur."""
    return F.expr(oracle.RISK_POINTS)


@query
def match_allocation(spark, base):
    """Pairs per treated and control score for a fixed score."""
    table = chains.model_table(_summary(spark, base)).withColumn("distance", _points())
    pairs = matching.match_pairs(table, "person_id", cl.EXPOSURE)
    return pairs.groupBy("treated_score", "control_score").agg(F.count("*").alias("n_pairs"))


@query
def match_pairs_stated(spark, base):
    """Pairs of persons by a fixed continuous score: risk points and a fraction from the person's digest."""
    table = chains.model_table(_summary(spark, base))
    table = table.withColumn("distance", _points() + hash_uniform(F.col("person_id")))
    return rounded(matching.match_pairs(table, "person_id", cl.EXPOSURE))


def _matched(spark, base) -> tuple[DataFrame, DataFrame]:
    table = _model_table(spark, base)
    _, scored = models.propensity_scores(table, cl.EXPOSURE, cl.MATCH_COVARIATES)
    scored = cut_lineage(scored)
    pairs = matching.match_pairs(scored, "person_id", cl.EXPOSURE)
    return scored, cut_lineage(matching.matched_data(scored, pairs, "person_id"))


@query
def ps_match(spark, base):
    return rounded(_matched(spark, base)[1].select("person_id", cl.EXPOSURE, "distance", "weights", "subclass"))


@query
def match_sizes(spark, base):
    """All treated units find a partner, as there are more controls."""
    before, after = _matched(spark, base)
    return balance.sample_sizes(before, after, cl.EXPOSURE)


@query
def match_summary(spark, base):
    before, after = _matched(spark, base)
    return rounded(balance.match_summary(before, after, cl.EXPOSURE, ["distance", *cl.MATCH_COVARIATES]))


@query
def ecdf_distances(spark, base):
    table = chains.model_table(_summary(spark, base))
    return rounded(balance.ecdf_distances(table, cl.EXPOSURE, cl.MATCH_COVARIATES))


def _stratum_scores(spark, base) -> DataFrame:
    """Exposure share of the person's race and obesity stratum as the score."""
    table = chains.model_table(_summary(spark, base))
    strata = ["race_White", "OBESITY_1y_during_1y_prior_to_1st_delivery_indicator"]
    shares = table.groupBy(*strata).agg(F.avg(cl.EXPOSURE).alias("distance"))
    return matching.with_ipw(table.join(shares, strata), cl.EXPOSURE)


@query
def balance_table(spark, base):
    weighted = _stratum_scores(spark, base)
    return rounded(balance.balance_table(weighted, weighted, cl.EXPOSURE, cl.MATCH_COVARIATES, weight="weights"))


@query
def ipw_rates(spark, base):
    outcomes = list(cl.OUTCOMES.values())
    return rounded(matching.weighted_rates(_stratum_scores(spark, base), cl.EXPOSURE, outcomes))


# --- mixed models ------------------------------------------------------------------------------------------


def _mixed_tables(spark, base, terms, outcomes: Mapping[str, str] = cl.OUTCOMES) -> DataFrame:
    table = _model_table(spark, base)
    fits = mixed.fit_models([mixed.Model(table, outcome, terms) for outcome in outcomes.values()])
    out = None
    for label, fit in zip(outcomes, fits):
        rows = fit.table(spark).select(
            F.lit(label).alias("dv_label"),
            "*",
            F.lit(fit.sigma).alias("sigma"),
            F.lit(fit.loglik).alias("loglik"),
            F.lit(fit.converged).alias("converged"),
        )
        out = rows if out is None else out.unionByName(rows)
    return rounded(out, 4)


@query
def glmm_reduced(spark, base):
    return _mixed_tables(spark, base, cl.REDUCED_TERMS)


@query
def glmm_full(spark, base):
    return _mixed_tables(spark, base, cl.FULL_TERMS)


@query
def glmm_interaction(spark, base):
    return _mixed_tables(spark, base, (f"{cl.EXPOSURE}*age", "race_White"))


@query
def glmm_interaction_full(spark, base):
    return _mixed_tables(spark, base, (f"{cl.EXPOSURE}*age", "race_White", *cl.ADJUSTING_TERMS))


def _both_models(table: DataFrame) -> list[tuple[str, str, mixed.Model]]:
    return [
        (label, name, mixed.Model(table, outcome, terms))
        for label, outcome in cl.OUTCOMES.items()
        for name, terms in (("Model 1", cl.REDUCED_TERMS), ("Model 2", cl.FULL_TERMS))
    ]


@query
def glmm_moments(spark, base):
    """Score equations of the reduced (1) and the full (2) fit of each outcome."""
    kinds = _both_models(_model_table(spark, base))
    wanted = [m for _, _, m in kinds]
    moments = mixed.score_moments(wanted, mixed.fit_models(wanted))
    rows = [(label, name, t, v) for (label, name, _), m in zip(kinds, moments) for t, v in m.items()]
    return rounded(spark.createDataFrame(rows, "dv_label string, model string, term string, moment double"), 1)


@query
def effect_size_fitted(spark, base):
    """Effect sizes of the exposure from the reduced (1) and the full (2) mixed fit of each outcome."""
    kinds = _both_models(_model_table(spark, base))
    fits = mixed.fit_models([m for _, _, m in kinds])
    rows = [(label, name, float(f.beta[f.terms.index(cl.EXPOSURE)])) for (label, name, _), f in zip(kinds, fits)]
    return rounded(hypothesis.add_effect_size(spark.createDataFrame(rows, "dv string, model string, estimate double")), 4)


@query
def glmm_likelihood(spark, base):
    """Laplace log-likelihood of the reduced and the full model of each outcome at stated parameters."""
    table = _model_table(spark, base)
    kinds = [
        (label, model, mixed.Model(table, outcome, terms))
        for label, outcome in cl.OUTCOMES.items()
        for model, terms in (("reduced", cl.REDUCED_TERMS), ("full", cl.FULL_TERMS))
    ]
    points = [(oracle.stated_beta(m.terms), oracle.STATED_SIGMA) for _, _, m in kinds]
    values = mixed.log_likelihoods([m for _, _, m in kinds], points)
    rows = [(label, model, value) for (label, model, _), value in zip(kinds, values)]
    return rounded(spark.createDataFrame(rows, "dv_label string, model string, loglik double"), 4)


@query
def stated_curve(spark, base):
    """Prediction curve of the interaction model at stated coefficients."""
    table = _model_table(spark, base)
    terms = (cl.EXPOSURE, "age", "race_White", f"{cl.EXPOSURE}:age")
    spread = [0.01 * (i + 1) / (900 if t == "age" or ":" in t else 1) for i, t in enumerate(("", *terms))]
    white = table.agg(F.avg("race_White")).first()[0]
    fit = mixed.MixedFit(
        terms=(mixed.INTERCEPT, *terms),
        beta=np.array(oracle.stated_beta(terms)),
        vcov=np.diag(spread),
        sigma=oracle.STATED_SIGMA,
        loglik=0.0,
        n_rows=0,
        n_groups=0,
        passes=0,
        converged=True,
        means={"race_White": white},
    )
    return rounded(mixed.predicted_curve(table, fit, "age", cl.EXPOSURE))


@query
def predicted_curve(spark, base):
    """Curves of the three outcomes over age, for persons with two to eleven visits."""
    table = cut_lineage(filters.visits_between(_model_table(spark, base), 2, 12))
    terms = (f"{cl.EXPOSURE}*age", "race_White", *cl.ADJUSTING_TERMS)
    fits = mixed.fit_models([mixed.Model(table, outcome, terms) for outcome in cl.OUTCOMES.values()])
    out = None
    for label, fit in zip(cl.OUTCOMES, fits):
        curve = mixed.predicted_curve(table, fit, "age", cl.EXPOSURE).withColumn("dv_label", F.lit(label))
        out = curve if out is None else out.unionByName(curve)
    return rounded(out, 4)


@query
def nested_lrt(spark, base):
    table = mixed.compare_nested(_model_table(spark, base), cl.OUTCOMES, cl.REDUCED_TERMS, cl.FULL_TERMS)
    return rounded(table, 4)


@query
def nested_lrt_matched(spark, base):
    _, matched = _matched(spark, base)
    return rounded(mixed.compare_nested(matched, cl.OUTCOMES, cl.REDUCED_TERMS, cl.FULL_TERMS), 4)
