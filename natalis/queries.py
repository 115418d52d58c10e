"""One named query per operator over the test tables; each takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis import oracle
from natalis.functions.columns import flag
from natalis.operators import cohort, correlate, describe, fairness, features, filters, flags, hypothesis, metrics
from natalis.plans import chains
from natalis.plans import clinical as cl
from natalis.sources import fixtures as fx
from natalis.sources.store import fresh_node, read_node, write_node

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, columns: Sequence[str] | None = None) -> DataFrame:
    """Doubles rounded for comparison; adding 0 turns a negative zero into zero."""
    names = columns or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


def _index_cohort(spark: SparkSession, base: str) -> DataFrame:
    return cohort.index_cohort(fx.fact_day(spark, base))


def _summary(spark: SparkSession, base: str) -> DataFrame:
    return chains.summary(fx.fact_day(spark, base), fx.person(spark, base), fx.deaths(spark, base))


def _history(spark: SparkSession, base: str) -> DataFrame:
    return cohort.history_table(_summary(spark, base))


def _cleaned(spark: SparkSession, base: str) -> DataFrame:
    return cohort.clean_patients(fx.patient_summary_wide(spark, base), ("person_id",) + cl.SUMMARY_COLUMNS)


def _groups(spark: SparkSession, base: str) -> DataFrame:
    return features.privilege_flags(_cleaned(spark, base), ("person_id",) + cl.FEATURE_COLUMNS)


# --- inputs and filters -------------------------------------------------------------------------


@query
def fact_day(spark, base):
    return fx.fact_day(spark, base)


@query
def person(spark, base):
    return fx.person(spark, base)


@query
def deaths(spark, base):
    return fx.deaths(spark, base)


@query
def filter_delivery_or_pregnancy(spark, base):
    return filters.any_event(fx.fact_day(spark, base))


@query
def filter_pregnant(spark, base):
    return filters.in_cohort(fx.fact_day(spark, base))


@query
def filter_delivery(spark, base):
    return filters.index_rows(fx.fact_day(spark, base))


@query
def filter_adult_female(spark, base):
    return filters.adult_female(fx.person(spark, base))


@query
def filter_age_band(spark, base):
    return filters.age_band(fx.person(spark, base))


@query
def filter_age_known(spark, base):
    return filters.age_known(fx.patient_summary_wide(spark, base).select("person_id", "age"))


@query
def filter_known_sex(spark, base):
    return filters.known_sex(fx.person(spark, base))


@query
def filter_common_race(spark, base):
    return filters.common_race(fx.person(spark, base))


@query
def filter_visits(spark, base):
    return filters.visits_between(fx.person(spark, base), at_least=2, below=12)


@query
def drop_null_pairs(spark, base):
    pair = ["postpartum_depression_main", "postpartum_csection_main"]
    rows = filters.complete_rows(_history(spark, base).select("person_id", *pair), pair)
    return rows.withColumn("diff", F.col(pair[0]) - F.col(pair[1]))


@query
def cohort_flow(spark, base):
    facts = fx.fact_day(spark, base)
    return filters.flow_report(
        facts,
        {
            "all rows": F.lit(True),
            "delivery or pregnancy": (F.col("delivery_record_only") == 1)
            | (F.col("number_given_birth") == 1)
            | (F.col("pregnancy") == 1),
            "pregnancy": F.col("pregnancy") == 1,
            "delivery": F.col("delivery_record_only") == 1,
        },
    )


@query
def patient_flow(spark, base):
    return filters.flow_report(
        fx.patient_summary_wide(spark, base),
        {
            "age known": F.col("age") >= 1,
            "known sex": F.col("sex").isin("MALE", "FEMALE"),
            "common race": F.col("race").isin(*cl.COMMON_RACES),
        },
    )


# --- index dates and windows ----------------------------------------------------------------------


@query
def index_date(spark, base):
    return cohort.index_dates(filters.in_cohort(filters.any_event(fx.fact_day(spark, base))))


@query
def index_cohort(spark, base):
    return _index_cohort(spark, base)


@query
def window_bounds(spark, base):
    bounded = flags.with_bounds(_index_cohort(spark, base))
    return bounded.select(
        "person_id",
        "first_delivery_date",
        "_1y_prior_1st_delivery",
        "_1y_after_1st_delivery",
        "_280d_prior_1st_delivery",
    ).distinct()


def _labels(spark, base, window):
    labelled = flags.with_labels(_index_cohort(spark, base), oracle.CONDITIONS, [window])
    return labelled.select("person_id", "date", *[flags.label_name(c, window) for c in oracle.CONDITIONS])


@query
def window_label_1y(spark, base):
    return _labels(spark, base, cl.YEAR)


@query
def window_label_280d(spark, base):
    return _labels(spark, base, cl.DAYS_280)


@query
def window_dummies(spark, base):
    labelled = flags.with_labels(_index_cohort(spark, base), oracle.CONDITIONS)
    names = [flags.dummy_name(c, w, lb) for c in oracle.CONDITIONS for w in cl.WINDOWS for lb in w.labels]
    return flags.with_dummies(labelled, oracle.CONDITIONS).select("person_id", "date", *names)


@query
def flag_windows(spark, base):
    merged = _index_cohort(spark, base)
    return flags.flag_windows(merged, flags.column_range(merged.columns, cl.FIRST_CONDITION, cl.LAST_CONDITION))


# --- aggregates and cohort tables -------------------------------------------------------------------


@query
def indicator_rollup(spark, base):
    return cohort.indicator_rollup(
        flags.flag_windows(_index_cohort(spark, base), oracle.CONDITIONS), oracle.CONDITIONS
    )


@query
def indicator_rollup_fused(spark, base):
    return cohort.fused_rollup(fx.fact_day(spark, base), oracle.CONDITIONS)


@query
def optional_aggregates(spark, base):
    return cohort.indicator_rollup(_index_cohort(spark, base), [])


@query
def row_count(spark, base):
    return describe.row_count(filters.in_cohort(filters.any_event(fx.fact_day(spark, base))))


@query
def distinct_persons(spark, base):
    return cohort.distinct_persons(_summary(spark, base))


@query
def distinct_levels(spark, base):
    return describe.distinct_levels(fx.person(spark, base), ["sex", "race", "race_ethnicity"])


@query
def level_counts(spark, base):
    return describe.level_counts(_history(spark, base), "postpartum_depression_main")


@query
def three_statistics(spark, base):
    return rounded(describe.three_statistics(_history(spark, base), "age"))


@query
def describe_by_group(spark, base):
    return rounded(describe.describe_by_group(_summary(spark, base), "race_ethnicity", "age"))


@query
def describe_price(spark, base):
    orders = fx.read_table(spark, base, "orders")
    return rounded(describe.describe_by_group(orders, "o_orderstatus", "o_totalprice"), 3)


@query
def patient_summary(spark, base):
    return _summary(spark, base)


@query
def patient_summary_plain(spark, base):
    rolled = indicator_rollup(spark, base)
    return cohort.enrich(rolled, fx.person(spark, base), fx.deaths(spark, base))


@query
def history_table(spark, base):
    return _history(spark, base)


@query
def history_node(spark, base):
    """The history table written as a node partitioned by race, and read back."""
    path = write_node(_history(spark, base), fresh_node(spark, "history"), ["race"])
    return read_node(spark, path)


@query
def exclude_prior(spark, base):
    return _history(spark, base).select("person_id", *cl.INCIDENT_OUTCOMES)


@query
def depression_by_race(spark, base):
    return rounded(chains.incidence_by(_history(spark, base), "postpartum_depression_main", "race"))


@query
def clean_patients(spark, base):
    cleaned = _cleaned(spark, base).drop("person_id")
    return rounded(cleaned, columns=["BMI_max_observed_or_calculated"])


def _with_any(spark, base) -> tuple[DataFrame, list[str]]:
    combined = {
        **cl.combined_indicators("eclampsia", ("eclampsia", "preeclampsia")),
        **cl.combined_indicators("diabetes", ("diabetes", "diabetes_complicated")),
    }
    return features.combine_indicators(_summary(spark, base), combined), list(combined)


def _with_history(df: DataFrame) -> DataFrame:
    """The summary with its history and first-time-case columns beside the others."""
    return cohort.exclude_prior(df.withColumns({n: F.col(o) for n, o in cl.HISTORY_COLUMNS.items()}), cl.INCIDENT_OUTCOMES)


def _wide_columns(combined: Sequence[str]) -> list[str]:
    extra = ["BMI_max_observed_or_calculated", "total_number_of_COVID_vaccine_doses"]
    return [*cl.HISTORY_COLUMNS, *cl.INCIDENT_OUTCOMES, *combined, *oracle.INDICATORS, *extra]


@query
def any_of(spark, base):
    df, names = _with_any(spark, base)
    return df.select("person_id", *names)


@query
def age_band_cohort(spark, base):
    df, names = _with_any(spark, base)
    return cohort.age_band_cohort(_with_history(df), [*cl.BASE_COLUMNS, *_wide_columns(names)])


@query
def clean_full(spark, base):
    return cohort.clean_before_encoding(_history(spark, base))


# --- encoding, scaling, selection ----------------------------------------------------------------------


@query
def recode_race(spark, base):
    return features.recode(_history(spark, base).select("person_id", "race"))


@query
def one_hot_sex_race(spark, base):
    return features.encode_demographics(_history(spark, base))


@query
def one_hot_race(spark, base):
    return features.encode_demographics(_history(spark, base), encode=["race"])


@query
def sex_female_flag(spark, base):
    return features.encode_demographics(features.sex_as_flag(_history(spark, base)), encode=["race"])


@query
def one_hot_extended(spark, base):
    df, names = _with_any(spark, base)
    return features.encode_demographics(_with_history(df), [*cl.BASE_COLUMNS, *_wide_columns(names)])


@query
def privilege_flags(spark, base):
    return _groups(spark, base).drop("person_id")


@query
def zscore_sample(spark, base):
    return rounded(features.zscore(_history(spark, base).select("person_id", "age")))


@query
def zscore_replace(spark, base):
    return rounded(features.zscore(_history(spark, base).select("person_id", "age"), replace=True))


@query
def zscore_population(spark, base):
    scaled = features.zscore(_history(spark, base).select("person_id", "age"), ddof=0)
    return rounded(scaled.drop("age"))


@query
def scaled_vector(spark, base):
    vectors = features.scaled_vector(_history(spark, base))
    return rounded(features.vector_element(vectors, "features_selected", "scaled_age").select("scaled_age"))


@query
def feature_variances(spark, base):
    columns = list(cl.COMORBIDITIES) + ["sex_privilege", "race_privilege"]
    return rounded(features.variances(_groups(spark, base), columns))


@query
def quasi_constant(spark, base):
    """Names of the indicator columns that survive the quasi-constant filter."""
    rolled = cohort.fused_rollup(fx.fact_day(spark, base), oracle.CONDITIONS)
    return _names(features.drop_quasi_constant(rolled, oracle.INDICATORS), oracle.INDICATORS)


def _names(df: DataFrame, of: Sequence[str]) -> DataFrame:
    """The columns of ``df`` among those named, as rows."""
    return df.sparkSession.createDataFrame([(c,) for c in of if c in df.columns], "feature string")


@query
def zero_variance(spark, base):
    """Names of the indicator columns that are not constant."""
    rolled = cohort.fused_rollup(fx.fact_day(spark, base), oracle.CONDITIONS)
    return _names(features.drop_quasi_constant(rolled, oracle.INDICATORS, threshold=0.0), oracle.INDICATORS)


@query
def corr_long(spark, base):
    return rounded(correlate.correlations(_summary(spark, base), oracle.CORR_COLUMNS))


@query
def corr_rounded(spark, base):
    return correlate.correlations(_summary(spark, base), oracle.CORR_COLUMNS, digits=2)


@query
def corr_drop(spark, base):
    return correlate.correlated_columns(correlate.correlations(_summary(spark, base), oracle.CORR_COLUMNS))


@query
def age_bin(spark, base):
    people = fx.person(spark, base).select("person_id", "age")
    return features.age_bins(people, [18, 25, 30, 35, 45])


# --- tests ----------------------------------------------------------------------------------------------


@query
def t_one_sample(spark, base):
    return rounded(hypothesis.t_one_sample(_history(spark, base), "age", 35))


def _paired(spark, base, before):
    return rounded(hypothesis.t_paired(_history(spark, base), "postpartum_depression", before))


@query
def t_paired_1y(spark, base):
    return _paired(spark, base, "depression_hist_1y_prior")


@query
def t_paired_280d(spark, base):
    return _paired(spark, base, "depression_hist_280d_prior")


@query
def t_welch(spark, base):
    result = hypothesis.t_welch(
        _summary(spark, base), "race_ethnicity", "age", "White Non-Hispanic", "Hispanic or Latino Any Race"
    )
    return rounded(result)


@query
def chisq_equal(spark, base):
    return rounded(hypothesis.chi_square_fit(_history(spark, base), "postpartum_depression"))


@query
def chisq_given(spark, base):
    races = ("White", "Asian", "Black or African American", "Hispanic or Latino", "Unknown")
    return rounded(hypothesis.chi_square_fit(_history(spark, base), "race", {r: 0.2 for r in races}))


@query
def rank_sum(spark, base):
    return rounded(hypothesis.rank_sum(_history(spark, base), "age", "postpartum_depression"))


@query
def rank_sum_price(spark, base):
    orders = fx.read_table(spark, base, "orders").select("o_totalprice", flag(F.col("o_orderstatus") == "F").alias("g"))
    return rounded(hypothesis.rank_sum(orders, "o_totalprice", "g").select("n0", "n1", "w"))


def _exposure_table(spark, base) -> DataFrame:
    """Per outcome the log odds ratio of the exposure with its standard error, from the 2 x 2 counts."""
    table = chains.model_table(_summary(spark, base))
    e, y = F.col(cl.EXPOSURE), F.col("y")
    entries = F.array(*[F.struct(F.lit(k).alias("dv"), F.col(v).alias("y")) for k, v in cl.OUTCOMES.items()])
    cells = table.select(cl.EXPOSURE, F.explode(entries).alias("o")).select(cl.EXPOSURE, "o.*").groupBy("dv").agg(
        *[
            (F.count_if((e == i) & (y == j)) + 0.5).alias(name)
            for name, i, j in (("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0))
        ]
    )
    a, b, c, d = (F.col(k) for k in "abcd")
    return cells.select(
        F.col("dv").alias("term"),
        F.log((a * d) / (b * c)).alias("estimate"),
        F.sqrt(1 / a + 1 / b + 1 / c + 1 / d).alias("std_error"),
    )


@query
def effect_size(spark, base):
    table = _exposure_table(spark, base).select(F.col("term").alias("dv"), F.lit("Model 1").alias("model"), "estimate")
    return rounded(hypothesis.add_effect_size(table))


@query
def wald_table(spark, base):
    return rounded(hypothesis.wald_table(_exposure_table(spark, base)))


@query
def age_report(spark, base):
    """Age by ethnicity and the comparison of its two largest levels, as one table."""
    levels, described, test = hypothesis.age_report(
        _summary(spark, base), "White Non-Hispanic", "Hispanic or Latino Any Race"
    )
    none = F.lit(None).cast("double")
    rows = described.join(levels, F.col("race_ethnicity").eqNullSafe(F.col("level"))).select(
        F.lit("level").alias("section"),
        F.col("race_ethnicity").alias("label"),
        F.col("count").alias("n"),
        "mean",
        F.col("std").alias("sd"),
        none.alias("t"),
        none.alias("df"),
        none.alias("p_value"),
    )
    gap = test.select(
        F.lit("test"), F.lit("difference"), F.col("n1") + F.col("n2"), F.col("mean1") - F.col("mean2"), none, "t", "df", "p_value"
    )
    return rounded(rows.union(gap))


def _loglik(hit, total):
    """Bernoulli log-likelihood of a cell at its own rate."""
    miss = total - hit
    part = lambda n: F.when(n > 0, n * F.log(n / total)).otherwise(0.0)
    return part(hit) + part(miss)


@query
def likelihood_ratio(spark, base):
    """Outcome without and with the exposure; both logistic models have closed-form likelihoods."""
    table = chains.model_table(_summary(spark, base))
    y, e = F.col("y"), F.col(cl.EXPOSURE)
    entries = F.array(*[F.struct(F.lit(k).alias("dv_label"), F.col(v).alias("y")) for k, v in cl.OUTCOMES.items()])
    long = table.select(cl.EXPOSURE, F.explode(entries).alias("o")).select(cl.EXPOSURE, "o.*")
    cells = long.groupBy("dv_label").agg(
        *[F.count_if(e == k).cast("double").alias(f"n{k}") for k in (0, 1)],
        *[F.count_if((e == k) & (y == 1)).cast("double").alias(f"y{k}") for k in (0, 1)],
    )
    n0, n1, y0, y1 = (F.col(c) for c in ("n0", "n1", "y0", "y1"))
    fits = cells.select(
        "dv_label",
        _loglik(y0 + y1, n0 + n1).alias("loglik_reduced"),
        (_loglik(y0, n0) + _loglik(y1, n1)).alias("loglik_full"),
        F.lit(1).alias("df_diff"),
    )
    return rounded(hypothesis.likelihood_ratio(fits))


# --- metrics and fairness on a fixed score ------------------------------------------------------------


@query
def confusion(spark, base):
    return metrics.confusion_matrix(fx.scored_documents(spark, base))


@query
def class_report(spark, base):
    return rounded(metrics.classification_report(fx.scored_documents(spark, base)))


@query
def macro_scores(spark, base):
    return rounded(metrics.macro_scores(fx.scored_documents(spark, base)))


@query
def roc_points(spark, base):
    return rounded(metrics.roc_points(fx.scored_documents(spark, base)), columns=["fpr", "tpr"])


@query
def auc(spark, base):
    return rounded(metrics.auc(fx.scored_documents(spark, base)))


@query
def auc_by_group(spark, base):
    return rounded(metrics.auc(fx.scored_documents(spark, base), by=["race_privilege"]))


@query
def split_sizes(spark, base):
    split = F.when(F.col("person_id") % 5 == 0, "test").otherwise("train")
    return metrics.split_sizes(_groups(spark, base).select(split.alias("split")))


@query
def group_rates(spark, base):
    return rounded(fairness.group_rates(fx.scored_documents(spark, base), "source"))


@query
def race_ratio(spark, base):
    return rounded(fairness.privilege_ratio(fx.scored_documents(spark, base), "race_privilege"))


@query
def sex_ratio(spark, base):
    return rounded(fairness.privilege_ratio(fx.scored_documents(spark, base), "sex_privilege"))


@query
def intersection_rates(spark, base):
    return rounded(fairness.intersection_rates(fx.scored_documents(spark, base)))


@query
def fairness_overview(spark, base):
    return rounded(fairness.fairness_overview(fx.scored_documents(spark, base)))


@query
def dp_difference(spark, base):
    return rounded(fairness.demographic_parity_difference(fx.scored_documents(spark, base), "race_privilege"))


@query
def eo_difference(spark, base):
    return rounded(fairness.equalized_odds_difference(fx.scored_documents(spark, base), "race_privilege"))
