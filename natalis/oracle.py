"""SQL texts that a second engine can run on the same tables to check the queries.

They state each result the plain way (joins, label by label, row-level CASE), not the way the operators
compute it. Doubles are rounded to six decimals on both sides.
"""

from __future__ import annotations

from natalis.plans import clinical as cl
from natalis.sources import fixtures as fx

CONDITIONS = tuple(
    list(fx.FACT_DAY)[
        list(fx.FACT_DAY).index(cl.FIRST_CONDITION) : list(fx.FACT_DAY).index(cl.LAST_CONDITION) + 1
    ]
)


def r6(text: str, digits: int = 6) -> str:
    return f"round(CAST({text} AS DOUBLE), {digits}) + 0.0"


def _view(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {source}"


_VISITS = "customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) v ON v.o_custkey = c_custkey"
_WIDE = (
    "customer LEFT JOIN (SELECT o_custkey, max(o_totalprice / 12500.0) AS bmi, "
    + ", ".join(f"max({fx.wide_indicator(k)}) AS {name}" for k, name in enumerate(cl.COMORBIDITIES))
    + " FROM orders GROUP BY o_custkey) v ON v.o_custkey = c_custkey"
)

_BOUNDS = (
    "CAST(first_delivery_date - INTERVAL 12 MONTH AS DATE) AS _1y_prior_1st_delivery, "
    "CAST(first_delivery_date + INTERVAL 12 MONTH AS DATE) AS _1y_after_1st_delivery, "
    "CAST(first_delivery_date - INTERVAL 280 DAY AS DATE) AS _280d_prior_1st_delivery"
)


def _tests(tag: str) -> dict[str, str]:
    low = {"1y": "_1y_prior_1st_delivery", "280d": "_280d_prior_1st_delivery"}[tag]
    end = {"1y": "<=", "280d": "<"}[tag]
    return {
        f"before_{tag}_prior_to_1st_delivery": f"date < {low}",
        f"during_{tag}_prior_to_1st_delivery": f"date >= {low} AND date < first_delivery_date",
        "during_1y_postpartum": f"date >= first_delivery_date AND date {end} _1y_after_1st_delivery",
    }


def label_case(condition: str, tag: str) -> str:
    whens = " ".join(f"WHEN {condition} = 1 AND {test} THEN '{label}'" for label, test in _tests(tag).items())
    return f"CASE WHEN {condition} = 0 THEN 'no' {whens} ELSE 'undefined' END"


def _indicators() -> list[str]:
    return [
        f"max(CASE WHEN {c} = 1 AND {test} THEN 1 ELSE 0 END) AS {c}_{tag}_{label}_indicator"
        for c in CONDITIONS
        for tag in ("1y", "280d")
        for label, test in _tests(tag).items()
    ]


INDICATORS = tuple(text.rsplit(" AS ", 1)[1] for text in _indicators())

_STEPS = {
    "fact_day": _view(fx.FACT_DAY, "orders"),
    "person": _view({**fx.PERSON, "total_visits": "COALESCE(n_orders, 0)"}, _VISITS),
    "deaths": _view(fx.DEATHS, "customer"),
    "scored": _view(fx.SCORED, "labels JOIN documents USING (doc_id)"),
    "wide": _view(
        {
            **fx.WIDE_PERSON,
            "BMI_max_observed_or_calculated": "bmi",
            **{name: f"COALESCE({name}, 0)" for name in cl.COMORBIDITIES},
        },
        _WIDE,
    ),
    "days": "SELECT * FROM fact_day WHERE (delivery_record_only = 1 OR number_given_birth = 1 OR pregnancy = 1) "
    "AND pregnancy = 1",
    "idx": "SELECT person_id, min(date) AS first_delivery_date FROM days WHERE delivery_record_only = 1 "
    "GROUP BY person_id",
    "merged": "SELECT days.*, first_delivery_date FROM idx LEFT JOIN days USING (person_id)",
    "bounded": f"SELECT *, {_BOUNDS} FROM merged",
    "rolled": f"SELECT person_id, {', '.join(_indicators())}, "
    "max(BMI_rounded) AS BMI_max_observed_or_calculated, "
    "CAST(sum(had_vaccine_administered) AS BIGINT) AS total_number_of_COVID_vaccine_doses "
    "FROM bounded GROUP BY person_id",
    "summary": "SELECT person.*, rolled.* EXCLUDE (person_id), patient_death AS patient_death_indicator "
    "FROM rolled LEFT JOIN deaths USING (person_id) JOIN person USING (person_id) "
    "WHERE age >= 18 AND sex = 'FEMALE'",
    "history0": f"SELECT {', '.join(cl.BASE_COLUMNS)}, "
    + ", ".join(f"{old} AS {new}" for new, old in cl.HISTORY_COLUMNS.items())
    + " FROM summary",
    "history": "SELECT *, "
    + ", ".join(
        f"CASE WHEN {prior} = 1 THEN NULL ELSE {outcome} END AS {new}"
        for new, (outcome, prior) in cl.INCIDENT_OUTCOMES.items()
    )
    + " FROM history0",
    "recoded": "SELECT * REPLACE (CASE race "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in cl.RACE_RECODE.items())
    + " ELSE race END AS race) FROM history",
    "modelled": "SELECT summary.*, "
    + f"{cl.HISTORY_COLUMNS['postpartum_depression']} AS postpartum_depression, "
    + f"{cl.HISTORY_COLUMNS['postpartum_csection']} AS postpartum_csection, "
    + "CAST(race = 'White' AS INT) AS race_White, "
    + ", ".join(f"greatest({', '.join(parts)}) AS {new}" for new, parts in cl.COMBINED.items())
    + " FROM summary",
    "cleaned": f"SELECT person_id, {', '.join(cl.SUMMARY_COLUMNS)} FROM wide WHERE age >= 1 "
    "AND sex IN ('MALE', 'FEMALE') AND race IN ('White', 'Asian', 'Black or African American', 'Unknown')",
    "flagged_groups": f"SELECT person_id, age, {', '.join(cl.COMORBIDITIES)}, {cl.MORTALITY}, "
    "CAST(sex = 'MALE' AS INT) AS sex_privilege, CAST(race = 'White' AS INT) AS race_privilege FROM cleaned",
}


def sql(final: str, *names: str) -> str:
    """``WITH`` clause of the named steps (in table order) in front of the final select."""
    wanted = set(names)
    if "flagged_groups" in wanted:
        wanted |= {"cleaned"}
    if "cleaned" in wanted:
        wanted |= {"wide"}
    if "modelled" in wanted or "history" in wanted or "recoded" in wanted:
        wanted |= {"summary"}
    if "recoded" in wanted:
        wanted |= {"history"}
    if "history" in wanted:
        wanted |= {"history0"}
    if "summary" in wanted:
        wanted |= {"rolled", "person", "deaths"}
    if "rolled" in wanted:
        wanted |= {"bounded"}
    if "bounded" in wanted:
        wanted |= {"merged"}
    if "merged" in wanted:
        wanted |= {"idx"}
    if "idx" in wanted:
        wanted |= {"days"}
    if "days" in wanted:
        wanted |= {"fact_day"}
    steps = ",\n".join(f"{name} AS ({text})" for name, text in _STEPS.items() if name in wanted)
    return f"WITH {steps}\n{final}"


def normal_two_sided(z: str) -> str:
    """2 (1 - Phi(|z|)) by Simpson's rule over [0, |z|] with 2000 intervals."""
    x = f"(i * least(abs({z}), 40.0) / 2000.0)"
    weight = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (
        f"greatest(1 - 2 * (SELECT sum({weight} * exp(-{x} * {x} / 2)) FROM range(2001) g(i)) "
        f"* least(abs({z}), 40.0) / 6000.0 / sqrt(2 * pi()), 0)"
    )


def t_two_sided(t: str, df: str) -> str:
    """Two-sided tail of the t law, from the Simpson integral of its density over [0, |t|]."""
    x = f"(i * abs({t}) / 20000.0)"
    weight = "CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(({df}) * pi())"
    return (
        f"greatest(1 - 2 * {density} * (SELECT sum({weight} * pow(1 + {x} * {x} / ({df}), -(({df}) + 1) / 2.0)) "
        f"FROM range(20001) g(i)) * abs({t}) / 60000.0, 0)"
    )


def t_quantile_975(df: str) -> str:
    """The t law's 0.975 quantile by its expansion around the normal one, for the large samples checked here."""
    z = 1.959963984540054
    terms = (
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    return "(" + " + ".join(f"{t!r} / pow({df}, {i})" for i, t in enumerate(terms)) + ")"


def _scored_cells(by: str = "") -> str:
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {group}count(*) FILTER (y = 0 AND y_pred = 0) AS tn, count(*) FILTER (y = 0 AND y_pred = 1) AS fp, "
        "count(*) FILTER (y = 1 AND y_pred = 0) AS fn, count(*) FILTER (y = 1 AND y_pred = 1) AS tp "
        f"FROM scored{tail}"
    )


RATES = {
    "acc": "(tp + tn) / nullif(tp + tn + fp + fn, 0)",
    "tpr": "tp / nullif(tp + fn, 0)",
    "fpr": "fp / nullif(fp + tn, 0)",
    "fnr": "fn / nullif(tp + fn, 0)",
    "ppp": "(tp + fp) / nullif(tp + tn + fp + fn, 0)",
}


def _rates(by: str) -> str:
    return (
        f"SELECT {by}, tn + fp + fn + tp AS n, {', '.join(f'{t} AS {n}' for n, t in RATES.items())} "
        f"FROM ({_scored_cells(by)})"
    )


def _ratio(by: str) -> str:
    pieces = ", ".join(
        f"{r6(f'max(CASE WHEN {by} = 0 THEN {r} END) / nullif(max(CASE WHEN {by} = 1 THEN {r} END), 0)')} AS {r}_ratio"
        for r in RATES
    )
    return sql(f"SELECT {pieces} FROM ({_rates(by)})", "scored")


_ROC = (
    "SELECT s.score AS threshold, "
    f"{r6('(SELECT count(*) FROM scored b WHERE b.y = 0 AND b.score >= s.score) / (SELECT count(*) FROM scored WHERE y = 0)')} AS fpr, "
    f"{r6('(SELECT count(*) FROM scored b WHERE b.y = 1 AND b.score >= s.score) / (SELECT count(*) FROM scored WHERE y = 1)')} AS tpr "
    "FROM (SELECT DISTINCT score FROM scored) s UNION ALL SELECT NULL, 0.0, 0.0"
)

_HISTORY_ALL = (
    list(cl.BASE_COLUMNS) + list(cl.HISTORY_COLUMNS) + list(cl.INCIDENT_OUTCOMES)
)


def _hot(column: str, levels) -> str:
    return ", ".join(f'CASE WHEN {column} = \'{v}\' THEN 1 ELSE 0 END AS "{column}_{v}"' for v in levels)


_KEPT_RACES = [r for r in cl.RACE_LEVELS if r != "Unknown"]
CORR_COLUMNS = ("age", "total_visits", "BMI_max_observed_or_calculated", "total_number_of_COVID_vaccine_doses") + INDICATORS


def _corr(digits: int = 6) -> str:
    """Every pair of columns, over the rows where both are known; NULL where one of them is constant."""
    entries = ", ".join(f"{{'k': {i}, 'f': '{c}', 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(CORR_COLUMNS))
    r = r6("CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN round(corr(a.v, b.v), 12) END", digits)
    return (
        f"SELECT a.f AS feature_a, b.f AS feature_b, count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS n, {r} AS r "
        "FROM long a JOIN long b ON a.person_id = b.person_id AND a.k < b.k GROUP BY a.f, b.f"
    ).replace(
        "long", f"(SELECT person_id, unnest([{entries}], recursive := true) FROM summary)"
    )


def _describe(group: str, value: str, source: str) -> str:
    q = ", ".join(f"{r6(f'quantile_cont({value}, {p / 100})')} AS p{p}" for p in (25, 50, 75))
    return (
        f"SELECT {group}, count({value}) AS count, {r6(f'avg({value})')} AS mean, {r6(f'stddev_samp({value})')} AS std, "
        f"{r6(f'min({value})')} AS min, {q}, {r6(f'max({value})')} AS max FROM {source} GROUP BY {group}"
    )


def _flow() -> str:
    steps = {
        "all rows": "true",
        "delivery or pregnancy": "delivery_record_only = 1 OR number_given_birth = 1 OR pregnancy = 1",
        "pregnancy": "pregnancy = 1",
        "delivery": "delivery_record_only = 1 AND pregnancy = 1",
    }
    return " UNION ALL ".join(
        f"SELECT {i + 1} AS step_no, '{name}' AS step, count(*) AS n_rows, count(DISTINCT person_id) AS n_persons "
        f"FROM fact_day WHERE {test}"
        for i, (name, test) in enumerate(steps.items())
    )


def _patient_flow() -> str:
    steps = {
        "age known": "age >= 1",
        "known sex": "age >= 1 AND sex IN ('MALE', 'FEMALE')",
        "common race": "age >= 1 AND sex IN ('MALE', 'FEMALE') AND race IN "
        "('White', 'Asian', 'Black or African American', 'Unknown')",
    }
    return " UNION ALL ".join(
        f"SELECT {i + 1} AS step_no, '{name}' AS step, count(*) AS n_rows, count(DISTINCT person_id) AS n_persons "
        f"FROM wide WHERE {test}"
        for i, (name, test) in enumerate(steps.items())
    )


_PAIRED = (
    "SELECT n, {mean} AS mean, {sd} AS sd, {t} AS t, n - 1 AS df, {p} AS p_value, {low} AS ci_low, {high} AS ci_high "
    "FROM (SELECT count(d) AS n, "
    "avg(d) AS mean, stddev_samp(d) AS sd, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS t FROM "
    "(SELECT CAST({a} AS DOUBLE) - {b} AS d FROM history))"
)


def _paired(a: str, b: str) -> str:
    half = f"({t_quantile_975('(n - 1)')} * sd / sqrt(n))"
    text = _PAIRED.format(
        a=a,
        b=b,
        mean=r6("mean"),
        sd=r6("sd"),
        t=r6("t"),
        p=r6(t_two_sided("t", "n - 1")),
        low=r6(f"mean - {half}"),
        high=r6(f"mean + {half}"),
    )
    return sql(text, "history")


def core_texts() -> dict[str, str]:
    out: dict[str, str] = {}
    flags = "(delivery_record_only = 1 OR number_given_birth = 1 OR pregnancy = 1)"
    out["fact_day"] = sql("SELECT * FROM fact_day", "fact_day")
    out["person"] = sql("SELECT * FROM person", "person")
    out["deaths"] = sql("SELECT * FROM deaths", "deaths")
    out["filter_delivery_or_pregnancy"] = sql(f"SELECT * FROM fact_day WHERE {flags}", "fact_day")
    out["filter_pregnant"] = sql("SELECT * FROM fact_day WHERE pregnancy = 1", "fact_day")
    out["filter_delivery"] = sql("SELECT * FROM fact_day WHERE delivery_record_only = 1", "fact_day")
    out["filter_adult_female"] = sql("SELECT * FROM person WHERE age >= 18 AND sex = 'FEMALE'", "person")
    out["filter_age_band"] = sql("SELECT * FROM person WHERE age BETWEEN 18 AND 50", "person")
    out["filter_age_known"] = sql("SELECT person_id, age FROM wide WHERE age >= 1", "wide")
    out["filter_known_sex"] = sql("SELECT * FROM person WHERE sex IN ('MALE', 'FEMALE')", "person")
    out["filter_common_race"] = sql(
        "SELECT * FROM person WHERE race IN ('White', 'Asian', 'Black or African American', 'Unknown')", "person"
    )
    out["filter_visits"] = sql("SELECT * FROM person WHERE total_visits >= 2 AND total_visits < 12", "person")
    out["drop_null_pairs"] = sql(
        "SELECT person_id, postpartum_depression_main, postpartum_csection_main, postpartum_depression_main - "
        "postpartum_csection_main AS diff FROM history WHERE postpartum_depression_main IS NOT NULL AND "
        "postpartum_csection_main IS NOT NULL",
        "history",
    )
    out["cohort_flow"] = sql(_flow(), "fact_day")
    out["patient_flow"] = sql(_patient_flow(), "wide")
    out["index_date"] = sql("SELECT * FROM idx", "idx")
    out["index_cohort"] = sql("SELECT * FROM merged", "merged")
    out["window_bounds"] = sql(
        "SELECT DISTINCT person_id, first_delivery_date, _1y_prior_1st_delivery, _1y_after_1st_delivery, "
        "_280d_prior_1st_delivery FROM bounded",
        "bounded",
    )
    for tag in ("1y", "280d"):
        labels = ", ".join(f"{label_case(c, tag)} AS {c}_flag_{tag}" for c in CONDITIONS)
        out[f"window_label_{tag}"] = sql(f"SELECT person_id, date, {labels} FROM bounded", "bounded")
    dummies = ", ".join(
        f"CASE WHEN {c} = 1 AND {test} THEN 1 ELSE 0 END AS {c}_flag_{tag}_{label}"
        for c in CONDITIONS
        for tag in ("1y", "280d")
        for label, test in _tests(tag).items()
    )
    out["window_dummies"] = sql(f"SELECT person_id, date, {dummies} FROM bounded", "bounded")
    labels = ", ".join(f"{label_case(c, tag)} AS {c}_flag_{tag}" for c in CONDITIONS for tag in ("1y", "280d"))
    every = ", ".join(
        f"CASE WHEN {c} = 1 AND {test} THEN 1 ELSE 0 END AS {c}_flag_{tag}_{label}"
        for c in CONDITIONS
        for tag in ("1y", "280d")
        for label, test in _tests(tag).items()
    )
    out["flag_windows"] = sql(f"SELECT *, {labels}, {every} FROM bounded", "bounded")
    out["indicator_rollup"] = sql("SELECT * FROM rolled", "rolled")
    out["indicator_rollup_fused"] = out["indicator_rollup"]
    out["optional_aggregates"] = sql(
        "SELECT person_id, max(BMI_rounded) AS BMI_max_observed_or_calculated, CAST(sum(had_vaccine_administered) AS "
        "BIGINT) AS total_number_of_COVID_vaccine_doses FROM merged GROUP BY person_id",
        "merged",
    )
    out["row_count"] = sql("SELECT count(*) AS n_rows FROM days", "days")
    out["distinct_persons"] = sql("SELECT count(DISTINCT person_id) AS n_persons FROM summary", "summary")
    out["distinct_levels"] = sql(
        "SELECT DISTINCT 'sex' AS feature, sex AS level FROM person UNION ALL SELECT DISTINCT 'race', race FROM person "
        "UNION ALL SELECT DISTINCT 'race_ethnicity', race_ethnicity FROM person",
        "person",
    )
    out["level_counts"] = sql(
        "SELECT postpartum_depression_main, count(*) AS n FROM history GROUP BY 1 ORDER BY n", "history"
    )
    out["three_statistics"] = sql(
        f"SELECT count(age) AS n, {r6('avg(age)')} AS mean, {r6('stddev_samp(age)')} AS sd FROM history", "history"
    )
    out["describe_by_group"] = sql(_describe("race_ethnicity", "age", "summary"), "summary")
    out["describe_price"] = (
        f"SELECT o_orderstatus, count(o_totalprice) AS count, {r6('avg(o_totalprice)', 3)} AS mean, "
        f"{r6('stddev_samp(o_totalprice)', 3)} AS std, {r6('min(o_totalprice)', 3)} AS min, "
        + ", ".join(f"{r6(f'quantile_cont(o_totalprice, {p / 100})', 3)} AS p{p}" for p in (25, 50, 75))
        + f", {r6('max(o_totalprice)', 3)} AS max FROM orders GROUP BY o_orderstatus"
    )
    out["patient_summary"] = sql("SELECT * FROM summary", "summary")
    out["patient_summary_plain"] = out["patient_summary"]
    out["history_table"] = sql("SELECT * FROM history", "history")
    out["history_node"] = out["history_table"]
    out["exclude_prior"] = sql(
        f"SELECT person_id, {', '.join(cl.INCIDENT_OUTCOMES)} FROM history", "history"
    )
    out["depression_by_race"] = sql(
        f"SELECT race, count(*) AS n_persons, count(postpartum_depression_main) AS n_at_risk, "
        f"{r6('avg(postpartum_depression_main)')} AS share FROM history GROUP BY race",
        "history",
    )
    shown = [c for c in cl.SUMMARY_COLUMNS if not c.startswith("BMI")]
    bmi = f"{r6('BMI_max_observed_or_calculated')} AS BMI_max_observed_or_calculated"
    out["clean_patients"] = sql(f"SELECT {', '.join(shown)}, {bmi} FROM cleaned", "cleaned")
    any_columns = {**cl.combined_indicators("eclampsia", ("eclampsia", "preeclampsia")),
                   **cl.combined_indicators("diabetes", ("diabetes", "diabetes_complicated"))}
    anys = ", ".join(f"greatest({', '.join(parts)}) AS {new}" for new, parts in any_columns.items())
    out["any_of"] = sql(f"SELECT person_id, {anys} FROM summary", "summary")
    renamed = ", ".join(f"{old} AS {new}" for new, old in cl.HISTORY_COLUMNS.items())
    incident = ", ".join(
        f"CASE WHEN {cl.HISTORY_COLUMNS[prior]} = 1 THEN NULL ELSE {cl.HISTORY_COLUMNS[outcome]} END AS {new}"
        for new, (outcome, prior) in cl.INCIDENT_OUTCOMES.items()
    )
    out["age_band_cohort"] = sql(
        f"SELECT {', '.join(cl.BASE_COLUMNS)}, {renamed}, {incident}, {anys}, {', '.join(INDICATORS)}, "
        "BMI_max_observed_or_calculated, total_number_of_COVID_vaccine_doses FROM summary WHERE age BETWEEN 18 AND 50",
        "summary",
    )
    out["clean_full"] = sql(
        "SELECT * FROM history WHERE age BETWEEN 18 AND 50 AND sex IN ('MALE', 'FEMALE') AND race IN "
        "('White', 'Asian', 'Black or African American', 'Unknown')",
        "history",
    )
    out["recode_race"] = sql("SELECT person_id, race FROM recoded", "recoded")
    plain = ", ".join(c for c in _HISTORY_ALL if c != "race")
    out["one_hot_sex_race"] = sql(
        f"SELECT {plain}, {_hot('sex', cl.SEX_LEVELS)}, {_hot('race', _KEPT_RACES)} FROM recoded", "recoded"
    )
    out["one_hot_race"] = sql(f"SELECT {plain}, {_hot('race', _KEPT_RACES)} FROM recoded", "recoded")
    out["sex_female_flag"] = sql(
        f"SELECT {plain} , {_hot('race', _KEPT_RACES)} FROM recoded".replace(
            " sex,", " CASE WHEN sex = 'FEMALE' THEN 1 END AS sex,", 1
        ),
        "recoded",
    )
    out["one_hot_extended"] = sql(
        f"SELECT {', '.join(c for c in cl.BASE_COLUMNS if c != 'race')}, {renamed}, {incident}, {anys}, {', '.join(INDICATORS)}, "
        f"BMI_max_observed_or_calculated, total_number_of_COVID_vaccine_doses, {_hot('sex', cl.SEX_LEVELS)}, "
        f"{_hot('race', _KEPT_RACES)} FROM (SELECT * REPLACE (CASE race "
        + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in cl.RACE_RECODE.items())
        + " ELSE race END AS race) FROM summary)",
        "summary",
    )
    out["privilege_flags"] = sql(
        f"SELECT age, {', '.join(cl.COMORBIDITIES)}, {cl.MORTALITY}, sex_privilege, race_privilege FROM flagged_groups",
        "flagged_groups",
    )
    out["zscore_sample"] = sql(
        f"SELECT person_id, age, {r6('(age - (SELECT avg(age) FROM history)) / (SELECT stddev_samp(age) FROM history)')}"
        " AS scaled_age FROM history",
        "history",
    )
    out["zscore_replace"] = sql(
        f"SELECT person_id, {r6('(age - (SELECT avg(age) FROM history)) / (SELECT stddev_samp(age) FROM history)')}"
        " AS age FROM history",
        "history",
    )
    out["scaled_vector"] = sql(
        f"SELECT {r6('(age - (SELECT avg(age) FROM history)) / (SELECT stddev_samp(age) FROM history)')}"
        " AS scaled_age FROM history",
        "history",
    )
    out["zscore_population"] = sql(
        f"SELECT person_id, {r6('(age - (SELECT avg(age) FROM history)) / (SELECT stddev_pop(age) FROM history)')}"
        " AS scaled_age FROM history",
        "history",
    )
    out["feature_variances"] = sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r6(f'var_pop({c})')} AS variance FROM flagged_groups"
            for c in cl.COMORBIDITIES + ("sex_privilege", "race_privilege")
        ),
        "flagged_groups",
    )
    out["quasi_constant"] = sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature FROM rolled HAVING var_pop({c}) > 0.01" for c in INDICATORS
        ),
        "rolled",
    )
    out["corr_long"] = sql(_corr(), "summary")
    out["corr_rounded"] = sql(_corr(2), "summary")
    out["corr_drop"] = sql(
        f"SELECT DISTINCT feature_b AS feature FROM ({_corr()}) WHERE abs(r) > 0.90", "summary"
    )
    out["age_bin"] = sql(
        "SELECT person_id, age, CASE WHEN age >= 45 THEN 5 WHEN age >= 35 THEN 4 WHEN age >= 30 THEN 3 "
        "WHEN age >= 25 THEN 2 WHEN age >= 18 THEN 1 ELSE 0 END AS age_bin FROM person",
        "person",
    )
    t_one = "(avg(age) - 35) / (stddev_samp(age) / sqrt(count(age)))"
    half = t_two_sided("t", "n - 1")
    out["t_one_sample"] = sql(
        f"SELECT n, {r6('mean')} AS mean, {r6('sd')} AS sd, {r6('t')} AS t, n - 1 AS df, "
        f"{r6(f'CASE WHEN t > 0 THEN {half} / 2 ELSE 1 - {half} / 2 END')} AS p_value FROM (SELECT count(age) AS n, "
        f"avg(age) AS mean, stddev_samp(age) AS sd, {t_one} AS t FROM history)",
        "history",
    )
    out["t_paired_1y"] = _paired("postpartum_depression", "depression_hist_1y_prior")
    out["t_paired_280d"] = _paired("postpartum_depression", "depression_hist_280d_prior")
    out["t_welch"] = sql(
        f"SELECT n1, n2, {r6('m1')} AS mean1, {r6('m2')} AS mean2, {r6('v1')} AS var1, {r6('v2')} AS var2, {r6('t')} AS t, "
        f"{r6('df')} AS df, {r6(t_two_sided('t', 'df'))} AS p_value FROM (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) "
        "AS t, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM (SELECT "
        + ", ".join(
            f"{f}(age) FILTER (race_ethnicity = '{level}') AS {k}{i}"
            for i, level in ((1, "White Non-Hispanic"), (2, "Hispanic or Latino Any Race"))
            for f, k in (("count", "n"), ("avg", "m"), ("var_samp", "v"))
        )
        + " FROM summary))",
        "summary",
    )
    chi = "SELECT sum(o) AS n, count(*) AS k, {stat} AS x FROM (SELECT {c} AS level, count(*) AS o FROM history WHERE {c} IS NOT NULL GROUP BY 1)"
    out["chisq_equal"] = sql(
        f"SELECT CAST(n AS BIGINT) AS n, k AS levels, {r6('x')} AS chi_square, 1 AS df, "
        f"{r6(normal_two_sided('sqrt(x)'))} AS p_value FROM ("
        + chi.format(c="postpartum_depression", stat="sum(o * o) / (0.5 * sum(o)) - sum(o)")
        + ")",
        "history",
    )
    out["chisq_given"] = sql(
        f"SELECT CAST(n AS BIGINT) AS n, k AS levels, {r6('x')} AS chi_square, 4 AS df, "
        f"{r6('exp(-x / 2) * (1 + x / 2)')} AS p_value FROM ("
        + chi.format(c="race", stat="sum(o * o / 0.2) / sum(o) - sum(o)")
        + ")",
        "history",
    )
    out["rank_sum"] = sql(
        f"SELECT n0, n1, {r6('w')} AS w, {r6('z')} AS z, {r6(normal_two_sided('z'))} AS p_value FROM (SELECT n0, n1, w, "
        "(w - n0 * n1 / 2.0 - sign(w - n0 * n1 / 2.0) * 0.5) / sqrt(n0 * n1 / 12.0 * (n0 + n1 + 1 - ties / ((n0 + n1) * "
        "(n0 + n1 - 1.0)))) AS z FROM (SELECT count(*) FILTER (g = 0) AS n0, count(*) FILTER (g = 1) AS n1, sum(mid) "
        "FILTER (g = 0) - count(*) FILTER (g = 0) * (count(*) FILTER (g = 0) + 1) / 2.0 AS w, "
        "sum(CAST(c AS DOUBLE) * c - 1) AS ties FROM (SELECT postpartum_depression AS g, "
        "rank() OVER (ORDER BY age) + (count(*) OVER (PARTITION BY age) - 1) / 2.0 AS mid, "
        "count(*) OVER (PARTITION BY age) AS c FROM history)))",
        "history",
    )
    price = (
        "SELECT CAST(o_orderstatus = 'F' AS INT) AS g, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER "
        "(PARTITION BY o_totalprice) - 1) / 2.0 AS mid FROM orders"
    )
    out["rank_sum_price"] = (
        "SELECT count(*) FILTER (g = 0) AS n0, count(*) FILTER (g = 1) AS n1, "
        + r6("sum(mid) FILTER (g = 0) - count(*) FILTER (g = 0) * (count(*) FILTER (g = 0) + 1) / 2.0")
        + f" AS w FROM ({price})"
    )
    out["confusion"] = sql(
        "SELECT a.v AS actual, p.v AS predicted, count(y) AS n FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) "
        "p(v) LEFT JOIN scored ON y = a.v AND y_pred = p.v GROUP BY 1, 2",
        "scored",
    )
    klass = (
        "SELECT '{k}' AS label, COALESCE({hit} / nullif({hit} + {wrong}, 0), 0) AS p, COALESCE({hit} / nullif({hit} + "
        "{missed}, 0), 0) AS r, COALESCE(2.0 * {hit} / nullif(2 * {hit} + {wrong} + {missed}, 0), 0) AS f, {hit} + {missed} AS s "
        "FROM cells"
    )
    report = (
        f"cells AS ({_scored_cells()}), k AS ("
        + klass.format(k=0, hit="tn", wrong="fn", missed="fp")
        + " UNION ALL "
        + klass.format(k=1, hit="tp", wrong="fp", missed="fn")
        + ")"
    )
    base = sql("", "scored").strip()
    out["class_report"] = (
        f"{base}, {report} SELECT label, {r6('p')} AS precision, {r6('r')} AS recall, {r6('f')} AS f1, s AS support FROM k "
        f"UNION ALL SELECT 'accuracy', {r6('(tn + tp) / (tn + tp + fn + fp)')}, {r6('(tn + tp) / (tn + tp + fn + fp)')}, "
        f"{r6('(tn + tp) / (tn + tp + fn + fp)')}, tn + tp + fn + fp FROM cells "
        f"UNION ALL SELECT 'macro avg', {r6('avg(p)')}, {r6('avg(r)')}, {r6('avg(f)')}, CAST(sum(s) AS BIGINT) FROM k "
        f"UNION ALL SELECT 'weighted avg', {r6('sum(p * s) / sum(s)')}, {r6('sum(r * s) / sum(s)')}, "
        f"{r6('sum(f * s) / sum(s)')}, CAST(sum(s) AS BIGINT) FROM k"
    )
    out["macro_scores"] = (
        f"{base}, {report} SELECT (SELECT {r6('(tn + tp) / (tn + tp + fn + fp)')} FROM cells) AS accuracy, "
        f"{r6('avg(p)')} AS macro_precision, {r6('avg(r)')} AS macro_recall, {r6('avg(f)')} AS macro_f1 FROM k"
    )
    out["roc_points"] = sql(_ROC, "scored")
    out["auc"] = sql(
        f"SELECT {r6('sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*)')} "
        "AS auc FROM scored p, scored n WHERE p.y = 1 AND n.y = 0",
        "scored",
    )
    out["auc_by_group"] = sql(
        f"SELECT race_privilege, {r6('sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*)')} "
        "AS auc FROM scored p JOIN scored n USING (race_privilege) WHERE p.y = 1 AND n.y = 0 GROUP BY 1",
        "scored",
    )
    out["split_sizes"] = sql(
        "SELECT CASE WHEN person_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows FROM "
        "flagged_groups GROUP BY 1",
        "flagged_groups",
    )
    out["group_rates"] = sql(
        f"SELECT source, n, {', '.join(f'{r6(r)} AS {r}' for r in RATES)} FROM ({_rates('source')})", "scored"
    )
    out["race_ratio"] = _ratio("race_privilege")
    out["sex_ratio"] = _ratio("sex_privilege")
    label = (
        "CASE WHEN sex_privilege = 1 THEN 'Male' ELSE 'Female' END || '_' || "
        "CASE WHEN race_privilege = 1 THEN 'White' ELSE 'Non-White' END"
    )
    rounded = ", ".join(f"{r6(r)} AS {r}" for r in RATES)
    inter = _rates("sex_privilege, race_privilege")
    out["intersection_rates"] = sql(f"SELECT {label} AS intersection_group, n, {rounded} FROM ({inter})", "scored")
    out["fairness_overview"] = sql(
        f"SELECT 'intersection' AS family, {label} AS group_name, n, {rounded} FROM ({inter}) UNION ALL "
        f"SELECT 'race', CASE WHEN race_privilege = 1 THEN 'White' ELSE 'Non-White' END, n, {rounded} FROM "
        f"({_rates('race_privilege')}) UNION ALL SELECT 'sex', CASE WHEN sex_privilege = 1 THEN 'Male' ELSE 'Female' END, "
        f"n, {rounded} FROM ({_rates('sex_privilege')})",
        "scored",
    )
    out["dp_difference"] = sql(
        f"SELECT {r6('max(ppp) - min(ppp)')} AS demographic_parity_difference FROM ({_rates('race_privilege')})", "scored"
    )
    out["eo_difference"] = sql(
        f"SELECT {r6('greatest(max(tpr) - min(tpr), max(fpr) - min(fpr))')} AS equalized_odds_difference FROM "
        f"({_rates('race_privilege')})",
        "scored",
    )
    cells = " UNION ALL ".join(
        f"SELECT '{label}' AS dv, count(*) FILTER (e = 1 AND y = 1) + 0.5 AS a, count(*) FILTER (e = 1 AND y = 0) + 0.5 AS b, "
        "count(*) FILTER (e = 0 AND y = 1) + 0.5 AS c, count(*) FILTER (e = 0 AND y = 0) + 0.5 AS d FROM "
        f"(SELECT {cl.EXPOSURE} AS e, {y} AS y FROM modelled)"
        for label, y in cl.OUTCOMES.items()
    )
    odds = f"SELECT dv, ln((a * d) / (b * c)) AS est, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS se FROM ({cells})"
    out["effect_size"] = sql(
        f"SELECT dv, 'Model 1' AS model, {r6('est')} AS estimate, {r6('exp(est)')} AS odds_ratio, "
        f"round(est / 1.81, 3) + 0.0 AS cohen_d FROM ({odds})",
        "modelled",
    )
    out["wald_table"] = sql(
        f"SELECT dv AS term, {r6('exp(est)')} AS odds_ratio, {r6('exp(est - 1.96 * se)')} AS ci_low, "
        f"{r6('exp(est + 1.96 * se)')} AS ci_high, {r6('est')} AS estimate, {r6('se')} AS std_error, "
        f"{r6('est / se')} AS z, {r6(normal_two_sided('est / se'))} AS p_value FROM ({odds})",
        "modelled",
    )
    welch = out["t_welch"]
    out["age_report"] = (
        welch[: welch.rindex("SELECT n1, n2")]
        + f", test AS (SELECT m1 - m2 AS gap, {welch[welch.rindex('SELECT n1, n2') + 7:]}) "
        "SELECT 'level' AS section, race_ethnicity AS label, count(age) AS n, "
        f"{r6('avg(age)')} AS mean, {r6('stddev_samp(age)')} AS sd, CAST(NULL AS DOUBLE) AS t, CAST(NULL AS DOUBLE) AS df, "
        "CAST(NULL AS DOUBLE) AS p_value FROM summary GROUP BY race_ethnicity UNION ALL "
        f"SELECT 'test', 'difference', n1 + n2, {r6('gap')}, NULL, t, df, p_value FROM test"
    )
    out["zero_variance"] = sql(
        " UNION ALL ".join(f"SELECT '{c}' AS feature FROM rolled HAVING var_pop({c}) > 0" for c in INDICATORS), "rolled"
    )
    return out


def hash_uniform(key: str, seed: int = 42) -> str:
    """The split's uniform number of a key: forty bits of an MD5 digest."""
    return f"CAST('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}')), 1, 10) AS BIGINT) / {float(1 << 40)!r}"


RISK_POINTS = (
    "CAST(age + 3 * total_visits + 4 * race_White + "
    "6 * OBESITY_1y_during_1y_prior_to_1st_delivery_indicator AS DOUBLE)"
)


# Coefficients at which the mixed models' likelihood and curves are checked.
STATED_SIGMA = 0.6


def stated_beta(terms) -> list[float]:
    """An intercept and small coefficients of both signs, smaller for the wide-ranged columns."""
    return [-1.2, *[(0.3 - 0.07 * i) / (30 if t == "age" else 10 if t == "total_visits" else 1) for i, t in enumerate(terms)]]


def _likelihoods(rounds: int = 12) -> str:
    """Newton steps for the cluster modes, one common table expression each, then the Laplace sum."""
    parts = []
    for label, y in cl.OUTCOMES.items():
        for model, terms in (("reduced", cl.REDUCED_TERMS), ("full", cl.FULL_TERMS)):
            b = stated_beta(terms)
            eta = " + ".join([repr(b[0]), *(f"{v!r} * {t}" for v, t in zip(b[1:], terms))])
            known = " AND ".join(f"{c} IS NOT NULL" for c in (y, cl.CLUSTER, *terms))
            parts.append(
                f"SELECT '{label}' AS dv_label, '{model}' AS model, {cl.CLUSTER} AS g, CAST({y} AS DOUBLE) AS y, {eta} AS eta "
                f"FROM modelled WHERE {known}"
            )
    var = STATED_SIGMA**2
    chain = [f"rows_ AS MATERIALIZED ({' UNION ALL '.join(parts)})", "u0 AS (SELECT DISTINCT dv_label, model, g, 0.0 AS u FROM rows_)"]
    for i in range(1, rounds + 1):
        chain.append(
            f"u{i} AS MATERIALIZED (SELECT dv_label, model, g, u + (sum(y - p) - u / {var}) / (sum(p * (1 - p)) + 1 / {var}) AS u FROM "
            f"(SELECT r.*, u, 1 / (1 + exp(-(eta + u))) AS p FROM rows_ r JOIN u{i - 1} USING (dv_label, model, g)) "
            "GROUP BY dv_label, model, g, u)"
        )
    steps = sql("", "modelled").strip() + ", " + ", ".join(chain)
    return (
        f"{steps} SELECT dv_label, model, {r6('sum(part)', 4)} AS loglik FROM (SELECT dv_label, model, g, "
        f"sum(y * (eta + u) - ln(1 + exp(eta + u))) - u * u / (2 * {var}) - 0.5 * ln(1 + {var} * sum(exp(eta + u) / "
        f"pow(1 + exp(eta + u), 2))) AS part FROM rows_ JOIN u{rounds} USING (dv_label, model, g) GROUP BY dv_label, model, g, u) "
        "GROUP BY dv_label, model"
    )


CHECKED_PENALTIES = (0.01, 0.1)


def _fold_moments(features, folds: int = 3) -> str:
    """Observed side of the score equations of each penalty and fold: sum of y times each term over the other folds."""
    fold = f"CAST(floor(({hash_uniform('person_id')}) * {folds}) AS INTEGER)"
    sums = [("(Intercept)", f"sum({cl.LUNG})"), *((f, f"sum({cl.LUNG} * {f})") for f in features)]
    parts = [
        f"SELECT CAST({p!r} AS DOUBLE) AS penalty, {k} AS fold, '{name}' AS term, {r6(f'CAST({total} AS DOUBLE)', 1)} AS moment "
        f"FROM folded WHERE fold <> {k}"
        for p in CHECKED_PENALTIES
        for k in range(folds)
        for name, total in sums
    ]
    steps = sql("", "flagged_groups").strip() + f", folded AS MATERIALIZED (SELECT *, {fold} AS fold FROM flagged_groups)"
    return f"{steps} {' UNION ALL '.join(parts)}"


#: weights in quarters and sixteenths keep the sums of a stated score exact
STATED_INTERCEPT = -3.0


def stated_weights(features) -> dict[str, float]:
    return {f: 0.0625 if f == "age" else (k % 7 - 2) * 0.25 for k, f in enumerate(features)}


def _permutation(features, seed: int = 42) -> str:
    """Accuracy of the stated score, less that with a feature's values taken from the row before in digest order."""
    weights = stated_weights(features)
    known = " AND ".join(f"{c} IS NOT NULL" for c in (cl.LUNG, *features))
    eta = " + ".join([repr(STATED_INTERCEPT), *(f"{w!r}::DOUBLE * r.{f}" for f, w in weights.items())])
    hit = lambda e: f"avg(CASE WHEN (CASE WHEN {e} > 0 THEN 1 ELSE 0 END) = r.{cl.LUNG} THEN 1 ELSE 0 END)"
    order = f"ORDER BY md5(concat_ws('|', CAST(person_id AS VARCHAR), '{seed}')), person_id"
    loss = ", ".join(r6(f"{hit(eta)} - {hit(f'{eta} + {w!r}::DOUBLE * (d.{f} - r.{f})')}") + f" AS {f}" for f, w in weights.items())
    steps = sql("", "flagged_groups").strip()
    return (
        f"{steps}, numbered AS MATERIALIZED (SELECT *, row_number() OVER ({order}) - 1 AS no FROM flagged_groups WHERE {known}), "
        f"losses AS (SELECT {loss} FROM numbered r JOIN numbered d ON r.no = (d.no + 1) % (SELECT count(*) FROM numbered)) "
        f"UNPIVOT losses ON {', '.join(weights)} INTO NAME feature VALUE importance"
    )


#: cuts of the checked trees: flags at 0, age every five years
def stated_edges(features) -> dict[str, list[float]]:
    return {f: [float(v) for v in range(5, 90, 5)] if f == "age" else [0.0] for f in features}


def _boosting(features, rounds: int = 0, depth: int = 2, rate: float = 0.3, penalty: float = 1.0, least: float = 1.0) -> str:
    """Boosted trees by trying every stated cut at every node; without rounds the gains of the cuts of the first root."""
    known = " AND ".join(f"{c} IS NOT NULL" for c in (cl.LUNG, *features))
    longs = " UNION ALL ".join(f"SELECT person_id, {i} AS f, CAST({c} AS DOUBLE) AS v FROM rows_" for i, c in enumerate(features))
    cuts = ", ".join(f"({i}, '{c}', {e!r}::DOUBLE)" for i, c in enumerate(features) for e in stated_edges(features)[c])
    part = lambda g, h: f"pow({g}, 2) / ({h} + {penalty!r}::DOUBLE)"
    gain = f"round(({part('g', 'h')} + {part('ag - g', 'ah - h')} - {part('ag', 'ah')}) / 2, 9)"
    steps = [
        sql("", "flagged_groups").strip(),
        f"rows_ AS MATERIALIZED (SELECT * FROM flagged_groups WHERE {known})",
        f"long_ AS MATERIALIZED ({longs})",
        f"cuts AS (SELECT * FROM (VALUES {cuts}) c(f, feature, edge))",
        f"m0 AS (SELECT person_id, CAST({cl.LUNG} AS DOUBLE) AS y, 0.0::DOUBLE AS margin FROM rows_)",
    ]
    parts = []
    for r in range(1, max(rounds, 1) + 1):
        p = "1 / (1 + exp(-margin))"
        steps.append(f"t{r}_0 AS MATERIALIZED (SELECT person_id, y, margin, 1 AS node, {p} - y AS dg, {p} * (1 - {p}) AS dh FROM m{r - 1})")
        for level in range(depth if rounds else 1):
            here = f"t{r}_{level}"
            steps.append(
                f"g{r}_{level} AS MATERIALIZED (SELECT *, {gain} AS gain FROM (SELECT node, f, feature, edge, "
                "coalesce(sum(dg) FILTER (v <= edge), 0) AS g, coalesce(sum(dh) FILTER (v <= edge), 0) AS h, sum(dg) AS ag, sum(dh) AS ah "
                f"FROM {here} JOIN long_ USING (person_id) JOIN cuts USING (f) WHERE node >= {1 << level} GROUP BY node, f, feature, edge) "
                f"WHERE h >= {least!r} AND ah - h >= {least!r})"
            )
            steps.append(
                f"b{r}_{level} AS MATERIALIZED (SELECT * FROM g{r}_{level} WHERE gain > 0 "
                "QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, edge) = 1)"
            )
            steps.append(
                f"t{r}_{level + 1} AS MATERIALIZED (SELECT t.person_id, y, margin, dg, dh, CASE WHEN b.node IS NULL THEN t.node "
                f"WHEN v <= edge THEN 2 * t.node ELSE 2 * t.node + 1 END AS node FROM {here} t LEFT JOIN b{r}_{level} b ON b.node = t.node "
                "LEFT JOIN long_ l ON l.person_id = t.person_id AND l.f = b.f)"
            )
            parts.append(
                f"SELECT {r} AS tree, node, feature, edge, {r6('gain', 5)} AS gain, {r6('ah', 5)} AS curvature, CAST(NULL AS DOUBLE) AS weight FROM b{r}_{level}"
            )
        last = f"t{r}_{depth}" if rounds else f"t{r}_1"
        steps.append(
            f"w{r} AS MATERIALIZED (SELECT node, sum(dh) AS ah, -{rate!r}::DOUBLE * sum(dg) / (sum(dh) + {penalty!r}::DOUBLE) AS weight FROM {last} GROUP BY node)"
        )
        steps.append(f"m{r} AS MATERIALIZED (SELECT person_id, y, margin + weight AS margin FROM {last} JOIN w{r} USING (node))")
        parts.append(
            f"SELECT {r} AS tree, node, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS edge, CAST(NULL AS DOUBLE) AS gain, "
            f"{r6('ah', 5)} AS curvature, {r6('weight', 5)} AS weight FROM w{r}"
        )
    wanted = " UNION ALL ".join(parts) if rounds else f"SELECT feature, edge, {r6('gain', 5)} AS gain FROM g1_0"
    return f"{', '.join(steps)} {wanted}"


def _mixed_moments() -> str:
    """Observed side of the score equations: sum of y times each term over the complete rows of a model."""
    parts = []
    for label, y in cl.OUTCOMES.items():
        for model, terms in (("Model 1", cl.REDUCED_TERMS), ("Model 2", cl.FULL_TERMS)):
            known = " AND ".join(f"{c} IS NOT NULL" for c in (y, cl.CLUSTER, *terms))
            parts += [
                f"SELECT '{label}' AS dv_label, '{model}' AS model, '{name}' AS term, {r6(f'CAST(sum({y} * {x}) AS DOUBLE)', 1)} AS moment "
                f"FROM modelled WHERE {known}"
                for name, x in (("(Intercept)", "1"), *((t, t) for t in terms))
            ]
    return sql(" UNION ALL ".join(parts), "modelled")


def _stated_curve() -> str:
    """Curve over age by exposure from stated coefficients with independent errors, other terms at their means."""
    terms = (cl.EXPOSURE, "age", "race_White", f"{cl.EXPOSURE}:age")
    b = stated_beta(terms)
    spread = [0.01 * (i + 1) / (900 if t == "age" or ":" in t else 1) for i, t in enumerate(("", *terms))]
    x = ["1", "level", "x", "white", "level * x"]
    eta = " + ".join(f"{v!r} * {t}" for v, t in zip(b, x))
    var = " + ".join(f"{v!r} * pow({t}, 2)" for v, t in zip(spread, x))
    logit = "1 / (1 + exp(-({})))"
    return sql(
        f"SELECT x, CASE WHEN level = 1 THEN 'Positive' ELSE 'Negative' END AS \"group\", {r6(logit.format('eta'))} AS predicted, "
        f"{r6(logit.format('eta - 1.96 * sqrt(var)'))} AS conf_low, {r6(logit.format('eta + 1.96 * sqrt(var)'))} AS conf_high "
        f"FROM (SELECT *, {eta} AS eta, {var} AS var FROM (SELECT DISTINCT CAST(age AS DOUBLE) AS x FROM modelled WHERE age IS NOT "
        "NULL), (VALUES (0.0), (1.0)) l(level), (SELECT avg(race_White) AS white FROM modelled))",
        "modelled",
    )


EMBEDDING_NAMES = tuple(f"e{i}" for i in range(64))


def _smote(steps: str, source: str, features, by, k: int = 5, seed: int = 42) -> str:
    """Synthetic points by comparing all pairs of value patterns of a class."""
    names, klass = ", ".join(features), ", ".join(by)
    known = " AND ".join(f"{c} IS NOT NULL" for c in (*features, *by))
    x = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in features) + "]"
    same = " AND ".join(f"a.{b} = b.{b}" for b in by)
    text = "array_to_string(list_transform(x, lambda v: CAST(CAST(round(v * 1000000) AS BIGINT) AS VARCHAR)), '|')"
    share = "CAST('0x' || substr(md5(concat_ws('|', CAST(pid AS VARCHAR), CAST(copy AS VARCHAR), '{seed}')), 1, 10) AS BIGINT)"
    pick, along = (f"{share.format(seed=v)} / {float(1 << 40)!r}" for v in (seed, seed + 1))
    values = ", ".join(
        f"{r6(f'x[{i}] + (partner[{i}] - x[{i}]) * along')} AS {f}" for i, f in enumerate(features, start=1)
    )
    return (
        f"{steps.strip()}, rows_ AS (SELECT {klass}, {names} FROM {source} WHERE {known}), "
        f"sizes AS (SELECT {klass}, count(*) AS n, max(count(*)) OVER () AS largest FROM rows_ GROUP BY {klass}), "
        f"raw AS (SELECT {klass}, {x} AS x, count(*) AS m FROM rows_ JOIN sizes USING ({klass}) WHERE n < largest "
        f"GROUP BY {klass}, {names}), "
        f"points AS (SELECT *, row_number() OVER (PARTITION BY {klass} ORDER BY md5({text} || '|{seed}')) - 1 AS pid FROM raw), "
        f"planned AS (SELECT points.*, n, largest - n AS fresh, least({k}, n - 1) AS k, coalesce(sum(m) OVER (PARTITION BY {klass} "
        f"ORDER BY pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM points JOIN sizes USING ({klass})), "
        "ready AS (SELECT *, CAST(m * (fresh // n) + greatest(least(fresh % n - start, m), 0) AS BIGINT) AS copies FROM planned), "
        f"pairs AS (SELECT {', '.join(f'a.{b}' for b in by)}, a.pid, b.pid AS nid, b.m AS nm, b.x AS nx, a.k, list_sum("
        "list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM ready a "
        f"JOIN ready b ON {same} AND a.pid <> b.pid), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {klass}, pid ORDER BY d2, nid) AS rank FROM pairs), "
        f"near AS (SELECT {klass}, pid, nx, sum(nm) OVER (PARTITION BY {klass}, pid ORDER BY rank) AS upto FROM ranked WHERE rank <= k), "
        f"lists AS (SELECT {klass}, pid, list({{'upto': upto, 'x': nx}} ORDER BY upto) AS near FROM near GROUP BY {klass}, pid), "
        f"single AS (SELECT ready.*, near, unnest(range(copies)) AS copy FROM ready LEFT JOIN lists USING ({klass}, pid)), "
        f"drawn AS (SELECT *, CAST(floor({pick} * k) AS BIGINT) - (m - 1) AS pick, {along} AS along FROM single), "
        "mixed AS (SELECT *, CASE WHEN pick < 0 THEN x ELSE coalesce(list_filter(near, lambda e: e.upto > pick)[1].x, x) END "
        f"AS partner FROM drawn) SELECT {klass}, {values} FROM mixed"
    )


def _observed_moments(target: str, features, source: str, where: str) -> str:
    rows = [f"SELECT '(Intercept)' AS term, {r6(f'sum({target})', 1)} AS moment FROM {source} WHERE {where}"]
    rows += [
        f"SELECT '{f}' AS term, {r6(f'sum({target} * {f})', 1)} AS moment FROM {source} WHERE {where}" for f in features
    ]
    return " UNION ALL ".join(rows)


def _ecdf(column: str) -> str:
    t = cl.EXPOSURE
    gaps = (
        f"SELECT abs((SELECT count(*) FILTER ({t} = 1 AND m.{column} <= v.x) / count(*) FILTER ({t} = 1) FROM modelled m) - "
        f"(SELECT count(*) FILTER ({t} = 0 AND m.{column} <= v.x) / count(*) FILTER ({t} = 0) FROM modelled m)) AS gap "
        f"FROM (SELECT DISTINCT {column} AS x FROM modelled) v"
    )
    return (
        f"SELECT '{column}' AS covariate, {r6('CASE WHEN count(*) <= 2 THEN max(gap) ELSE avg(gap) END')} AS ecdf_mean, "
        f"{r6('max(gap)')} AS ecdf_max FROM ({gaps})"
    )


_STRATA = (
    "strata AS (SELECT race_White, OBESITY_1y_during_1y_prior_to_1st_delivery_indicator, "
    f"avg({cl.EXPOSURE}) AS distance FROM modelled GROUP BY 1, 2), "
    f"weighted AS (SELECT *, CASE WHEN {cl.EXPOSURE} = 1 THEN 1 / distance ELSE 1 / (1 - distance) END AS w "
    "FROM modelled JOIN strata USING (race_White, OBESITY_1y_during_1y_prior_to_1st_delivery_indicator))"
)


def _weighted_mean(column: str, level: int, weight: str) -> str:
    here = f"FILTER ({cl.EXPOSURE} = {level})"
    return f"sum({column} * {weight}) {here} / sum({weight}) {here}"


def _weighted_variance(column: str, level: int, weight: str) -> str:
    here = f"FILTER ({cl.EXPOSURE} = {level})"
    total = f"sum({weight}) {here}"
    spread = f"sum({column} * {column} * {weight}) {here} / {total} - pow({_weighted_mean(column, level, weight)}, 2)"
    return f"({spread}) / (1 - sum({weight} * {weight}) {here} / pow({total}, 2))"


def _balance(column: str, stage: str) -> str:
    weight = "1.0" if stage == "before" else "w"
    binary = column not in ("age", "total_visits", "total_number_of_COVID_vaccine_doses")
    p = f"avg({column}) FILTER ({cl.EXPOSURE} = 1)"
    sd = f"sqrt({p} * (1 - {p}))" if binary else f"stddev_samp({column}) FILTER ({cl.EXPOSURE} = 1)"
    return (
        f"SELECT '{column}' AS covariate, '{stage}' AS stage, {r6('m1')} AS mean_treated, {r6('m0')} AS mean_control, "
        f"{r6('(m1 - m0) / sd')} AS smd, {r6('abs((m1 - m0) / sd)')} AS abs_smd, abs((m1 - m0) / sd) < 0.1 AS ok, "
        f"{'CAST(NULL AS DOUBLE)' if binary else r6('v1 / v0')} AS variance_ratio FROM "
        f"(SELECT {_weighted_mean(column, 1, weight)} AS m1, {_weighted_mean(column, 0, weight)} AS m0, {sd} AS sd, "
        f"{_weighted_variance(column, 1, weight)} AS v1, {_weighted_variance(column, 0, weight)} AS v0 "
        "FROM weighted)"
    )


def model_texts() -> dict[str, str]:
    out: dict[str, str] = {}
    lung = ["age", *[c for c in cl.COMORBIDITIES if c != cl.LUNG], cl.MORTALITY, "sex_privilege", "race_privilege"]
    out["lr_lung"] = sql(_observed_moments(cl.LUNG, lung, "flagged_groups", "true"), "flagged_groups")
    out["cross_validation_moments"] = _fold_moments(lung)
    out["permutation_stated"] = _permutation(lung)
    out["boosted_first_gains"] = _boosting(lung)
    out["boosted_trees"] = _boosting(lung, rounds=3)
    death = [*cl.COMORBIDITIES, "sex_privilege", "race_privilege", "age"]
    out["lr_mortality"] = sql(
        _observed_moments(cl.MORTALITY, death, "flagged_groups", "true"), "flagged_groups"
    )
    out["propensity"] = sql(_observed_moments(cl.EXPOSURE, cl.MATCH_COVARIATES, "modelled", "true"), "modelled")
    split = f"CASE WHEN {hash_uniform('person_id')} < 0.8 THEN 'train' ELSE 'test' END"
    out["hash_split"] = sql(
        f"SELECT {split} AS split, count(*) AS n_rows FROM flagged_groups GROUP BY 1", "flagged_groups"
    )

    def loglik(hit: str, total: str) -> str:
        return (
            f"CASE WHEN {hit} > 0 THEN {hit} * ln({hit} / {total}) ELSE 0 END + "
            f"CASE WHEN {total} - {hit} > 0 THEN ({total} - {hit}) * ln(({total} - {hit}) / {total}) ELSE 0 END"
        )

    chi = f"2 * ({loglik('y0', 'n0')} + {loglik('y1', 'n1')} - ({loglik('(y0 + y1)', '(n0 + n1)')}))"
    tests = " UNION ALL ".join(
        f"SELECT '{label}' AS dv_label, greatest({chi}, 0) AS x FROM (SELECT "
        + ", ".join(
            f"CAST(count(*) FILTER ({cl.EXPOSURE} = {k}) AS DOUBLE) AS n{k}, "
            f"CAST(count(*) FILTER ({cl.EXPOSURE} = {k} AND {y} = 1) AS DOUBLE) AS y{k}"
            for k in (0, 1)
        )
        + " FROM modelled)"
        for label, y in cl.OUTCOMES.items()
    )
    out["likelihood_ratio"] = sql(
        "SELECT dv_label, round(x, 2) + 0.0 AS chi_sq, 1 AS df_diff, "
        f"{r6('p')} AS p_val, CASE WHEN p < 0.001 THEN '< 0.001' ELSE printf('%.4f', p) END AS p_val_str FROM "
        f"(SELECT *, {normal_two_sided('sqrt(x)')} AS p FROM ({tests}))",
        "modelled",
    )
    out["leakage_table"] = sql(
        "SELECT y_pred, n_0, n_1, CAST(n_1 > n_0 AS INT) AS best_guess, "
        f"{r6('greatest(n_0, n_1) / (n_0 + n_1)')} AS guess_accuracy FROM (SELECT y_pred, count(*) FILTER "
        "(race_privilege = 0) AS n_0, count(*) FILTER (race_privilege = 1) AS n_1 FROM scored GROUP BY y_pred)",
        "scored",
    )
    out["smote"] = _smote(sql("", "flagged_groups"), "flagged_groups", [*lung], [cl.LUNG])
    out["smote_by_group"] = _smote(
        sql("", "flagged_groups"), "flagged_groups", [c for c in lung if c != "race_privilege"], [cl.LUNG, "race_privilege"]
    )
    wide = ", ".join(f"embedding[{i + 1}] AS {n}" for i, n in enumerate(EMBEDDING_NAMES))
    out["smote_embeddings"] = _smote(f"WITH wide AS (SELECT label, {wide} FROM embeddings)", "wide", EMBEDDING_NAMES, ["label"])
    stages = []
    for stage, column in (("before", "y_pred"), ("after", "CAST(score >= 0.6 AS INT)")):
        cells = (
            f"SELECT race_privilege, y, {column} AS p FROM scored"
        )
        rates = (
            "SELECT race_privilege, avg(p) AS ppp, avg(p) FILTER (y = 1) AS tpr, avg(p) FILTER (y = 0) AS fpr "
            f"FROM ({cells}) GROUP BY 1"
        )
        stages.append(
            f"SELECT '{stage}' AS stage, count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp, "
            "count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp, "
            f"{r6('avg(CAST(y = p AS INT))')} AS accuracy, "
            f"(SELECT {r6('max(ppp) - min(ppp)')} FROM ({rates})) AS demographic_parity_difference, "
            f"(SELECT {r6('greatest(max(tpr) - min(tpr), max(fpr) - min(fpr))')} FROM ({rates})) AS "
            f"equalized_odds_difference FROM ({cells})"
        )
    out["before_after"] = sql(" UNION ALL ".join(stages), "scored")
    base = sql("", "modelled").strip().replace("WITH ", "WITH RECURSIVE ", 1)
    out["match_allocation"] = (
        f"{base}, units AS (SELECT person_id AS id, {cl.EXPOSURE} AS t, {RISK_POINTS} AS s FROM modelled), "
        "treated AS (SELECT id, s, row_number() OVER (ORDER BY s DESC, id) AS i FROM units WHERE t = 1), "
        "controls AS (SELECT list({'s': s, 'id': id} ORDER BY s, id) AS free FROM units WHERE t = 0), "
        "steps AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS ts, CAST(NULL AS DOUBLE) AS cs, free FROM controls "
        "UNION ALL SELECT t.i, t.s, c.best.s, list_filter(p.free, lambda x: x.id <> c.best.id) FROM steps p "
        "JOIN treated t ON t.i = p.i + 1, LATERAL (SELECT list_reduce(p.free, lambda a, b: CASE WHEN abs(b.s - t.s) < "
        "abs(a.s - t.s) THEN b ELSE a END) AS best) c WHERE len(p.free) > 0) "
        "SELECT ts AS treated_score, cs AS control_score, count(*) AS n_pairs FROM steps WHERE i > 0 GROUP BY 1, 2"
    )
    out["match_pairs_stated"] = (
        f"{base}, units AS (SELECT person_id AS id, {cl.EXPOSURE} AS t, {RISK_POINTS} + {hash_uniform('person_id')} AS s FROM modelled), "
        "treated AS (SELECT id, s, row_number() OVER (ORDER BY s DESC) AS i FROM units WHERE t = 1), "
        "controls AS (SELECT list({'s': s, 'id': id} ORDER BY s) AS free FROM units WHERE t = 0), "
        "steps AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS tid, CAST(NULL AS BIGINT) AS cid, CAST(NULL AS DOUBLE) AS ts, "
        "CAST(NULL AS DOUBLE) AS cs, free FROM controls UNION ALL SELECT t.i, t.id, c.best.id, t.s, c.best.s, "
        "list_filter(p.free, lambda x: x.id <> c.best.id) FROM steps p "
        "JOIN treated t ON t.i = p.i + 1, LATERAL (SELECT list_reduce(p.free, lambda a, b: CASE WHEN abs(b.s - t.s) < "
        "abs(a.s - t.s) THEN b ELSE a END) AS best) c WHERE len(p.free) > 0) "
        f"SELECT tid AS treated_id, cid AS control_id, {r6('ts')} AS treated_score, {r6('cs')} AS control_score FROM steps WHERE i > 0"
    )
    matched = f"least(count(*) FILTER ({cl.EXPOSURE} = 1), count(*) FILTER ({cl.EXPOSURE} = 0))"
    sides = {"treated": f"count(*) FILTER ({cl.EXPOSURE} = 1)", "control": f"count(*) FILTER ({cl.EXPOSURE} = 0)"}
    out["match_sizes"] = sql(
        f"SELECT 'all' AS stage, {', '.join(f'{n} AS {k}' for k, n in sides.items())} FROM modelled UNION ALL "
        f"SELECT 'matched', {matched}, {matched} FROM modelled UNION ALL "
        f"SELECT 'unmatched', {', '.join(f'{n} - {matched}' for n in sides.values())} FROM modelled",
        "modelled",
    )
    out["glmm_likelihood"] = _likelihoods()
    out["glmm_moments"] = _mixed_moments()
    out["stated_curve"] = _stated_curve()
    out["ecdf_distances"] = sql(" UNION ALL ".join(_ecdf(c) for c in cl.MATCH_COVARIATES), "modelled")
    weighted = sql("", "modelled").strip() + ", " + _STRATA
    out["balance_table"] = f"{weighted} " + " UNION ALL ".join(
        _balance(c, stage) for stage in ("before", "after") for c in cl.MATCH_COVARIATES
    )
    out["ipw_rates"] = f"{weighted} " + " UNION ALL ".join(
        f"SELECT '{o}' AS outcome, {r6('a')} AS rate_exposed, {r6('b')} AS rate_unexposed, {r6('a - b')} AS difference FROM "
        f"(SELECT {_weighted_mean(o, 1, 'w')} AS a, {_weighted_mean(o, 0, 'w')} AS b FROM weighted)"
        for o in cl.OUTCOMES.values()
    )
    return out


def texts() -> dict[str, str]:
    return {**core_texts(), **model_texts()}
