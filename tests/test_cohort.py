from datetime import date, timedelta

from pyspark.sql import functions as F

from natalis.operators import cohort, filters, flags
from natalis.plans.clinical import DAYS_280, YEAR

SCHEMA = (
    "person_id int, date date, delivery_record_only int, number_given_birth int, pregnancy int, "
    "a int, b int, BMI_rounded int, had_vaccine_administered int"
)


def labels(spark, index, day, value, window):
    row = spark.createDataFrame([(index, day, value)], "first_delivery_date date, date date, a int")
    return row.select(flags.window_label("a", window).alias("v")).first()["v"]


def test_window_borders(spark):
    index = date(2021, 6, 15)
    cases = [
        (date(2020, 6, 14), YEAR, "before_1y_prior_to_1st_delivery"),
        (date(2020, 6, 15), YEAR, "during_1y_prior_to_1st_delivery"),
        (date(2021, 6, 14), YEAR, "during_1y_prior_to_1st_delivery"),
        (index, YEAR, "during_1y_postpartum"),
        (date(2022, 6, 15), YEAR, "during_1y_postpartum"),
        (date(2022, 6, 16), YEAR, "undefined"),
        (index - timedelta(days=281), DAYS_280, "before_280d_prior_to_1st_delivery"),
        (index - timedelta(days=280), DAYS_280, "during_280d_prior_to_1st_delivery"),
        (date(2022, 6, 14), DAYS_280, "during_1y_postpartum"),
        (date(2022, 6, 15), DAYS_280, "undefined"),
        (None, YEAR, "undefined"),
    ]
    for day, window, want in cases:
        assert labels(spark, index, day, 1, window) == want, (day, window.tag)
    assert labels(spark, index, index, 0, YEAR) == "no"
    assert labels(spark, index, index, None, YEAR) == "undefined"
    assert labels(spark, index, index, 2, YEAR) == "undefined"
    assert labels(spark, None, index, 1, YEAR) == "undefined"


def test_leap_day_clamps_to_month_end(spark):
    assert labels(spark, date(2024, 2, 29), date(2023, 2, 28), 1, YEAR) == "during_1y_prior_to_1st_delivery"
    assert labels(spark, date(2023, 2, 28), date(2024, 2, 29), 1, YEAR) == "undefined"


def fixture(spark, copies=1):
    """Person 1 is heavy: many days and every row several times. Person 3 has no delivery, 4 no date."""
    start = date(2019, 1, 1)
    rows = [
        (1, start + timedelta(days=i), int(i in (700, 900)), 0, 1, int(i % 97 == 0), int(i % 50 == 0), i % 40, i % 3 % 2)
        for i in range(1200)
    ] * copies
    rows += [(2, date(2020, 1, 1), 1, 0, 1, 1, None, None, 1), (2, date(2019, 6, 1), 0, 1, 1, 0, 1, 30, None)]
    rows += [(3, date(2020, 1, 1), 0, 1, 1, 1, 1, 20, 1), (4, None, 1, 0, 1, 1, 1, 25, 1)]
    rows += [(5, date(2020, 1, 1), 1, 0, 0, 1, 1, 22, 1), (None, date(2020, 1, 1), 1, 0, 1, 1, 1, 22, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_fused_rollup_equals_labels_and_dummies(spark):
    for copies in (1, 5):
        facts = fixture(spark, copies)
        plain = cohort.indicator_rollup(flags.flag_windows(cohort.index_cohort(facts), ["a", "b"]), ["a", "b"])
        fused = cohort.fused_rollup(facts, ["a", "b"])
        assert fused.columns == plain.columns
        assert sorted(map(str, fused.collect())) == sorted(map(str, plain.collect()))
        assert {r["person_id"] for r in fused.collect()} == {1, 2, 4}
    unique = cohort.fused_rollup(fixture(spark), ["a", "b"], unique_days=True)
    assert sorted(map(str, unique.collect())) == sorted(map(str, cohort.fused_rollup(fixture(spark), ["a", "b"]).collect()))


def test_more_conditions_than_bits_in_a_mask(spark):
    names = [f"c{i}" for i in range(130)]
    facts = fixture(spark).withColumns({n: (F.dayofyear("date") % (i + 2) == 0).cast("int") for i, n in enumerate(names)})
    fused = cohort.fused_rollup(facts, names)
    plain = cohort.indicator_rollup(flags.flag_windows(cohort.index_cohort(facts), names[120:]), names[120:])
    both = plain.select(*plain.columns[:-2])
    assert sorted(map(str, fused.select(*both.columns).collect())) == sorted(map(str, both.collect()))


def test_fused_plan_has_no_join_and_two_exchanges(spark):
    plan = cohort.fused_rollup(fixture(spark), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    once = cohort.fused_rollup(fixture(spark), ["a", "b"], unique_days=True)._jdf.queryExecution().executedPlan().toString()
    assert once.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    fixture(spark).write.parquet(path)
    facts = spark.read.parquet(path)
    plan = cohort.fused_rollup(facts, ["a"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema:")[0]
    assert "EqualTo(pregnancy,1)" in pushed and "IsNotNull(person_id)" in pushed
    assert "number_given_birth" not in pushed
    schema = plan.split("ReadSchema:")[1]
    assert "number_given_birth" not in schema and "b:int" not in schema


def test_index_join_keeps_heavy_person_spread(spark):
    facts = fixture(spark, 3)
    merged = cohort.index_cohort(facts)
    assert merged.filter("person_id = 1").count() == 3600
    assert merged.filter("person_id = 1").select("first_delivery_date").distinct().count() == 1
    assert merged.filter("person_id = 3 OR person_id = 5").count() == 0


def test_null_history_keeps_the_outcome(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 0)], "y int, h int")
    got = [r["z"] for r in cohort.exclude_prior(df, {"z": ("y", "h")}).collect()]
    assert got == [None, 1, 0]


def test_duplicate_deaths_do_not_multiply_rows(spark):
    rolled = spark.createDataFrame([(1, 1)], "person_id int, x int")
    people = spark.createDataFrame([(1, 30, "FEMALE"), (2, 17, "FEMALE"), (3, 30, "MALE")], "person_id int, age int, sex string")
    deaths = spark.createDataFrame([(1, 0), (1, 1)], "person_id int, patient_death int")
    rows = cohort.enrich(rolled, people, deaths).collect()
    assert len(rows) == 1 and rows[0]["patient_death_indicator"] == 1


def test_flow_report_counts_rows_and_persons(spark):
    report = filters.flow_report(
        fixture(spark, 2), {"all": F.lit(True), "cohort": F.col("pregnancy") == 1, "index": F.col("delivery_record_only") == 1}
    )
    got = [(r["step"], r["n_rows"], r["n_persons"]) for r in report.orderBy("step_no").collect()]
    assert got == [("all", 2406, 5), ("cohort", 2405, 4), ("index", 7, 3)]
