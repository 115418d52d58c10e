"""Clinical views over the star-schema test tables.

Every view is a projection built from SQL expressions that mean the same in Spark and in DuckDB, so
the oracle texts in ``natalis.oracle`` are generated from the same dictionaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.plans.clinical import COMORBIDITIES
from natalis.sources.store import read_table

# One row per order stands for one record of a person on a day.
FACT_DAY = {
    "person_id": "o_custkey",
    "date": "CAST(o_orderdate AS DATE)",
    "delivery_record_only": "CAST(o_orderpriority = '1-URGENT' AS INT)",
    "number_given_birth": "CAST(o_orderpriority = '2-HIGH' AS INT)",
    "pregnancy": "CAST(o_totalprice > 100000 AS INT)",
    "delivery_mode_caesarean": "CAST(o_orderstatus = 'O' AS INT)",
    "depression": "CAST(o_orderstatus = 'F' AS INT)",
    "preeclampsia": "CAST(o_orderstatus = 'P' AS INT)",
    "eclampsia": "CAST(o_orderkey % 11 = 0 AS INT)",
    "LL_COVID_diagnosis": "CAST(o_orderkey % 5 = 0 AS INT)",
    "hypertension": "CAST(o_orderkey % 7 = 0 AS INT)",
    "OBESITY": "CAST(o_orderkey % 3 = 0 AS INT)",
    "chronic_lung_disease": "CAST(o_orderkey % 13 = 0 AS INT)",
    "tobacco_smoker": "CAST(o_orderkey % 17 = 0 AS INT)",
    "diabetes": "CAST(o_orderkey % 19 = 0 AS INT)",
    "diabetes_complicated": "CAST(o_orderkey % 23 = 0 AS INT)",
    "ectopic_pregnancy": "CAST(o_orderkey % 29 = 0 AS INT)",
    "maternal_obesity": "CAST(o_orderkey % 9 = 0 AS INT)",
    "psychosis": "CAST(o_orderkey % 31 = 0 AS INT)",
    "patient_death_at_visit": "CAST(o_orderkey % 101 = 0 AS INT)",
    "BMI_rounded": "CAST(round(o_totalprice / 12500.0) AS INT)",
    "had_vaccine_administered": "CAST(o_orderkey % 4 = 0 AS INT)",
}

PERSON = {
    "person_id": "c_custkey",
    "age": "CAST(15 + c_custkey % 50 AS INT)",
    "sex": "CASE WHEN c_custkey % 10 = 0 THEN 'MALE' WHEN c_custkey % 37 = 0 THEN 'No matching concept' "
    "ELSE 'FEMALE' END",
    "race": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White' WHEN 'BUILDING' THEN 'Black or African American' "
    "WHEN 'FURNITURE' THEN 'Asian' WHEN 'HOUSEHOLD' THEN 'Hispanic or Latino' ELSE 'Unknown' END",
    "race_ethnicity": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White Non-Hispanic' "
    "WHEN 'HOUSEHOLD' THEN 'Hispanic or Latino Any Race' ELSE 'Other Non-Hispanic' END",
    "data_partner_id": "c_nationkey",
}

DEATHS = {"person_id": "c_custkey", "patient_death": "CAST(c_acctbal < 0 AS INT)"}

# The wide summary of the classification chain: person attributes, BMI and one 0/1 column per
# comorbidity, which is the k-th odd divisor from 7 on; men and women are both common here.
WIDE_PERSON = {
    "person_id": "c_custkey",
    "age": "CAST(c_custkey % 90 AS INT)",
    "sex": "CASE WHEN c_custkey % 37 = 0 THEN 'No matching concept' WHEN c_custkey % 2 = 0 THEN 'MALE' "
    "ELSE 'FEMALE' END",
    "race": PERSON["race"],
    "race_ethnicity": PERSON["race_ethnicity"],
    "patient_death_indicator": "CAST(c_acctbal < 0 AS INT)",
}


def wide_indicator(k: int) -> str:
    return f"CAST(o_orderkey % {7 + 2 * k} = 0 AS INT)"


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def fact_day(spark: SparkSession, base: str) -> DataFrame:
    return _project(read_table(spark, base, "orders"), FACT_DAY)


def person(spark: SparkSession, base: str) -> DataFrame:
    visits = read_table(spark, base, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    customers = read_table(spark, base, "customer").join(visits, F.col("c_custkey") == F.col("o_custkey"), "left")
    return _project(customers, {**PERSON, "total_visits": "COALESCE(n_orders, 0)"})


def deaths(spark: SparkSession, base: str) -> DataFrame:
    return _project(read_table(spark, base, "customer"), DEATHS)


def patient_summary_wide(spark: SparkSession, base: str) -> DataFrame:
    """One row per person with ``age``, BMI, demographics, comorbidity flags and the death flag."""
    flags = (
        read_table(spark, base, "orders")
        .groupBy("o_custkey")
        .agg(
            F.expr("max(o_totalprice / 12500.0)").alias("BMI_max_observed_or_calculated"),
            *[F.expr(f"max({wide_indicator(k)}) AS {name}") for k, name in enumerate(COMORBIDITIES)],
        )
    )
    customers = read_table(spark, base, "customer").join(flags, F.col("c_custkey") == F.col("o_custkey"), "left")
    columns = {
        **WIDE_PERSON,
        "BMI_max_observed_or_calculated": "BMI_max_observed_or_calculated",
        **{name: f"COALESCE({name}, 0)" for name in COMORBIDITIES},
    }
    return _project(customers, columns)


SCORED = {
    "doc_id": "doc_id",
    "y": "quality",
    "score": "CAST(n_chars % 97 AS DOUBLE) / 100.0 + quality * 0.2",
    "y_pred": "CAST(n_chars % 97 + quality * 20 >= 50 AS INT)",
    "sex_privilege": "CAST(doc_id % 2 AS INT)",
    "race_privilege": "CAST(lang = 'en' AS INT)",
    "source": "source",
}


def scored_documents(spark: SparkSession, base: str) -> DataFrame:
    """Labels with a fixed score and a thresholded prediction: metric input that needs no model."""
    joined = read_table(spark, base, "labels").join(read_table(spark, base, "documents").drop("text"), "doc_id")
    return _project(joined, SCORED)
