"""Default clinical vocabulary. Operators take all of this as arguments; nothing is hard-wired."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EventColumns:
    """Names of the person-day table that the cohort operators need."""

    person: str = "person_id"
    date: str = "date"
    index_flag: str = "delivery_record_only"
    cohort_flag: str = "pregnancy"
    any_flags: tuple[str, ...] = ("delivery_record_only", "number_given_birth", "pregnancy")
    index_date: str = "first_delivery_date"


@dataclass(frozen=True)
class LabelWindow:
    """A window family around the index date: long before, shortly before, within a year after."""

    tag: str
    lower_column: str
    months_before: int = 0
    days_before: int = 0
    months_after: int = 12
    upper_column: str = "_1y_after_1st_delivery"
    post_inclusive: bool = True

    @property
    def before(self) -> str:
        return f"before_{self.tag}_prior_to_1st_delivery"

    @property
    def during(self) -> str:
        return f"during_{self.tag}_prior_to_1st_delivery"

    @property
    def after(self) -> str:
        return "during_1y_postpartum"

    @property
    def labels(self) -> tuple[str, str, str]:
        return (self.before, self.during, self.after)


EVENTS = EventColumns()
# The yearly family closes its postpartum window on the right, the 280-day family leaves it open.
YEAR = LabelWindow(tag="1y", lower_column="_1y_prior_1st_delivery", months_before=12, post_inclusive=True)
DAYS_280 = LabelWindow(tag="280d", lower_column="_280d_prior_1st_delivery", days_before=280, post_inclusive=False)
WINDOWS = (YEAR, DAYS_280)

FIRST_CONDITION = "delivery_mode_caesarean"
LAST_CONDITION = "patient_death_at_visit"

# Names and levels that the result tables must carry.
BASE_COLUMNS = ("person_id", "total_visits", "sex", "age", "race", "race_ethnicity", "data_partner_id")
HISTORY_COLUMNS = {
    "postpartum_depression": "depression_1y_during_1y_postpartum_indicator",
    "depression_hist_1y_prior": "depression_1y_during_1y_prior_to_1st_delivery_indicator",
    "depression_hist_280d_prior": "depression_280d_during_280d_prior_to_1st_delivery_indicator",
    "preeclampsia_hist_1y_prior": "preeclampsia_1y_during_1y_prior_to_1st_delivery_indicator",
    "preeclampsia_hist_280d_prior": "preeclampsia_280d_during_280d_prior_to_1st_delivery_indicator",
    "postpartum_csection": "delivery_mode_caesarean_1y_during_1y_postpartum_indicator",
    "csection_hist_1y_prior": "delivery_mode_caesarean_1y_during_1y_prior_to_1st_delivery_indicator",
    "csection_hist_280d_prior": "delivery_mode_caesarean_280d_during_280d_prior_to_1st_delivery_indicator",
    "covid_diag_hist_1y_prior": "LL_COVID_diagnosis_1y_during_1y_prior_to_1st_delivery_indicator",
    "covid_diag_hist_280d_prior": "LL_COVID_diagnosis_280d_during_280d_prior_to_1st_delivery_indicator",
}
# new column -> (outcome, prior history that excludes the person from it)
INCIDENT_OUTCOMES = {
    "postpartum_depression_main": ("postpartum_depression", "depression_hist_1y_prior"),
    "postpartum_csection_main": ("postpartum_csection", "csection_hist_1y_prior"),
    "postpartum_depression_sens": ("postpartum_depression", "depression_hist_280d_prior"),
    "postpartum_csection_sens": ("postpartum_csection", "csection_hist_280d_prior"),
}
RACE_RECODE = {
    "Black or African American": "Black_or_African_American",
    "Hispanic or Latino": "Other",
    "Native Hawaiian or Other Pacific Islander": "Other",
    "American Indian or Alaska Native": "Other",
}
RACE_LEVELS = ("White", "Asian", "Black_or_African_American", "Other", "Unknown")
SEX_LEVELS = ("FEMALE", "MALE")
COMMON_RACES = ("White", "Asian", "Black or African American", "Unknown")

_PRIOR = {
    "1y_prior_to_1st_delivery": "1y_during_1y_prior_to_1st_delivery_indicator",
    "before__1y_prior_to_1st_delivery": "1y_before_1y_prior_to_1st_delivery_indicator",
    "280d_before_prior_to_1st_delivery": "280d_before_280d_prior_to_1st_delivery_indicator",
    "280d_during_prior_to_1st_delivery": "280d_during_280d_prior_to_1st_delivery_indicator",
}


def combined_indicators(name: str, components: tuple[str, ...]) -> dict[str, list[str]]:
    """The four ``<name>_any_*`` columns of a disease group and the indicators each is made from."""
    return {f"{name}_any_{new}": [f"{part}_{old}" for part in components] for new, old in _PRIOR.items()}


EXPOSURE = "LL_COVID_diagnosis_1y_during_1y_prior_to_1st_delivery_indicator"
PRE_ECLAMPSIA = "pre_eclampsia_combined_1y_during_1y_prior_to_1st_delivery_indicator"
DIABETES = "diabetes_combined_1y_during_1y_prior_to_1st_delivery_indicator"
COMBINED = {
    PRE_ECLAMPSIA: [
        "preeclampsia_1y_during_1y_prior_to_1st_delivery_indicator",
        "eclampsia_1y_during_1y_prior_to_1st_delivery_indicator",
    ],
    DIABETES: [
        "diabetes_1y_during_1y_prior_to_1st_delivery_indicator",
        "diabetes_complicated_1y_during_1y_prior_to_1st_delivery_indicator",
    ],
}
OUTCOMES = {
    "postpartum depression": "postpartum_depression",
    "C-section": "postpartum_csection",
    "(Pre)eclampsia": PRE_ECLAMPSIA,
}
REDUCED_TERMS = (EXPOSURE, "age", "race_White")
ADJUSTING_TERMS = (
    "total_number_of_COVID_vaccine_doses",
    "OBESITY_1y_during_1y_prior_to_1st_delivery_indicator",
    "hypertension_1y_during_1y_prior_to_1st_delivery_indicator",
    "chronic_lung_disease_1y_during_1y_prior_to_1st_delivery_indicator",
    "tobacco_smoker_1y_during_1y_prior_to_1st_delivery_indicator",
    DIABETES,
    "total_visits",
)
FULL_TERMS = REDUCED_TERMS + ADJUSTING_TERMS
MATCH_COVARIATES = ("age", "race_White") + ADJUSTING_TERMS
CLUSTER = "data_partner_id"

LUNG = "CHRONICLUNGDISEASE_indicator"
MORTALITY = "patient_death_indicator"
# The comorbidity and treatment flags of the wide patient summary, in table order.
COMORBIDITIES = (
    "OBESITY_indicator",
    "PREGNANCY_indicator",
    "TOBACCOSMOKER_indicator",
    "CARDIOMYOPATHIES_indicator",
    "CEREBROVASCULARDISEASE_indicator",
    "CHRONICLUNGDISEASE_indicator",
    "CONGESTIVEHEARTFAILURE_indicator",
    "CORONARYARTERYDISEASE_indicator",
    "DEMENTIA_indicator",
    "DEPRESSION_indicator",
    "DIABETESCOMPLICATED_indicator",
    "DIABETESUNCOMPLICATED_indicator",
    "DOWNSYNDROME_indicator",
    "HEARTFAILURE_indicator",
    "HEMIPLEGIAORPARAPLEGIA_indicator",
    "HIVINFECTION_indicator",
    "HYPERTENSION_indicator",
    "KIDNEYDISEASE_indicator",
    "MALIGNANTCANCER_indicator",
    "METASTATICSOLIDTUMORCANCERS_indicator",
    "MILDLIVERDISEASE_indicator",
    "MODERATESEVERELIVERDISEASE_indicator",
    "MYOCARDIALINFARCTION_indicator",
    "OTHERIMMUNOCOMPROMISED_indicator",
    "PEPTICULCER_indicator",
    "PERIPHERALVASCULARDISEASE_indicator",
    "PSYCHOSIS_indicator",
    "PULMONARYEMBOLISM_indicator",
    "RHEUMATOLOGICDISEASE_indicator",
    "SICKLECELLDISEASE_indicator",
    "SUBSTANCEUSEDISORDER_indicator",
    "THALASSEMIA_indicator",
    "TUBERCULOSIS_indicator",
    "SYSTEMICCORTICOSTEROIDS_indicator",
)
SUMMARY_COLUMNS = (
    ("age", "BMI_max_observed_or_calculated", "sex", "race", "race_ethnicity") + COMORBIDITIES + (MORTALITY,)
)
FEATURE_COLUMNS = ("age", "sex", "race") + COMORBIDITIES + (MORTALITY,)
