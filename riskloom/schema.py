"""Column lists and constants shared by every module."""

from __future__ import annotations

# The policy layout, the model's feature order and the decision constants.
CATEGORICAL = ["SEX", "INSR_TYPE", "TYPE_VEHICLE", "MAKE", "USAGE"]
RAW_NUMERIC = ["INSURED_VALUE", "PREMIUM", "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON"]
DERIVED_NUMERIC = [
    "VEHICLE_AGE_YEARS",
    "POLICY_DURATION_DAYS",
    "POLICY_BEGIN_MONTH",
    "POLICY_BEGIN_QUARTER",
    "POLICY_END_MONTH",
    "POLICY_END_QUARTER",
    "POLICY_DURATION_MONTHS",
    "INSURED_VALUE_LOG",
    "PREMIUM_LOG",
    "VALUE_PER_PREMIUM",
    "VALUE_PER_SEAT",
    "CAPACITY_PER_SEAT",
    "PREMIUM_PER_DAY",
    "AGE_BY_VALUE",
]
FEATURES = [
    "SEX",
    "INSR_TYPE",
    "INSURED_VALUE",
    "PREMIUM",
    "SEATS_NUM",
    "CARRYING_CAPACITY",
    "TYPE_VEHICLE",
    "CCM_TON",
    "MAKE",
    "USAGE",
    *DERIVED_NUMERIC,
]
NUMERIC = [c for c in FEATURES if c not in CATEGORICAL]

CODE_COLUMNS = ["SEX", "INSR_TYPE"]
AMOUNT_COLUMNS = [*RAW_NUMERIC, "CLAIM_PAID"]
POLICY_COLUMNS = [
    "SEX",
    "INSR_BEGIN",
    "INSR_END",
    "INSR_TYPE",
    "INSURED_VALUE",
    "PREMIUM",
    "SEATS_NUM",
    "CARRYING_CAPACITY",
    "TYPE_VEHICLE",
    "CCM_TON",
    "MAKE",
    "USAGE",
    "PROD_YEAR",
    "CLAIM_PAID",
]
REQUIRED_COLUMNS = [c for c in POLICY_COLUMNS if c != "CLAIM_PAID"]
LABEL = "CLAIM"

SEED = 42
TEST_FRACTION = 0.2
TRAIN_ROWS_MAX = 30_000
CV_ROWS_MAX = 80_000
CV_FOLDS = 5
MIN_RECALL = 0.75
DEFAULT_THRESHOLD = 0.5
REFERENCE_SAMPLE = 50_000
TOP_PERCENTS = (10, 15, 20)
HIGH_RISK = 0.7
MEDIUM_RISK = 0.3

# Policy profile used where there is no reference data.
POLICY_MIN_DATE = "2000-01-01"
DEFAULT_PROFILE = {
    "prod_year_min": 1950,
    "prod_year_max": 2018,
    "policy_max_date": "2019-12-31",
    "policy_default_begin": "2013-01-01",
    "policy_default_end": "2014-01-01",
}

# Text that a delimited policy file uses for "missing".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def missing_columns(columns: list[str]) -> list[str]:
    return [c for c in REQUIRED_COLUMNS if c not in columns]


def require_columns(columns: list[str]) -> None:
    missing = missing_columns(columns)
    if missing:
        raise ValueError(f"policy columns missing: {', '.join(missing)}")
