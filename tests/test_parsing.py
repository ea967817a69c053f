import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions.decisions import decide_threshold, outcome_note, risk_label
from riskloom.functions.parsing import POLICY_DATE, clamp_date, claim_label, parse_code, parse_number, parse_policy_date
from riskloom.operators.cleaning import dedup, drop_blank, validate_policies
from riskloom.operators.features import policy_features, select_features
from riskloom.plans.scoring import POLICY_SCHEMA, SAMPLE_POLICY
from riskloom.schema import DEFAULT_PROFILE, FEATURES, POLICY_COLUMNS


def one(spark, schema, values, expression):
    df = spark.createDataFrame([(v,) for v in values], f"c {schema}")
    return [r[0] for r in df.select(expression(F.col("c"))).collect()]


def test_policy_dates(spark):
    texts = {
        "08-AUG-13": dt.date(2013, 8, 8),
        "8-aug-13": dt.date(2013, 8, 8),
        " 01-Jan-98 ": dt.date(1998, 1, 1),
        "31-DEC-68": dt.date(2068, 12, 31),
        "01-JAN-69": dt.date(1969, 1, 1),
        "2013-08-08": dt.date(2013, 8, 8),
        "29-FEB-12": dt.date(2012, 2, 29),
        "29-FEB-13": None,
        "32-JAN-13": None,
        "01-JAN-2013": dt.date(2013, 1, 1),
        "2013-08-08 00:00:00": dt.date(2013, 8, 8),
        "2013-08-08T10:30:00": dt.date(2013, 8, 8),
        "8/31/2013": dt.date(2013, 8, 31),
        "31/8/2013": None,
        "01-ANF-13": None,
        "01-N F-13": None,
        "2013": None,
        "2013-13-01": None,
        "bad-date": None,
        "": None,
        None: None,
    }
    assert one(spark, "string", texts, parse_policy_date) == list(texts.values())


def test_policy_date_only(spark):
    assert one(spark, "string", ["2013-08-08"], lambda c: parse_policy_date(c, [POLICY_DATE])) == [None]


def test_numbers(spark):
    texts = {"1": 1.0, "2007.0": 2007.0, " 3 ": 3.0, "1e3": 1000.0, "n/a": None, "NaN": None, "2007d": None, "5F": None, "": None, None: None}
    assert one(spark, "string", texts, parse_number) == list(texts.values())
    assert one(spark, "double", [1.5, math.nan, None], lambda c: parse_number(c, False)) == [1.5, None, None]
    assert one(spark, "string", ["1202", "1202.0", "x"], parse_code) == [1202, 1202, None]


def test_claim_label(spark):
    assert one(spark, "double", [0.0, 1.5, None, math.nan, -2.0], claim_label) == [0, 1, 0, 0, 0]
    assert one(spark, "string", ["0.0", "12", "x", None], lambda c: claim_label(c, True)) == [0, 1, 0, 0]


def test_clamp_date(spark):
    low, high = (F.lit(d).cast("date") for d in ("2000-01-01", "2001-01-01"))
    days = [dt.date(1999, 5, 5), dt.date(2000, 5, 5), dt.date(2002, 5, 5), None]
    expected = [dt.date(2000, 1, 1), dt.date(2000, 5, 5), dt.date(2001, 1, 1), None]
    assert one(spark, "date", days, lambda c: clamp_date(c, low, high)) == expected


def test_decisions(spark):
    assert one(spark, "double", [0.5, 0.4999, None], lambda c: decide_threshold(c, 0.5)) == [1, 0, 0]
    assert one(spark, "double", [0.7, 0.3, 0.29], risk_label) == ["HIGH", "MEDIUM", "LOW"]
    rows = [(5.0, 1), (5.0, 0), (0.0, 1), (None, 1), (0.0, 0)]
    df = spark.createDataFrame(rows, "paid double, pred int")
    notes = [r[0] for r in df.select(outcome_note(F.col("paid"), F.col("pred"))).collect()]
    assert notes == ["MATCH", "MISSED_CLAIM", "FALSE_ALARM", "FALSE_ALARM", "MATCH"]


def policy(**changes):
    row = {**SAMPLE_POLICY, **changes}
    return tuple(row[c] for c in POLICY_COLUMNS)


def policies(spark, *rows):
    order = POLICY_SCHEMA.replace(",", "").split()[::2]
    data = [tuple(dict(zip(POLICY_COLUMNS, r))[c] for c in order) for r in rows]
    return spark.createDataFrame(data, POLICY_SCHEMA)


def test_dedup_compares_numbers_by_value_and_dates_by_text(spark):
    same = [policy(PROD_YEAR="2007"), policy(PROD_YEAR="2007.0"), policy(PROD_YEAR="2007.0", MAKE=None), policy(MAKE=None)]
    assert dedup(policies(spark, *same)).count() == 2
    assert dedup(policies(spark, policy(INSR_BEGIN="08-AUG-13"), policy(INSR_BEGIN="8-AUG-13"))).count() == 2
    assert dedup(policies(spark, policy(PROD_YEAR="bad"), policy(PROD_YEAR="worse"))).count() == 2
    assert {r.PROD_YEAR for r in dedup(policies(spark, policy(PROD_YEAR="2007"))).collect()} == {"2007"}


def test_drop_blank(spark):
    df = spark.createDataFrame([(" a ",), ("",), ("  ",), (None,), ("b",)], "c string")
    assert [r.c for r in drop_blank(df, "c").collect()] == ["a", "b"]


def test_features_of_the_sample_policy(spark):
    row = policy_features(policies(spark, policy())).first()
    assert row.EFFECTIVE_YEAR_DERIVED == 2013
    assert row.POLICY_DURATION_DAYS == 364
    assert row.VEHICLE_AGE_YEARS == 6.0
    assert (row.POLICY_BEGIN_MONTH, row.POLICY_BEGIN_QUARTER, row.POLICY_END_MONTH, row.POLICY_END_QUARTER) == (8, 3, 8, 3)
    assert row.POLICY_DURATION_MONTHS == pytest.approx(364 / 30)
    assert row.INSURED_VALUE_LOG == pytest.approx(math.log1p(519755.22))
    assert row.PREMIUM_LOG == pytest.approx(math.log1p(7209.14))
    assert row.VALUE_PER_PREMIUM == pytest.approx(519755.22 / 7209.14)
    assert row.VALUE_PER_SEAT == pytest.approx(519755.22 / 4)
    assert row.CAPACITY_PER_SEAT == 1.5
    assert row.PREMIUM_PER_DAY == pytest.approx(7209.14 / 364)
    assert row.AGE_BY_VALUE == pytest.approx(6 / 519756.22)
    assert row.INSR_BEGIN == "2013-08-08" and row.PROD_YEAR == "2007.0"


def test_features_without_values(spark):
    gone = dict(INSR_BEGIN="x", INSURED_VALUE=-1.0, PREMIUM=0.0, SEATS_NUM=0.0, PROD_YEAR="n/a")
    row = select_features(policy_features(policies(spark, policy(**gone)))).first()
    assert list(row.asDict()) == FEATURES
    for name in ("VEHICLE_AGE_YEARS", "POLICY_DURATION_DAYS", "INSURED_VALUE_LOG", "VALUE_PER_PREMIUM", "VALUE_PER_SEAT",
                 "CAPACITY_PER_SEAT", "PREMIUM_PER_DAY", "AGE_BY_VALUE"):
        assert row[name] is None
    zero_days = policy(INSR_END="2013-08-08")
    assert policy_features(policies(spark, zero_days)).first().PREMIUM_PER_DAY is None


def test_features_need_their_columns(spark):
    with pytest.raises(ValueError, match="MAKE"):
        policy_features(policies(spark, policy()).drop("MAKE"))


def test_parsing_is_done_once(spark):
    plan = select_features(policy_features(policies(spark, policy())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") <= 6  # two per date, one for the text year, and the plan text shows each once


def test_validation_reasons(spark):
    rows = [
        policy(),
        policy(INSR_END="2013-08-08"),
        policy(SEATS_NUM=0.0, PREMIUM=-1.0),
        policy(PROD_YEAR="1900"),
        policy(INSR_BEGIN="01-JAN-99", INSR_END="01-JAN-25"),
        policy(INSURED_VALUE=None, SEATS_NUM=None, PROD_YEAR=None, INSR_BEGIN=None),
    ]
    found = validate_policies(policies(spark, *rows), DEFAULT_PROFILE).collect()
    assert [sorted(r.reasons) for r in found] == [
        [],
        ["END_NOT_AFTER_BEGIN"],
        ["PREMIUM_NEGATIVE", "SEATS_NUM_BELOW_ONE"],
        ["PROD_YEAR_OUT_OF_RANGE"],
        ["INSR_BEGIN_OUT_OF_RANGE", "INSR_END_OUT_OF_RANGE"],
        [],
    ]
    assert [r.is_valid for r in found] == [True, False, False, False, False, True]
