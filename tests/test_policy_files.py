"""Policy files whose headers and lines differ; copies among unreadable amounts; decisions on odd values."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions.decisions import decide_threshold, risk_label
from riskloom.operators.cleaning import dedup
from riskloom.operators.profiles import reference_profile
from riskloom.schema import POLICY_COLUMNS, REQUIRED_COLUMNS
from riskloom.sources.policies import file_headers, read_policies, read_policy_text, type_policies

ROW = {
    "SEX": "0", "INSR_BEGIN": "08-AUG-13", "INSR_END": "07-AUG-14", "INSR_TYPE": "1202", "INSURED_VALUE": "5.5", "PREMIUM": "7.25",
    "SEATS_NUM": "4", "CARRYING_CAPACITY": "6", "TYPE_VEHICLE": "Pick-up", "CCM_TON": "3153", "MAKE": "NISSAN", "USAGE": "Own, Goods",
    "PROD_YEAR": "2007.0", "CLAIM_PAID": "1",
}


def _file(path, columns, rows, head=None):
    cells = [",".join(f'"{r[c]}"' if "," in r[c] else r[c] for c in columns) for r in rows]
    path.write_text("\n".join([head or ",".join(columns), *cells]) + "\n", encoding="utf-8")


def _read(spark, path, **more):
    return {r.MAKE or r[-1]: r for r in read_policies(spark, str(path), **more).collect()}


def test_columns_are_bound_by_name_file_by_file(spark, tmp_path):
    _file(tmp_path / "a.csv", POLICY_COLUMNS, [{**ROW, "MAKE": "a"}])
    _file(tmp_path / "b.csv", POLICY_COLUMNS[::-1], [{**ROW, "MAKE": "b"}])
    _file(tmp_path / "c.csv", REQUIRED_COLUMNS, [{**ROW, "MAKE": "c"}])
    _file(tmp_path / "d.csv", ["X", *POLICY_COLUMNS, "Y z"], [{**ROW, "MAKE": "d", "X": "1,2", "Y z": "0"}])
    _file(tmp_path / "e.csv", POLICY_COLUMNS, [{**ROW, "MAKE": "e"}], "\ufeff" + ", ".join(POLICY_COLUMNS))
    (tmp_path / "f.csv").write_text("")
    found = _read(spark, tmp_path)
    assert set(found) == set("abcde")
    for name, row in found.items():
        assert row.PREMIUM == 7.25 and row.SEX == 0 and row.USAGE == "Own, Goods" and row.PROD_YEAR == "2007.0"
        assert row.CLAIM_PAID == (None if name == "c" else 1.0)
        assert (row.X, row["Y z"]) == (("1,2", "0") if name == "d" else (None, None))
    assert len(file_headers(spark, str(tmp_path))) == 4


def test_lines_of_the_wrong_width(spark, tmp_path):
    rows = [ROW, {**ROW, "MAKE": "long", "CLAIM_PAID": "1,2"}]
    _file(tmp_path / "a.csv", POLICY_COLUMNS, [ROW])
    with (tmp_path / "a.csv").open("a") as f:
        f.write("0,08-AUG-13,short\n" + ",".join(ROW[c].replace(",", "") for c in POLICY_COLUMNS) + ",surplus\n")
    rows = read_policies(spark, str(tmp_path), corrupt="raw").collect()
    good = [r for r in rows if r.raw is None]
    bad = [r for r in rows if r.raw is not None]
    assert len(good) == 1 and good[0].MAKE == "NISSAN"
    assert {r.raw.split(",")[-1] for r in bad} == {"short", "surplus"}
    assert all(r[c] is None for r in bad for c in POLICY_COLUMNS)
    assert read_policies(spark, str(tmp_path), ["MAKE"], corrupt="raw").filter("raw IS NULL").count() == 1
    assert read_policies(spark, str(tmp_path)).count() == 3


def test_headers_that_cannot_be_bound(spark, tmp_path):
    for name in "abc":
        (tmp_path / name).mkdir()
    _file(tmp_path / "a" / "x.csv", ["MAKE", *POLICY_COLUMNS], [ROW])
    with pytest.raises(ValueError, match="names columns twice: MAKE"):
        read_policies(spark, str(tmp_path / "a"))
    _file(tmp_path / "b" / "x.csv", ["MAKE", "SEX"], [ROW])
    with pytest.raises(ValueError, match="columns missing: .*PREMIUM"):
        read_policies(spark, str(tmp_path / "b"))
    assert read_policies(spark, str(tmp_path / "b"), ["SEX", "MAKE"]).first()[:] == (0, "NISSAN")
    assert read_policies(spark, str(tmp_path / "c"), corrupt="raw").columns == [*POLICY_COLUMNS, "raw"]


def test_a_header_split_over_many_tasks_is_read_once(spark, tmp_path):
    _file(tmp_path / "a.csv", POLICY_COLUMNS, [{**ROW, "MAKE": f"m{i}"} for i in range(3000)])
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        assert list(file_headers(spark, str(tmp_path))) == [tuple(POLICY_COLUMNS)]
        assert read_policies(spark, str(tmp_path)).count() == 3000
    finally:
        spark.conf.set(name, before)


def test_rows_that_differ_in_unreadable_amounts_are_no_copies(spark, tmp_path):
    rows = [{**ROW, "PREMIUM": p} for p in ("7.25", "7.250", "abc", "abd", "abc")]
    _file(tmp_path / "a.csv", POLICY_COLUMNS, rows)
    raw = read_policy_text(spark, str(tmp_path))
    typed = type_policies(dedup(raw))
    assert sorted(str(r.PREMIUM) for r in typed.collect()) == ["7.25", "None", "None"]
    assert dedup(read_policies(spark, str(tmp_path))).count() == 2


def test_nan_is_low_risk_and_no_claim(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.7,), (0.3,), (0.1,)], "p double")
    found = df.select(risk_label(F.col("p")), decide_threshold(F.col("p"), 0.5)).collect()
    assert [tuple(r) for r in found] == [("LOW", 0), ("LOW", 0), ("HIGH", 1), ("MEDIUM", 0), ("LOW", 0)]


def test_one_huge_year_hides_no_other(spark):
    df = spark.createDataFrame([("1e30",), ("1999",), ("2005.0",), ("x",)], "PROD_YEAR string")
    df = df.withColumns({"INSR_BEGIN": F.lit("08-AUG-13"), "INSR_END": F.lit("07-AUG-14")})
    row = reference_profile(df).first()
    assert (row.prod_year_min, row.prod_year_max) == (1999, 2005)
