"""DuckDB SQL that each registered query must agree with.

Written from the operator definitions, independently of the Spark plans: plain window functions and
sorts over whole tables. Rounding matches the registered queries.
"""

from __future__ import annotations

from riskloom.schema import CATEGORICAL, FEATURES, NUMERIC, POLICY_COLUMNS

ORACLES: dict[str, str] = {}

IDS = "policy_id, line_k, sup_k, part_k"

POLICIES = """
policies_raw AS (
SELECT b.* FROM (
SELECT l_orderkey AS policy_id, l_linenumber AS line_k, l_suppkey AS sup_k, l_partkey AS part_k,
  CAST(l_orderkey % 3 AS INT) AS SEX,
  CASE l_returnflag WHEN 'A' THEN 1201 WHEN 'N' THEN 1202 ELSE 1204 END AS INSR_TYPE,
  CASE WHEN l_orderkey % 101 = 0 THEN 'bad-date' WHEN l_orderkey % 97 = 0 THEN NULL
       ELSE upper(strftime(l_shipdate, '%d-%b-%y')) END AS INSR_BEGIN,
  CASE WHEN l_partkey % 103 = 0 THEN NULL
       ELSE upper(strftime(l_shipdate + INTERVAL 1 DAY * CASE WHEN l_linenumber = 7 THEN 0
            WHEN l_linenumber = 6 THEN 180 ELSE 364 END, '%d-%b-%y')) END AS INSR_END,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_extendedprice END AS INSURED_VALUE,
  l_extendedprice * l_tax AS PREMIUM,
  CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) % 8 AS DOUBLE) END AS SEATS_NUM,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_quantity END AS CARRYING_CAPACITY,
  CASE WHEN p_partkey % 79 = 0 THEN NULL ELSE p_type END AS TYPE_VEHICLE,
  CAST(p_size * 100 AS DOUBLE) AS CCM_TON,
  p_brand AS MAKE,
  CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE o_orderpriority END AS USAGE,
  CASE WHEN l_orderkey % 61 = 0 THEN 'n/a'
       ELSE CAST(CAST(year(l_shipdate) AS INT) - p_size % 20 AS VARCHAR) END AS PROD_YEAR,
  CASE WHEN (l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 1000 < 75 THEN l_extendedprice * 0.25
       WHEN l_orderkey % 5 = 0 THEN 0.0 ELSE NULL END AS CLAIM_PAID,
  CAST((l_orderkey * 104729 + l_partkey * 1299709 + l_suppkey * 15485863 + l_linenumber * 611953) % 10007
       AS DOUBLE) / 10007.0 AS u
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
) b JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) d ON d.copy = 1 OR b.policy_id % 50 = 0
)"""

ROW_KEY = (
    "md5('{\"seed\":42,\"policy_id\":' || policy_id || ',\"line_k\":' || line_k || "
    "',\"sup_k\":' || sup_k || ',\"part_k\":' || part_k || '}')"
)

# Each part may use the ones before it.
PARTS = {
    "policies_raw": POLICIES,
    "policies": "policies AS (SELECT DISTINCT * FROM policies_raw)",
    "labelled": f"""labelled AS (
SELECT {IDS}, CAST(CASE WHEN CLAIM_PAID > 0 THEN 1 ELSE 0 END AS INT) AS CLAIM, {ROW_KEY} AS k FROM policies)""",
    "scored": f"""scored AS (
SELECT *, CAST(CASE WHEN CLAIM_PAID > 0 THEN 1 ELSE 0 END AS INT) AS y,
  0.7 * u + CASE WHEN CLAIM_PAID > 0 THEN 0.25 ELSE 0.0 END AS p, {ROW_KEY} AS k FROM policies_raw)""",
    "parsed": """parsed AS (
SELECT *, CAST(try_strptime(INSR_BEGIN, '%d-%b-%y') AS DATE) AS b, CAST(try_strptime(INSR_END, '%d-%b-%y') AS DATE) AS e,
  TRY_CAST(PROD_YEAR AS DOUBLE) AS yr FROM policies_raw)""",
    "derived": """derived AS (
SELECT *,
  CAST(year(b) AS INT) AS EFFECTIVE_YEAR_DERIVED,
  CAST(e - b AS INT) AS POLICY_DURATION_DAYS,
  year(b) - yr AS VEHICLE_AGE_YEARS,
  CAST(month(b) AS INT) AS POLICY_BEGIN_MONTH,
  CAST(quarter(b) AS INT) AS POLICY_BEGIN_QUARTER,
  CAST(month(e) AS INT) AS POLICY_END_MONTH,
  CAST(quarter(e) AS INT) AS POLICY_END_QUARTER,
  CAST(e - b AS DOUBLE) / 30 AS POLICY_DURATION_MONTHS,
  ln(1 + INSURED_VALUE) AS INSURED_VALUE_LOG,
  ln(1 + PREMIUM) AS PREMIUM_LOG,
  INSURED_VALUE / nullif(PREMIUM, 0) AS VALUE_PER_PREMIUM,
  INSURED_VALUE / nullif(SEATS_NUM, 0) AS VALUE_PER_SEAT,
  CARRYING_CAPACITY / nullif(SEATS_NUM, 0) AS CAPACITY_PER_SEAT,
  PREMIUM / nullif(CAST(e - b AS DOUBLE), 0) AS PREMIUM_PER_DAY,
  (year(b) - yr) / (INSURED_VALUE + 1) AS AGE_BY_VALUE
FROM parsed)""",
    "sizes": """sizes AS (
SELECT CLAIM, nc, sum(nc) OVER () AS n, coalesce(sum(nc) OVER (ORDER BY CLAIM ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0) AS start FROM (SELECT CLAIM, count(*) AS nc FROM labelled GROUP BY CLAIM))""",
    "quotas": """quotas AS (
SELECT CLAIM, q + CASE WHEN row_number() OVER (ORDER BY rem DESC, CLAIM) <= want - sum(q) OVER () THEN 1 ELSE 0 END AS q
FROM (SELECT CLAIM, want, CAST(want * nc AS BIGINT) // CAST(n AS BIGINT) AS q, CAST(want * nc AS BIGINT) % CAST(n AS BIGINT) AS rem
      FROM (SELECT *, CAST(ceil(0.2 * n) AS BIGINT) AS want FROM sizes)))""",
    "placed": "placed AS (SELECT *, row_number() OVER (PARTITION BY CLAIM ORDER BY k) AS rn FROM labelled)",
    "split": f"""split AS (
SELECT {IDS}, CLAIM, CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS split FROM placed JOIN quotas USING (CLAIM))""",
    "folds": f"""fold_ends AS (
SELECT CLAIM, f, sum(c) OVER (PARTITION BY CLAIM ORDER BY f) AS hi, c FROM (
  SELECT CLAIM, f, CAST((start + nc - f + 4) // 5 - (start - f + 4) // 5 AS BIGINT) AS c
  FROM (SELECT CLAIM, CAST(start AS BIGINT) AS start, nc FROM sizes) CROSS JOIN (SELECT unnest(range(5)) AS f)))
, folds AS (
SELECT {IDS}, CLAIM, CAST(f AS INT) AS fold FROM placed JOIN fold_ends USING (CLAIM) WHERE rn > hi - c AND rn <= hi)""",
}


def with_parts(names: str, select: str) -> str:
    return "WITH " + ",\n".join(PARTS[n] for n in names.split()) + "\n" + select


def oracle(name: str, parts: str, select: str) -> None:
    ORACLES[name] = with_parts(parts, select)


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


# --- flagship, sources and sinks ------------------------------------------------------------------

oracle(
    "flagship_claim_rate_by_vehicle",
    "policies_raw",
    f"""SELECT TYPE_VEHICLE, count(*) AS n_policies, {r("avg(CASE WHEN CLAIM_PAID > 0 THEN 1.0 ELSE 0.0 END)")} AS claim_rate,
{r("avg(PREMIUM)", 4)} AS avg_premium,
{r("avg(year(CAST(try_strptime(INSR_BEGIN, '%d-%b-%y') AS DATE)) - TRY_CAST(PROD_YEAR AS DOUBLE))")} AS avg_vehicle_age
FROM (SELECT DISTINCT * FROM policies_raw) GROUP BY TYPE_VEHICLE""",
)
oracle(
    "a1_read_policies",
    "policies_raw",
    """SELECT SEX, INSR_BEGIN, INSR_END, INSR_TYPE, INSURED_VALUE, PREMIUM, SEATS_NUM, CARRYING_CAPACITY, TYPE_VEHICLE,
CCM_TON, MAKE, USAGE, CASE WHEN PROD_YEAR <> 'n/a' THEN PROD_YEAR END AS PROD_YEAR, CLAIM_PAID FROM policies_raw""",
)

_UNREAD = ", ".join(f"NULL AS {c}" for c in POLICY_COLUMNS)
oracle(
    "a1_reconcile_files",
    "policies_raw",
    f"""SELECT * EXCLUDE (policy_id, sup_k, part_k, u, PROD_YEAR, CLAIM_PAID, line_k),
  CASE WHEN PROD_YEAR <> 'n/a' THEN PROD_YEAR END AS PROD_YEAR, CASE WHEN policy_id % 3 <> 2 THEN CLAIM_PAID END AS CLAIM_PAID,
  CASE WHEN policy_id % 3 = 1 THEN 'a, b' END AS NOTE, CASE WHEN policy_id % 3 = 1 THEN CAST(line_k AS VARCHAR) END AS line_k,
  CAST(NULL AS VARCHAR) AS raw_line FROM policies_raw
UNION ALL BY NAME SELECT {_UNREAD}, NULL AS NOTE, NULL AS line_k, policy_id || ',' || sup_k || ',x' AS raw_line
FROM policies_raw WHERE policy_id % 3 = 0 AND line_k = 1""",
)

CELLS = """SELECT {by} count(*) FILTER (y = 1 AND p >= {t}) AS tp, count(*) FILTER (y = 0 AND p >= {t}) AS fp,
count(*) FILTER (y = 1 AND p < {t}) AS fn, count(*) FILTER (y = 0 AND p < {t}) AS tn FROM {src} {group}"""
CELLS_ALL = CELLS.format(by="", t="0.5", src="scored", group="")
CELLS_BY_SEX = CELLS.format(by="SEX,", t="0.5", src="scored", group="GROUP BY SEX")
RATE = {
    "accuracy": "CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)",
    "precision": "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)",
}
RATES = ", ".join(f"{r(v)} AS {k}" for k, v in RATE.items())


def ranking(source: str, by: str = "") -> str:
    """ROC-AUC and average precision per group from sorted distinct scores."""
    cols = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {cols} sum(neg * (cp - pos + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc,
sum(pos * CAST(cp AS DOUBLE) / (cp + cn)) / sum(pos) AS pr_auc FROM (
SELECT *, sum(pos) OVER ({part} ORDER BY p DESC) AS cp, sum(neg) OVER ({part} ORDER BY p DESC) AS cn FROM (
SELECT {cols} p, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY {cols} p)) {group}"""


oracle(
    "a2_read_report",
    "policies_raw scored",
    f"""SELECT 'n/a' AS best_model, CAST(0.5 AS DOUBLE) AS selected_threshold, {r(RATE["accuracy"])} AS holdout_accuracy,
{r(RATE["precision"])} AS holdout_precision, {r(RATE["recall"])} AS holdout_recall, {r("pr_auc")} AS holdout_pr_auc
FROM ({CELLS_ALL}), ({ranking("scored")})""",
)

SWEEP = f"""SELECT t AS threshold, {RATE["precision"]} AS precision, {RATE["recall"]} AS recall, {RATE["f1"]} AS f1 FROM (
SELECT t, sum(CASE WHEN p >= t THEN pos ELSE 0 END) AS tp, sum(CASE WHEN p >= t THEN neg ELSE 0 END) AS fp,
sum(CASE WHEN p < t THEN pos ELSE 0 END) AS fn
FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p)
CROSS JOIN (SELECT unnest(range(5, 96)) / CAST(100 AS DOUBLE) AS t) GROUP BY t)"""
SWEEP_ROUNDED = f"SELECT threshold, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1"
oracle("a3_write_table_csv", "policies_raw scored", f"{SWEEP_ROUNDED} FROM ({SWEEP})")

RANKED = """ranked AS (SELECT *, row_number() OVER (ORDER BY p DESC, k) AS rn, count(*) OVER () AS n FROM (
SELECT DISTINCT * FROM scored))"""
TOP_X = """SELECT x, n * x // 100 AS k, n, sum(y) AS all_pos, sum(CASE WHEN rn <= n * x // 100 THEN y ELSE 0 END) AS tp
FROM ranked CROSS JOIN (SELECT unnest([10, 15, 20]) AS x) GROUP BY x, n"""
TOP_CELLS = f"SELECT x, k, n, tp, k - tp AS fp, all_pos - tp AS fn, n - k - all_pos + tp AS tn FROM ({TOP_X})"
PARTS["ranked"] = RANKED
oracle(
    "a4_write_report",
    "policies_raw scored ranked",
    f"""SELECT n_positive, n_total, x / CAST(100 AS DOUBLE) AS top_pct, CAST(k AS BIGINT) AS k, {r(RATE["precision"])} AS precision,
{r(RATE["recall"])} AS recall, {r("CAST(k AS DOUBLE) / n")} AS coverage
FROM ({TOP_CELLS}) CROSS JOIN (SELECT count(*) FILTER (p >= 0.5) AS n_positive, count(*) AS n_total FROM ranked)""",
)

# --- cleaning, projections, validation ------------------------------------------------------------

oracle("b1_dedup", "policies_raw", "SELECT DISTINCT * FROM policies_raw")
oracle(
    "b2_claim_label",
    "policies_raw",
    f"SELECT {IDS}, CAST(coalesce(CLAIM_PAID, 0) > 0 AS INT) AS CLAIM FROM policies_raw",
)
oracle(
    "b3_parse_policy_date",
    "policies_raw parsed",
    f"SELECT {IDS}, b AS begin_date, e AS end_date, b AS iso_date FROM parsed",
)
oracle("b4_parse_number", "policies_raw parsed", f"SELECT {IDS}, yr AS prod_year FROM parsed")


def as_double(column: str) -> str:
    return f"{r(f'CAST({column} AS DOUBLE)')} AS {column}"


oracle(
    "b5_select_features",
    "policies_raw parsed derived",
    f"SELECT {IDS}, " + ", ".join(c if c in CATEGORICAL else as_double(c) for c in FEATURES) + " FROM derived",
)
RULES = {
    "CCM_TON_NEGATIVE": "CCM_TON < 0",
    "CARRYING_CAPACITY_NEGATIVE": "CARRYING_CAPACITY < 0",
    "CLAIM_PAID_NEGATIVE": "CLAIM_PAID < 0",
    "END_NOT_AFTER_BEGIN": "e <= b",
    "INSR_BEGIN_OUT_OF_RANGE": "b NOT BETWEEN DATE '2000-01-01' AND DATE '2001-12-31'",
    "INSR_END_OUT_OF_RANGE": "e NOT BETWEEN DATE '2000-01-01' AND DATE '2001-12-31'",
    "INSURED_VALUE_NEGATIVE": "INSURED_VALUE < 0",
    "PREMIUM_NEGATIVE": "PREMIUM < 0",
    "PROD_YEAR_OUT_OF_RANGE": "yr NOT BETWEEN 1980 AND 1999",
    "SEATS_NUM_BELOW_ONE": "SEATS_NUM < 1",
}
REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in sorted(RULES.items())) + ")"
oracle(
    "b6_validate_policies",
    "policies_raw parsed",
    f"SELECT *, reasons = '' AS is_valid FROM (SELECT {IDS}, {REASONS} AS reasons FROM parsed)",
)
oracle(
    "b7_clamp_date",
    "policies_raw parsed",
    f"""SELECT {IDS}, CASE WHEN b < DATE '1999-01-01' THEN DATE '1999-01-01' WHEN b > DATE '2000-12-31' THEN DATE '2000-12-31'
ELSE b END AS clamped FROM parsed""",
)
oracle("b8_drop_blank", "policies_raw", "SELECT trim(USAGE) AS USAGE FROM policies_raw WHERE trim(USAGE) <> ''")

# --- derived features -----------------------------------------------------------------------------

DERIVED = [
    "EFFECTIVE_YEAR_DERIVED", "POLICY_DURATION_DAYS", "VEHICLE_AGE_YEARS", "POLICY_BEGIN_MONTH", "POLICY_BEGIN_QUARTER",
    "POLICY_END_MONTH", "POLICY_END_QUARTER", "POLICY_DURATION_MONTHS", "INSURED_VALUE_LOG", "PREMIUM_LOG",
    "VALUE_PER_PREMIUM", "VALUE_PER_SEAT", "CAPACITY_PER_SEAT", "PREMIUM_PER_DAY", "AGE_BY_VALUE",
]
for i, column in enumerate(DERIVED, start=1):
    oracle(f"c{i}_{column.lower()}", "policies_raw parsed derived", f"SELECT {IDS}, {as_double(column)} FROM derived")

# --- splits and samples ---------------------------------------------------------------------------

SPLIT = "policies_raw policies labelled sizes quotas placed split"
oracle("d1_stratified_split", SPLIT, "SELECT * FROM split")
oracle(
    "d2_stratified_sample",
    "policies_raw policies labelled sizes placed",
    f"""SELECT {IDS}, CLAIM FROM placed JOIN sizes USING (CLAIM)
WHERE n <= 30000 OR rn <= round_even(CAST(30000 AS DOUBLE) / CAST(n AS DOUBLE) * nc, 0)""",
)
FOLDS = "policies_raw policies labelled sizes placed folds"
oracle("d3_stratified_kfold", FOLDS, "SELECT * FROM folds")
oracle("d4_grown_sample", "policies_raw", f"SELECT {IDS} FROM policies_raw ORDER BY {ROW_KEY} LIMIT 20000")
oracle("d4_sample_n", "policies_raw", f"SELECT {IDS} FROM policies_raw ORDER BY {ROW_KEY} LIMIT 50000")

# --- model input ----------------------------------------------------------------------------------


def filled(column: str) -> str:
    return f"coalesce(CAST({column} AS DOUBLE), (SELECT median(CAST({column} AS DOUBLE)) FROM derived))"


def most_common(column: str) -> str:
    return (
        f"(SELECT {column} FROM derived WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


DERIVED_PARTS = "policies_raw parsed derived"
oracle(
    "e1_impute_median",
    DERIVED_PARTS,
    f"SELECT {IDS}, " + ", ".join(f"{r(filled(c))} AS {c}" for c in NUMERIC) + " FROM derived",
)
oracle(
    "e2_impute_mode",
    DERIVED_PARTS,
    f"SELECT {IDS}, " + ", ".join(f"coalesce({c}, {most_common(c)}) AS {c}" for c in CATEGORICAL) + " FROM derived",
)
oracle(
    "e3_one_hot",
    "policies_raw",
    f"SELECT {IDS}, "
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR) NULLS LAST) - 1 END AS {c}_slot"
        for c in CATEGORICAL
    )
    + " FROM policies_raw",
)
TOTAL = " + ".join(filled(c) for c in NUMERIC)
WIDTH = "CAST(" + " + ".join(f"(SELECT count(DISTINCT {c}) FROM derived)" for c in CATEGORICAL) + f" + {len(NUMERIC)} AS INT)"
oracle("e4_assemble", DERIVED_PARTS, f"SELECT {IDS}, {WIDTH} AS width, {r(f'{TOTAL} + 5', 4)} AS total FROM derived")
SEEN = "(SELECT * FROM parts WHERE split = 'train')"
TRAIN_TOTAL = " + ".join(
    [f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM {SEEN}))" for c in NUMERIC]
    + [f"CASE WHEN {c} IS NULL OR {c} IN (SELECT {c} FROM {SEEN}) THEN 1 ELSE 0 END" for c in CATEGORICAL]
)
TRAIN_WIDTH = " + ".join(f"(SELECT count(DISTINCT {c}) FROM {SEEN})" for c in CATEGORICAL)
PARTS["parts"] = f"""parts AS (
SELECT * FROM (SELECT DISTINCT *, CAST(coalesce(CLAIM_PAID, 0) > 0 AS INT) AS CLAIM FROM derived)
JOIN (SELECT DISTINCT * FROM split) USING ({IDS}, CLAIM))"""
oracle(
    "e5_fit_transform",
    f"{DERIVED_PARTS} policies labelled sizes quotas placed split parts",
    f"""SELECT {IDS}, split, CAST({TRAIN_WIDTH} + {len(NUMERIC)} AS INT) AS width, {r(TRAIN_TOTAL, 4)} AS total FROM parts""",
)
oracle(
    "e6_align_width",
    DERIVED_PARTS,
    f"""SELECT {IDS}, 100 AS width_wide, {r(f"{TOTAL} + 5", 4)} AS total_wide, {len(NUMERIC)} AS width_narrow,
{r(TOTAL, 4)} AS total_narrow FROM derived""",
)
oracle(
    "f1_class_weight",
    "policies_raw policies labelled",
    f"""SELECT {r("CAST(greatest(sum(1 - CLAIM), 1) AS DOUBLE) / greatest(sum(CLAIM), 1)")} AS class_weight FROM labelled""",
)

# --- model ----------------------------------------------------------------------------------------
# SQL can't grow the trees. It states the rows of each side, and what must hold of any model.

PARTS["train"] = f"""train AS (
SELECT {IDS}, CLAIM, {ROW_KEY} AS k42, {ROW_KEY.replace('42', '1')} AS k FROM split WHERE split = 'train')"""
PARTS["sampled"] = """sampled AS (
SELECT CLAIM, CASE WHEN n <= 30000 THEN nc ELSE CAST(round_even(CAST(30000 AS DOUBLE) / n * nc, 0) AS BIGINT) END AS nc
FROM (SELECT CLAIM, count(*) AS nc, CAST(sum(count(*)) OVER () AS BIGINT) AS n FROM train GROUP BY CLAIM))"""
# All rows of the train side take part where the model is fit without a bound.
PARTS["unsampled"] = "sampled AS (SELECT CLAIM, count(*) AS nc FROM train GROUP BY CLAIM)"
PARTS["held"] = """held AS (
SELECT CLAIM, nc - q - CASE WHEN row_number() OVER (ORDER BY rem DESC, CLAIM) <= want - sum(q) OVER () THEN 1 ELSE 0 END AS fit
FROM (SELECT CLAIM, nc, want, want * nc // n AS q, want * nc % n AS rem FROM (
  SELECT CLAIM, nc, n, CAST(ceil(0.2 * n) AS BIGINT) AS want FROM (SELECT *, CAST(sum(nc) OVER () AS BIGINT) AS n FROM sampled))))"""
PARTS["sides"] = f"""sides AS (
SELECT {IDS}, CLAIM, CASE WHEN rn <= fit THEN 'fit' ELSE 'valid' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY CLAIM ORDER BY k) AS rn FROM train) JOIN held USING (CLAIM))"""
SIDES = SPLIT + " train sampled held sides"
WHOLE_SIDES = SPLIT + " train unsampled held sides"
oracle("a5_save_load_model", "policies_raw", f"SELECT {IDS}, TRUE AS same FROM policies_raw")
oracle("f2_train_boosted", WHOLE_SIDES, f"SELECT {IDS}, CLAIM, TRUE AS is_probability FROM sides WHERE part = 'valid'")
oracle(
    "f3_tune",
    SIDES,
    "SELECT part, count(*) AS n_rows, CAST(sum(CLAIM) AS BIGINT) AS n_claims, TRUE AS found FROM sides GROUP BY part",
)
oracle("f4_predict_probability", "policies_raw", f"SELECT {IDS}, TRUE AS is_probability FROM policies_raw")
oracle(
    "f5_cross_validate",
    SPLIT,
    """SELECT CAST(f AS INT) AS fold, CAST(sum(CASE WHEN CLAIM = 0 THEN c ELSE 0 END) AS BIGINT) AS negatives,
CAST(sum(CASE WHEN CLAIM = 1 THEN c ELSE 0 END) AS BIGINT) AS positives FROM (
SELECT CLAIM, f, CAST((first + nc - f + 4) // 5 - (first - f + 4) // 5 AS BIGINT) AS c FROM (
SELECT CLAIM, nc, CAST(coalesce(sum(nc) OVER (ORDER BY CLAIM ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
FROM (SELECT CLAIM, count(*) AS nc FROM split WHERE split = 'train' GROUP BY CLAIM)) CROSS JOIN (SELECT unnest(range(5)) AS f))
GROUP BY f""",
)
FIT_SLOTS = " + ".join(f"count(DISTINCT {c})" for c in CATEGORICAL)
oracle(
    "f6_feature_importance",
    WHOLE_SIDES + " parsed derived",
    f"""SELECT {FIT_SLOTS} + {len(NUMERIC)} AS slots, CAST(1 AS DOUBLE) AS total
FROM derived SEMI JOIN (SELECT * FROM sides WHERE part = 'fit') USING ({IDS})""",
)

# --- aggregates and metrics -----------------------------------------------------------------------

oracle(
    "g1_claim_rate",
    SPLIT,
    f"""SELECT split, count(*) AS n_rows, CAST(sum(CLAIM) AS BIGINT) AS n_claims, {r("avg(CLAIM)")} AS claim_rate
FROM split GROUP BY split""",
)
SCORED = "policies_raw scored"
oracle(
    "g2_confusion_matrix",
    SCORED,
    f"""SELECT 'Actual_0' AS actual, tn AS Pred_0, fp AS Pred_1 FROM ({CELLS_ALL})
UNION ALL SELECT 'Actual_1', fn, tp FROM ({CELLS_ALL})""",
)
for key, metric in [("g3", "accuracy"), ("g4", "precision"), ("g5", "recall"), ("g6", "f1")]:
    oracle(f"{key}_{metric}", SCORED, f"SELECT SEX, {r(RATE[metric])} AS {metric} FROM ({CELLS_BY_SEX})")
oracle("g7_roc_auc", SCORED, f"SELECT SEX, {r('roc_auc')} AS roc_auc FROM ({ranking('scored', 'SEX')})")
oracle("g8_pr_auc", SCORED, f"SELECT SEX, {r('pr_auc')} AS pr_auc FROM ({ranking('scored', 'SEX')})")
oracle(
    "g9_evaluate",
    SCORED,
    f"""SELECT CAST(0.5 AS DOUBLE) AS threshold, {RATES}, {r("roc_auc")} AS roc_auc, {r("pr_auc")} AS pr_auc, tn, fp, fn, tp
FROM ({CELLS_ALL}), ({ranking("scored")})""",
)
oracle("g10_threshold_sweep", SCORED, f"{SWEEP_ROUNDED} FROM ({SWEEP})")
oracle(
    "g11_select_threshold",
    SCORED,
    f"""{SWEEP_ROUNDED} FROM ({SWEEP}) s ORDER BY s.recall >= 0.75 DESC, CASE WHEN s.recall >= 0.75 THEN s.precision END DESC,
s.f1 DESC, CASE WHEN s.recall >= 0.75 THEN s.threshold END DESC, s.precision DESC, s.threshold LIMIT 1""",
)
FOLD_SCORED = f"SELECT fold, y, p FROM folds JOIN (SELECT DISTINCT {IDS}, y, p FROM scored) USING ({IDS})"
oracle(
    "g12_cv_summary",
    FOLDS + " scored",
    f"""SELECT {r("avg(pr_auc)")} AS cv_pr_auc_mean, {r("stddev_pop(pr_auc)")} AS cv_pr_auc_std
FROM ({ranking(f"({FOLD_SCORED})", "fold")})""",
)
MODELS = "(SELECT 'leaning' AS model, y, p FROM scored UNION ALL SELECT 'plain', y, u FROM scored)"
CELLS_BY_MODEL = CELLS.format(by="model,", t="0.5", src=MODELS, group="GROUP BY model")
oracle(
    "g13_model_comparison",
    SCORED,
    "SELECT model, "
    + ", ".join(f"{r(v)} AS {k}_0_5" for k, v in RATE.items())
    + f", {r('roc_auc')} AS roc_auc, {r('pr_auc')} AS pr_auc FROM ({CELLS_BY_MODEL}) JOIN ({ranking(MODELS, 'model')}) USING (model)",
)
oracle("g14_percentile_cutoff", SCORED, f"SELECT 15 AS top_pct, {r('quantile_cont(p, 0.85)')} AS cutoff FROM scored")
oracle(
    "g15_top_x_report",
    "policies_raw scored ranked",
    f"""SELECT CAST(x AS INT) AS top_pct, CAST(k AS BIGINT) AS k, {RATES}, {r("CAST(k AS DOUBLE) / n")} AS coverage
FROM ({TOP_CELLS})""",
)
oracle("g16_category_counts", "policies_raw", "SELECT MAKE, count(*) AS n FROM policies_raw WHERE trim(MAKE) <> '' GROUP BY MAKE")
oracle("g17_distinct_codes", "policies_raw", "SELECT DISTINCT INSR_TYPE FROM policies_raw WHERE INSR_TYPE IS NOT NULL")
oracle(
    "g18_reference_profile",
    "policies_raw parsed",
    """SELECT CAST(min(yr) AS INT) AS prod_year_min, CAST(max(yr) AS INT) AS prod_year_max,
greatest(max(b), max(e)) AS policy_max_date, greatest(min(b), DATE '2000-01-01') AS policy_default_begin,
least(CAST(greatest(min(b), DATE '2000-01-01') + INTERVAL 12 MONTH AS DATE), greatest(max(b), max(e))) AS policy_default_end
FROM parsed""",
)
oracle(
    "g19_prediction_summary",
    SCORED,
    "SELECT CASE WHEN p >= 0.5 THEN 'CLAIM' ELSE 'NO_CLAIM' END AS label, count(*) AS n FROM scored GROUP BY 1",
)
oracle(
    "g20_all_policy_dates",
    "policies_raw parsed",
    """SELECT b AS policy_date FROM parsed WHERE b IS NOT NULL
UNION ALL SELECT e FROM parsed WHERE e IS NOT NULL""",
)

# --- decisions and scoring output -----------------------------------------------------------------

DECIDED = "CAST(p >= 0.5 AS INT)"
oracle("h1_decide_threshold", SCORED, f"SELECT {IDS}, {DECIDED} AS prediction FROM scored")
oracle(
    "h2_decide_top_pct",
    SCORED,
    f"""SELECT {IDS}, CAST(row_number() OVER (ORDER BY p DESC, k) <= greatest(1, count(*) OVER () * 10 // 100) AS INT) AS prediction
FROM scored""",
)
oracle(
    "h3_decide_reference_cutoff",
    SCORED,
    f"""SELECT {IDS}, CAST(p >= (SELECT quantile_cont(p, 0.9) FROM (SELECT p FROM scored ORDER BY k LIMIT 50000)) AS INT)
AS prediction FROM scored""",
)
oracle(
    "h4_risk_label",
    SCORED,
    f"SELECT {IDS}, CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM scored",
)
oracle(
    "h5_actual_and_match",
    SCORED,
    f"SELECT {IDS}, {DECIDED} AS prediction, y AS actual_from_claim_paid, {DECIDED} = y AS prediction_match FROM scored",
)
oracle(
    "h6_outcome_note",
    SCORED,
    f"""SELECT {IDS}, CASE WHEN {DECIDED} = y THEN 'MATCH' WHEN y = 1 THEN 'MISSED_CLAIM' ELSE 'FALSE_ALARM' END AS outcome_note
FROM scored""",
)
oracle(
    "h7_preview",
    SCORED,
    f"SELECT {IDS}, {DECIDED} AS prediction FROM scored ORDER BY {IDS} LIMIT 20",
)
oracle(
    "h8_score_batch",
    "policies_raw",
    f"""SELECT {IDS}, {", ".join(POLICY_COLUMNS)}, CAST(coalesce(CLAIM_PAID, 0) > 0 AS INT) AS actual_from_claim_paid, TRUE AS follows
FROM policies_raw""",
)
oracle(
    "h8_score_batch_top_pct",
    "policies_raw",
    "SELECT count(*) AS n_rows, greatest(1, count(*) * 10 // 100) AS n_flagged, TRUE AS highest_flagged FROM policies_raw",
)
# The latest date and the production years are those of the table itself.
LATEST = "(SELECT greatest(max(b), max(e)) FROM parsed)"
OWN_RULES = {k: v.replace("DATE '2001-12-31'", LATEST) for k, v in RULES.items() if k != "PROD_YEAR_OUT_OF_RANGE"}
OWN_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in sorted(OWN_RULES.items())) + ")"
for name in ("h9_score_policies", "h9_score_policies_reference_cutoff"):
    oracle(
        name,
        "policies_raw parsed",
        f"SELECT *, reasons = '' AS decided FROM (SELECT {IDS}, {OWN_REASONS} AS reasons FROM parsed)",
    )
