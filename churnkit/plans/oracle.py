"""DuckDB SQL for every SQL-expressible query (the correctness oracle).

Written independently of the Spark code, over the pre-registered driver tables. The
common CTE chain derives ``subscriber_raw`` -> ``clean`` -> ``featured`` -> ``encoded``
-> ``scored`` -> ``split``; each query selects from it. Rounding mirrors the Spark side:
rates, money and metrics from integers with half-up integer arithmetic, other doubles
with ``round``.
"""

from __future__ import annotations

from churnkit.schema import NUMERIC_FEATURES

NUMERIC_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def half_up(num: str, den: str, places: int) -> str:
    """SQL for round(num/den, places) half-up over non-negative integers (NULL if den=0)."""
    s = 10 ** places
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(((CAST({num} AS HUGEINT) * {2 * s} + ({den})) // (CAST({den} AS HUGEINT) * 2)) AS DOUBLE) / {s}.0 END)")


def signed_half_up(num: str, den: str, places: int) -> str:
    return f"(CASE WHEN ({num}) < 0 THEN -{half_up(f'abs({num})', den, places)} ELSE {half_up(num, den, places)} END)"


def mills(x: str) -> str:
    return signed_half_up(x, "1000", 2)


_ADDONS = [("OnlineSecurity", 13, 4), ("OnlineBackup", 17, 5), ("DeviceProtection", 19, 5),
           ("TechSupport", 23, 4), ("StreamingTV", 29, 5), ("StreamingMovies", 31, 5)]

RAW = """
n_orders AS (SELECT o_custkey AS k_o, count(*) AS n_orders FROM orders GROUP BY o_custkey),
n_err AS (SELECT user_id AS k_e, count(*) AS n_err FROM events WHERE event_type = 'error' GROUP BY user_id),
base AS (
  SELECT c.c_custkey AS k, c.c_nationkey, c.c_mktsegment,
         coalesce(o.n_orders, 0) AS n_orders, coalesce(e.n_err, 0) AS n_err
  FROM customer c LEFT JOIN n_orders o ON c.c_custkey = o.k_o LEFT JOIN n_err e ON c.c_custkey = e.k_e),
b1 AS (
  SELECT *,
    CAST(CASE WHEN k % 97 = 0 THEN 0 ELSE (n_orders * 5 + k % 31) % 73 END AS INTEGER) AS tenure,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'No'
         WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Fiber optic' ELSE 'DSL' END AS InternetService,
    CASE WHEN k % 10 = 9 THEN 'No' ELSE 'Yes' END AS PhoneService
  FROM base),
b2 AS (
  SELECT *,
    """ + ",\n    ".join(
    f"CASE WHEN InternetService = 'No' THEN 'No internet service' WHEN (k * {m}) % 10 < {t} THEN 'Yes' ELSE 'No' END AS {n}"
    for n, m, t in _ADDONS) + """,
    CASE WHEN tenure <= 24 AND k % 5 < 4 THEN 'Month-to-month' WHEN k % 3 = 0 THEN 'Two year'
         WHEN k % 3 = 1 THEN 'One year' ELSE 'Month-to-month' END AS Contract,
    CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
    1800 + (k * 37) % 2000 + CASE WHEN InternetService = 'Fiber optic' THEN 6000
         WHEN InternetService = 'DSL' THEN 3000 ELSE 0 END AS mcc
  FROM b1),
subscriber_raw AS (
  SELECT 'C' || lpad(CAST(k AS VARCHAR), 7, '0') AS customerID,
    CASE WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS INTEGER) AS SeniorCitizen,
    CASE WHEN (k * 7) % 10 < 5 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN (k * 11) % 10 < 3 THEN 'Yes' ELSE 'No' END AS Dependents,
    tenure, PhoneService,
    CASE WHEN PhoneService = 'No' THEN 'No phone service' WHEN k % 5 < 2 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV, StreamingMovies,
    Contract,
    CASE WHEN (k * 3) % 10 < 6 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    PaymentMethod,
    CAST(mcc AS DOUBLE) / 100 AS MonthlyCharges,
    CASE WHEN tenure = 0 THEN ' ' ELSE
      CAST(CAST((mcc * tenure - (mcc * tenure) % 100) / 100 AS BIGINT) AS VARCHAR) || '.' ||
      lpad(CAST((mcc * tenure) % 100 AS VARCHAR), 2, '0') END AS TotalCharges,
    CASE WHEN (CASE Contract WHEN 'Month-to-month' THEN 30 WHEN 'One year' THEN 10 ELSE 3 END
               + CASE WHEN tenure <= 6 THEN 25 ELSE 0 END
               + CASE WHEN InternetService = 'Fiber optic' THEN 15 ELSE 0 END
               + CASE WHEN n_err > 12 THEN 10 ELSE 0 END) > (k * 53) % 100 THEN 'Yes' ELSE 'No' END AS Churn
  FROM b2)"""

_RAW_FIELDS = ("customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, "
               "MultipleLines, InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, "
               "TechSupport, StreamingTV, StreamingMovies, Contract, PaperlessBilling, PaymentMethod, "
               "MonthlyCharges")

CLEAN = f"""
parsed AS (
  SELECT *, CASE WHEN isnan(tc0) THEN NULL ELSE tc0 END AS tc FROM (
    SELECT *, CASE WHEN regexp_matches(TotalCharges, '{NUMERIC_RE}')
                   THEN TRY_CAST(trim(TotalCharges) AS DOUBLE) END AS tc0 FROM subscriber_raw)),
med AS (SELECT round(median(tc), 6) AS m FROM parsed),
clean AS (
  SELECT {_RAW_FIELDS}, coalesce(tc, (SELECT m FROM med)) AS TotalCharges,
         CAST(Churn = 'Yes' AS INTEGER) AS Churn
  FROM parsed)"""


def _yes(c: str) -> str:
    return f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END"


def _svc(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL AND {c} NOT IN ('No', 'No phone service', 'No internet service') "
            f"THEN 1 ELSE 0 END")


_SEC = " + ".join(_yes(c) for c in ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"])
_STR = " + ".join(_yes(c) for c in ["StreamingTV", "StreamingMovies"])
_NSV = ("greatest(" + " + ".join(_svc(c) for c in [
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]) + ", 1)")

FEATURED = f"""
cmean AS (
  SELECT Contract AS c_contract,
         CAST(sum(CAST(MonthlyCharges AS DECIMAL(12,2))) AS DOUBLE) / count(MonthlyCharges) AS c_mean
  FROM clean WHERE Contract IS NOT NULL GROUP BY Contract),
featured AS (
  SELECT clean.* EXCLUDE (c_contract, c_mean) FROM (
  SELECT clean.*, cmean.*,
    CASE WHEN tenure <= 0 THEN NULL WHEN tenure <= 6 THEN '0-6mo' WHEN tenure <= 12 THEN '6-12mo'
         WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' WHEN tenure <= 72 THEN '4-6yr'
         WHEN tenure > 72 THEN '6yr+' END AS tenure_group,
    TotalCharges / CAST(greatest(tenure, 1) AS DOUBLE) AS avg_monthly_spend,
    ({_SEC}) AS security_bundle_count,
    CAST(({_SEC}) >= 2 AS INTEGER) AS has_security_bundle,
    ({_STR}) AS streaming_bundle_count,
    CAST(({_STR}) = 2 AS INTEGER) AS has_streaming_bundle,
    CAST(tenure <= 6 AS INTEGER) AS is_new_customer,
    CAST(CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END AS INTEGER)
      AS contract_risk_score,
    {_NSV} AS num_services,
    MonthlyCharges / CAST({_NSV} AS DOUBLE) AS monthly_charge_per_service,
    MonthlyCharges / c_mean AS overpay_ratio
  FROM clean LEFT JOIN cmean ON clean.Contract = cmean.c_contract) clean)"""

# Expected one-hot levels (first level of each column dropped), in column order.
DUMMIES = [
    ("gender", "Male"), ("Partner", "Yes"), ("Dependents", "Yes"), ("PhoneService", "Yes"),
    ("MultipleLines", "No phone service"), ("MultipleLines", "Yes"),
    ("InternetService", "Fiber optic"), ("InternetService", "No"),
] + [(c, v) for c in ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
                      "StreamingTV", "StreamingMovies"] for v in ("No internet service", "Yes")] + [
    ("Contract", "One year"), ("Contract", "Two year"), ("PaperlessBilling", "Yes"),
    ("PaymentMethod", "Credit card (automatic)"), ("PaymentMethod", "Electronic check"),
    ("PaymentMethod", "Mailed check"),
    ("tenure_group", "6-12mo"), ("tenure_group", "1-2yr"), ("tenure_group", "2-4yr"),
    ("tenure_group", "4-6yr"), ("tenure_group", "6yr+"),
]
_DUMMY_SQL = ",\n    ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, v in DUMMIES)
_ENGINEERED = ("avg_monthly_spend, security_bundle_count, has_security_bundle, streaming_bundle_count, "
               "has_streaming_bundle, is_new_customer, contract_risk_score, num_services, "
               "monthly_charge_per_service, overpay_ratio")

ENCODED = f"""
encoded AS (
  SELECT customerID, SeniorCitizen, tenure, MonthlyCharges, TotalCharges, Churn, {_ENGINEERED},
    {_DUMMY_SQL}
  FROM featured)"""

# Fixed scorecard (same values as the Spark side), vector order.
_CARD = [("tenure", -0.03, 32.0), ("MonthlyCharges", 0.02, 65.0), ("security_bundle_count", -0.3, 0.0),
         ("is_new_customer", 0.6, 0.0), ("contract_risk_score", 0.9, 2.0)]


def _xval(f: str) -> str:
    return ("CAST(coalesce(contract_risk_score, 2) AS DOUBLE)" if f == "contract_risk_score"
            else f"CAST({f} AS DOUBLE)")


_PHI = ",\n    ".join(f"CAST({w} AS DOUBLE) * ({_xval(f)} - CAST({c} AS DOUBLE)) AS phi_{f}"
                      for f, w, c in _CARD)
_Z = "CAST(-1.2 AS DOUBLE) + " + " + ".join(f"phi_{f}" for f, _, _ in _CARD)

SCORED = f"""
scored0 AS (
  SELECT featured.*,
    {_PHI}
  FROM featured),
scored AS (SELECT *, 1.0 / (1.0 + exp(-({_Z}))) AS p FROM scored0),
drivers AS (
  SELECT customerID, feature, pos, value, impact,
         row_number() OVER (PARTITION BY customerID ORDER BY abs(impact) DESC, pos) AS driver_rank
  FROM (""" + "\n    UNION ALL ".join(
    f"SELECT customerID, '{f}' AS feature, {i} AS pos, {_xval(f)} AS value, phi_{f} AS impact FROM scored"
    for i, (f, _, _) in enumerate(_CARD)) + "))"

SPLIT = """
lab_counts AS (SELECT Churn, count(*) AS n_c FROM featured GROUP BY Churn),
tot AS (SELECT sum(n_c) AS n, (sum(n_c) * 20 + 99) // 100 AS n_test FROM lab_counts),
quota0 AS (
  SELECT l.Churn, (t.n_test * l.n_c) // t.n AS q0, (t.n_test * l.n_c) % t.n AS rem, t.n_test
  FROM lab_counts l, tot t),
quota AS (
  SELECT Churn, q0 + CASE WHEN row_number() OVER (ORDER BY rem DESC, Churn)
                          <= n_test - sum(q0) OVER () THEN 1 ELSE 0 END AS quota
  FROM quota0),
ranked AS (
  SELECT f.customerID, f.Churn,
         row_number() OVER (PARTITION BY f.Churn ORDER BY md5('42:' || f.customerID), f.customerID) AS r
  FROM featured f),
split AS (
  SELECT r.customerID, r.Churn, CASE WHEN r.r <= q.quota THEN 'test' ELSE 'train' END AS split,
         CASE WHEN r.r <= q.quota THEN NULL ELSE CAST((r.r - q.quota - 1) % 3 AS INTEGER) END AS fold
  FROM ranked r JOIN quota q ON r.Churn = q.Churn)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


BASE = with_ctes(RAW, CLEAN, FEATURED)
BASE_ENC = with_ctes(RAW, CLEAN, FEATURED, ENCODED)
BASE_SCORED = with_ctes(RAW, CLEAN, FEATURED, SCORED)
BASE_SPLIT = with_ctes(RAW, CLEAN, FEATURED, SPLIT)
BASE_SCORED_SPLIT = with_ctes(RAW, CLEAN, FEATURED, SCORED, SPLIT)

_RATE = half_up("sum(Churn)", "count(*)", 4)
_AVG_M = f"({half_up('sum(CAST(round(MonthlyCharges * 100) AS BIGINT))', 'count(*)', 0)} / 100)"


def _segment(dim: str) -> str:
    return (f"{BASE}\nSELECT {dim} AS segment, count(*) AS customers, CAST(sum(Churn) AS BIGINT) AS churned, "
            f"{_RATE} AS churn_rate, {_AVG_M} AS avg_monthly_charges FROM featured GROUP BY {dim}")


def _hist(col: str) -> str:
    return f"""{BASE},
mm AS (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM featured),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS width FROM mm),
b AS (SELECT CAST(least(floor((CAST({col} AS DOUBLE) - w.lo) / w.width), 29) AS INTEGER) AS bin, Churn, w.lo, w.width
      FROM featured, w WHERE {col} IS NOT NULL)
SELECT bin, Churn, count(*) AS n, round(any_value(lo) + bin * any_value(width), 4) AS bin_lo,
       round(any_value(lo) + (bin + 1) * any_value(width), 4) AS bin_hi
FROM b GROUP BY bin, Churn"""


_CORR_COLS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "Churn"] + [
    c for c in NUMERIC_FEATURES if c not in ("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")]


def _corr() -> str:
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            expr = (f"round(CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) * stddev_pop(CAST({b} AS DOUBLE)) = 0 "
                    f"THEN NULL ELSE covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / "
                    f"(stddev_pop(CAST({a} AS DOUBLE)) * stddev_pop(CAST({b} AS DOUBLE))) END, 4)")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {expr} AS r FROM featured")
    return BASE + "\n" + "\nUNION ALL ".join(parts)


_BOX = f"""{BASE},
q AS (SELECT Churn, count(MonthlyCharges) AS n, min(MonthlyCharges) AS mn, max(MonthlyCharges) AS mx,
             quantile_cont(MonthlyCharges, 0.25) AS q1, quantile_cont(MonthlyCharges, 0.5) AS q2,
             quantile_cont(MonthlyCharges, 0.75) AS q3 FROM featured GROUP BY Churn),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q),
w AS (SELECT f.Churn, min(CASE WHEN x.MonthlyCharges >= f.lf THEN x.MonthlyCharges END) AS lw,
             max(CASE WHEN x.MonthlyCharges <= f.uf THEN x.MonthlyCharges END) AS uw,
             CAST(sum(CASE WHEN x.MonthlyCharges < f.lf OR x.MonthlyCharges > f.uf THEN 1 ELSE 0 END) AS BIGINT) AS n_out
      FROM featured x JOIN f ON x.Churn = f.Churn GROUP BY f.Churn)
SELECT f.Churn, f.n, round(mn, 4) AS min, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
       round(mx, 4) AS max, round(lw, 4) AS lower_whisker, round(uw, 4) AS upper_whisker, n_out AS n_outliers
FROM f JOIN w ON f.Churn = w.Churn"""

_REQ_TC = f"""CASE WHEN regexp_matches(TotalCharges, '{NUMERIC_RE}')
                   THEN TRY_CAST(trim(TotalCharges) AS DOUBLE) END"""

_FEATURES_FOR_REQUESTS = f"""{BASE},
req0 AS (SELECT r.customerID, r.gender, r.SeniorCitizen, r.Partner, r.Dependents, r.tenure, r.PhoneService,
    r.MultipleLines, r.InternetService, r.OnlineSecurity, r.OnlineBackup, r.DeviceProtection, r.TechSupport,
    r.StreamingTV, r.StreamingMovies, r.Contract, r.PaperlessBilling, r.PaymentMethod, r.MonthlyCharges,
    coalesce(CASE WHEN isnan({_REQ_TC}) THEN NULL ELSE {_REQ_TC} END,
             r.MonthlyCharges * CAST(greatest(r.tenure, 1) AS DOUBLE)) AS TotalCharges
  FROM subscriber_raw r),
rf AS (
  SELECT req0.*,
    CASE WHEN tenure <= 0 THEN NULL WHEN tenure <= 6 THEN '0-6mo' WHEN tenure <= 12 THEN '6-12mo'
         WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' WHEN tenure <= 72 THEN '4-6yr'
         WHEN tenure > 72 THEN '6yr+' END AS tenure_group,
    TotalCharges / CAST(greatest(tenure, 1) AS DOUBLE) AS avg_monthly_spend,
    ({_SEC}) AS security_bundle_count,
    CAST(({_SEC}) >= 2 AS INTEGER) AS has_security_bundle,
    ({_STR}) AS streaming_bundle_count,
    CAST(({_STR}) = 2 AS INTEGER) AS has_streaming_bundle,
    CAST(tenure <= 6 AS INTEGER) AS is_new_customer,
    CAST(CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END AS INTEGER)
      AS contract_risk_score,
    {_NSV} AS num_services,
    MonthlyCharges / CAST({_NSV} AS DOUBLE) AS monthly_charge_per_service,
    MonthlyCharges / cmean.c_mean AS overpay_ratio
  FROM req0 LEFT JOIN cmean ON req0.Contract = cmean.c_contract)
SELECT customerID, SeniorCitizen, tenure, MonthlyCharges, TotalCharges, {_ENGINEERED},
    {_DUMMY_SQL}
FROM rf"""

_DOMAINS_SQL = [
    ("gender", ["Male", "Female"]), ("Partner", ["Yes", "No"]), ("Dependents", ["Yes", "No"]),
    ("PhoneService", ["Yes", "No"]), ("MultipleLines", ["Yes", "No", "No phone service"]),
    ("InternetService", ["Fiber optic", "DSL", "No"]),
] + [(c, ["Yes", "No", "No internet service"]) for c in
     ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]] + [
    ("Contract", ["Month-to-month", "One year", "Two year"]), ("PaperlessBilling", ["Yes", "No"]),
    ("PaymentMethod", ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]),
]


def _conditions(typed: bool = False) -> list[tuple[str, str]]:
    """(rule, violated?) over raw records, or over typed requests, whose TotalCharges is a number already."""
    conds = []
    for c, vals in _DOMAINS_SQL:
        lst = ", ".join(f"'{v}'" for v in vals)
        conds.append((f"{c}_not_allowed", f"{c} IS NOT NULL AND {c} NOT IN ({lst})"))
    tcn = f"(CASE WHEN isnan({_REQ_TC}) THEN NULL ELSE {_REQ_TC} END)"
    for c, lo, hi in [("SeniorCitizen", 0, 1), ("tenure", 0, 72), ("MonthlyCharges", 18.0, 120.0)]:
        conds.append((f"{c}_out_of_range", f"{c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})"))
    if not typed:
        conds.append(("TotalCharges_not_numeric", f"TotalCharges IS NOT NULL AND {tcn} IS NULL"))
    conds.append(("TotalCharges_out_of_range", f"{tcn} IS NOT NULL AND ({tcn} < 0.0 OR {tcn} > 9000.0)"))
    # Spark orders range rules as in RANGES: SeniorCitizen, tenure, MonthlyCharges, TotalCharges
    return conds


def _validation() -> str:
    conds = _conditions()
    names = ", ".join(f"CASE WHEN {cond} THEN '{n}' END" for n, cond in conds)
    count = " + ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END" for n, cond in conds)
    return (f"{with_ctes(RAW)}\nSELECT customerID, CAST({count} AS INTEGER) AS n_violations, "
            f"nullif(concat_ws('; ', {names}), '') AS error, CAST(({count}) = 0 AS INTEGER) AS is_valid "
            f"FROM subscriber_raw")


_TIER = ("CASE WHEN p > 0.8 THEN 'Critical' WHEN p > 0.6 THEN 'High' WHEN p > 0.4 THEN 'Moderate' "
         "ELSE 'Low' END")

_CLASS = """CASE
  WHEN contains(lower(feature), 'contract') OR contains(lower(feature), 'month-to-month') THEN 'contract_flexibility'
  WHEN contains(lower(feature), 'tenure') OR contains(lower(feature), 'new_customer') THEN 'new_customer'
  WHEN contains(lower(feature), 'charge') OR contains(lower(feature), 'overpay') THEN 'pricing'
  WHEN contains(lower(feature), 'security') OR contains(lower(feature), 'support') OR contains(lower(feature), 'tech') THEN 'service_gap'
  WHEN contains(lower(feature), 'fiber') OR contains(lower(feature), 'internet') THEN 'service_quality'
  WHEN contains(lower(feature), 'paperless') OR contains(lower(feature), 'electronic') THEN 'billing'
  ELSE 'general' END"""

# Requests with broken ones among them, by the first hex digit of md5(customerID): 0 cut off, 1 tenure is text,
# 2 unknown contract, 3 charge out of range, 4 no customerID.
_REQUESTS = """
requests AS (
  SELECT * REPLACE (CASE WHEN h = '2' THEN 'Weekly' ELSE Contract END AS Contract,
                    CASE WHEN h = '3' THEN CAST(500 AS DOUBLE) ELSE MonthlyCharges END AS MonthlyCharges,
                    CASE WHEN h = '1' THEN NULL ELSE tenure END AS tenure)
  FROM (SELECT *, substr(md5(customerID), 1, 1) AS h FROM subscriber_raw)),
judged AS (
  SELECT CASE WHEN h NOT IN ('0', '4') THEN customerID END AS customerID,
         CASE WHEN h = '0' THEN 'malformed_record' ELSE nullif(concat_ws('; ', """ + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _conditions(typed=True)) + """,
           CASE WHEN h = '1' THEN 'malformed_record' END, CASE WHEN h = '4' THEN 'customerID_missing' END), '') END AS error
  FROM requests)"""

_CLASSED = f"""{BASE_SCORED},
cls AS (SELECT customerID, {_CLASS} AS cls FROM drivers WHERE driver_rank <= 3),
flags AS (
  SELECT customerID,
    bool_or(cls = 'contract_flexibility') AS f_contract, bool_or(cls = 'pricing') AS f_pricing,
    bool_or(cls = 'billing') AS f_billing, bool_or(cls = 'service_gap') AS f_gap,
    bool_or(cls = 'new_customer') AS f_new, bool_or(cls = 'service_quality') AS f_quality
  FROM cls GROUP BY customerID),
answered AS (SELECT s.customerID, s.p, s.tenure, s.MonthlyCharges, f.* EXCLUDE (customerID),
                 {_TIER} AS risk_level,
                 NOT (f_contract OR f_pricing OR f_billing OR f_gap OR f_new OR f_quality) AS f_none
          FROM scored s JOIN flags f ON s.customerID = f.customerID)"""

_FLAGS = f"""{_CLASSED},
gated AS (SELECT * FROM answered WHERE p > 0.4)"""


def _money0(expr: str) -> str:
    return f"CAST(CAST(round_even({expr}, 0) AS BIGINT) AS VARCHAR)"


# The message texts once more, so that a changed word shows.
_TEXTS = {
    "new": "Your first months with us should go well. This letter is about how we can help with that.",
    "mid": ("You have now been with us for ", " months, and we want you to have every reason to stay."),
    "long": ("After ", " months you know us well, and a customer of so many months is worth a good deal to us."),
    "annual": ("- Yearly contract: change to it and each month costs 20% less, $", " in a year."),
    "lock": ("- Lower bill: $", " off every month for half a year, and no price rise meanwhile."),
    "security": "- Security and technical support: three months of both at no charge.",
    "first": "- Television and films: one month of both streaming packages at no charge.",
    "speed": "- Faster line: the next higher speed for half a year at your present price.",
    "credit": ("- Credit: $", " off your next bill."),
    "critical": "We hold this for you for two days.",
    "high": "We hold this for you for one week.",
    "moderate": "There is no hurry: answer when it suits you.",
    "intro": "What we can do for you:",
    "end": ["Answer this letter or call the number on your bill, and we arrange the rest.",
            "", "If something else troubles you, tell us that too.", "", "Kind regards", "Customer Care", "Your telephone company"],
}


def _messages(gated: bool = True) -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def around(key: str, inner: str) -> str:
        return f"{lit(_TEXTS[key][0])} || {inner} || {lit(_TEXTS[key][1])}"

    annual = _money0("MonthlyCharges * CAST(0.2 AS DOUBLE) * CAST(12.0 AS DOUBLE)")
    lock = _money0("MonthlyCharges * CAST(0.15 AS DOUBLE)")
    loyal = _money0("MonthlyCharges * CAST(0.1 AS DOUBLE)")
    offers_sql = (f"concat_ws(chr(10), CASE WHEN f_contract THEN {around('annual', annual)} END, "
                  f"CASE WHEN f_pricing OR f_billing THEN {around('lock', lock)} END, "
                  f"CASE WHEN f_gap THEN {lit(_TEXTS['security'])} END, "
                  f"CASE WHEN f_new THEN {lit(_TEXTS['first'])} END, "
                  f"CASE WHEN f_quality THEN {lit(_TEXTS['speed'])} END, "
                  f"CASE WHEN f_none THEN {around('credit', loyal)} END)")
    months = "CAST(tenure AS VARCHAR)"
    opening = (f"CASE WHEN tenure <= 6 THEN {lit(_TEXTS['new'])} WHEN tenure <= 24 THEN {around('mid', months)} "
               f"ELSE {around('long', months)} END")
    urgency = (f"CASE WHEN p > 0.8 THEN {lit(_TEXTS['critical'])} WHEN p > 0.6 THEN {lit(_TEXTS['high'])} "
               f"ELSE {lit(_TEXTS['moderate'])} END")
    parts = ["'Dear Customer #' || customerID || ','", "''", opening, "''", lit(_TEXTS["intro"]), "''", offers_sql,
             "''", urgency, "''"] + [lit(t) for t in _TEXTS["end"]]
    source, tier = (_FLAGS, "") if gated else (_CLASSED, "risk_level, ")
    return (f"{source}\nSELECT customerID AS customer_id, round(p, 4) AS churn_probability, {tier}"
            f"concat_ws(chr(10), {', '.join(parts)}) AS message FROM {'gated' if gated else 'answered'}")


def _four(x: str) -> str:
    return f"CAST(CAST(round({x}, 4) AS DECIMAL(18,4)) AS VARCHAR)"


def _prompts() -> str:
    lines = ["'Write an email that gives a subscriber of a telephone company good reason to stay.'", "''", "'Subscriber'",
             "'- Customer ID: ' || customerID", "'- Tenure: ' || CAST(tenure AS VARCHAR) || ' months'", "'- Contract: ' || Contract",
             "'- Monthly Charges: $' || printf('%.2f', MonthlyCharges)", "'- Internet Service: ' || InternetService",
             "'- Churn Probability: ' || printf('%.1f', round_even(p * 100, 1)) || '%'", "''",
             "'What moves the score, strongest first (JSON):'", "factors", "''", "'The email should'",
             "'- write as a person who knows this customer'", "'- answer the reasons listed above, the strongest first'",
             "'- name one offer and its amount'", "'- say until when it holds, and press no further'", "'- stay below 200 words'",
             "'- end with the one step the customer should take'"]
    factor = ("'{\"feature\":\"' || feature || '\",\"value\":' || " + _four("value") + " || ',\"shap_impact\":' || " + _four("impact")
              + " || ',\"direction\":\"' || CASE WHEN impact > 0 THEN 'increases' ELSE 'decreases' END || '\"}'")
    return (f"{BASE_SCORED},\nfactors AS (SELECT customerID, '[' || string_agg({factor}, ',' ORDER BY driver_rank) || ']' AS factors "
            f"FROM drivers WHERE driver_rank <= 5 GROUP BY customerID)\n"
            f"SELECT customerID AS customer_id, concat_ws(chr(10), {', '.join(lines)}) AS prompt "
            f"FROM scored JOIN factors USING (customerID) WHERE p > 0.4")


# The batch endpoint's answers: a post holds the customers that share five digits, in order.
_BATCHES = "batches AS (SELECT r.*, substr(r.customerID, 1, 6) AS source, CASE WHEN h = '0' THEN 'malformed_record' ELSE nullif(concat_ws('; ', " \
    "CASE WHEN h = '1' THEN 'tenure_wrong_type' END, " + ", ".join(
        f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _conditions(typed=True)) + "), '') END AS error FROM requests r)"


def _request_batches() -> str:
    good = lambda x: f"CASE WHEN error IS NULL THEN {x} END"
    return f"""{BASE_SCORED},{_REQUESTS},
{_BATCHES}
SELECT b.source, CAST(row_number() OVER (PARTITION BY b.source ORDER BY b.customerID) - 1 AS INTEGER) AS position,
  CAST(count(*) OVER (PARTITION BY b.source) AS INTEGER) AS n_elements,
  CASE WHEN h NOT IN ('0', '4') THEN b.customerID END AS customerID, error, {good('round(p, 4)')} AS churn_probability,
  {good('CAST(CAST(p >= 0.5 AS INTEGER) AS DOUBLE)')} AS churn_prediction, {good(_TIER)} AS risk_level
FROM batches b JOIN scored s ON s.customerID = b.customerID"""


_REQUEST_DEFAULTS = [
    ("gender", "'Male'"), ("SeniorCitizen", "0"), ("Partner", "'No'"), ("Dependents", "'No'"), ("tenure", "1"), ("PhoneService", "'Yes'"),
    ("MultipleLines", "'No'"), ("InternetService", "'Fiber optic'"), ("OnlineSecurity", "'No'"), ("OnlineBackup", "'No'"),
    ("DeviceProtection", "'No'"), ("TechSupport", "'No'"), ("StreamingTV", "'No'"), ("StreamingMovies", "'No'"),
    ("Contract", "'Month-to-month'"), ("PaperlessBilling", "'Yes'"), ("PaymentMethod", "'Electronic check'"), ("MonthlyCharges", "CAST(70 AS DOUBLE)"),
]


def _struck(tag: str, digits: str) -> str:
    return f"substr(md5('{tag}:' || customerID), 1, 1) IN ({', '.join(repr(d) for d in digits)})"


def _request_defaults() -> str:
    filled = ", ".join(f"CASE WHEN {_struck(c, '012')} THEN {d} ELSE {c} END AS {c}" for c, d in _REQUEST_DEFAULTS)
    total = f"(CASE WHEN isnan({_REQ_TC}) THEN NULL ELSE {_REQ_TC} END)"
    return f"""{with_ctes(RAW)},
filled AS (SELECT customerID, {filled}, CASE WHEN {_struck('TotalCharges', '012')} THEN NULL ELSE {total} END AS total FROM subscriber_raw)
SELECT * EXCLUDE (total), coalesce(total, MonthlyCharges * CAST(greatest(tenure, 1) AS DOUBLE)) AS TotalCharges FROM filled"""


def _request_rules() -> str:
    bad = {"SeniorCitizen": "5", "tenure": "99", "MonthlyCharges": "CAST(500 AS DOUBLE)", "TotalCharges": "'99999'"}
    names = [c for c, _ in _DOMAINS_SQL] + ["SeniorCitizen", "tenure", "MonthlyCharges"]
    cols = ", ".join(f"CASE WHEN {_struck('bad ' + c, '0')} THEN {bad.get(c, repr('other'))} ELSE {c} END AS {c}" for c in names)
    conds = _conditions()
    errors = ", ".join(f"CASE WHEN {cond} THEN '{n}' END" for n, cond in conds)
    count = " + ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END" for _, cond in conds)
    return f"""{with_ctes(RAW)},
broken AS (SELECT customerID, {cols}, CASE WHEN {_struck('bad TotalCharges', '1')} THEN 'n/a' WHEN {_struck('bad TotalCharges', '0')} THEN '99999'
  ELSE TotalCharges END AS TotalCharges FROM subscriber_raw)
SELECT customerID, CAST({count} AS INTEGER) AS n_violations, nullif(concat_ws('; ', {errors}), '') AS error,
  CAST(({count}) = 0 AS INTEGER) AS is_valid FROM broken"""


def _sparse() -> str:
    value = lambda c: "coalesce(contract_risk_score, 2)" if c == "contract_risk_score" else f'"{c}"'
    names = list(NUMERIC_FEATURES) + [f"{c}_{v}" for c, v in DUMMIES]
    parts = "\nUNION ALL ".join(f"SELECT customerID, CAST({i} AS INTEGER) AS feature_index, CAST({value(c)} AS DOUBLE) AS value FROM encoded"
                                for i, c in enumerate(names))
    return f"{BASE_ENC}\nSELECT * FROM ({parts}) WHERE value <> 0"


def _rule_metrics() -> str:
    """One row a rule: the metrics at 0.5 and the AUC, by plain window sums."""
    rules = [("scorecard", "p"), ("contract_rule", "CASE contract_risk_score WHEN 3 THEN 0.6 WHEN 1 THEN 0.1 ELSE 0.3 END"),
             ("tenure_rule", "CAST(0.75 AS DOUBLE) - CAST(0.01 AS DOUBLE) * CAST(tenure AS DOUBLE)")]
    scores = "\n  UNION ALL ".join(f"SELECT {i} AS position, '{m}' AS model, Churn, CAST({x} AS DOUBLE) AS s FROM ts" for i, (m, x) in enumerate(rules))
    return f"""{_TEST_SCORED},
rs AS ({scores}),
rper AS (SELECT position, model, s, sum(CASE WHEN Churn = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN Churn = 1 THEN 0 ELSE 1 END) AS neg
         FROM rs GROUP BY ALL),
rpre AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM rper),
rc AS (SELECT position, model, sum(pos) AS n_pos, sum(neg) AS n_neg, sum(pos * (2 * below + neg)) AS num2,
         sum(CASE WHEN s >= 0.5 THEN pos ELSE 0 END) AS tp, sum(CASE WHEN s >= 0.5 THEN neg ELSE 0 END) AS fp,
         sum(CASE WHEN s >= 0.5 THEN 0 ELSE neg END) AS tn, sum(CASE WHEN s >= 0.5 THEN 0 ELSE pos END) AS fn FROM rpre GROUP BY position, model),
comparison AS (SELECT position, model, coalesce({half_up('tp + tn', 'tp + fp + tn + fn', 4)}, 0.0) AS accuracy,
  coalesce({half_up('tp', 'tp + fp', 4)}, 0.0) AS precision, coalesce({half_up('tp', 'tp + fn', 4)}, 0.0) AS recall,
  coalesce({half_up('2 * tp', '2 * tp + fp + fn', 4)}, 0.0) AS f1, {half_up('num2', '2 * n_pos * n_neg', 4)} AS roc_auc FROM rc)"""


def _offer_mix() -> str:
    rows = [
        ("annual_plan", "f_contract", "CAST(round_even(MonthlyCharges * CAST(0.2 AS DOUBLE) * CAST(12.0 AS DOUBLE), 0) AS BIGINT)"),
        ("price_lock", "f_pricing OR f_billing", "CAST(round_even(MonthlyCharges * CAST(0.15 AS DOUBLE), 0) AS BIGINT)"),
        ("security_bundle", "f_gap", "CAST(NULL AS BIGINT)"),
        ("new_customer_bonus", "f_new", "CAST(NULL AS BIGINT)"),
        ("speed_boost", "f_quality", "CAST(NULL AS BIGINT)"),
        ("loyalty_credit", "f_none", "CAST(round_even(MonthlyCharges * CAST(0.1 AS DOUBLE), 0) AS BIGINT)"),
    ]
    union = "\n  UNION ALL ".join(f"SELECT '{k}' AS offer, risk_level, {amt} AS amount FROM gated WHERE {cond}"
                                  for k, cond, amt in rows)
    return (f"{_FLAGS}\nSELECT offer, risk_level, count(*) AS customers, "
            f"CAST(coalesce(sum(amount), 0) AS BIGINT) AS quoted_amount FROM ({union}) GROUP BY offer, risk_level")


def _revenue_report(pct: float = 5.0) -> str:
    # saved = floor(n_churned * pct / 100); pct given with one decimal -> exact in tenths
    tenths = int(round(pct * 10))
    return f"""{BASE},
b AS (SELECT count(*) AS n, CAST(coalesce(sum(Churn), 0) AS BIGINT) AS nc,
             coalesce(sum(CAST(round(MonthlyCharges * 100) AS BIGINT)), 0) AS cents,
             coalesce(sum(CASE WHEN Churn = 1 THEN CAST(round(MonthlyCharges * 100) AS BIGINT) END), 0) AS ch
      FROM featured),
sv AS (SELECT *, (nc * {tenths}) // 1000 AS saved FROM b),
rk AS (SELECT CAST(round(MonthlyCharges * 100) AS BIGINT) AS c,
              row_number() OVER (ORDER BY md5('42:' || customerID), customerID) AS r
       FROM featured WHERE Churn = 1),
s AS (SELECT coalesce(sum(c), 0) AS sc FROM rk, sv WHERE rk.r <= sv.saved),
m AS (SELECT sv.*, s.sc, s.sc * 120 AS annual_mills, sv.saved * 50000 AS camp_mills, s.sc * 3 AS disc_mills
      FROM sv, s)
SELECT 'Reduce churn by {float(pct)}%' AS scenario, n AS total_customers, nc AS churned_customers,
  {half_up('nc * 100', 'n', 2)} AS churn_rate,
  ({half_up('cents', 'n', 0)} / 100) AS avg_monthly_revenue_per_customer,
  cents / 100 AS total_monthly_revenue,
  ch * 12 / 100 AS annual_revenue_loss_from_churn,
  '{float(pct)}%' AS churn_reduction_target,
  saved AS customers_saved,
  {half_up('(nc - saved) * 100', 'n', 2)} AS new_churn_rate,
  sc / 100 AS monthly_revenue_recovered,
  {mills('annual_mills')} AS annual_revenue_recovered,
  {mills('camp_mills')} AS retention_campaign_cost,
  {mills('disc_mills')} AS discount_cost,
  {mills('camp_mills + disc_mills')} AS total_retention_cost,
  {mills('annual_mills - camp_mills - disc_mills')} AS net_annual_impact,
  CASE WHEN camp_mills + disc_mills > 0
       THEN {signed_half_up('(annual_mills - camp_mills - disc_mills) * 100', 'camp_mills + disc_mills', 1)}
       ELSE 0.0 END AS roi_pct
FROM m"""


def _revenue_sensitivity() -> str:
    pcts = ", ".join(f"({p})" for p in [1, 2, 3, 5, 7, 10, 15])
    return f"""{BASE},
nc AS (SELECT CAST(coalesce(sum(Churn), 0) AS BIGINT) AS nc FROM featured),
sc AS (SELECT p.pct, (nc.nc * p.pct) // 100 AS saved,
              CASE WHEN nc.nc = 0 THEN 0 ELSE greatest((nc.nc * p.pct) // 100, 1) END AS take
       FROM (VALUES {pcts}) p(pct), nc),
rk AS (SELECT CAST(round(MonthlyCharges * 100) AS BIGINT) AS c,
              row_number() OVER (ORDER BY md5('42:' || customerID), customerID) AS r
       FROM featured WHERE Churn = 1),
agg AS (SELECT sc.pct, sc.saved, coalesce(sum(rk.c), 0) AS s
        FROM sc LEFT JOIN rk ON rk.r <= sc.take GROUP BY sc.pct, sc.saved),
m AS (SELECT pct, saved, s * 120 AS rec, saved * 50000 + s * 3 AS cost FROM agg)
SELECT CAST(pct AS INTEGER) AS reduction_pct, CAST(saved AS BIGINT) AS customers_saved,
  {mills('rec')} AS annual_revenue_recovered, {mills('cost')} AS total_cost,
  {mills('rec - cost')} AS net_impact,
  CASE WHEN cost > 0 THEN {signed_half_up('(rec - cost) * 100', 'cost', 1)} ELSE 0.0 END AS roi_pct
FROM m"""


_TEST_SCORED = f"""{BASE_SCORED_SPLIT},
ts AS (SELECT s.*, CAST(s.p >= 0.5 AS INTEGER) AS prediction FROM scored s
       JOIN split x ON s.customerID = x.customerID WHERE x.split = 'test')"""

_CLASS_METRICS = f"""{_TEST_SCORED},
c AS (SELECT CAST(sum(CASE WHEN Churn = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN Churn <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN Churn <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(sum(CASE WHEN Churn = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM ts)
SELECT tp, fp, tn, fn,
  coalesce({half_up('tp + tn', 'tp + fp + tn + fn', 4)}, 0.0) AS accuracy,
  coalesce({half_up('tp', 'tp + fp', 4)}, 0.0) AS precision,
  coalesce({half_up('tp', 'tp + fn', 4)}, 0.0) AS recall,
  coalesce({half_up('2 * tp', '2 * tp + fp + fn', 4)}, 0.0) AS f1
FROM c"""

_ROC = f"""{_TEST_SCORED},
per AS (SELECT p AS s, sum(CASE WHEN Churn = 1 THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN Churn = 1 THEN 0 ELSE 1 END) AS neg FROM ts GROUP BY p),
pre AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS neg_below FROM per),
a AS (SELECT sum(pos) AS n_pos, sum(neg) AS n_neg, sum(pos * (2 * neg_below + neg)) AS num2 FROM pre)
SELECT CAST(coalesce(n_pos, 0) AS BIGINT) AS n_pos, CAST(coalesce(n_neg, 0) AS BIGINT) AS n_neg,
       {half_up('num2', '2 * n_pos * n_neg', 4)} AS roc_auc FROM a"""

_STD_COLS = list(NUMERIC_FEATURES)


def _standardize() -> str:
    def x(c):
        return "CAST(coalesce(contract_risk_score, 2) AS DOUBLE)" if c == "contract_risk_score" else f"CAST({c} AS DOUBLE)"
    stats = ", ".join(f"avg({x(c)}) AS m_{c}, stddev_samp({x(c)}) AS s_{c}" for c in _STD_COLS)
    cols = ", ".join(f"round(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 0.0 ELSE ({x(c)} - m_{c}) / s_{c} END, 4) AS z_{c}"
                     for c in _STD_COLS)
    return f"""{BASE_SPLIT},
st AS (SELECT {stats} FROM featured f JOIN split s ON f.customerID = s.customerID WHERE s.split = 'train')
SELECT customerID, {cols} FROM featured, st"""


def _importance() -> str:
    n = len(_CARD)
    del n
    parts = "\n  UNION ALL ".join(
        f"SELECT {i} AS pos, '{f}' AS feature, avg(abs(phi_{f})) AS importance FROM scored"
        for i, (f, _, _) in enumerate(_CARD))
    return f"""{BASE_SCORED},
imp AS ({parts})
SELECT importance_rank, feature, round(importance, 4) AS importance FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, pos) AS INTEGER) AS importance_rank FROM imp)
WHERE importance_rank <= 20"""


def _spread() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT '{f}' AS feature, {_xval(f)} AS value, phi_{f} AS impact, avg({_xval(f)}) OVER () AS mean FROM scored"
        for f, _, _ in _CARD)
    return f"""{BASE_SCORED},
l AS ({parts})
SELECT feature, CASE WHEN value > mean THEN 'high' ELSE 'low' END AS value_half, count(*) AS n,
       round(quantile_cont(impact, 0.25), 4) + 0.0 AS impact_q1,
       round(quantile_cont(impact, 0.5), 4) + 0.0 AS impact_median,
       round(quantile_cont(impact, 0.75), 4) + 0.0 AS impact_q3
FROM l GROUP BY 1, 2"""


ORACLE: dict[str, str] = {
    "clean_subscribers": f"{with_ctes(RAW, CLEAN)}\nSELECT * FROM clean",
    "features_engineered": f"{BASE}\nSELECT * FROM featured",
    "features_encoded": f"{BASE_ENC}\nSELECT * FROM encoded",
    "encoder_categories": f"""{with_ctes(RAW)},
pairs AS (""" + "\n  UNION ".join(
        f"SELECT DISTINCT '{c}' AS column_name, {c} AS category FROM subscriber_raw WHERE {c} IS NOT NULL"
        for c in ["gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService",
                  "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                  "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod"]) + """),
lv AS (SELECT column_name, category,
              CAST(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS INTEGER) AS level_index
       FROM pairs
       UNION ALL SELECT 'tenure_group', v, CAST(i AS INTEGER) FROM (VALUES ('0-6mo', 0), ('6-12mo', 1),
         ('1-2yr', 2), ('2-4yr', 3), ('4-6yr', 4), ('6yr+', 5)) t(v, i))
SELECT column_name, category, level_index, CAST(level_index = 0 AS INTEGER) AS dropped,
       CASE WHEN level_index > 0 THEN column_name || '_' || category END AS feature_name FROM lv""",
    "features_for_requests": _FEATURES_FOR_REQUESTS,
    "request_validation": _validation(),
    "kpi_summary": f"""{BASE}
SELECT count(*) AS total_customers, CAST(sum(Churn) AS BIGINT) AS churned_customers,
  {half_up('sum(Churn)', 'count(*)', 4)} AS churn_rate,
  {_AVG_M} AS avg_monthly_revenue,
  coalesce(sum(CAST(round(MonthlyCharges * 100) AS BIGINT)), 0) / 100 AS total_monthly_revenue,
  coalesce(sum(CASE WHEN Churn = 1 THEN CAST(round(MonthlyCharges * 100) AS BIGINT) ELSE 0 END), 0) / 100
    AS churned_monthly_revenue,
  coalesce(sum(CASE WHEN Churn = 1 THEN CAST(round(MonthlyCharges * 100) AS BIGINT) ELSE 0 END), 0) * 12 / 100
    AS annual_revenue_loss
FROM featured""",
    "churn_by_contract": _segment("Contract"),
    "churn_by_internet": _segment("InternetService"),
    "churn_by_payment": _segment("PaymentMethod"),
    "churn_segments_grouping_sets": f"""{BASE}
SELECT CASE WHEN GROUPING(Contract) = 0 THEN 'Contract' WHEN GROUPING(InternetService) = 0 THEN 'InternetService'
            ELSE 'PaymentMethod' END AS dimension,
       coalesce(Contract, InternetService, PaymentMethod) AS segment,
       count(*) AS customers, CAST(sum(Churn) AS BIGINT) AS churned, {_RATE} AS churn_rate,
       {_AVG_M} AS avg_monthly_charges
FROM featured GROUP BY GROUPING SETS ((Contract), (InternetService), (PaymentMethod))""",
    "churn_new_vs_rest": f"""{BASE},
g AS (SELECT is_new_customer, count(*) AS customers, CAST(sum(Churn) AS BIGINT) AS churned
      FROM featured GROUP BY is_new_customer),
o AS (SELECT *, sum(customers) OVER () - customers AS on_, sum(churned) OVER () - churned AS oc FROM g)
SELECT is_new_customer, customers, churned, {half_up('churned', 'customers', 4)} AS churn_rate,
       {half_up('churned * on_', 'customers * oc', 4)} AS rate_ratio_vs_other FROM o""",
    "churn_counts": f"{BASE}\nSELECT Churn, count(*) AS customers FROM featured GROUP BY Churn",
    "hist_tenure": _hist("tenure"),
    "hist_monthly": _hist("MonthlyCharges"),
    "box_monthly": _BOX,
    "correlation_matrix": _corr(),
    "stratified_split": f"{BASE_SPLIT}\nSELECT customerID, Churn, split FROM split",
    "stratified_folds": f"{BASE_SPLIT}\nSELECT customerID, Churn, fold FROM split WHERE split = 'train'",
    "sample_churners": f"""{BASE},
n AS (SELECT (CAST(sum(Churn) AS BIGINT) * 50) // 1000 AS saved FROM featured),
rk AS (SELECT customerID, MonthlyCharges,
              CAST(row_number() OVER (ORDER BY md5('42:' || customerID), customerID) AS BIGINT) AS sample_rank
       FROM featured WHERE Churn = 1)
SELECT customerID, MonthlyCharges, sample_rank FROM rk, n WHERE sample_rank <= n.saved""",
    "background_sample": f"""{BASE_SPLIT},
rk AS (SELECT customerID,
              CAST(row_number() OVER (ORDER BY md5('42:' || customerID), customerID) AS BIGINT) AS sample_rank
       FROM split WHERE split = 'test')
SELECT customerID, sample_rank FROM rk WHERE sample_rank <= 200""",
    "revenue_report": _revenue_report(5.0),
    "revenue_sensitivity": _revenue_sensitivity(),
    "score_batch": f"""{BASE_SCORED}
SELECT s.customerID, round(p, 4) AS churn_probability, CAST(p >= 0.5 AS INTEGER) AS churn_prediction,
       {_TIER} AS risk_level, d1.feature AS top_factor_1, d2.feature AS top_factor_2, d3.feature AS top_factor_3
FROM scored s
LEFT JOIN drivers d1 ON d1.customerID = s.customerID AND d1.driver_rank = 1
LEFT JOIN drivers d2 ON d2.customerID = s.customerID AND d2.driver_rank = 2
LEFT JOIN drivers d3 ON d3.customerID = s.customerID AND d3.driver_rank = 3""",
    "score_bands": f"""{BASE_SCORED}
SELECT CASE WHEN p * 100 < 40 THEN '0-40' WHEN p * 100 < 60 THEN '40-60' WHEN p * 100 < 80 THEN '60-80'
            ELSE '80-100' END AS band, count(*) AS customers FROM scored GROUP BY 1""",
    "top_drivers": f"""{BASE_SCORED}
SELECT customerID, CAST(driver_rank AS INTEGER) AS driver_rank, feature, round(value, 4) + 0.0 AS value,
       round(impact, 4) + 0.0 AS shap_impact, CASE WHEN impact > 0 THEN 'increases' ELSE 'decreases' END AS direction
FROM drivers WHERE driver_rank <= 5""",
    "driver_classes": f"""{BASE_SCORED}
SELECT customerID, CAST(driver_rank AS INTEGER) AS driver_rank, feature, {_CLASS} AS driver_class
FROM drivers WHERE driver_rank <= 3""",
    "global_importance": _importance(),
    "importance_spread": _spread(),
    "retention_messages": _messages(),
    "retention_response": _messages(gated=False),
    "stream_scoring": f"""{BASE_SCORED},{_REQUESTS}
SELECT s.customerID, round(p, 4) AS churn_probability, CAST(p >= 0.5 AS INTEGER) AS churn_prediction, {_TIER} AS risk_level
FROM scored s JOIN judged j ON s.customerID = j.customerID WHERE j.error IS NULL""",
    "stream_quarantine": f"""{with_ctes(RAW)},{_REQUESTS}
SELECT customerID, error FROM judged WHERE error IS NOT NULL""",
    "offer_mix": _offer_mix(),
    "class_metrics": _CLASS_METRICS,
    "roc_auc": _ROC,
    "dataset_metadata": f"""{BASE_SPLIT}
SELECT 45 AS n_features, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS n_test,
       {half_up('sum(Churn)', 'count(*)', 4)} AS churn_rate FROM split""",
    "standardize": _standardize(),
    "prompt_table": _prompts(),
    "features_sparse": _sparse(),
    "request_batches": _request_batches(),
    "request_defaults": _request_defaults(),
    "request_rules": _request_rules(),
    "revenue_quantiles": """
WITH o AS (SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, CAST(o_totalprice AS DOUBLE) AS v FROM orders WHERE o_totalprice IS NOT NULL),
r AS (SELECT month, v, row_number() OVER (PARTITION BY month ORDER BY v) AS i, count(*) OVER (PARTITION BY month) AS n FROM o)
SELECT month, any_value(n) AS n, """ + ", ".join(
        f"min(CASE WHEN i >= {q} * n THEN v END) AS {c}" for c, q in (("p05", 0.05), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("p95", 0.95)))
    + " FROM r GROUP BY month",
    "csv_roundtrip": f"{with_ctes(RAW)}\nSELECT * FROM subscriber_raw",
    "attributions_saved": f"{BASE_SCORED}\nSELECT customerID, feature, round(value, 4) + 0.0 AS value, round(impact, 4) + 0.0 AS impact FROM drivers",
}
ORACLE["rule_compare"] = f"{_rule_metrics()}\nSELECT model, accuracy, precision, recall, f1, roc_auc FROM comparison"
ORACLE["rule_best_per_metric"] = f"""{_rule_metrics()}
SELECT metric, first(model ORDER BY value DESC, position) AS best_model, max(value) AS value
FROM (UNPIVOT comparison ON accuracy, precision, recall, f1, roc_auc INTO NAME metric VALUE value) GROUP BY metric"""
