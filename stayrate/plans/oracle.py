"""The same questions as plain SQL, for another engine to answer on the same tables.

Rates and means are rounded half up in whole-number arithmetic, so that they match decimal
rounding exactly; unrounded measures are rounded to a stated number of digits on both sides.
"""

from __future__ import annotations

from stayrate.operators.eda import BOXED, CORRELATED
from stayrate.operators.joint import DIMENSIONS
from stayrate.schema import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    COLUMN_MAP,
    CUSTOMER_COLUMNS,
    DOMAINS,
    MAX_LENGTHS,
    NON_NEGATIVE_COLUMNS,
    NUMERIC_FEATURES,
    PROTECTIVE_ADD_ONS,
    REQUIRED_COLUMNS,
    SERVICE_ADD_ONS,
    TEXT_COLUMNS,
    WHITESPACE,
    YES_NO_COLUMNS,
)
from stayrate.sources.derived import CUSTOMERS_SQL, RAW_SQL, SCORES_SQL

# --- shared expressions ----------------------------------------------------

CHURNED = "sum(CASE WHEN churn THEN 1 ELSE 0 END)"
CENTS = "sum(CAST(monthly_charges * 100 AS BIGINT))"
MONEY_COLUMNS = ["monthly_charges", "total_charges", "clv"]


def ratio(part: str, whole: str, digits: int) -> str:
    """part / whole for whole numbers, rounded half up."""
    scale = 10**digits
    return (
        f"CAST((2 * CAST({part} AS HUGEINT) * {scale} + ({whole})) // (2 * ({whole})) AS DOUBLE) / {scale}"
    )


RATE = ratio(f"100 * {CHURNED}", "count(*)", 2) + " AS churn_rate_pct"
REVENUE = f"CAST({CENTS} AS DOUBLE) / 100 AS total_monthly_revenue"
AVG_CHARGES = ratio(CENTS, "100 * count(*)", 2) + " AS avg_monthly_charges"
AVG_TENURE = ratio("sum(tenure_months)", "count(*)", 1) + " AS avg_tenure_months"
N = "count(*) AS customers"
CHURNED_N = f"CAST({CHURNED} AS BIGINT) AS churned"
CLV = "CAST(monthly_charges * 12 AS DECIMAL(12,2))"
TIE = "concat(md5(customer_id), customer_id)"


def doubles(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLUMNS else c for c in columns)


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


BUCKET = """CASE WHEN tenure_months <= 12 THEN '0-12 months' WHEN tenure_months <= 24 THEN '13-24 months'
  WHEN tenure_months <= 48 THEN '25-48 months' ELSE '49+ months' END"""
SEGMENT = """CASE WHEN contract_type = 'Month-to-month' AND payment_method = 'Electronic check'
    THEN 'Month-to-month + Electronic check'
  WHEN contract_type IN ('One year', 'Two year')
    AND payment_method IN ('Bank transfer (automatic)', 'Credit card (automatic)') THEN 'Annual+ contract + Autopay'
  ELSE 'Other' END"""
SERVICES = " + ".join(
    ["CAST(phone_service AS INT)", "CASE WHEN internet_service = 'No' THEN 0 ELSE 1 END"]
    + [f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in SERVICE_ADD_ONS]
)
FLAGGED_VALUE = """CASE WHEN churn_probability >= {t} AND churn THEN 0.25 * clv - 20
  WHEN churn_probability >= {t} THEN -20 WHEN churn THEN -clv ELSE 0 END"""
WHITE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

# --- relations that queries build on ---------------------------------------


def _typed(raw: str, name: str) -> str:
    if name == "senior_citizen":
        return f"CAST(TRY_CAST({raw} AS INT) AS BOOLEAN)"
    if name in YES_NO_COLUMNS:
        return f"CASE {raw} WHEN 'Yes' THEN true WHEN 'No' THEN false END"
    number = {"tenure_months": "INT", "monthly_charges": "DECIMAL(8,2)", "total_charges": "DECIMAL(10,2)"}
    return f"TRY_CAST({raw} AS {number[name]})" if name in number else raw


_FILLED = "CASE WHEN total_charges IS NULL AND tenure_months = 0 THEN 0 ELSE total_charges END AS total_charges"

RELATIONS = {
    "customers": CUSTOMERS_SQL.replace("{orders}", "orders").replace("{customer}", "customer"),
    "raw": RAW_SQL.replace("{customers}", "customers"),
    "loaded": "SELECT seq, "
    + ", ".join(f"{_typed(raw, name)} AS {name}" for raw, name in COLUMN_MAP.items())
    + " FROM raw",
    "tidy": f"SELECT * REPLACE ({_FILLED}) FROM customers",
    "cuts": """SELECT quantile_cont(CAST(total_charges AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST(monthly_charges AS DOUBLE), 1/3) AS low,
  quantile_cont(CAST(monthly_charges AS DOUBLE), 2/3) AS high FROM tidy""",
    "features": f"""SELECT tidy.*, {BUCKET} AS tenure_group, {SERVICES} AS service_count,
  CAST(total_charges AS DOUBLE) > median AS high_value_customer,
  internet_service = 'Fiber optic' AS premium_customer,
  payment_method IN ('Bank transfer (automatic)', 'Credit card (automatic)') AS autopay_customer,
  CASE WHEN CAST(monthly_charges AS DOUBLE) <= low THEN 'Low'
       WHEN CAST(monthly_charges AS DOUBLE) <= high THEN 'Medium' ELSE 'High' END AS revenue_category
FROM tidy CROSS JOIN cuts""",
    "scores": SCORES_SQL.replace("{customers}", "customers"),
    "grid": "SELECT CAST(range AS DOUBLE) / 100 AS threshold FROM range(5, 96)",
    "sweep": f"""SELECT threshold, CAST(sum({FLAGGED_VALUE.format(t="threshold")}) AS DOUBLE) AS business_value
FROM scores CROSS JOIN grid GROUP BY threshold""",
    "best": "SELECT * FROM sweep ORDER BY business_value DESC, threshold LIMIT 1",
    "active": """SELECT *, churn_probability * CAST(clv AS DOUBLE) AS revenue_at_risk,
  CAST(20 AS DOUBLE) AS retention_offer_cost,
  churn_probability * CAST(0.25 AS DOUBLE) * CAST(clv AS DOUBLE) - 20 AS expected_net_benefit
FROM scores WHERE NOT churn""",
    "recommended": """SELECT customer_id, churn_probability, CAST(monthly_charges AS DOUBLE) AS monthly_charges,
  CAST(clv AS DOUBLE) AS clv, revenue_at_risk, retention_offer_cost, expected_net_benefit,
  CASE WHEN churn_probability < (SELECT threshold FROM best) THEN 'No Action'
       WHEN expected_net_benefit > 0 THEN 'Retain' ELSE 'Monitor' END AS recommended_action
FROM active""",
    "dashboard": """SELECT c.*, r.churn_probability, r.clv, r.revenue_at_risk, r.retention_offer_cost,
  r.expected_net_benefit, r.recommended_action
FROM customers c LEFT JOIN recommended r ON c.customer_id = r.customer_id""",
    "placed": """SELECT *, row_number() OVER (PARTITION BY churn
    ORDER BY concat(md5(concat('42|', customer_id)), customer_id)) AS place FROM customers""",
    "shares": """SELECT churn, n, whole, wanted * n // whole AS quota, wanted * n % whole AS rest, wanted
FROM (SELECT *, CAST(ceil(0.2 * whole) AS BIGINT) AS wanted
  FROM (SELECT churn, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS whole FROM customers GROUP BY churn))""",
    "quotas": """SELECT churn, quota + CASE WHEN row_number() OVER (ORDER BY rest DESC, churn)
    <= wanted - sum(quota) OVER () THEN 1 ELSE 0 END AS quota FROM shares""",
}

_NEEDS = {
    "raw": ["customers"],
    "loaded": ["raw"],
    "tidy": ["customers"],
    "cuts": ["tidy"],
    "features": ["tidy", "cuts"],
    "scores": ["customers"],
    "sweep": ["scores", "grid"],
    "best": ["sweep"],
    "active": ["scores"],
    "recommended": ["active", "best"],
    "dashboard": ["customers", "recommended"],
    "placed": ["customers"],
    "shares": ["customers"],
    "quotas": ["shares"],
}


def _closure(names: list[str]) -> set[str]:
    found: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += _NEEDS.get(name, [])
    return found


def query(body: str, *relations: str) -> str:
    """The body with the relations it reads, and theirs, as leading WITH entries."""
    needed = _closure(list(relations) or ["customers"])
    texts = [f"{name} AS ({RELATIONS[name]})" for name in RELATIONS if name in needed]
    return f"WITH {', '.join(texts)}\n{body}"


# --- the questions ---------------------------------------------------------


def by(columns: str, *measures: str, source: str = "customers", tail: str = "") -> str:
    names = columns.split(" AS ")[-1]
    return f"SELECT {columns}, {', '.join(measures)} FROM {source} GROUP BY {names} {tail}"


def long_rates(columns: list[str], name: str, value: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, CAST({c} AS VARCHAR) AS {value}, {N}, {RATE} FROM {source} GROUP BY {c}"
        for c in columns
    )


def finding(check: str, column: str, value: str, n: str, bad: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, {column} AS column_name, CAST({value} AS VARCHAR) AS value, "
        f"CAST({n} AS BIGINT) AS n, CASE WHEN {bad} THEN 'warn' ELSE 'ok' END AS status FROM {source}"
    )


SLICED = "(SELECT * FROM tidy WHERE contract_type IN ('Month-to-month', 'One year') AND partner)"


def histogram(column: str, units: int, bins: int, source: str = "tidy") -> str:
    low, span = "(SELECT low FROM ends)", "(SELECT high - low FROM ends)"
    edge = f"round(({low} + {span} * {{i}} / {bins}.0) / {units}.0, 6)"
    return f"""
, u AS (SELECT churn, CAST({column} * {units} AS BIGINT) AS v FROM {source} t),
ends AS (SELECT min(v) AS low, max(v) AS high FROM u),
counted AS (SELECT least((v - {low}) * {bins} // {span}, {bins - 1}) + 1 AS bin, churn, count(*) AS n FROM u GROUP BY 1, 2)
SELECT CAST(g.bin AS INT) AS bin, g.churn, {edge.format(i="(g.bin - 1)")} AS bin_start, {edge.format(i="g.bin")} AS bin_end,
  coalesce(n, 0) AS customers
FROM (SELECT b.range AS bin, c.churn FROM range(1, {bins + 1}) b CROSS JOIN (VALUES (false), (true)) c(churn)) g
LEFT JOIN counted ON g.bin = counted.bin AND g.churn = counted.churn"""


def boxes() -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, churn, CAST({c} AS DOUBLE) AS v FROM tidy" for c in BOXED)
    return f"""
, long AS (SELECT * FROM ({parts}) WHERE v IS NOT NULL),
q AS (SELECT column_name, churn, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM long GROUP BY 1, 2),
w AS (SELECT long.*, q1, median, q3, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM long JOIN q ON long.column_name = q.column_name AND long.churn = q.churn)
SELECT column_name, churn, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  least(min(v) FILTER (inside), q1) AS whisker_low, greatest(max(v) FILTER (inside), q3) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers
FROM w GROUP BY column_name, churn, q1, median, q3"""


def correlations() -> str:
    number = {c: f"CAST({c} AS DOUBLE)" if c in BOXED else f"CAST(CAST({c} AS INT) AS DOUBLE)" for c in CORRELATED}
    cells = []
    for a in CORRELATED:
        for b in CORRELATED:
            r = "1" if a == b else f"(SELECT round(corr({number[a]}, {number[b]}), 8) FROM tidy)"
            cells.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, CAST({r} AS DOUBLE) AS correlation")
    return " UNION ALL ".join(cells)


def density(points: int, bins: int | None = None) -> str:
    """Kernels over all values, or over masses dealt to the two nearest of `bins` even places."""
    dealt = "m AS (SELECT churn, x, 1.0 AS n FROM x)"
    if bins:
        place = f"coalesce((x - low) / nullif((high - low) / {bins - 1}, 0), 0)"
        dealt = f"""p AS (SELECT churn, low, (high - low) / {bins - 1} AS step, {place} AS place, least(floor({place}), {bins - 2}) AS l FROM x, e),
m AS (SELECT churn, low + l * step AS x, sum(1 - (place - l)) AS n FROM p GROUP BY churn, low, step, l
  UNION ALL SELECT churn, low + (l + 1) * step, sum(place - l) FROM p GROUP BY churn, low, step, l)"""
    return f"""
, x AS (SELECT churn, CAST(monthly_charges AS DOUBLE) AS x FROM tidy),
s AS (SELECT churn, count(*) AS size, stddev_samp(x) * pow(count(*), -0.2) AS h FROM x GROUP BY churn),
e AS (SELECT min(x) AS low, max(x) AS high FROM x),
{dealt},
g AS (SELECT range AS point, low + (high - low) * range / {points - 1} AS grid_value FROM range({points}), e)
SELECT m.churn, CAST(point AS INT) AS point, round(grid_value, 6) AS grid_value,
  round(sum(n * exp(-((grid_value - x) / h) * ((grid_value - x) / h) / 2) / (size * h * sqrt(2 * pi()))), 8) AS density
FROM m JOIN s ON m.churn = s.churn CROSS JOIN g GROUP BY m.churn, point, grid_value"""


_BROKEN = (
    [("not_null", c, f"{c} IS NULL") for c in REQUIRED_COLUMNS]
    + [("domain", c, f"{c} NOT IN ({quoted(DOMAINS[c])})") for c in TEXT_COLUMNS]
    + [("non_negative", c, f"{c} < 0") for c in NON_NEGATIVE_COLUMNS]
    + [("max_length", c, f"length({c}) > {size}") for c, size in MAX_LENGTHS.items()]
)


def constraints() -> str:
    rows = [
        f"SELECT '{kind}' AS check_name, '{c}' AS column_name, count(*) FILTER ({broken}) AS n FROM loaded"
        for kind, c, broken in _BROKEN
    ]
    rows.append("SELECT 'unique', 'customer_id', count(*) - count(DISTINCT customer_id) FROM loaded")
    return f"""SELECT *, CASE WHEN n > 0 THEN 'warn' ELSE 'ok' END AS status FROM ({" UNION ALL ".join(rows)})"""


def quarantine() -> str:
    reasons = [f"CASE WHEN {broken} THEN '{kind}:{c}' END" for kind, c, broken in _BROKEN]
    reasons.append("CASE WHEN seq > first_seq THEN 'unique:customer_id' END")
    sound = " AND ".join(f"({broken}) IS NOT TRUE" for _, _, broken in _BROKEN)
    return f"""SELECT seq, customer_id, violations FROM (
  SELECT seq, customer_id, concat_ws(',', {", ".join(reasons)}) AS violations
  FROM (SELECT *, min(CASE WHEN {sound} THEN seq END) OVER (PARTITION BY customer_id) AS first_seq FROM loaded))
WHERE violations <> ''"""


def categories() -> str:
    parts = []
    for c, allowed in DOMAINS.items():
        bad = f"{c} NOT IN ({quoted(allowed)})"
        parts.append(f"SELECT '{c}' AS c, {c} AS v, count(*) AS k FROM loaded WHERE {bad} GROUP BY {c}")
        parts.append(
            f"SELECT '{c}' AS c, NULL AS v, 0 AS k WHERE NOT EXISTS (SELECT 1 FROM loaded WHERE {bad})"
        )
    return finding("categories", "c", "v", "k", "k > 0", f"({' UNION ALL '.join(parts)})")


CLEANED = ", ".join(
    f"trim({c}, {WHITE}) AS {c}" if c in TEXT_COLUMNS else (f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLUMNS else c)
    for c in CUSTOMER_COLUMNS
)
TESTED = "SELECT placed.*, place <= quota AS test FROM placed JOIN quotas ON placed.churn = quotas.churn"
CONFUSION = """count(*) FILTER (NOT flagged AND NOT churn) AS tn, count(*) FILTER (flagged AND NOT churn) AS fp,
  count(*) FILTER (NOT flagged AND churn) AS fn, count(*) FILTER (flagged AND churn) AS tp"""
RATES = """CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
# Every pair of a churner and a stayer, one by one.
AUC = """SELECT CAST(sum(CASE WHEN p.s > n.s THEN 2 WHEN p.s = n.s THEN 1 ELSE 0 END) AS DOUBLE)
    / CAST(2 * count(*) AS DOUBLE) AS roc_auc
FROM (SELECT churn_probability AS s FROM scores WHERE churn) p
CROSS JOIN (SELECT churn_probability AS s FROM scores WHERE NOT churn) n"""


def confusion(threshold: str) -> str:
    return f"SELECT {CONFUSION} FROM (SELECT churn, churn_probability >= {threshold} AS flagged FROM scores)"


def value_at(name: str, threshold: str) -> str:
    return (
        f"SELECT '{name}' AS strategy, CAST(sum({FLAGGED_VALUE.format(t=threshold)}) AS DOUBLE) "
        "AS business_value FROM scores"
    )


MATRIX = ", ".join(
    ["customer_id", "CAST(monthly_charges AS DOUBLE) AS monthly_charges"]
    + [f"{c} AS x_{c}" for c in CATEGORICAL_FEATURES]
    + [f"CAST({c} AS INT) AS x_{c}" for c in BOOLEAN_FEATURES]
    + [f"CAST({c} AS DOUBLE) AS x_{c}" for c in NUMERIC_FEATURES]
    + ["churn", "CAST(CAST(churn AS INT) AS DOUBLE) AS label"]
)
TOP = f"SELECT {doubles(CUSTOMER_COLUMNS)}"
INTERNET = "(SELECT * FROM customers WHERE internet_service <> 'No')"
ADD_ON_PARTS = PROTECTIVE_ADD_ONS

ORACLE: dict[str, str] = {
    # sources
    "s01_csv_scan": query(f"SELECT {doubles(CUSTOMER_COLUMNS)} FROM loaded", "loaded"),
    "s01_line_breaks": query(
        "SELECT "
        + doubles(CUSTOMER_COLUMNS).replace(
            "contract_type", "CASE WHEN seq % 10 = 4 THEN contract_type || chr(10) || ', \"two\" lines' ELSE contract_type END AS contract_type"
        )
        + " FROM loaded",
        "loaded",
    ),
    "s02_rename": query(
        "SELECT seq, " + ", ".join(f"{raw} AS {name}" for raw, name in COLUMN_MAP.items()) + " FROM raw", "raw"
    ),
    "s03_type_coercion": query(f"SELECT seq, {doubles(CUSTOMER_COLUMNS)} FROM loaded", "loaded"),
    "s04_full_refresh": query(f"{TOP} FROM customers"),
    "s05_table_scan": query(f"{TOP} FROM customers"),
    "s07_features_csv": query(
        f"""SELECT {doubles(CUSTOMER_COLUMNS)}, tenure_group, CAST(service_count AS INT) AS service_count,
  high_value_customer, premium_customer, autopay_customer, revenue_category FROM features""",
        "features",
    ),
    "s08_recommendations_table": query("SELECT * FROM recommended", "recommended"),
    "s12_top_risk_report": query(
        """SELECT * FROM (SELECT concat('top ', measure) AS section, concat(customer_id, ' ', recommended_action) AS item, amount FROM (
  UNPIVOT (SELECT customer_id, recommended_action, CAST(churn_probability AS DOUBLE) AS churn_probability,
      CAST(monthly_charges AS DOUBLE) AS monthly_charges, CAST(clv AS DOUBLE) AS clv,
      CAST(revenue_at_risk AS DOUBLE) AS revenue_at_risk, CAST(expected_net_benefit AS DOUBLE) AS expected_net_benefit
    FROM recommended ORDER BY churn_probability DESC, customer_id LIMIT 20)
  ON churn_probability, monthly_charges, clv, revenue_at_risk, expected_net_benefit INTO NAME measure VALUE amount))
UNION ALL SELECT 'action', recommended_action, CAST(count(*) AS DOUBLE) FROM recommended GROUP BY recommended_action
UNION ALL SELECT 'value', strategy, business_value FROM ("""
        + value_at("default", "0.5")
        + " UNION ALL "
        + value_at("no_program", "1.01")
        + " UNION ALL SELECT 'optimal', business_value FROM best)",
        "recommended",
    ),
    # quality
    "v01_missing_values": query(
        finding("missing_values", "c", "NULL", "k", "true", "("
                + " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) FILTER ({c} IS NULL) AS k FROM loaded" for c in CUSTOMER_COLUMNS)
                + ") WHERE k > 0"),
        "loaded",
    ),
    "v02_duplicate_ids": query(
        finding("duplicate_ids", "'customer_id'", "NULL", "k", "k > 0",
                "(SELECT count(*) - count(DISTINCT coalesce(customer_id, '')) AS k FROM loaded)"),
        "loaded",
    ),
    "v03_blank_total_charges": query(
        finding("blank_total_charges", "'total_charges'", "v", "k", "k > 0 AND v <> 'null total'",
                """(SELECT 'null total' AS v, count(*) FILTER (total_charges IS NULL) AS k FROM loaded UNION ALL
  SELECT 'null total, tenure not 0', count(*) FILTER (total_charges IS NULL AND tenure_months <> 0) FROM loaded)"""),
        "loaded",
    ),
    "v04_categorical_values": query(categories(), "loaded"),
    "v05_dtypes": query(
        finding("numeric_type", "c", "NULL", "k", "k > 0", "("
                + " UNION ALL ".join(
                    f"SELECT '{c}' AS c, count(*) FILTER (trim({raw}) <> '' AND TRY_CAST({raw} AS {t}) IS NULL) AS k FROM raw"
                    for c, raw, t in [("tenure_months", "tenure", "INT"), ("monthly_charges", "MonthlyCharges", "DECIMAL(8,2)"),
                                      ("total_charges", "TotalCharges", "DECIMAL(10,2)")]) + ")"),
        "raw",
    ),
    "v06_constraints": query(constraints(), "loaded"),
    "v06_quarantine": query(quarantine(), "loaded"),
    # cleaning
    "c01_fill_total_charges": query(
        "SELECT customer_id, tenure_months, CAST(total_charges AS DOUBLE) AS total_charges FROM tidy", "tidy"
    ),
    "c02_trim_text": query(
        f"SELECT seq, {', '.join(f'trim({c}, {WHITE}) AS {c}' for c in TEXT_COLUMNS)} FROM loaded", "loaded"
    ),
    "c03_keep_first": query(
        f"SELECT seq, {doubles(CUSTOMER_COLUMNS)} FROM loaded "
        "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1",
        "loaded",
    ),
    "c03_dropped": query(
        """SELECT count(*) AS rows_before, count(DISTINCT customer_id) AS rows_after,
  count(*) - count(DISTINCT customer_id) AS dropped_rows FROM loaded""",
        "loaded",
    ),
    "c04_update_count": query(
        "SELECT count(*) AS updated_rows FROM loaded WHERE total_charges IS NULL AND tenure_months = 0", "loaded"
    ),
    "c04_updated_table": query(
        "SELECT customer_id, tenure_months, CAST(total_charges AS DOUBLE) AS total_charges FROM tidy", "tidy"
    ),
    "c05_clean": query(
        f"""SELECT {CLEANED} FROM (SELECT * REPLACE ({_FILLED}) FROM loaded
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1)""",
        "loaded",
    ),
    # projections and predicates
    "p01_projection": query(f"SELECT {', '.join(CATEGORICAL_FEATURES + BOOLEAN_FEATURES)} FROM features", "features"),
    "p02_filters": query(
        """SELECT customer_id FROM customers WHERE (contract_type = 'Two year' OR tenure_months <= 48)
  AND internet_service <> 'No' AND payment_method IN ('Mailed check', 'Electronic check') AND total_charges IS NOT NULL"""
    ),
    "p03_active": query("SELECT customer_id FROM customers WHERE NOT churn"),
    "p04_case": query(f"SELECT customer_id, {SEGMENT} AS segment, {BUCKET} AS tenure_bucket FROM customers"),
    "p05_having": query(by("contract_type, payment_method", N, RATE, tail="HAVING count(*) >= 100")),
    "p06_order_by_aggregate": query(by(f"{BUCKET} AS tenure_bucket", N, tail="ORDER BY min(tenure_months)")),
    "p07_casts": query(
        """SELECT customer_id, CAST(partner AS VARCHAR) AS partner_text, CAST(churn AS INT) AS churn_number,
  CAST(tenure_months AS BOOLEAN) AS has_tenure FROM customers"""
    ),
    "p08_value_map": query(
        "SELECT seq, CASE Partner WHEN 'Yes' THEN true WHEN 'No' THEN false END AS partner FROM raw", "raw"
    ),
    "p09_arithmetic": query(
        f"""SELECT customer_id, CAST({CLV} AS DOUBLE) AS clv, CAST(0.25 * {CLV} - 20 AS DOUBLE) AS offer_value,
  20 AS retention_offer_cost FROM customers"""
    ),
    "p10_row_sum": query(
        "SELECT customer_id, CAST("
        + " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in SERVICE_ADD_ONS)
        + " AS INT) AS add_ons FROM customers"
    ),
    "p11_row_value": query(
        f"SELECT customer_id, CAST({FLAGGED_VALUE.format(t='0.5')} AS DOUBLE) AS value FROM scores", "scores"
    ),
    "p12_cte": query(
        """, spenders AS (SELECT contract_type, avg(CAST(monthly_charges AS DOUBLE)) AS mean FROM customers GROUP BY contract_type)
SELECT c.contract_type, count(*) AS customers FROM customers c JOIN spenders s ON c.contract_type = s.contract_type
WHERE c.monthly_charges > s.mean GROUP BY c.contract_type"""
    ),
    # business questions
    "q01_overall_churn": query(
        f"SELECT count(*) AS total_customers, CAST({CHURNED} AS BIGINT) AS churned_customers, {RATE} FROM customers"
    ),
    "q02_churn_by_demographics": query(
        long_rates(["gender", "senior_citizen", "partner", "dependents"], "dimension", "value", "customers")
    ),
    "q03_tenure_by_churn": query(by("churn", N, AVG_TENURE)),
    "q04_revenue_totals": query(f"SELECT {REVENUE}, {AVG_CHARGES} FROM customers"),
    "q05_revenue_lost": query(
        f"""SELECT CAST(gone AS DOUBLE) / 100 AS churned_monthly_revenue,
  CAST(whole - gone AS DOUBLE) / 100 AS retained_monthly_revenue,
  {ratio("100 * gone", "whole", 2)} AS pct_revenue_from_churned
FROM (SELECT {CENTS} AS whole, sum(CASE WHEN churn THEN CAST(monthly_charges * 100 AS BIGINT) ELSE 0 END) AS gone FROM customers)"""
    ),
    "q06_revenue_by_contract": query(by("contract_type", N, REVENUE, AVG_CHARGES)),
    "q07_churn_by_contract": query(by("contract_type", N, CHURNED_N, RATE)),
    "q08_tenure_by_contract": query(by("contract_type", AVG_TENURE)),
    "q09_churn_by_payment": query(by("payment_method", N, CHURNED_N, RATE)),
    "q10_churn_by_paperless": query(by("paperless_billing", N, RATE)),
    "q11_churn_by_risk_segment": query(by(f"{SEGMENT} AS segment", N, RATE)),
    "q12_churn_by_internet": query(by("internet_service", N, RATE, AVG_CHARGES)),
    "q13_churn_by_add_on": query(long_rates(ADD_ON_PARTS, "add_on", "status", INTERNET)),
    "q14_churn_by_tenure_bucket": query(by(f"{BUCKET} AS tenure_bucket", N, RATE)),
    "q15_churn_by_spend_quartile": query(
        f"""SELECT CAST(spend_quartile AS INT) AS spend_quartile, {N}, CAST(min(monthly_charges) AS DOUBLE) AS min_monthly_charges,
  CAST(max(monthly_charges) AS DOUBLE) AS max_monthly_charges, {RATE}
FROM (SELECT *, ntile(4) OVER (ORDER BY monthly_charges, {TIE}) AS spend_quartile FROM customers) GROUP BY spend_quartile"""
    ),
    "q16_churn_matrix": query(by("contract_type, payment_method", N, RATE, tail="HAVING count(*) >= 20")),
    "q00_joint_aggregate": query(
        f"""SELECT {", ".join(DIMENSIONS)}, count(*) AS customers, count(monthly_charges) AS charged_customers,
  CAST(sum(monthly_charges) AS DOUBLE) AS charges FROM customers GROUP BY ALL"""
    ),
    "j01_left_join": query(f"SELECT {doubles(CUSTOMER_COLUMNS)}, recommended_action FROM dashboard", "dashboard"),
    "j01_bucketed_join": query(f"SELECT {doubles(CUSTOMER_COLUMNS)}, recommended_action FROM dashboard", "dashboard"),
    "w01_ntile": query(
        f"""SELECT customer_id, CAST(monthly_charges AS DOUBLE) AS monthly_charges, churn,
  CAST(ntile(4) OVER (ORDER BY monthly_charges, {TIE}) AS INT) AS spend_quartile FROM customers"""
    ),
    "t01_order_by": query(by("internet_service", N, tail="ORDER BY customers DESC")),
    "t02_top_k": query(
        "SELECT customer_id, churn_probability FROM scores ORDER BY churn_probability DESC, customer_id LIMIT 20", "scores"
    ),
    "t03_head": query(f"SELECT {doubles(CUSTOMER_COLUMNS)} FROM customers ORDER BY customer_id LIMIT 5"),
    "t03_shape": query("SELECT count(*) AS n_rows, 21 AS n_columns FROM customers"),
    "t04_arg_max": query("SELECT * FROM best", "best"),
    "u01_union_all": query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS dimension, {c} AS value, {N} FROM customers GROUP BY {c}"
            for c in ("contract_type", "payment_method", "internet_service")
        )
    ),
    # exploration
    "e01_churn_counts": query(
        f"""SELECT churn, n AS customers, {ratio("100 * n", "whole", 2)} AS share_pct
FROM (SELECT churn, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS whole FROM tidy GROUP BY churn)""",
        "tidy",
    ),
    "e02_charge_histogram": query(histogram("monthly_charges", 100, 40), "tidy"),
    "e02_tenure_histogram": query(histogram("tenure_months", 1, 36), "tidy"),
    "e03_describe_charges": query(
        """SELECT churn, round(avg(CAST(monthly_charges AS DOUBLE)), 6) AS mean,
  round(quantile_cont(CAST(monthly_charges AS DOUBLE), 0.5), 6) AS median,
  round(stddev_samp(CAST(monthly_charges AS DOUBLE)), 6) AS std FROM tidy GROUP BY churn""",
        "tidy",
    ),
    "e04_mean_tenure": query("SELECT churn, round(avg(tenure_months), 6) AS mean FROM tidy GROUP BY churn", "tidy"),
    "e05_correlations": query(correlations(), "tidy"),
    "e06_churn_share": query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS dimension, {c} AS value, round(avg(CAST(churn AS INT)) * 100, 6) AS churn_pct FROM tidy GROUP BY {c}"
            for c in ("contract_type", "payment_method", "internet_service")
        ),
        "tidy",
    ),
    "e07_boxplots": query(boxes(), "tidy"),
    "e08_binned_density": query(density(200, 401), "tidy"),
    "e08_density": query(density(200), "tidy"),
    # features
    "f01_tenure_group": query("SELECT customer_id, tenure_group FROM features", "features"),
    "f02_service_count": query("SELECT customer_id, CAST(service_count AS INT) AS service_count FROM features", "features"),
    "f03_high_value_customer": query("SELECT customer_id, high_value_customer FROM features", "features"),
    "f04_premium_customer": query("SELECT customer_id, premium_customer FROM features", "features"),
    "f05_autopay_customer": query("SELECT customer_id, autopay_customer FROM features", "features"),
    "f06_revenue_category": query("SELECT customer_id, revenue_category FROM features", "features"),
    "f06_cut_points": query(
        """SELECT round(median, 6) AS median_total_charges, round(low, 6) AS low_monthly_charges,
  round(high, 6) AS high_monthly_charges FROM cuts""",
        "cuts",
    ),
    "f07_engineer_features": query(
        f"""SELECT {doubles(CUSTOMER_COLUMNS)}, tenure_group, CAST(service_count AS INT) AS service_count,
  high_value_customer, premium_customer, autopay_customer, revenue_category FROM features""",
        "features",
    ),
    # models
    "m01_feature_matrix": query(f"SELECT {MATRIX} FROM features", "features"),
    "m02_stratified_split": query(
        f"SELECT customer_id, churn, CASE WHEN test THEN 'test' ELSE 'train' END AS split FROM ({TESTED})",
        "placed", "quotas",
    ),
    "m03_one_hot": query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS level, count(*) AS customers FROM features GROUP BY {c}"
            for c in CATEGORICAL_FEATURES
        ),
        "features",
    ),
    "m04_scaled_numbers": query(
        "SELECT customer_id, "
        + ", ".join(
            f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER (), 8) AS {c}"
            for c in NUMERIC_FEATURES
        )
        + " FROM features",
        "features",
    ),
    "m05_encoded_slots": query(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            [f"SELECT customer_id, '{c}=' || {c} AS slot, CAST(1 AS DOUBLE) AS value FROM features" for c in CATEGORICAL_FEATURES]
            + [
                f"SELECT customer_id, '{c}', round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) "
                f"/ stddev_pop(CAST({c} AS DOUBLE)) OVER (), 8) FROM features"
                for c in NUMERIC_FEATURES
            ]
            + [f"SELECT customer_id, '{c}', CAST({c} AS DOUBLE) FROM features" for c in BOOLEAN_FEATURES]
        )
        + ") WHERE value <> 0",
        "features",
    ),
    "m06_class_weights": query(
        """SELECT round(CAST(k + c AS DOUBLE) / (2 * k), 10) AS kept_weight, round(CAST(k + c AS DOUBLE) / (2 * c), 10) AS churned_weight,
  round(CAST(k AS DOUBLE) / c, 10) AS positive_weight
FROM (SELECT count(*) FILTER (NOT churn) AS k, count(*) FILTER (churn) AS c FROM customers)"""
    ),
    "m10_stratified_folds": query(
        """SELECT customer_id, churn, CAST(ntile(5) OVER (PARTITION BY churn
  ORDER BY concat(md5(concat('folds-42|', customer_id)), customer_id)) - 1 AS INT) AS fold FROM customers"""
    ),
    "m11_roc_auc": query(AUC, "scores"),
    "m13_confusion": query(confusion("0.5"), "scores"),
    "m14_classification_rates": query(f"SELECT *, {RATES} FROM ({confusion('0.5')})", "scores"),
    # decisions
    "r01_clv": query(f"SELECT customer_id, CAST({CLV} AS DOUBLE) AS clv FROM customers"),
    "r02_backtest": query(
        f"SELECT CAST(sum({FLAGGED_VALUE.format(t='0.3')}) AS DOUBLE) AS business_value FROM scores", "scores"
    ),
    "r03_threshold_sweep": query("SELECT * FROM sweep", "sweep"),
    "r03_optimal_threshold": query("SELECT * FROM best", "best"),
    "r04_reference_points": query(
        value_at("default", "0.5") + " UNION ALL " + value_at("no_program", "1.01")
        + " UNION ALL SELECT 'optimal', business_value FROM best",
        "best",
    ),
    "r05_rates_at_optimum": query(
        f"""SELECT best.threshold, precision, recall, tn, fp, fn, tp
FROM (SELECT *, {RATES} FROM ({confusion('(SELECT threshold FROM best)')})) CROSS JOIN best""",
        "best",
    ),
    "r06_score_active": query(
        """SELECT customer_id, churn_probability, CAST(clv AS DOUBLE) AS clv, revenue_at_risk, retention_offer_cost,
  expected_net_benefit FROM active""",
        "active",
    ),
    "r07_recommend_action": query("SELECT * FROM recommended", "recommended"),
    "r08_action_counts": query("SELECT recommended_action, count(*) AS customers FROM recommended GROUP BY 1", "recommended"),
    "r09_top_risk": query("SELECT * FROM recommended ORDER BY churn_probability DESC, customer_id LIMIT 20", "recommended"),
    # dashboard
    "d01_customer_dashboard": query(
        f"""SELECT {doubles(CUSTOMER_COLUMNS)}, churn_probability, clv, revenue_at_risk, retention_offer_cost,
  expected_net_benefit, recommended_action FROM dashboard""",
        "dashboard",
    ),
    "d02_kpi_cards": query(
        f"""SELECT count(*) AS total_customers, {RATE}, CAST({CENTS} AS DOUBLE) / 100 AS monthly_revenue,
  round(sum(revenue_at_risk), 2) AS revenue_at_risk,
  count(*) FILTER (churn_probability >= (SELECT threshold FROM best)) AS high_risk_customers FROM dashboard""",
        "dashboard", "best",
    ),
    "d03_revenue_by_contract": query(by("contract_type", N, REVENUE, AVG_CHARGES, source="dashboard"), "dashboard"),
    "d03_churn_by_tenure": query(by(f"{BUCKET} AS tenure_bucket", N, RATE, source="dashboard"), "dashboard"),
    "d03_contract_mix": query(
        f"""SELECT contract_type, n AS customers, {ratio("100 * n", "whole", 2)} AS share_pct
FROM (SELECT contract_type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS whole FROM dashboard GROUP BY contract_type)""",
        "dashboard",
    ),
    "d04_breakdowns": query(
        long_rates(
            ["contract_type", "payment_method", "internet_service", "gender", "senior_citizen"],
            "dimension", "value", "(SELECT * FROM dashboard WHERE contract_type IN ('Month-to-month', 'One year') AND partner)",
        ),
        "dashboard",
    ),
    "d04_charge_histogram": query(histogram("monthly_charges", 100, 40, SLICED), "tidy"),
    "d04_tenure_histogram": query(histogram("tenure_months", 1, 36, SLICED), "tidy"),
    "d05_worklist": query(
        "SELECT * FROM recommended WHERE recommended_action = 'Retain' ORDER BY expected_net_benefit DESC, customer_id",
        "recommended",
    ),
    "d05_page": query(
        """SELECT *, (rank - 1) // 50 AS page FROM (SELECT *, row_number() OVER (ORDER BY expected_net_benefit DESC NULLS LAST, customer_id) AS rank
  FROM recommended WHERE recommended_action = 'Retain') WHERE rank BETWEEN 151 AND 200""",
        "recommended",
    ),
    "d05_totals": query(
        """SELECT count(*) AS flagged_customers, round(sum(revenue_at_risk), 2) AS revenue_at_risk,
  round(sum(expected_net_benefit), 2) AS expected_net_benefit FROM recommended WHERE recommended_action <> 'No Action'""",
        "recommended",
    ),
}
