"""Independent SQL statements of every registered query, for DuckDB.

Each statement starts from the test tables and restates the whole chain (raw
view, typing, dedup, aggregation) in plain SQL, so it shares no code path with
the Spark operators it checks. Building blocks are common table expressions
assembled by ``with_ctes``.
"""

from __future__ import annotations

# --- fixed values, written out here so that a wrong one in the operators shows ---
SUPPRESSION_TOKENS = ("", "NULL", "N/A", "NA", "*", "#", "SUPPRESSED")
GE65_FLAG_TOKENS = ("Y", "*", "#")
LONG_PATTERN = r"^[+-]?[0-9]+$"
DOUBLE_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
RAW_COLUMNS = [
    "Prscrbr_NPI", "Prscrbr_Last_Org_Name", "Prscrbr_First_Name", "Prscrbr_City", "Prscrbr_State_Abrvtn", "Prscrbr_State_FIPS",
    "Prscrbr_Type", "Prscrbr_Type_Src", "Brnd_Name", "Gnrc_Name", "Tot_Clms", "Tot_30day_Fills", "Tot_Day_Suply", "Tot_Drug_Cst",
    "Tot_Benes", "GE65_Sprsn_Flag", "GE65_Tot_Clms", "GE65_Tot_30day_Fills", "GE65_Tot_Drug_Cst", "GE65_Tot_Day_Suply",
    "GE65_Bene_Sprsn_Flag", "GE65_Tot_Benes",
]
SILVER_COLUMNS = [
    "npi", "prescriber_last_or_org_name", "prescriber_first_name", "city", "state", "state_fips", "specialty", "brand_name",
    "generic_name", "ge65_suppression_flag", "year", "is_tot_claims_suppressed", "is_ge65_suppressed", "tot_claims",
    "tot_30day_fills", "tot_drug_cost", "tot_day_supply", "tot_beneficiaries", "ge65_claims", "ge65_drug_cost", "cost_per_claim",
    "claims_per_beneficiary",
]
SILVER_KEY = ["year", "npi", "state", "brand_name", "generic_name"]
NUMERIC = {
    "Tot_Clms": "BIGINT", "Tot_30day_Fills": "DOUBLE", "Tot_Drug_Cst": "DOUBLE", "Tot_Day_Suply": "BIGINT", "Tot_Benes": "BIGINT",
    "GE65_Tot_Clms": "BIGINT", "GE65_Tot_Drug_Cst": "DOUBLE",
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


RAW_DERIVED = {
    "Prscrbr_NPI": "CASE WHEN c_custkey % 83 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN '  ' ELSE ' ' || CAST(c_custkey AS VARCHAR) || ' ' END",
    "Prscrbr_Last_Org_Name": "c_name",
    "Prscrbr_First_Name": "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN o_orderkey % 50 = 0 THEN 'Patricia' ELSE 'Pat' END",
    "Prscrbr_City": "CASE WHEN c_custkey % 37 = 0 THEN ' ' ELSE lower(n_name) END",
    "Prscrbr_State_Abrvtn": "CASE WHEN c_custkey % 97 = 0 THEN '' ELSE lower(r_name) END",
    "Prscrbr_State_FIPS": "CAST(r_regionkey AS VARCHAR)",
    "Prscrbr_Type": "CASE WHEN c_custkey % 29 = 0 THEN '' ELSE lower(c_mktsegment) END",
    "Brnd_Name": "CASE WHEN p_partkey % 17 = 0 THEN ' ' || upper(p_type) WHEN p_partkey % 59 = 0 THEN '' ELSE lower(p_brand) END",
    "Gnrc_Name": "CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN 'multisource' ELSE lower(p_type) END",
    "Tot_Clms": "CASE WHEN l_orderkey % 227 = 0 THEN '99999999999999999999' WHEN l_orderkey % 229 = 0 THEN '20.0' "
    "WHEN l_quantity < 3 THEN '*' WHEN l_partkey % 31 = 0 "
    "THEN '1,' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 3, '0') "
    "ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END",
    "Tot_Drug_Cst": "CASE WHEN l_orderkey % 211 = 0 THEN '-5.25' WHEN l_orderkey % 223 = 0 THEN '1e5' "
    "WHEN l_orderkey % 97 = 0 THEN CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS DECIMAL(20,2)) AS VARCHAR) "
    "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END",
    "Tot_Benes": "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END",
    "GE65_Sprsn_Flag": "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'A' THEN '' WHEN l_linenumber % 2 = 0 THEN 'y ' ELSE '#' END",
    "GE65_Tot_Clms": "CASE WHEN l_linenumber = 1 THEN '*' ELSE CAST(CAST(floor(l_quantity / 2) AS INTEGER) AS VARCHAR) END",
    "GE65_Tot_Drug_Cst": "CASE WHEN l_linenumber = 2 THEN 'N/A' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END",
    "Tot_30day_Fills": "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5'",
    "Tot_Day_Suply": "CAST(CAST(l_quantity AS INTEGER) * 30 AS VARCHAR)",
}

RAW = (
    "SELECT "
    + ",\n ".join(f"{RAW_DERIVED.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in RAW_COLUMNS)
    + ",\n CAST(year(o_orderdate) AS INTEGER) AS yr\n"
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "JOIN part ON l_partkey = p_partkey"
)


def sup(c: str) -> str:
    return f"(upper(trim({c})) IN {_in(SUPPRESSION_TOKENS)} OR upper(trim({c})) IS NULL)"


def num(c: str, sql_type: str) -> str:
    cleaned = f"replace(trim({c}), ',', '')"
    pattern = LONG_PATTERN if sql_type == "BIGINT" else DOUBLE_PATTERN
    return f"CASE WHEN {sup(c)} THEN NULL WHEN regexp_matches({cleaned}, {_q(pattern)}) THEN TRY_CAST({cleaned} AS {sql_type}) END"


TYPED0 = f"""SELECT trim(Prscrbr_NPI) AS npi,
 trim(Prscrbr_Last_Org_Name) AS prescriber_last_or_org_name,
 trim(Prscrbr_First_Name) AS prescriber_first_name,
 upper(trim(Prscrbr_City)) AS city,
 COALESCE(NULLIF(upper(trim(Prscrbr_State_Abrvtn)), ''), 'UNKNOWN') AS state,
 trim(Prscrbr_State_FIPS) AS state_fips,
 upper(trim(Prscrbr_Type)) AS specialty,
 upper(trim(Brnd_Name)) AS brand_name,
 upper(trim(Gnrc_Name)) AS generic_name,
 upper(trim(GE65_Sprsn_Flag)) AS ge65_suppression_flag,
 yr AS year,
 {sup('Tot_Clms')} AS is_tot_claims_suppressed,
 ({sup('GE65_Tot_Clms')} OR {sup('GE65_Tot_Drug_Cst')} OR upper(trim(GE65_Sprsn_Flag)) IN {_in(GE65_FLAG_TOKENS)}) AS is_ge65_suppressed,
 {num('Tot_Clms', 'BIGINT')} AS tot_claims,
 {num('Tot_30day_Fills', 'DOUBLE')} AS tot_30day_fills,
 {num('Tot_Drug_Cst', 'DOUBLE')} AS tot_drug_cost,
 {num('Tot_Day_Suply', 'BIGINT')} AS tot_day_supply,
 {num('Tot_Benes', 'BIGINT')} AS tot_beneficiaries,
 {num('GE65_Tot_Clms', 'BIGINT')} AS ge65_claims,
 {num('GE65_Tot_Drug_Cst', 'DOUBLE')} AS ge65_drug_cost
FROM raw"""

TYPED = """SELECT *,
 CASE WHEN tot_claims > 0 THEN CAST(tot_drug_cost AS DOUBLE) / CAST(tot_claims AS DOUBLE) END AS cost_per_claim,
 CASE WHEN tot_beneficiaries > 0 THEN CAST(tot_claims AS DOUBLE) / CAST(tot_beneficiaries AS DOUBLE) END AS claims_per_beneficiary
FROM typed0"""

_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in SILVER_COLUMNS if c not in SILVER_KEY)
SILVER = f"""SELECT {', '.join(SILVER_COLUMNS)} FROM (
 SELECT *, row_number() OVER (PARTITION BY {', '.join(SILVER_KEY)} ORDER BY {_ORDER}) AS rn FROM typed
) WHERE rn = 1"""


def h(*cols: str) -> str:
    """Stable hash key, as SQL."""
    return "sha256(concat_ws('||', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '__NULL__')" for c in cols) + "))"


def money(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(28,6))) AS DOUBLE)"


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def stable_avg(c: str) -> str:
    return f"CAST(SUM(CAST(round({c} * 1000000) AS DECIMAL(38,0))) AS DOUBLE) / 1000000.0 / CAST(COUNT({c}) AS DOUBLE)"


def stable_stddev(c: str) -> str:
    x = f"CAST(round({c} * 1000000) AS DECIMAL(19,0))"
    n, one, two = f"CAST(COUNT({c}) AS DOUBLE)", f"CAST(SUM({x}) AS DOUBLE)", f"CAST(SUM({x} * {x}) AS DOUBLE)"
    return f"CASE WHEN COUNT({c}) > 1 THEN sqrt(greatest(({two} - {one} * ({one} / {n})) / ({n} - 1.0::DOUBLE), 0.0::DOUBLE)) / 1000000.0::DOUBLE END"


FULL_NAME = "trim(concat_ws(' ', COALESCE(prescriber_first_name, ''), COALESCE(prescriber_last_or_org_name, '')))"

SUMMARY0 = f"""SELECT year, npi, full_name, city, state, specialty,
 CAST(SUM(tot_claims) AS BIGINT) AS total_claims,
 {money('tot_drug_cost')} AS total_drug_cost,
 COUNT(*) FILTER (WHERE brand_name IS NOT NULL AND generic_name IS NOT NULL) AS drug_count
FROM (SELECT *, {FULL_NAME} AS full_name FROM silver)
GROUP BY year, npi, full_name, city, state, specialty"""

SUMMARY = f"""SELECT {h('year', 'npi', 'city', 'state', 'specialty')} AS mart_id,
 year, npi, full_name, city, state, specialty, total_claims, total_drug_cost, drug_count,
 {ratio('total_drug_cost', 'total_claims')} AS avg_cost_per_claim
FROM summary0"""


def thresholds_disc(src: str, keys: list[str], metric: str, q: float) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, quantile_disc({metric}, {q}) AS peer_threshold FROM {src} WHERE {metric} IS NOT NULL GROUP BY {k}"


ANOMALY_COLS = "mart_id, year, npi, full_name, city, state, specialty, total_claims, total_drug_cost, avg_cost_per_claim"


def anomaly(keys: list[str]) -> str:
    return f"""SELECT {', '.join('s.' + c for c in ANOMALY_COLS.split(', '))},
 t.peer_threshold AS peer_p95_cost_per_claim, 'avg_cost_per_claim_gt_peer_p95' AS anomaly_reason
FROM summary s JOIN thr t ON {' AND '.join(f's.{k} = t.{k}' for k in keys)}
WHERE s.total_claims >= 30 AND s.avg_cost_per_claim IS NOT NULL AND t.peer_threshold IS NOT NULL
 AND s.avg_cost_per_claim > t.peer_threshold"""


BASE_CTES = {
    "raw": RAW,
    "typed0": TYPED0,
    "typed": TYPED,
    "silver": SILVER,
    "summary0": SUMMARY0,
    "summary": SUMMARY,
}

_DEPENDS = {
    "typed0": ["raw"],
    "typed": ["typed0"],
    "silver": ["typed"],
    "summary0": ["silver"],
    "summary": ["summary0"],
}


def with_ctes(needed: list[str], body: str, extra: dict[str, str] | None = None, extra_deps: dict | None = None) -> str:
    """``WITH`` clause holding ``needed`` CTEs and their dependencies, in order."""
    ctes = {**BASE_CTES, **(extra or {})}
    deps = {**_DEPENDS, **(extra_deps or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in deps.get(name, []):
            visit(d)
        order.append(name)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{ctes[n]}\n)" for n in order) + "\n" + body


# --- marts ------------------------------------------------------------------------

DRUG_PAIRS = "COUNT(DISTINCT (brand_name, generic_name)) FILTER (WHERE brand_name IS NOT NULL AND generic_name IS NOT NULL)"

STATE_YEAR = f"""SELECT {h('year', 'state')} AS mart_id, year, state, total_claims, total_drug_cost, total_beneficiaries,
 prescriber_count, drug_count, {ratio('total_drug_cost', 'total_claims')} AS avg_cost_per_claim
FROM (SELECT year, state, CAST(SUM(tot_claims) AS BIGINT) AS total_claims, {money('tot_drug_cost')} AS total_drug_cost,
 CAST(SUM(tot_beneficiaries) AS BIGINT) AS total_beneficiaries, COUNT(DISTINCT npi) AS prescriber_count,
 {DRUG_PAIRS} AS drug_count FROM silver GROUP BY year, state)"""

DRUG_YEAR = f"""SELECT {h('year', 'brand_name', 'generic_name')} AS mart_id, year, brand_name, generic_name, total_claims,
 total_drug_cost, prescriber_count, state_count, {ratio('total_drug_cost', 'total_claims')} AS avg_cost_per_claim
FROM (SELECT year, brand_name, generic_name, CAST(SUM(tot_claims) AS BIGINT) AS total_claims,
 {money('tot_drug_cost')} AS total_drug_cost, COUNT(DISTINCT npi) AS prescriber_count, COUNT(DISTINCT state) AS state_count
 FROM silver GROUP BY year, brand_name, generic_name)"""

SPECIALTY_STATE = f"""SELECT {h('year', 'state', 'specialty')} AS mart_id, year, state, specialty, total_claims,
 total_drug_cost, prescriber_count, drug_count, {ratio('total_drug_cost', 'total_claims')} AS avg_cost_per_claim
FROM (SELECT year, state, specialty, CAST(SUM(tot_claims) AS BIGINT) AS total_claims,
 {money('tot_drug_cost')} AS total_drug_cost, COUNT(DISTINCT npi) AS prescriber_count, {DRUG_PAIRS} AS drug_count
 FROM silver GROUP BY year, state, specialty)"""

# --- star schema ------------------------------------------------------------------

DIM_PRESCRIBER = f"""SELECT prescriber_id, npi, min(full_name) AS full_name, city, state, specialty FROM (
 SELECT {h('npi', 'city', 'state', 'specialty')} AS prescriber_id, npi, {FULL_NAME} AS full_name, city, state, specialty
 FROM silver WHERE npi IS NOT NULL AND npi <> '')
GROUP BY prescriber_id, npi, city, state, specialty"""

DIM_DRUG = f"SELECT DISTINCT {h('brand_name', 'generic_name')} AS drug_id, brand_name, generic_name FROM silver"

DIM_STATE = """SELECT state AS state_id, state AS state_abbr, min(state_fips) AS state_fips
FROM silver WHERE state IS NOT NULL AND state <> '' GROUP BY state"""

DIM_YEAR = "SELECT DISTINCT year AS year_id, year FROM silver"

FACT = f"""SELECT {h('year', 'npi', 'state', 'brand_name', 'generic_name')} AS fact_id,
 {h('npi', 'city', 'state', 'specialty')} AS prescriber_id, {h('brand_name', 'generic_name')} AS drug_id,
 state AS state_id, year AS year_id, tot_claims, tot_30day_fills, tot_drug_cost, tot_day_supply, tot_beneficiaries,
 ge65_claims, ge65_drug_cost, cost_per_claim, claims_per_beneficiary, is_tot_claims_suppressed, is_ge65_suppressed
FROM silver"""

# --- outliers and views -----------------------------------------------------------

REF_KEYS = ["year", "state", "specialty"]
THR = thresholds_disc("summary", REF_KEYS, "avg_cost_per_claim", 0.95)
ANOMALY = anomaly(REF_KEYS)


def label(c: str) -> str:
    return f"COALESCE(NULLIF({c}, ''), 'UNKNOWN')"


KPIS = f"""SELECT year, total_claims, total_drug_cost, total_beneficiaries, state_prescriber_count_sum, state_drug_count_sum,
 CASE WHEN total_claims = 0 THEN NULL ELSE total_drug_cost / CAST(total_claims AS DOUBLE) END AS avg_cost_per_claim
FROM (SELECT year, CAST(SUM(total_claims) AS BIGINT) AS total_claims, {money('total_drug_cost')} AS total_drug_cost,
 CAST(SUM(total_beneficiaries) AS BIGINT) AS total_beneficiaries, CAST(SUM(prescriber_count) AS BIGINT) AS state_prescriber_count_sum,
 CAST(SUM(drug_count) AS BIGINT) AS state_drug_count_sum FROM state_year GROUP BY year)"""

V_STATE = """SELECT year, state, total_claims, total_drug_cost, total_beneficiaries, prescriber_count, drug_count,
 avg_cost_per_claim FROM state_year"""

V_TOP_DRUGS = f"""SELECT year, {label('brand_name')} AS brand_name, {label('generic_name')} AS generic_name, total_claims,
 total_drug_cost, prescriber_count, state_count, avg_cost_per_claim FROM drug_year"""

V_SPECIALTY_STATE = f"""SELECT year, state, {label('specialty')} AS specialty, total_claims, total_drug_cost,
 prescriber_count, drug_count, avg_cost_per_claim FROM specialty_state"""

V_LEADERS = f"""SELECT year, npi, {label('full_name')} AS full_name, {label('city')} AS city, state,
 {label('specialty')} AS specialty, total_claims, total_drug_cost, drug_count, avg_cost_per_claim FROM summary"""

V_ANOMALY = f"""SELECT year, npi, {label('full_name')} AS full_name, {label('city')} AS city, state,
 {label('specialty')} AS specialty, total_claims, total_drug_cost, avg_cost_per_claim, peer_p95_cost_per_claim,
 anomaly_reason FROM anomaly"""

V_ANOMALY_SUMMARY = f"""SELECT year, state, specialty, COUNT(*) AS anomaly_prescriber_count,
 CAST(SUM(total_claims) AS BIGINT) AS anomaly_total_claims, {money('total_drug_cost')} AS anomaly_total_drug_cost,
 {stable_avg('avg_cost_per_claim')} AS anomaly_avg_cost_per_claim,
 {stable_avg('peer_p95_cost_per_claim')} AS peer_p95_cost_per_claim
FROM (SELECT * REPLACE ({label('specialty')} AS specialty) FROM anomaly) GROUP BY year, state, specialty"""

BASE_CTES.update(
    {
        "state_year": STATE_YEAR,
        "drug_year": DRUG_YEAR,
        "specialty_state": SPECIALTY_STATE,
        "dim_prescriber": DIM_PRESCRIBER,
        "dim_drug": DIM_DRUG,
        "dim_state": DIM_STATE,
        "dim_year": DIM_YEAR,
        "fact": FACT,
        "thr": THR,
        "anomaly": ANOMALY,
        "kpis": KPIS,
        "v_state": V_STATE,
        "v_top_drugs": V_TOP_DRUGS,
        "v_specialty_state": V_SPECIALTY_STATE,
        "v_leaders": V_LEADERS,
        "v_anomaly": V_ANOMALY,
        "v_anomaly_summary": V_ANOMALY_SUMMARY,
    }
)
_DEPENDS.update(
    {
        "state_year": ["silver"],
        "drug_year": ["silver"],
        "specialty_state": ["silver"],
        "dim_prescriber": ["silver"],
        "dim_drug": ["silver"],
        "dim_state": ["silver"],
        "dim_year": ["silver"],
        "fact": ["silver"],
        "thr": ["summary"],
        "anomaly": ["summary", "thr"],
        "kpis": ["state_year"],
        "v_state": ["state_year"],
        "v_top_drugs": ["drug_year"],
        "v_specialty_state": ["specialty_state"],
        "v_leaders": ["summary"],
        "v_anomaly": ["anomaly"],
        "v_anomaly_summary": ["anomaly"],
    }
)


def top_k(src: str, by: str, metric_sql: str, alias: str, k: int | None) -> str:
    lim = f" LIMIT {k}" if k else ""
    return (
        f"SELECT {by}, {metric_sql} AS {alias} FROM {src} GROUP BY {by} "
        f"ORDER BY {alias} DESC NULLS LAST, {by} ASC NULLS LAST{lim}"
    )
