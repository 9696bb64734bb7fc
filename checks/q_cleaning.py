"""CLN and VAL queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from tenura.contract import CONTRACT, fields_by_tier
from tenura.operators import cleaning as K
from tenura.operators import mapping as M
from tenura.operators import validation as V
from tenura.session import stage

# --- repeats ---------------------------------------------------------------------------------------------------


def cln_1(spark, sf):
    return K.drop_exact_repeats(X.mapped(spark, sf))


_F = ", ".join(X.FIELDS)
CLN_1 = X.MAPPED_SQL + f" SELECT min(src_row) AS src_row, {_F} FROM mapped GROUP BY {_F}"


def cln_2(spark, sf):
    """Two clients with the same customer ids: a row of each stays."""
    rows = X.mapped(spark, sf)
    return K.keep_first(rows.withColumn("client_id", F.lit("a")).union(rows.withColumn("client_id", F.lit("b"))))


CLN_2 = X.DEDUPED_SQL + " SELECT *, 'a' AS client_id FROM deduped UNION ALL SELECT *, 'b' FROM deduped"


def cln_3(spark, sf):
    return K.repeat_counts(X.mapped(spark, sf))


REPEATS_SQL = X.DEDUPED_SQL + f""",
sizes AS (
  SELECT (SELECT count(*) FROM mapped) AS b, (SELECT count(*) FROM (SELECT DISTINCT {_F} FROM mapped)) AS d, (SELECT count(*) FROM deduped) AS a),
repeats AS (
  SELECT b AS rows_before, b - d AS exact_repeats, d - a AS id_repeats, b - a AS repeats,
         {X.rounded('((b - a) * 100.0::DOUBLE / b)', 1)} AS pct_of_rows, a AS rows_after FROM sizes)"""
CLN_3 = REPEATS_SQL + " SELECT * FROM repeats"

# --- values ----------------------------------------------------------------------------------------------------


def cln_4(spark, sf):
    return K.parse_numbers(X.deduped(spark, sf)).select("customer_id", *X.BOUNDS_SQL)


_NUMBERS = ", ".join(X.BOUNDS_SQL)
CLN_4 = X.PARSED_SQL + f" SELECT customer_id, {_NUMBERS} FROM parsed"


def _issues(spark, sf):
    return stage(K.issue_counts(X.deduped(spark, sf)))


def _garbage(spark, sf, most=0.05):
    g = K.garbage_profile(_issues(spark, sf), most)
    return g.withColumn("examples", F.array_join("examples", " | "))


def cln_5(spark, sf):
    return _garbage(spark, sf).select("column", "n", "pct", "examples")


_RAWS = {"tenure_months": "raw_tenure", "monthly_charges": "raw_monthly", "total_charges": "raw_total"}
GARBAGE_CTE = """,
garbage_rows AS (
  """ + " UNION ALL ".join(f"SELECT '{c}' AS col, {raw} AS value, src_row FROM parsed WHERE {raw} IS NOT NULL AND {c} IS NULL" for c, raw in _RAWS.items()) + f"""),
garbage_values AS (SELECT col, value, min(src_row) AS f FROM garbage_rows GROUP BY col, value),
garbage_top AS (SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY f) AS place FROM garbage_values),
garbage_n AS (SELECT col, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM parsed) AS p FROM garbage_rows GROUP BY col),
garbage AS (
  SELECT n.col AS "column", n.n, {X.rounded('p', 1)} AS pct, p,
         (SELECT string_agg(value, ' | ' ORDER BY place) FROM garbage_top t WHERE t.col = n.col AND place <= 5) AS examples,
         (SELECT string_agg('''' || value || '''', ', ' ORDER BY place) FROM garbage_top t WHERE t.col = n.col AND place <= 3) AS shown
  FROM garbage_n n)"""
CLN_5 = X.PARSED_SQL + GARBAGE_CTE + ' SELECT "column", n, pct, examples FROM garbage'


def cln_6(spark, sf):
    return _garbage(spark, sf).select("column", "pct", "severity")


CLN_6 = X.PARSED_SQL + GARBAGE_CTE + """ SELECT "column", pct, CASE WHEN p > 5 THEN 'CRITICAL' ELSE 'NOTE' END AS severity FROM garbage"""


def cln_7(spark, sf):
    """Capped values of the three clients; the bank brings its own limits for charges."""
    catalog = X.catalog(spark)
    mapped = M.apply_catalog(X.clients_raw(spark, sf), catalog)
    parsed = K.parse_numbers(mapped)
    return K.cap_numbers(K.with_client_bounds(parsed, catalog)).select("client_id", "src_row", *X.BOUNDS_SQL)


def _cap_case(c):
    lo, hi = X.BOUNDS_SQL[c]
    own = {"monthly_charges": 2000, "total_charges": 90000}.get(c)
    base = X.cap(c, lo, hi)
    return f"{base} AS {c}" if own is None else f"CASE client_id WHEN 'bank' THEN {X.cap(c, 0, own)} ELSE {base} END AS {c}"


CLN_7 = X.CLIENTS_MAPPED_SQL + ", n AS (SELECT client_id, src_row, " + ", ".join(f"{X.num(c)} AS {c}" for c in X.BOUNDS_SQL) + (
    " FROM clients_mapped) SELECT client_id, src_row, " + ", ".join(_cap_case(c) for c in X.BOUNDS_SQL) + " FROM n"
)


def cln_8(spark, sf):
    return K.normalize_categories(X.deduped(spark, sf)).select("customer_id", "contract_type", "payment_method", "gender")


CLN_8 = X.PARSED_SQL + " SELECT customer_id, contract_type, payment_method, gender FROM parsed"


def cln_9(spark, sf):
    return K.category_changes(_issues(spark, sf))


CHANGES_CTE = """,
changes AS (
  """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {raw} AS value, {c} AS new_value, count(*) AS n FROM parsed WHERE {raw} <> {c} GROUP BY 2, 3"
    for c, raw in (("contract_type", "raw_contract"), ("payment_method", "raw_payment"), ("gender", "raw_gender"))
) + ")"
CLN_9 = X.PARSED_SQL + CHANGES_CTE + " SELECT * FROM changes"


def cln_10(spark, sf):
    return K.null_counts(_issues(spark, sf))


NULLS_CTE = """,
nulls AS (
  """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, (SELECT count(*) FROM cleaned) AS t FROM cleaned WHERE {c} IS NULL HAVING count(*) > 0" for c in X.FIELDS
) + ")"
_NULL_PCT = X.rounded("(n * 100.0::DOUBLE / t)", 1)
CLN_10 = X.CLEANED_SQL + NULLS_CTE + f' SELECT "column", n, {_NULL_PCT} AS pct FROM nulls'


def cln_11(spark, sf):
    return K.null_total(_issues(spark, sf), len(X.FIELDS))


TOTAL_CTE = f""",
total AS (
  SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n,
         {X.rounded(f'(coalesce(sum(n), 0) * 100.0::DOUBLE / ((SELECT count(*) FROM cleaned) * {len(X.FIELDS)}))', 1)} AS pct FROM nulls)"""
CLN_11 = X.CLEANED_SQL + NULLS_CTE + TOTAL_CTE + " SELECT n, pct FROM total"


def cln_12(spark, sf):
    """The cleaned table itself; its report is cln_13."""
    return K.clean_rows(X.mapped(spark, sf))


CLN_12 = X.CLEANED_SQL + " SELECT * FROM cleaned"


def cln_13(spark, sf):
    _, report = K.clean_table(X.mapped(spark, sf), max_garbage=0.05)
    return report


def _report_sql():
    spans = " ".join(f"WHEN '{c}' THEN '[{lo}, {hi}]'" for c, (lo, hi) in X.BOUNDS_SQL.items())
    caps = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) AS n FROM parsed WHERE {c} < {lo} OR {c} > {hi} HAVING count(*) > 0" for c, (lo, hi) in X.BOUNDS_SQL.items())
    repeats = REPEATS_SQL[len(X.DEDUPED_SQL) :]
    return X.CLEANED_SQL + repeats + GARBAGE_CTE + CHANGES_CTE + NULLS_CTE + TOTAL_CTE + f"""
SELECT 'repeats' AS section, '' AS "column", CAST(NULL AS VARCHAR) AS item, repeats AS n, pct_of_rows AS pct,
       'Removed ' || repeats || ' duplicates: ' || concat_ws(', ', CASE WHEN exact_repeats > 0 THEN exact_repeats || ' exact duplicate rows' END,
         CASE WHEN id_repeats > 0 THEN id_repeats || ' duplicate customer_ids (kept first occurrence)' END)
       || ' (' || {X.fixed('(repeats * 100.0::DOUBLE / rows_before)', 1)} || '% of dataset).' AS message FROM repeats WHERE repeats > 0
UNION ALL SELECT 'garbage', "column", examples, n, pct,
       CASE WHEN p > 5 THEN 'CRITICAL: Column ''' || "column" || ''' has ' || {X.fixed('pct', 1)} || '% garbage values (examples: [' || shown
              || ']). This column may be unreliable.'
            ELSE 'Column ''' || "column" || ''': ' || n || ' values (' || {X.fixed('pct', 1)} || '%) couldn''t be parsed as numbers (examples: ['
              || shown || ']). Converted to NaN — will be imputed later.' END FROM garbage
UNION ALL SELECT 'capped', c, NULL, n, NULL, 'Column ''' || c || ''': ' || n || ' outlier values capped to ' || CASE c {spans} END || ' range.'
  FROM ({caps})
UNION ALL SELECT 'changed', "column", value || ' -> ' || new_value, n, NULL, NULL FROM changes
UNION ALL SELECT 'nulls', "column", NULL, n, {_NULL_PCT}, NULL FROM nulls
UNION ALL SELECT 'total_nulls', '', NULL, n, pct, 'Total null values after cleaning: ' || n || ' (' || {X.fixed('pct', 1)}
       || '% of all cells). These will be filled by imputation in feature engineering.' FROM total WHERE n > 0"""


CLN_13 = _report_sql()

# --- validation ------------------------------------------------------------------------------------------------


def val_1(spark, sf):
    """The tier-1 fields of the contract with the values the cleaned table has for each."""
    clean = X.cleaned(spark, sf)
    filled = clean.agg(*[F.count(c).alias(c) for c in fields_by_tier(1)])
    pairs = [F.struct(F.lit(c.field).alias("field"), F.lit(c.dtype).alias("dtype"), F.col(c.field).alias("n_filled")) for c in CONTRACT if c.tier == 1]
    return filled.select(F.inline(F.array(*pairs)))


VAL_1 = X.CLEANED_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS field, '{t}' AS dtype, count({c}) AS n_filled FROM cleaned"
    for c, t in (("customer_id", "string"), ("tenure_months", "int"), ("monthly_charges", "float"), ("total_charges", "float"), ("churn_label", "int"))
)


def _client_columns(spark, sf):
    """Mapped columns per client, seen in the raw rows."""
    seen = X.clients_raw(spark, sf).select("client_id", F.explode(F.map_keys("raw")).alias("from_value")).distinct()
    known = X.catalog(spark).filter("kind = 'column' and status = 'approved'").select("client_id", "from_value", F.col("to_value").alias("column_name"))
    return seen.join(known, ["client_id", "from_value"], "left").select(F.col("client_id").alias("table_name"), "column_name")


def val_2(spark, sf):
    return V.field_presence(_client_columns(spark, sf)).drop("dtype")


_TIERS = {
    "customer_id": 1, "tenure_months": 1, "monthly_charges": 1, "total_charges": 1, "churn_label": 1, "contract_type": 2,
    "payment_method": 2, "support_tickets": 2, "gender": 3, "age_bucket": 3, "partner_status": 3,
}
_CONTRACT_VALUES = ", ".join(f"({i}, '{f}', {t})" for i, (f, t) in enumerate(_TIERS.items()))
_HAVE_VALUES = ", ".join(f"('{m.client_id}', '{c}')" for m in X.CLIENTS for c in m.columns.values())
PRESENCE_SQL = X.RAW_SQL + f""",
tables AS (SELECT DISTINCT t.client_id AS table_name FROM churn_raw, (VALUES ('retail'), ('shop'), ('bank')) t(client_id)),
presence AS (
  SELECT table_name, pos, field, tier, EXISTS (SELECT 1 FROM (VALUES {_HAVE_VALUES}) h(c, f) WHERE h.c = table_name AND h.f = field) AS present
  FROM tables CROSS JOIN (VALUES {_CONTRACT_VALUES}) k(pos, field, tier))"""
VAL_2 = PRESENCE_SQL + " SELECT * FROM presence"


def val_3(spark, sf):
    return V.verdicts(V.field_presence(_client_columns(spark, sf)))


VAL_3 = PRESENCE_SQL + """
SELECT table_name, count(*) FILTER (NOT present AND tier = 1) = 0 AS is_valid, count(*) FILTER (NOT present AND tier = 1) AS n_required_missing,
       count(*) FILTER (NOT present) AS n_missing, CAST(NULL AS VARCHAR) AS error FROM presence GROUP BY table_name"""


def val_4(spark, sf):
    """One quarantine table per nation and segment: the rows whose tenure is no number. Some are empty."""
    customers = X.table(spark, sf, "customer")
    name = F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment")
    owners = customers.select(F.col("c_custkey").cast("string").alias("customer_id"), name.alias("table_name"))
    rows = X.deduped(spark, sf).filter(F.col("tenure_months").isNotNull() & ~F.col("tenure_months").rlike(r"^-?\d+$"))
    counts = rows.join(owners, "customer_id").groupBy("table_name").agg(F.count("*").alias("n_rows"))
    columns = [c for c in rows.columns if c != "src_row"]
    tables = owners.select("table_name").distinct().withColumn("column_name", F.explode(F.array(*[F.lit(c) for c in columns])))
    return V.verdicts(V.field_presence(tables), counts)


VAL_4 = X.DEDUPED_SQL + """,
owners AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_nationkey || '/' || c_mktsegment AS table_name FROM customer),
counts AS (SELECT table_name, count(*) AS n FROM deduped JOIN owners USING (customer_id)
  WHERE tenure_months IS NOT NULL AND NOT regexp_matches(tenure_months, '^-?\\d+$') GROUP BY table_name)
SELECT table_name, n IS NOT NULL AS is_valid, CAST(CASE WHEN n IS NULL THEN 5 ELSE 0 END AS BIGINT) AS n_required_missing,
       CAST(CASE WHEN n IS NULL THEN 11 ELSE 1 END AS BIGINT) AS n_missing, CASE WHEN n IS NULL THEN 'DataFrame is empty (0 rows)' END AS error
FROM (SELECT DISTINCT table_name FROM owners) LEFT JOIN counts USING (table_name)"""


def val_5(spark, sf):
    return V.bad_number_counts(X.deduped(spark, sf))


VAL_5 = X.PARSED_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) AS n_bad FROM parsed WHERE {test}"
    for c, test in (
        *((c, f"{raw} IS NOT NULL AND {c} IS NULL") for c, raw in _RAWS.items()), ("churn_label", "false"), ("support_tickets", "false")
    )
)


def val_6(spark, sf):
    """Before the categories are normalised, so that there is something to find."""
    return V.bad_values(X.deduped(spark, sf))


BAD_SQL = """, bad AS (
  SELECT 'contract_type' AS field, raw_contract AS value, count(*) AS n FROM parsed
  WHERE raw_contract NOT IN ('month-to-month', 'one_year', 'two_year') GROUP BY raw_contract)"""
VAL_6 = X.PARSED_SQL + BAD_SQL + " SELECT * FROM bad"


def val_7(spark, sf):
    """With a contract type for each customer: as many bad values as customers."""
    return V.validation_report(X.deduped(spark, sf).withColumn("contract_type", F.concat(F.lit("way "), "customer_id")))


_DTYPES = {c: t for c, t in (("tenure_months", "int"), ("monthly_charges", "float"), ("total_charges", "float"))}
_BADS = " ".join(f"WHEN '{c}' THEN (SELECT count(*) FROM parsed WHERE {raw} IS NOT NULL AND {c} IS NULL)" for c, raw in _RAWS.items())
VAL_7 = X.PARSED_SQL + f""",
fields AS (
  SELECT pos, field, tier, field <> 'age_bucket' AS present, CASE field {_BADS} ELSE 0 END AS n_num,
         CASE field WHEN 'contract_type' THEN (SELECT count(*) FROM parsed) ELSE 0 END AS n_values,
         CASE field WHEN 'contract_type' THEN (SELECT 'way ' || min(customer_id) FROM parsed) END AS first
  FROM (VALUES {_CONTRACT_VALUES}, (11, '*', 1)) k(pos, field, tier))
SELECT pos, field, tier, present, n_num + n_values AS n_bad, n_values AS n_bad_values,
       CASE WHEN n_num > 0 THEN 'Field ''' || field || ''': expected ' || (CASE field {' '.join(f"WHEN '{c}' THEN '{t}'" for c, t in _DTYPES.items())} END)
              || ', but ' || n_num || ' values cannot be converted to numeric'
            WHEN n_values > 0 THEN 'Field ''' || field || ''': found ' || n_values || ' invalid values, the first of them ''' || first || '''. Allowed: ['
              || '''month-to-month'', ''one_year'', ''two_year''' || ']' END AS error
FROM fields"""

CLIENTS = ["north", "south", "west"]


def val_7_clients(spark, sf):
    """The report of three clients in one job, from one reading of their table."""
    client = F.element_at(F.array(*[F.lit(c) for c in CLIENTS]), (F.col("customer_id").cast("bigint") % 3 + 1).cast("int"))
    table = X.deduped(spark, sf).withColumns({"client_id": client, "contract_type": F.concat(F.lit("way "), "customer_id")})
    return V.validation_report(table, group=["client_id"])


_OWN = "SELECT '{}' AS client_id, * FROM (WITH parsed AS (SELECT * FROM everyone WHERE CAST(customer_id AS BIGINT) % 3 = {}){})"
VAL_7_CLIENTS = X.PARSED_SQL + ", everyone AS (SELECT * FROM parsed) " + " UNION ALL ".join(_OWN.format(c, i, VAL_7[len(X.PARSED_SQL) :]) for i, c in enumerate(CLIENTS))

QUERIES = {n: f for n, f in list(globals().items()) if n.startswith(("cln_", "val_")) and callable(f)}
SQL = {n.lower(): s for n, s in list(globals().items()) if n.startswith(("CLN_", "VAL_")) and isinstance(s, str)}
