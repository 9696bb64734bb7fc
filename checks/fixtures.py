"""Inputs of the registered queries, derived from the given tables, and the same inputs as SQL text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.cleaning import clean_values, remove_repeats
from tenura.operators.mapping import apply_mapping
from tenura.session import small_table, stage
from tenura.sources.catalog import CATALOG_SCHEMA, Mapping, mapping_rows
from tenura.sources.csv_source import raw_rows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- churn_raw -------------------------------------------------------------------------------------------------


def _cents_text(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def churn_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty client table. Lines are counted per order, then orders per customer, so both joins are one to one."""
    orders = table(spark, sf, "orders")
    returned = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    lines = returned.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("r"))
    day = F.col("o_orderdate")
    spend = (
        orders.join(lines, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(day).alias("first"),
            F.max(day).alias("last"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"),
            F.max(F.when(day < F.lit("2000-10-01").cast("timestamp"), 0).otherwise(1)).alias("active"),
            F.min(F.substring("o_orderpriority", 1, 1).cast("int")).alias("prio"),
            F.coalesce(F.sum("r"), F.lit(0)).alias("n"),
        )
    )
    months = (F.year("last") - F.year("first")) * 12 + F.month("last") - F.month("first")
    base = table(spark, sf, "customer").join(spend, "c_custkey").select(
        F.col("c_custkey").alias("k"), months.cast("bigint").alias("m"), F.floor(F.col("total") / 100).cast("bigint").alias("total_c"),
        "active", "prio", "n", F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nk"),
    )
    k = F.col("k")
    kinds = F.array(F.lit(0), F.when(k % 29 == 0, 1), F.when(k % 31 == 0, 2))
    rows = base.withColumn("copy", F.explode(F.filter(kinds, lambda x: x.isNotNull())))

    def every(n: int, text: str | None):
        return (k % n == 0, F.lit(text).cast("string"))

    def first_of(*cases, otherwise):
        out = F.when(*cases[0])
        for c in cases[1:]:
            out = out.when(*c)
        return out.otherwise(otherwise)

    fee = F.floor(F.col("total_c") / (F.col("m") + 1)).cast("bigint")
    seg, sex = F.col("seg"), F.col("nk") % 5
    pay = F.col("prio")
    return rows.select(
        (k * 4 + F.col("copy")).alias("src_row"),
        k.cast("string").alias("CustID"),
        first_of(every(37, "N/A"), every(41, "ERROR"), every(43, "-3"), every(47, "999"), every(53, None), otherwise=F.col("m").cast("string")).alias("tenure"),
        first_of(every(19, "  "), every(23, "null"), otherwise=_cents_text(fee)).alias("MonthlyFee"),
        first_of(every(59, "---"), otherwise=_cents_text(F.col("total_c"))).alias("TotalSpend"),
        F.when(F.col("active") == 1, "No").otherwise("Yes").alias("Churned"),
        F.when(seg == "AUTOMOBILE", "Month-to-month").when(seg == "BUILDING", "MTM").when(seg == "FURNITURE", " annual ").when(seg == "HOUSEHOLD", "2 year").alias("plan_type"),
        F.when(pay == 1, "CC").when(pay == 2, "ACH").when(pay == 3, "e-check").when(pay == 4, "check").otherwise("paypal").alias("how_they_pay"),
        F.when(F.col("copy") == 2, F.col("n") + 1).otherwise(F.col("n")).alias("complaints"),
        F.when(sex == 0, "M").when(sex == 1, "f").when(sex == 2, "FEMALE").when(sex == 3, "male").alias("sex"),
        F.when(F.col("nk") % 2 == 0, "Yes").otherwise("No").alias("partner"),
    )


RAW_COLUMNS = ["CustID", "tenure", "MonthlyFee", "TotalSpend", "Churned", "plan_type", "how_they_pay", "complaints", "sex", "partner"]

RAW_SQL = """WITH spend AS (
  SELECT o_custkey AS k,
         CAST((year(max(o_orderdate)) - year(min(o_orderdate))) * 12
              + month(max(o_orderdate)) - month(min(o_orderdate)) AS BIGINT) AS m,
         CAST(floor(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100) AS BIGINT) AS total_c,
         max(CASE WHEN o_orderdate < TIMESTAMP '2000-10-01 00:00:00' THEN 0 ELSE 1 END) AS active,
         min(o_orderpriority) AS prio
  FROM orders GROUP BY o_custkey),
tickets AS (
  SELECT o_custkey AS k, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' GROUP BY o_custkey),
base AS (
  SELECT c_custkey AS k, m, total_c, active, prio, coalesce(n, 0) AS n, c_mktsegment AS seg, c_nationkey AS nk
  FROM customer JOIN spend ON spend.k = c_custkey LEFT JOIN tickets ON tickets.k = c_custkey),
copies AS (
  SELECT base.*, 0 AS copy FROM base
  UNION ALL SELECT base.*, 1 AS copy FROM base WHERE k % 29 = 0
  UNION ALL SELECT base.*, 2 AS copy FROM base WHERE k % 31 = 0),
churn_raw AS (
  SELECT k * 4 + copy AS src_row,
       CAST(k AS VARCHAR) AS CustID,
       CASE WHEN k % 37 = 0 THEN 'N/A' WHEN k % 41 = 0 THEN 'ERROR' WHEN k % 43 = 0 THEN '-3'
            WHEN k % 47 = 0 THEN '999' WHEN k % 53 = 0 THEN NULL ELSE CAST(m AS VARCHAR) END AS tenure,
       CASE WHEN k % 19 = 0 THEN '  ' WHEN k % 23 = 0 THEN 'null'
            ELSE CAST(CAST(CAST(floor(total_c / (m + 1)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS VARCHAR) END AS MonthlyFee,
       CASE WHEN k % 59 = 0 THEN '---' ELSE CAST(CAST(CAST(total_c AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS VARCHAR) END AS TotalSpend,
       CASE WHEN active = 1 THEN 'No' ELSE 'Yes' END AS Churned,
       CASE seg WHEN 'AUTOMOBILE' THEN 'Month-to-month' WHEN 'BUILDING' THEN 'MTM' WHEN 'FURNITURE' THEN ' annual '
                WHEN 'HOUSEHOLD' THEN '2 year' ELSE NULL END AS plan_type,
       CASE substr(prio, 1, 1) WHEN '1' THEN 'CC' WHEN '2' THEN 'ACH' WHEN '3' THEN 'e-check'
                WHEN '4' THEN 'check' ELSE 'paypal' END AS how_they_pay,
       CASE WHEN copy = 2 THEN n + 1 ELSE n END AS complaints,
       CASE nk % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'f' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'male' ELSE NULL END AS sex,
       CASE WHEN nk % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner
  FROM copies)"""

# --- mapped and cleaned ----------------------------------------------------------------------------------------

RETAIL = Mapping(
    "retail",
    "orders of the retail client",
    columns={
        "CustID": "customer_id", "tenure": "tenure_months", "MonthlyFee": "monthly_charges", "TotalSpend": "total_charges",
        "Churned": "churn_label", "plan_type": "contract_type", "how_they_pay": "payment_method",
        "complaints": "support_tickets", "sex": "gender", "partner": "partner_status",
    },
    values={"churn_label": {"Yes": "1", "No": "0"}},
    types={"churn_label": "int"},
)

FIELDS = list(RETAIL.columns.values())


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return apply_mapping(churn_raw(spark, sf), RETAIL)


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(mapped(spark, sf))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_values(deduped(spark, sf))


MAPPED_SQL = (
    RAW_SQL
    + """,
mapped AS (
  SELECT src_row, CustID AS customer_id, tenure AS tenure_months, MonthlyFee AS monthly_charges, TotalSpend AS total_charges,
         CAST(CASE Churned WHEN 'Yes' THEN '1' WHEN 'No' THEN '0' ELSE Churned END AS BIGINT) AS churn_label,
         plan_type AS contract_type, how_they_pay AS payment_method, complaints AS support_tickets, sex AS gender,
         partner AS partner_status
  FROM churn_raw)"""
)

DEDUPED_SQL = (
    MAPPED_SQL
    + """,
deduped AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY src_row) AS rn FROM mapped)
  WHERE rn = 1)"""
)

NUMBER = r"(?i)^\s*[+-]?(inf|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*$"


def num(x: str) -> str:
    """Numeric text to double, SQL."""
    return f"CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{NUMBER}') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END"


def cap(x: str, low: float, high: float) -> str:
    return f"CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END"


def rounded(x: str, places: int) -> str:
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale})"


def fixed(x: str, places: int) -> str:
    units = f"CAST(floor(abs({x}) * CAST({10**places} AS DOUBLE) + 0.5) AS BIGINT)"
    return (
        f"((CASE WHEN {x} < 0 AND {units} > 0 THEN '-' ELSE '' END) || CAST({units} // {10**places} AS VARCHAR) || '.' "
        f"|| lpad(CAST({units} % {10**places} AS VARCHAR), {places}, '0'))"
    )


def signed(x: str) -> str:
    return f"((CASE WHEN {x} >= 0 THEN '+' ELSE '-' END) || {fixed(f'abs({x})', 2)})"


BOUNDS_SQL = {"tenure_months": (0, 120), "monthly_charges": (0, 500), "total_charges": (0, 50000), "support_tickets": (0, 100)}

# The category spellings once more, as SQL.
_SPELL = {
    "contract_type": """CASE lower(regexp_replace(contract_type, '^\\s+|\\s+$', '', 'g'))
      WHEN 'month to month' THEN 'month-to-month' WHEN 'month-to-month' THEN 'month-to-month' WHEN 'm2m' THEN 'month-to-month'
      WHEN 'mtm' THEN 'month-to-month' WHEN 'monthly' THEN 'month-to-month' WHEN 'one year' THEN 'one_year' WHEN 'one_year' THEN 'one_year'
      WHEN '1 year' THEN 'one_year' WHEN '1year' THEN 'one_year' WHEN '12 months' THEN 'one_year' WHEN 'annual' THEN 'one_year'
      WHEN 'two year' THEN 'two_year' WHEN 'two_year' THEN 'two_year' WHEN '2 year' THEN 'two_year' WHEN '2year' THEN 'two_year'
      WHEN '24 months' THEN 'two_year' WHEN 'biennial' THEN 'two_year' ELSE contract_type END""",
    "payment_method": """CASE lower(regexp_replace(payment_method, '^\\s+|\\s+$', '', 'g'))
      WHEN 'credit card' THEN 'credit_card' WHEN 'credit_card' THEN 'credit_card' WHEN 'cc' THEN 'credit_card' WHEN 'visa' THEN 'credit_card'
      WHEN 'mastercard' THEN 'credit_card' WHEN 'bank transfer' THEN 'bank_transfer' WHEN 'bank_transfer' THEN 'bank_transfer'
      WHEN 'ach' THEN 'bank_transfer' WHEN 'direct debit' THEN 'bank_transfer' WHEN 'electronic check' THEN 'electronic_check'
      WHEN 'electronic_check' THEN 'electronic_check' WHEN 'e-check' THEN 'electronic_check' WHEN 'echeck' THEN 'electronic_check'
      WHEN 'mailed check' THEN 'mailed_check' WHEN 'mailed_check' THEN 'mailed_check' WHEN 'check' THEN 'mailed_check'
      ELSE payment_method END""",
    "gender": """CASE lower(regexp_replace(gender, '^\\s+|\\s+$', '', 'g'))
      WHEN 'male' THEN 'Male' WHEN 'm' THEN 'Male' WHEN 'female' THEN 'Female' WHEN 'f' THEN 'Female' ELSE gender END""",
}

PARSED_SQL = (
    DEDUPED_SQL
    + f""",
parsed AS (
  SELECT src_row, customer_id, churn_label, partner_status,
         tenure_months AS raw_tenure, monthly_charges AS raw_monthly, total_charges AS raw_total,
         {num('tenure_months')} AS tenure_months, {num('monthly_charges')} AS monthly_charges,
         {num('total_charges')} AS total_charges, CAST(support_tickets AS DOUBLE) AS support_tickets,
         contract_type AS raw_contract, payment_method AS raw_payment, gender AS raw_gender,
         {_SPELL['contract_type']} AS contract_type, {_SPELL['payment_method']} AS payment_method, {_SPELL['gender']} AS gender
  FROM deduped)"""
)

CLEANED_SQL = (
    PARSED_SQL
    + """,
cleaned AS (
  SELECT src_row, customer_id, """
    + ", ".join(f"{cap(c, lo, hi)} AS {c}" for c, (lo, hi) in BOUNDS_SQL.items())
    + """,
         churn_label, contract_type, payment_method, gender, partner_status
  FROM parsed)"""
)

# --- several clients -------------------------------------------------------------------------------------------

SHOP = Mapping(
    "shop",
    "orders of the web shop client",
    columns={
        "CustomerID": "customer_id", "Tenure": "tenure_months", "CashbackAmount": "monthly_charges", "OrderCount": "total_charges",
        "Churn": "churn_label", "PreferredPaymentMode": "payment_method", "Gender": "gender", "Complain": "support_tickets",
        "MaritalStatus": "partner_status",
    },
    values={"churn_label": {"1": "1", "0": "0"}, "partner_status": {"Married": "1", "Single": "0"}},
    types={"tenure_months": "int", "monthly_charges": "float", "total_charges": "float", "support_tickets": "int"},
)
BANK = Mapping(
    "bank",
    "accounts of the bank client",
    columns={
        "CustomerId": "customer_id", "Tenure": "tenure_months", "EstimatedSalary": "monthly_charges", "Balance": "total_charges",
        "Exited": "churn_label", "Gender": "gender", "NumOfProducts": "support_tickets",
    },
    values={"churn_label": {"1": "1", "0": "0"}},
    types={"tenure_months": "int", "monthly_charges": "float", "total_charges": "float", "support_tickets": "int"},
)
CLIENTS = [RETAIL, SHOP, BANK]


def catalog(spark: SparkSession) -> DataFrame:
    """The three mappings, plus the bank's own limits for charges."""
    rows = [r for m in CLIENTS for r in mapping_rows(m)]
    rows.append(("bank", "bound", "monthly_charges", "0", "2000", None, None, "approved"))
    rows.append(("bank", "bound", "total_charges", "0", "90000", None, None, "approved"))
    rows.append(("bank", "column", "gender", "Surname", "gender", "low", "guess", "draft"))
    return small_table(spark, rows, CATALOG_SCHEMA)


def clients_raw(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of ``churn_raw`` under the headers of three clients, in the shared raw shape."""
    raw = stage(churn_raw(spark, sf))
    coded = F.when(F.col("Churned") == "Yes", "1").otherwise("0")
    shop = raw.select(
        "src_row", F.col("CustID").alias("CustomerID"), F.col("tenure").alias("Tenure"), F.col("MonthlyFee").alias("CashbackAmount"),
        F.col("TotalSpend").alias("OrderCount"), coded.alias("Churn"), F.col("how_they_pay").alias("PreferredPaymentMode"),
        F.col("sex").alias("Gender"), F.col("complaints").alias("Complain"),
        F.when(F.col("partner") == "Yes", "Married").otherwise("Single").alias("MaritalStatus"),
    )
    bank = raw.select(
        "src_row", F.col("CustID").alias("CustomerId"), F.col("plan_type").alias("Surname"), F.col("tenure").alias("Tenure"),
        F.col("MonthlyFee").alias("EstimatedSalary"), F.col("TotalSpend").alias("Balance"), coded.alias("Exited"),
        F.col("sex").alias("Gender"), F.col("complaints").alias("NumOfProducts"),
    )
    return reduce(DataFrame.union, [raw_rows(raw, "retail"), raw_rows(shop, "shop"), raw_rows(bank, "bank")])


CLIENT_HEADERS = {
    "retail": [(c, c) for c in RAW_COLUMNS],
    "shop": [
        ("CustomerID", "CustID"), ("Tenure", "tenure"), ("CashbackAmount", "MonthlyFee"), ("OrderCount", "TotalSpend"),
        ("Churn", "CASE Churned WHEN 'Yes' THEN '1' ELSE '0' END"), ("PreferredPaymentMode", "how_they_pay"), ("Gender", "sex"),
        ("Complain", "complaints"), ("MaritalStatus", "CASE partner WHEN 'Yes' THEN 'Married' ELSE 'Single' END"),
    ],
    "bank": [
        ("CustomerId", "CustID"), ("Surname", "plan_type"), ("Tenure", "tenure"), ("EstimatedSalary", "MonthlyFee"), ("Balance", "TotalSpend"),
        ("Exited", "CASE Churned WHEN 'Yes' THEN '1' ELSE '0' END"), ("Gender", "sex"), ("NumOfProducts", "complaints"),
    ],
}

_NUMERIC = {"tenure_months": "tenure", "monthly_charges": "MonthlyFee", "total_charges": "TotalSpend"}
_WHOLE_TENURE = f"CAST(CAST(trunc({num('tenure')}) AS BIGINT) AS VARCHAR)"


def _kept(x: str) -> str:
    return f"CASE WHEN ({num(x)}) IS NOT NULL THEN {x} END"


_LABEL_SQL = "CASE Churned WHEN 'Yes' THEN '1' ELSE '0' END"

# Contract columns of all clients as text, as MAP-5 gives them.
CLIENTS_MAPPED_SQL = (
    RAW_SQL
    + f""",
clients_mapped AS (
  SELECT 'retail' AS client_id, src_row, CustID AS customer_id, tenure AS tenure_months, MonthlyFee AS monthly_charges,
         TotalSpend AS total_charges, {_LABEL_SQL} AS churn_label, plan_type AS contract_type, how_they_pay AS payment_method,
         CAST(complaints AS VARCHAR) AS support_tickets, sex AS gender, CAST(NULL AS VARCHAR) AS age_bucket, partner AS partner_status
  FROM churn_raw
  UNION ALL
  SELECT 'shop', src_row, CustID, {_WHOLE_TENURE}, {_kept('MonthlyFee')}, {_kept('TotalSpend')}, {_LABEL_SQL}, NULL, how_they_pay,
         CAST(complaints AS VARCHAR), sex, NULL, CASE partner WHEN 'Yes' THEN '1' ELSE '0' END
  FROM churn_raw
  UNION ALL
  SELECT 'bank', src_row, CustID, {_WHOLE_TENURE}, {_kept('MonthlyFee')}, {_kept('TotalSpend')}, {_LABEL_SQL}, NULL, NULL,
         CAST(complaints AS VARCHAR), sex, NULL, NULL
  FROM churn_raw)"""
)

# --- scored rows -----------------------------------------------------------------------------------------------


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars"), "doc_id")
    return joined.select(
        F.col("source").alias("client_id"), F.col("lang").alias("model_id"), F.col("quality").alias("y"), ((F.col("n_chars") % 997) / 997.0).alias("p")
    )


SCORED_SQL = """WITH scored AS (
  SELECT source AS client_id, lang AS model_id, quality AS y, CAST(n_chars % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS p
  FROM labels JOIN documents USING (doc_id))"""

FEATURE_NAMES = [
    "tenure_months", "monthly_charges", "total_charges", "support_tickets", "contract_type", "payment_method", "gender",
    "age_bucket", "partner_status", "interaction_charges_x_tenure",
]


# One name for each dimension of the embeddings.
VECTOR_NAMES = [*FEATURE_NAMES, *[f"usage_{i}" for i in range(len(FEATURE_NAMES), 64)]]


def scored_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a probability and contributions, from the whole embeddings."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("customer_id"),
        F.col("vec_id").alias("src_row"),
        ((F.col("vec_id") * 37 % 1000) / 1000.0).alias("churn_probability"),
        F.col("embedding").cast("array<double>").alias("contributions"),
    )


VECTORS_SQL = """WITH vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS customer_id, vec_id AS src_row, CAST(vec_id * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS churn_probability,
         CAST(embedding AS DOUBLE[]) AS contributions
  FROM embeddings)"""

TIER_SQL = "CASE WHEN churn_probability >= 0.7 THEN 'high' WHEN churn_probability >= 0.4 THEN 'medium' ELSE 'low' END"
