"""SRC, SNK and MAP queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from tenura.operators import drift as D
from tenura.operators import features as FE
from tenura.operators import mapping as M
from tenura.operators import scoring as S
from tenura.session import new_folder, small_table, stage
from tenura.sources import catalog as C
from tenura.sources import client_tables as CT
from tenura.sources import csv_source as IO
from tenura.sources import paths as P

# --- sources ---------------------------------------------------------------------------------------------------


def src_1(spark, sf):
    """Cells with quotes, commas and line breaks in three files; the columns are asked for in another order than the files have."""
    path = new_folder(spark, "client-csv")
    raw = X.churn_raw(spark, sf).withColumn("note", F.concat(F.lit('said "hi", '), "CustID", F.lit('\nand "left"')))
    IO.write_csv(raw.repartition(3, "src_row"), path)
    back = IO.read_client_csv(spark, path, raw.columns[::-1], order="file_row")
    return back.drop("file_row").withColumn("src_row", F.col("src_row").cast("bigint"))


_TOKENS = "('N/A', 'null')"
SRC_1 = X.RAW_SQL + f"""
SELECT src_row, CustID, CASE WHEN tenure NOT IN {_TOKENS} THEN tenure END AS tenure,
       CASE WHEN MonthlyFee NOT IN {_TOKENS} THEN MonthlyFee END AS MonthlyFee, TotalSpend, Churned, plan_type, how_they_pay,
       CAST(complaints AS VARCHAR) AS complaints, sex, partner, 'said "hi", ' || CustID || chr(10) || 'and "left"' AS note FROM churn_raw"""


def src_2(spark, sf):
    return IO.sample_rows(X.clients_raw(spark, sf))


def _cells(headers):
    cells = ", ".join(f"{{'pos': {i}, 'column': '{name}', 'value': CAST({expr} AS VARCHAR)}}" for i, (name, expr) in enumerate(headers))
    return f"unnest([{cells}], recursive := true)"


SAMPLES_SQL = X.RAW_SQL + ", top AS (SELECT *, row_number() OVER (ORDER BY src_row) AS row_no FROM churn_raw)"
SRC_2 = SAMPLES_SQL + " UNION ALL ".join(
    f" SELECT '{client}' AS client_id, row_no, {_cells(headers)} FROM top WHERE row_no <= 5" for client, headers in X.CLIENT_HEADERS.items()
)


def _config_text(client):
    """One YAML document per supplier, as its own catalog of spellings."""
    head = "client_id: {c}\nsource_description: rows of {c}\ncolumn_mappings:\n"
    body = "".join(f"  {raw}: {to}\n" for raw, to in X.RETAIL.columns.items())
    tail = 'value_mappings:\n  churn_label:\n    "Yes": 1\n    "No": 0\ntype_coercions:\n  churn_label: "int"\n'
    before, between, after = (head + body + tail).split("{c}")
    return F.concat(F.lit(before), client, F.lit(between), client, F.lit(after))


def _supplier_clients(spark, sf):
    return X.table(spark, sf, "supplier").select(F.concat(F.lit("client_"), F.col("s_suppkey").cast("string")).alias("client_id"), "s_suppkey", "s_nationkey")


def src_3(spark, sf):
    """Write every config as its own file, load all files in one job, render them back and parse once more."""
    path = new_folder(spark, "configs")
    texts = _supplier_clients(spark, sf).select("client_id", _config_text(F.col("client_id")).alias("value"))
    C.write_configs(texts, path)
    loaded = C.read_configs(spark, path)
    again = C.config_texts(loaded).select(F.concat("client_id", F.lit(".yaml")).alias("path"), "value")
    return C.parse_configs(again).select("client_id", "kind", "field", "from_value", "to_value", "status")


_ENTRIES = (
    [("description", None, None, None)]
    + [("column", to, raw, to) for raw, to in X.RETAIL.columns.items()]
    + [("value", "churn_label", "Yes", "1"), ("value", "churn_label", "No", "0"), ("type", "churn_label", None, "int")]
)


def _values(rows):
    return ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in rows)


SRC_3 = f"""
SELECT client_id, kind, field, from_value, CASE kind WHEN 'description' THEN 'rows of ' || client_id ELSE to_value END AS to_value,
       'approved' AS status
FROM (SELECT 'client_' || s_suppkey AS client_id FROM supplier) CROSS JOIN (VALUES {_values(_ENTRIES)}) t(kind, field, from_value, to_value)"""


def _supplier_paths(spark, sf):
    s = _supplier_clients(spark, sf)
    day = F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0")
    return s.select(
        "client_id",
        F.concat(F.lit("2024-01-"), day).alias("upload_date"),
        F.concat(F.lit("2024-02-"), day).alias("run_date"),
        F.concat(F.lit("v"), F.col("s_nationkey").cast("string")).alias("model_version"),
    )


def src_4(spark, sf):
    return P.client_paths(_supplier_paths(spark, sf), "lake")


PATHS_SQL = """WITH clients AS (
  SELECT 'client_' || s_suppkey AS client_id, '2024-01-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') AS u,
         '2024-02-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') AS r, 'v' || s_nationkey AS v
  FROM supplier),
paths AS (
  SELECT client_id, kind, 's3://lake/' || client_id || '/' || rest AS path FROM clients, LATERAL (SELECT unnest([
    {'kind': 'raw_data', 'rest': 'raw/' || u || '/data.csv'}, {'kind': 'config', 'rest': 'configs/mapping.yaml'},
    {'kind': 'draft_config', 'rest': 'configs/mapping.draft.yaml'}, {'kind': 'processed', 'rest': 'processed/' || r || '/features.csv'},
    {'kind': 'model', 'rest': 'models/' || v || '/model.tar.gz'}, {'kind': 'model_card', 'rest': 'models/' || v || '/model_card.json'},
    {'kind': 'feature_artifacts', 'rest': 'models/' || v || '/feature_artifacts.pkl'},
    {'kind': 'output', 'rest': 'outputs/scores/' || r || '/predictions.csv'},
    {'kind': 'monitoring', 'rest': 'monitoring/drift_reports/' || r || '/report.json'},
    {'kind': 'training_stats', 'rest': 'monitoring/training_stats.json'}], recursive := true)))"""
SRC_4 = PATHS_SQL + " SELECT client_id, kind, path FROM paths"


def src_5(spark, sf):
    """Every path against its own client and against the client whose name is one digit shorter."""
    paths = P.client_paths(_supplier_paths(spark, sf), "lake").withColumnRenamed("client_id", "owner")
    shorter = F.expr("substring(owner, 1, length(owner) - 1)")
    pairs = paths.withColumn("client_id", F.explode(F.array("owner", shorter)))
    return pairs.select("client_id", "path", P.belongs_to_client(F.col("path"), "lake", F.col("client_id")).alias("belongs"))


SRC_5 = PATHS_SQL + """, pairs AS (
  SELECT client_id, path FROM paths UNION ALL SELECT substr(client_id, 1, length(client_id) - 1), path FROM paths)
SELECT client_id, path, starts_with(path, 's3://lake/' || client_id || '/') AS belongs FROM pairs"""

# --- sinks -----------------------------------------------------------------------------------------------------


def snk_1(spark, sf):
    """Two clients one after the other, the first with half of its rows; then a rerun of the first with all of them."""
    path = new_folder(spark, "mapped")
    table = X.mapped(spark, sf).withColumn("run_date", F.lit("2024-02-01"))
    retail, other = (table.withColumn("client_id", F.lit(c)) for c in ("retail", "other"))
    for batch in (retail.where("src_row % 2 = 0"), other, retail):
        CT.write_table(batch, path)
    back = spark.read.schema(retail.schema).parquet(path)
    return back.select(*X.FIELDS, "client_id", "run_date")


_FIELDS = ", ".join(X.FIELDS)
SNK_1 = X.MAPPED_SQL + f" SELECT {_FIELDS}, client_id, '2024-02-01' AS run_date FROM mapped CROSS JOIN (VALUES ('retail'), ('other')) t(client_id)"


def snk_2(spark, sf):
    """Learned state written, read back and applied."""
    clean = X.cleaned(spark, sf)
    path = new_folder(spark, "state")
    FE.write_state(FE.fit_features(clean), path)
    state = FE.read_state(spark, path)
    return state.stats.select("feature", "kind", F.round("impute_num", 6).alias("impute_num"), "impute_cat", "n_classes", F.round("min", 4).alias("min"), F.round("max", 4).alias("max"))


def snk_3(spark, sf):
    """The deliverable as CSV with a header, read back as text."""
    path = new_folder(spark, "deliverable")
    out = S.deliverable(X.scored_vectors(spark, sf), X.VECTOR_NAMES)
    IO.write_csv(out.withColumn("churn_probability", F.format_string("%.4f", "churn_probability")), path)
    return spark.read.option("header", True).option("escape", '"').schema("customer_id string, churn_probability double, risk_tier string, top_3_reasons string, narrative_explanation string").csv(path)


def snk_4(spark, sf):
    """Training snapshot written as parquet and read back."""
    path = new_folder(spark, "training-stats")
    D.training_snapshot(D.long_values(stage(X.cleaned(spark, sf)), list(X.BOUNDS_SQL))).write.parquet(path)
    return spark.read.parquet(path).select("feature", "n", F.col("least").alias("least"), F.col("most").alias("most"), F.concat_ws(",", F.transform("counts", lambda n: n.cast("string"))).alias("counts"))


# --- mapping ---------------------------------------------------------------------------------------------------


def map_1(spark, sf):
    return M.rename_columns(X.churn_raw(spark, sf), {**X.RETAIL.columns, "not_there": "age_bucket"})


MAP_1 = X.RAW_SQL + " SELECT src_row, " + ", ".join(f"{raw} AS {to}" for raw, to in X.RETAIL.columns.items()) + " FROM churn_raw"


def map_2(spark, sf):
    """Short lists, and one of 300 values of which two keys are one text: the last one counts."""
    values = {"Churned": {"Yes": "1", "No": "0"}, "partner": {"Yes": "1"}, "complaints": {0: "nothing", "0": "none"}, "absent": {"a": "b"}}
    values["CustID"] = {**{k: f"x{k}" for k in range(300)}, "7": "seven"}
    return M.map_values(X.churn_raw(spark, sf), values).select("src_row", "CustID", "Churned", "partner", "complaints", "plan_type")


MAP_2 = X.RAW_SQL + """
SELECT src_row, CASE WHEN CustID = '7' THEN 'seven' WHEN CAST(CustID AS BIGINT) < 300 THEN 'x' || CustID ELSE CustID END AS CustID,
       CASE Churned WHEN 'Yes' THEN '1' WHEN 'No' THEN '0' ELSE Churned END AS Churned,
       CASE partner WHEN 'Yes' THEN '1' ELSE partner END AS partner,
       CASE CAST(complaints AS VARCHAR) WHEN '0' THEN 'none' ELSE CAST(complaints AS VARCHAR) END AS complaints, plan_type FROM churn_raw"""


def map_3(spark, sf):
    types = {"tenure": "int", "MonthlyFee": "float", "TotalSpend": "int", "complaints": "string", "plan_type": "category"}
    return M.coerce_types(X.churn_raw(spark, sf), types).select("src_row", *types)


MAP_3 = X.RAW_SQL + f"""
SELECT src_row, CAST(trunc({X.num('tenure')}) AS BIGINT) AS tenure, {X.num('MonthlyFee')} AS MonthlyFee,
       CAST(trunc({X.num('TotalSpend')}) AS BIGINT) AS TotalSpend, CAST(complaints AS VARCHAR) AS complaints, plan_type FROM churn_raw"""


def map_4(spark, sf):
    return X.mapped(spark, sf)


MAP_4 = X.MAPPED_SQL + " SELECT * FROM mapped"


def map_5(spark, sf):
    """The three clients, and a fourth whose raw columns bear contract names; the fifth has no approved mapping and is left out."""
    raw = X.clients_raw(spark, sf)
    named = X.churn_raw(spark, sf).select("src_row", F.col("CustID").alias("customer_id"), F.col("sex").alias("gender"), F.col("partner").alias("plan"))
    every = raw.union(IO.raw_rows(named, "plain")).union(IO.raw_rows(named, "stranger"))
    catalog = X.catalog(spark).union(small_table(spark, [("plain", "column", "contract_type", "plan", "contract_type", None, None, "approved")], C.CATALOG_SCHEMA))
    return M.apply_catalog(every, catalog, leave_out=True)


MAP_5 = X.CLIENTS_MAPPED_SQL + """ SELECT * FROM clients_mapped
UNION ALL SELECT 'plain', src_row, CustID, NULL, NULL, NULL, NULL, partner, NULL, NULL, sex, NULL, NULL FROM churn_raw"""


def map_6(spark, sf):
    """Coverage of the three clients' mappings next to the rows each one brings."""
    rows = X.clients_raw(spark, sf).groupBy("client_id").agg(F.count("*").alias("n_rows"))
    return C.mapping_coverage(X.catalog(spark).filter("status = 'approved'")).join(rows, "client_id")


MAP_6 = X.RAW_SQL + """
SELECT client_id, n_columns, n_value_maps, n_types, (SELECT count(*) FROM churn_raw) AS n_rows
FROM (VALUES ('retail', 10::BIGINT, 1::BIGINT, 1::BIGINT), ('shop', 9, 2, 4), ('bank', 7, 1, 4)) t(client_id, n_columns, n_value_maps, n_types)"""

QUERIES = {
    "src_1": src_1, "src_2": src_2, "src_3": src_3, "src_4": src_4, "src_5": src_5,
    "snk_1": snk_1, "snk_2": snk_2, "snk_3": snk_3, "snk_4": snk_4,
    "map_1": map_1, "map_2": map_2, "map_3": map_3, "map_4": map_4, "map_5": map_5, "map_6": map_6,
}
SQL = {
    "src_1": SRC_1, "src_2": SRC_2, "src_3": SRC_3, "src_4": SRC_4, "src_5": SRC_5, "snk_1": SNK_1,
    "map_1": MAP_1, "map_2": MAP_2, "map_3": MAP_3, "map_4": MAP_4, "map_5": MAP_5, "map_6": MAP_6,
}
