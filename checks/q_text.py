"""DRF and LLM queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import q_sources as Q
from checks.q_models import REASONS_CTE
from tenura.contract import CONTRACT
from tenura.operators import drift as D
from tenura.operators import prompts as P
from tenura.operators import scoring as S
from tenura.session import stage
from tenura.sources import csv_source as IO

# --- drift -----------------------------------------------------------------------------------------------------

NUMERIC = ["tenure_months", "monthly_charges", "total_charges", "support_tickets"]


def _pair(spark, sf):
    """Cleaned rows split by id: even ids are the training side, odd ids a later batch with shorter tenure.

    The later batch also lacks ``support_tickets`` and brings a column of one value; the training side has it too.
    """
    clean = stage(X.cleaned(spark, sf)).withColumn("constant", F.lit(7.0))
    even = F.col("customer_id").cast("bigint") % 2 == 0
    reference = D.long_values(clean.filter(even), [*NUMERIC, "constant"])
    later = clean.filter(~even).withColumn("tenure_months", F.col("tenure_months") * 0.3)
    return reference, D.long_values(later, ["tenure_months", "monthly_charges", "total_charges", "constant"])


_SIDE = " UNION ALL ".join(f"SELECT '{c}' AS feature, {{scale_{c}}}{c} AS value FROM cleaned WHERE {c} IS NOT NULL AND CAST(customer_id AS BIGINT) % 2 = {{odd}}" for c in NUMERIC)
_CONSTANT = " UNION ALL SELECT 'constant', 7.0::DOUBLE FROM cleaned WHERE CAST(customer_id AS BIGINT) % 2 = {odd}"
_SCALES = {f"scale_{c}": "" for c in NUMERIC}
_REFERENCE = (_SIDE + _CONSTANT).format(odd=0, **_SCALES)
_CURRENT = (_SIDE.rsplit(" UNION ALL ", 1)[0] + _CONSTANT).format(odd=1, **{**_SCALES, "scale_tenure_months": "0.3::DOUBLE * "})
_BIN = " + ".join(f"CASE WHEN value >= least + {i}.0::DOUBLE * ((most - least) / 10.0::DOUBLE) THEN 1 ELSE 0 END" for i in range(1, 10))


def _drift_sql(head, reference, current):
    return head + f""",
reference AS ({reference}),
present AS ({current}),
ranges AS (SELECT feature, count(*) AS n, min(value) AS least, max(value) AS most FROM reference GROUP BY feature),
hist AS (
  SELECT feature, side, {_BIN} AS bin, count(*) AS k
  FROM (SELECT 'r' AS side, * FROM reference UNION ALL SELECT 'c', * FROM present) JOIN ranges USING (feature) GROUP BY ALL),
now AS (SELECT feature, count(*) AS m, min(value) AS cl, max(value) AS cm FROM present GROUP BY feature),
shares AS (
  SELECT r.feature, b.bin, greatest(coalesce(hr.k, 0)::DOUBLE / r.n, 1e-6::DOUBLE) AS rs, greatest(coalesce(hc.k, 0)::DOUBLE / now.m, 1e-6::DOUBLE) AS cs
  FROM ranges r JOIN now USING (feature) CROSS JOIN (SELECT unnest(range(10)) AS bin) b
  LEFT JOIN hist hr ON hr.feature = r.feature AND hr.side = 'r' AND hr.bin = b.bin
  LEFT JOIN hist hc ON hc.feature = r.feature AND hc.side = 'c' AND hc.bin = b.bin),
sums AS (SELECT feature, sum((cs - rs) * ln(cs / rs)) AS s FROM shares GROUP BY feature),
scores AS (
  SELECT feature, n AS n_reference, m AS n_current,
         round(CASE WHEN least = most THEN CASE WHEN cl = least AND cm = least THEN 0.0 ELSE 0.25 END ELSE s END, 9) AS psi
  FROM ranges JOIN now USING (feature) JOIN sums USING (feature) WHERE n >= 10 AND m >= 10)"""


DRIFT_SQL = _drift_sql(X.CLEANED_SQL, _REFERENCE, _CURRENT)


def _edges_text(edges):
    return F.concat_ws(",", F.transform(edges, lambda e: F.floor(e * 1000 + 0.5).cast("string")))


def drf_1(spark, sf):
    reference, _ = _pair(spark, sf)
    return D.bin_ranges(reference).select("feature", "n", "least", "most", _edges_text(F.col("edges")).alias("edges"))


DRF_1 = DRIFT_SQL + """
SELECT feature, n, least, most, (SELECT string_agg(CAST(CAST(floor((least + CAST(i AS DOUBLE) * ((most - least) / 10.0::DOUBLE)) * 1000 + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY i)
  FROM (SELECT unnest(range(1, 10)) AS i)) AS edges FROM ranges"""


def drf_2(spark, sf):
    reference, current = _pair(spark, sf)
    ranges = stage(D.bin_ranges(reference))
    sides = [(D.histogram(v, ranges).select(F.lit(s).alias("side"), "feature", "bin", "n")) for s, v in (("r", reference), ("c", current))]
    return sides[0].union(sides[1])


DRF_2 = DRIFT_SQL + " SELECT side, feature, bin, k AS n FROM hist"


def _scores(spark, sf):
    reference, current = _pair(spark, sf)
    return D.psi_scores(D.training_snapshot(reference), current).withColumn("psi", F.round("psi", 9))


def drf_3(spark, sf):
    return _scores(spark, sf).select("feature", "psi")


DRF_3 = DRIFT_SQL + " SELECT feature, psi FROM scores"


def drf_4(spark, sf):
    """A constant training column against itself and against a later batch that varies."""
    clean = stage(X.cleaned(spark, sf))
    reference = D.long_values(clean.select(F.lit(7.0).alias("same"), F.lit(7.0).alias("varies")), ["same", "varies"])
    current = D.long_values(clean.select(F.lit(7.0).alias("same"), F.col("support_tickets").alias("varies")), ["same", "varies"])
    return D.psi_scores(D.training_snapshot(reference), current)


DRF_4 = X.CLEANED_SQL + """
SELECT 'same' AS feature, count(*) AS n_reference, count(*) AS n_current, 0.0::DOUBLE AS psi FROM cleaned
UNION ALL SELECT 'varies', count(*), count(support_tickets), CASE WHEN min(support_tickets) = 7 AND max(support_tickets) = 7 THEN 0.0 ELSE 0.25 END FROM cleaned"""


def _events(spark, sf):
    """Event values per type: first half of January as training side, second half as later batch."""
    events = X.table(spark, sf, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    value = F.when(F.col("event_type") == "error", F.col("value") * F.when(early, 1.0).otherwise(2.0)).otherwise(F.col("value"))
    values = events.select(early.alias("early"), F.col("event_type").alias("feature"), value.alias("value"))
    return values.filter("early").drop("early"), values.filter("not early").drop("early")


_EVENT = "SELECT event_type AS feature, CASE WHEN event_type = 'error' THEN value * {scale}::DOUBLE ELSE value END AS value FROM events WHERE value IS NOT NULL AND ts {test} TIMESTAMP '2024-01-16'"
EVENT_SQL = _drift_sql("WITH one AS (SELECT 1)", _EVENT.format(scale="1.0", test="<"), _EVENT.format(scale="2.0", test=">="))


def _event_scores(spark, sf):
    reference, current = _events(spark, sf)
    return D.psi_scores(D.training_snapshot(reference), current).withColumn("psi", F.round("psi", 9))


def drf_5(spark, sf):
    return D.flagged(_event_scores(spark, sf))


DRF_5 = EVENT_SQL + " SELECT *, psi > 0.2 AS drifted FROM scores"


def drf_6(spark, sf):
    report = D.drift_report(_scores(spark, sf), "2024-02-01")
    scores = F.transform(F.map_entries("psi_scores"), lambda e: F.concat(e["key"], F.lit("="), F.floor(e["value"] * 1e6 + 0.5).cast("string")))
    return report.select(
        "run_date", "features_checked", F.concat_ws(",", "features_drifted").alias("features_drifted"), F.concat_ws(",", scores).alias("psi_scores"), "alert_triggered"
    )


DRF_6 = DRIFT_SQL + """
SELECT '2024-02-01' AS run_date, count(*) AS features_checked, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (psi > 0.2), '') AS features_drifted,
       string_agg(feature || '=' || CAST(floor(psi * 1e6 + 0.5) AS BIGINT), ',' ORDER BY feature) AS psi_scores, bool_or(psi > 0.2) AS alert_triggered FROM scores"""


def drf_7(spark, sf):
    return D.banded(_scores(spark, sf)).select("feature", "psi", "band")


DRF_7 = DRIFT_SQL + " SELECT feature, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS band FROM scores"


def drf_8(spark, sf):
    reference, _ = _events(spark, sf)
    snapshot = D.training_snapshot(reference)
    return snapshot.select("feature", "n", "least", "most", F.concat_ws(",", F.transform("counts", lambda n: n.cast("string"))).alias("counts"))


_COUNTS = """(SELECT string_agg(CAST(coalesce(k, 0) AS VARCHAR), ',' ORDER BY b.bin) FROM (SELECT unnest(range(10)) AS bin) b
  LEFT JOIN hist h ON h.bin = b.bin AND h.side = 'r' AND h.feature = ranges.feature) AS counts"""
DRF_8 = EVENT_SQL + f" SELECT feature, n, least, most, {_COUNTS} FROM ranges"
_ALL = _drift_sql(X.CLEANED_SQL, " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM cleaned WHERE {c} IS NOT NULL" for c in NUMERIC), "SELECT 'tenure_months' AS feature, 1.0::DOUBLE AS value")
SNK_4 = _ALL + f" SELECT feature, n, least, most, {_COUNTS} FROM ranges"

# --- narratives ------------------------------------------------------------------------------------------------


def _scored(spark, sf):
    v = X.scored_vectors(spark, sf)
    return v.withColumn("risk_tier", S.risk_tier(F.col("churn_probability"))).withColumn("top", S.top_factors(F.col("contributions"), X.VECTOR_NAMES))


def _batched(spark, sf):
    return P.batches(_scored(spark, sf), ["src_row"])


def llm_1(spark, sf):
    return _batched(spark, sf).select("customer_id", "position", "batch_id")


BATCH_CTE = """,
batched AS (
  SELECT customer_id, churn_probability, row_number() OVER (ORDER BY src_row) AS position, (row_number() OVER (ORDER BY src_row) - 1) // 50 AS batch_id FROM vectors)"""
LLM_1 = X.VECTORS_SQL + BATCH_CTE + " SELECT customer_id, position, batch_id FROM batched"

DEFINITIONS = {"tenure_months": "months since the first order", "monthly_charges": "spend per month"}


def llm_2(spark, sf):
    return P.narrative_prompts(_batched(spark, sf), DEFINITIONS)


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


# Fixed value: the wording of the narrative prompt, with two definitions filled in.
_HEAD = """You are an expert customer retention analyst writing for non-technical business users. For each customer, explain in plain English WHY the model predicts they are at risk of leaving. Reference specific feature values. Use simple language. Keep each explanation under 150 words. Do not use technical jargon like 'SHAP values' or 'feature importance.'

Feature definitions (for your reference):
  - tenure_months: months since the first order
  - monthly_charges: spend per month

For each customer below, write a plain-English paragraph (under 150 words) explaining why they are at risk of leaving. Reference the specific factors listed.

Format your response as:
CUSTOMER_ID: [customer_id]
NARRATIVE: [your explanation]

(Repeat for each customer)

"""
PROMPT_CTE = BATCH_CTE + REASONS_CTE + f""",
blocks AS (
  SELECT batch_id, position, chr(10) || '--- Customer: ' || customer_id || ' ---' || chr(10) || 'Churn probability: ' || {X.fixed('churn_probability', 2)}
         || chr(10) || 'Risk tier: ' || {X.TIER_SQL} || chr(10) || 'Top contributing factors:' || chr(10)
         || (SELECT string_agg('  - ' || reason || chr(10), '' ORDER BY place) FROM reasons r WHERE r.customer_id = b.customer_id) AS block
  FROM batched b),
prompts AS (SELECT batch_id, count(*) AS n_customers, {_quoted(_HEAD)} || string_agg(block, '' ORDER BY position) AS prompt FROM blocks GROUP BY batch_id)"""
LLM_2 = X.VECTORS_SQL + PROMPT_CTE + " SELECT * FROM prompts"


def _responses(spark, sf):
    """A response per batch: chatter first, an id left out now and then, one id told twice; every seventh batch failed."""
    b = _batched(spark, sf)
    n = F.col("position")
    text = F.concat(F.lit("CUSTOMER_ID: "), "customer_id", F.lit("\nNARRATIVE: First line for "), "customer_id", F.lit(".\n  Second line.  \n\n"))
    twice = F.concat(F.lit("  CUSTOMER_ID:"), "customer_id", F.lit("\nNARRATIVE:\nTold again.\n"))
    own = F.when(n % 11 == 0, F.lit("")).when(n % 13 == 0, F.concat(text, twice)).otherwise(text)
    parts = b.select("batch_id", F.struct("position", own.alias("t")).alias("p")).groupBy("batch_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    body = F.concat(F.lit("Here you are:\n"), F.array_join(F.transform("p", lambda p: p["t"]), ""))
    return parts.select("batch_id", F.when(F.col("batch_id") % 7 != 6, body).alias("response"))


def llm_3(spark, sf):
    return P.parse_narratives(_responses(spark, sf))


NARRATIVE_CTE = BATCH_CTE + """,
narratives AS (
  SELECT batch_id, customer_id, CASE WHEN position % 13 = 0 THEN 'Told again.' ELSE 'First line for ' || customer_id || '. Second line.' END AS narrative
  FROM batched WHERE batch_id % 7 <> 6 AND position % 11 <> 0)"""
LLM_3 = X.VECTORS_SQL + NARRATIVE_CTE + " SELECT * FROM narratives"


def llm_4(spark, sf):
    batched = stage(_batched(spark, sf))
    return P.attach_narratives(batched, P.parse_narratives(_responses(spark, sf))).select("customer_id", "batch_id", "narrative", "success")


LLM_4 = X.VECTORS_SQL + NARRATIVE_CTE + """
SELECT customer_id, b.batch_id, coalesce(narrative, 'N/A') AS narrative, narrative IS NOT NULL AS success
FROM batched b LEFT JOIN narratives USING (customer_id)"""


def llm_5(spark, sf):
    """A local stand-in for the model that fails on the batch of customer 60."""

    def fake(prompt):
        if "--- Customer: 60 ---" in prompt:
            raise RuntimeError("no answer")
        return f"prompt of {len(prompt)} characters"

    return P.ask(P.narrative_prompts(_batched(spark, sf), DEFINITIONS), fake)


LLM_5 = X.VECTORS_SQL + PROMPT_CTE + """
SELECT batch_id, CASE WHEN prompt NOT LIKE '%--- Customer: 60 ---%' THEN 'prompt of ' || length(prompt) || ' characters' END AS response FROM prompts"""

# --- mapping drafts --------------------------------------------------------------------------------------------


def llm_6(spark, sf):
    return P.mapping_prompts(IO.sample_rows(X.clients_raw(spark, sf), 5))


_FIELD_LINES = "\n".join(f"  - {c.field} ({c.dtype}): {c.description}" for c in CONTRACT)
# Fixed value: the wording of the mapping prompt after the sample rows.
_ASK = """

Your task: Map each client column to the most appropriate standard field from this list:

Standard fields:
""" + _FIELD_LINES + """

For each mapping, provide:
1. The source column name (from the client)
2. The target field name (from the standard list)
3. A confidence level: "high", "medium", or "low"
4. A brief reasoning why you think this mapping is correct

Output your response as a JSON array of objects with keys: "source_column", "target_field", "confidence", "reasoning"

If a client column doesn't map to any standard field, include it with target_field: null.

Only map columns where you have reasonable confidence. It's better to leave a column unmapped than to guess wrong."""
_SAMPLES = Q.SAMPLES_SQL + ", samples AS (" + Q.SRC_2[len(Q.SAMPLES_SQL) :] + ")"
LLM_6 = _SAMPLES + f""",
cells AS (
  SELECT client_id, row_no, pos, "column", "column" || '=' || CASE WHEN value IS NULL THEN 'nan' WHEN ({X.num('value')}) IS NOT NULL THEN trim(value) ELSE '''' || value || '''' END AS cell
  FROM samples),
rows_text AS (
  SELECT client_id, row_no, '  Row ' || row_no || ': ' || string_agg(cell, ', ' ORDER BY pos) || chr(10) AS line FROM cells WHERE row_no <= 3 AND pos < 8 GROUP BY client_id, row_no),
names AS (SELECT client_id, string_agg('''' || "column" || '''', ', ' ORDER BY pos) AS names FROM cells WHERE row_no = 1 GROUP BY client_id),
lines AS (SELECT client_id, string_agg(line, '' ORDER BY row_no) AS lines FROM rows_text GROUP BY client_id)
SELECT client_id, {_quoted('You are a data mapping expert. A client has uploaded a CSV with the following columns:' + chr(10) * 2 + 'Client columns: [')}
       || names
       || {_quoted(']' + chr(10) * 2 + 'Sample data:' + chr(10))} || lines || {_quoted(_ASK)} AS prompt
FROM names JOIN lines USING (client_id)"""


def _answers(spark, sf):
    """A response per supplier, in one of six forms: plain, fenced, tagged fence, no source, text, an object."""
    s = X.table(spark, sf, "supplier").select(F.concat(F.lit("client_"), F.col("s_suppkey").cast("string")).alias("client_id"), F.col("s_suppkey").alias("k"))
    one = '{"source_column": "Fee", "target_field": "monthly_charges", "confidence": "high", "reasoning": "name"}'
    two = '{"source_column": "Id", "target_field": "customer_id"}, {"source_column": "Note", "target_field": null, "confidence": "low"}'
    again = '{"source_column": "Fee", "target_field": "total_charges", "confidence": "low", "reasoning": "second thought"}'
    plain = f"[{one}, {two}, {again}]"
    form = F.col("k") % 6
    text = (
        F.when(form == 0, plain)
        .when(form == 1, f"Sure.\n```\n[{one}, {two}]\n```\nDone.")
        .when(form == 2, f"Sure.\n```json\n[{one}]\n```\nDone.")
        .when(form == 3, f'[{one}, {{"target_field": "gender"}}]')
        .when(form == 4, "no brackets in this answer")
        .otherwise(one)
    )
    return s.select("client_id", text.alias("response"))


def llm_7(spark, sf):
    return P.mapping_answers(_answers(spark, sf))


ANSWER_SQL = """WITH answers AS (
  SELECT 'client_' || s_suppkey AS client_id, CAST(pos AS INTEGER) AS pos, source_column, target_field, confidence, reasoning
  FROM supplier JOIN (VALUES (0, 0, 'Fee', 'monthly_charges', 'high', 'name'), (0, 1, 'Id', 'customer_id', 'medium', ''),
    (0, 3, 'Fee', 'total_charges', 'low', 'second thought'), (1, 0, 'Fee', 'monthly_charges', 'high', 'name'), (1, 1, 'Id', 'customer_id', 'medium', ''),
    (2, 0, 'Fee', 'monthly_charges', 'high', 'name')) t(form, pos, source_column, target_field, confidence, reasoning) ON form = s_suppkey % 6)"""
LLM_7 = ANSWER_SQL + " SELECT * FROM answers"


def llm_8(spark, sf):
    return P.draft_rows(P.mapping_answers(_answers(spark, sf)))


LLM_8 = ANSWER_SQL + """
SELECT client_id, 'column' AS kind, target_field AS field, source_column AS from_value, target_field AS to_value, confidence, reasoning, 'draft' AS status
FROM (SELECT *, row_number() OVER (PARTITION BY client_id, source_column ORDER BY pos DESC) AS rn FROM answers) WHERE rn = 1"""


def llm_9(spark, sf):
    """Config and draft paths of every supplier; only some have been approved, so that their config exists."""
    from tenura.sources.paths import client_paths

    paths = client_paths(Q._supplier_paths(spark, sf), "lake").filter(F.col("kind").isin("config", "draft_config"))
    number = F.regexp_extract("client_id", r"(\d+)$", 1).cast("bigint")
    existing = paths.filter((F.col("kind") == "draft_config") | (number % 3 == 0))
    return P.approved_configs(paths, existing).select("client_id", "path")


LLM_9 = Q.PATHS_SQL + " SELECT client_id, path FROM paths WHERE kind = 'config' AND CAST(substr(client_id, 8) AS BIGINT) % 3 = 0"


def llm_10(spark, sf):
    seen = X.clients_raw(spark, sf).select("client_id", F.explode(F.map_keys("raw")).alias("column")).distinct()
    return P.unmapped_columns(seen, X.catalog(spark).filter("status = 'approved'"))


LLM_10 = X.RAW_SQL + " SELECT DISTINCT 'bank' AS client_id, 'Surname' AS \"column\" FROM churn_raw"

_PREFIXES = ("drf_", "llm_")
QUERIES = {n: f for n, f in list(globals().items()) if n.startswith(_PREFIXES) and callable(f)}
SQL = {n.lower(): s for n, s in list(globals().items()) if n.lower().startswith((*_PREFIXES, "snk_")) and n.isupper() and isinstance(s, str)}
