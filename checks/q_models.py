"""FEA, TRN, EVL and SCR queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as X
from tenura.operators import contributions as CO
from tenura.operators import evaluation as E
from tenura.operators import features as FE
from tenura.operators import group_features as GF
from tenura.operators import registry as R
from tenura.operators import scoring as S
from tenura.operators import splitting as SP
from tenura.operators import training as T
from tenura.session import new_folder, small_table, stage
from tenura.sources import client_tables as CT

# --- features --------------------------------------------------------------------------------------------------

NUMERIC = ["tenure_months", "monthly_charges", "total_charges", "support_tickets"]
CATEGORY = ["contract_type", "payment_method", "gender", "partner_status"]


def fea_1(spark, sf):
    """The feature columns found, in order, with the values each one has."""
    clean = X.cleaned(spark, sf)
    numeric, category, given = FE.feature_columns(clean)
    names = numeric + category + given
    counts = clean.agg(*[F.count(c).alias(c) for c in names])
    pairs = [F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"), F.col(c).alias("n_filled")) for i, c in enumerate(names)]
    return counts.select(F.inline(F.array(*pairs)))


FEA_1 = X.CLEANED_SQL + " " + " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS feature, count({c}) AS n_filled FROM cleaned" for i, c in enumerate(NUMERIC + CATEGORY)
)


def fea_2(spark, sf):
    """Exact medians of the numeric features per column, as learned."""
    summary = FE.numeric_summary(stage(X.cleaned(spark, sf).select(*NUMERIC)), NUMERIC)
    rows = [(c, s["n"], s["min"], s["max"], s["median"]) for c, s in summary.items()]
    learned = small_table(spark, rows, "feature string, n bigint, least double, most double, median double")
    return learned.withColumn("median", F.round("median", 6))


FEA_2 = X.CLEANED_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, min({c}) AS least, max({c}) AS most, round(median({c}), 6) AS median FROM cleaned" for c in NUMERIC
)


def fea_3(spark, sf):
    return FE.category_fills(FE.category_counts(X.cleaned(spark, sf)))


FILLS_CTE = """,
cat_values AS (
  """ + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM cleaned WHERE {c} IS NOT NULL GROUP BY {c}" for c in CATEGORY) + """),
cat_fills AS (
  SELECT feature, value AS impute_cat FROM (
    SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM cat_values) WHERE rn = 1),
num_fills AS (SELECT """ + ", ".join(f"median({c}) AS {c}" for c in NUMERIC) + """ FROM cleaned),
filled AS (
  SELECT src_row, customer_id, churn_label, """ + ", ".join(f"coalesce(c.{c}, f.{c}) AS {c}" for c in NUMERIC) + ", " + ", ".join(
    f"coalesce(c.{c}, (SELECT impute_cat FROM cat_fills WHERE feature = '{c}')) AS {c}" for c in CATEGORY
) + """ FROM cleaned c CROSS JOIN num_fills f),
codes AS (
  SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM cat_values),
encoded AS (
  SELECT src_row, customer_id, churn_label, """ + ", ".join(NUMERIC) + ", " + ", ".join(
    f"CAST((SELECT code FROM codes WHERE feature = '{c}' AND value = filled.{c}) AS DOUBLE) AS {c}" for c in CATEGORY
) + """, monthly_charges * tenure_months AS interaction_charges_x_tenure FROM filled)"""
FEA_3 = X.CLEANED_SQL + FILLS_CTE + " SELECT * FROM cat_fills"


def fea_4(spark, sf):
    clean = stage(X.cleaned(spark, sf))
    out = FE.fill_values(clean, FE.fit_features(clean))
    return out.select("customer_id", *[F.round(c, 6).alias(c) for c in NUMERIC], *CATEGORY)


_ROUND_NUM = ", ".join(f"round({c}, 6) AS {c}" for c in NUMERIC)
FEA_4 = X.CLEANED_SQL + FILLS_CTE + f" SELECT customer_id, {_ROUND_NUM}, {', '.join(CATEGORY)} FROM filled"


def fea_5(spark, sf):
    counts = stage(FE.category_counts(X.cleaned(spark, sf)))
    """By ranges over many tasks, as long lists are ordered."""
    return FE.category_codes(counts, FE.category_fills(counts), few=0).select("feature", "value", "code")


FEA_5 = X.CLEANED_SQL + FILLS_CTE + " SELECT feature, value, code FROM codes"


def fea_6(spark, sf):
    """Codes of the raw spellings under the state learned on the cleaned table: unseen spellings get code 0."""
    clean = stage(X.cleaned(spark, sf))
    state = FE.fit_features(clean)
    raw = X.deduped(spark, sf).withColumn("age_bucket", F.lit("18-25"))
    filled = FE.fill_values(raw, state)
    return FE.encode_categories(filled, state).select("customer_id", *CATEGORY, "age_bucket")


FEA_6 = X.CLEANED_SQL + FILLS_CTE + " SELECT customer_id, " + ", ".join(
    f"CAST(coalesce((SELECT code FROM codes WHERE feature = '{c}' AND value = coalesce(d.{c}, (SELECT impute_cat FROM cat_fills WHERE feature = '{c}'))), 0) AS DOUBLE) AS {c}"
    for c in CATEGORY
) + ", CAST(0 AS DOUBLE) AS age_bucket FROM deduped d"


def fea_7(spark, sf):
    clean = stage(X.cleaned(spark, sf))
    fills = {r["feature"]: r["impute_num"] for r in FE.fit_features(clean).rows}
    value = FE.interaction(fills["monthly_charges"], fills["tenure_months"])
    return clean.select("customer_id", F.round(value, 4).alias(FE.INTERACTION))


FEA_7 = X.CLEANED_SQL + FILLS_CTE + " SELECT customer_id, round(interaction_charges_x_tenure, 4) AS interaction_charges_x_tenure FROM encoded"

_SCALED = NUMERIC + CATEGORY + [FE.INTERACTION]


def _scaled_sql(columns, source="encoded", places=9):
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _SCALED)
    cells = ", ".join(
        f"round(least(greatest((e.{c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END, 0), 1), {places}) AS {c}" for c in columns
    )
    return f", ends AS (SELECT {ends} FROM encoded) SELECT customer_id, {cells} FROM {source} e CROSS JOIN ends"


def _features(spark, sf):
    clean = stage(X.cleaned(spark, sf))
    return FE.apply_features(clean, FE.fit_features(clean))


def fea_8(spark, sf):
    """A batch that lacks two columns: they are 0 before scaling."""
    clean = stage(X.cleaned(spark, sf))
    state = FE.fit_features(clean)
    out = FE.apply_features(clean.drop("support_tickets", "gender"), state)
    return out.select("customer_id", *[F.round(c, 9).alias(c) for c in state.names])


_LACKING = ", zeroed AS (SELECT * REPLACE (0.0::DOUBLE AS support_tickets, 0.0::DOUBLE AS gender) FROM encoded)"
FEA_8 = X.CLEANED_SQL + FILLS_CTE + _LACKING + _scaled_sql(_SCALED, "zeroed")


def fea_9(spark, sf):
    return _features(spark, sf).select("customer_id", *[F.round(c, 9).alias(c) for c in NUMERIC])


FEA_9 = X.CLEANED_SQL + FILLS_CTE + _scaled_sql(NUMERIC)


def fea_10(spark, sf):
    state = FE.fit_features(X.cleaned(spark, sf))
    return state.stats.select("feature", "kind", F.round("impute_num", 6).alias("impute_num"), "impute_cat", "n_classes", F.round("min", 4).alias("min"), F.round("max", 4).alias("max"))


FEA_10 = X.CLEANED_SQL + FILLS_CTE + " " + " UNION ALL ".join(
    [
        f"SELECT '{c}' AS feature, 'numeric' AS kind, (SELECT round({c}, 6) FROM num_fills) AS impute_num, CAST(NULL AS VARCHAR) AS impute_cat, "
        f"CAST(NULL AS BIGINT) AS n_classes, round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM encoded"
        for c in NUMERIC
    ]
    + [
        f"SELECT '{c}', 'category', NULL, (SELECT impute_cat FROM cat_fills WHERE feature = '{c}'), "
        f"(SELECT count(*) FROM codes WHERE feature = '{c}'), min({c}), max({c}) FROM encoded"
        for c in CATEGORY
    ]
    + ["SELECT 'interaction_charges_x_tenure', 'interaction', NULL, NULL, NULL, round(min(interaction_charges_x_tenure), 4), round(max(interaction_charges_x_tenure), 4) FROM encoded"]
)
SNK_2 = FEA_10


CLIENTS = ["north", "south", "west"]


def _clients(df):
    """The customers of the table dealt to three clients."""
    return df.withColumn("client_id", F.element_at(F.array(*[F.lit(c) for c in CLIENTS]), (F.col("customer_id").cast("bigint") % 3 + 1).cast("int")))


def for_clients(base, name, rest):
    """SQL that is ``rest`` for each client by itself; ``name`` is the table of ``base`` that it reads."""
    own = "SELECT '{}' AS client_id, * FROM (WITH {} AS (SELECT * FROM everyone WHERE CAST(customer_id AS BIGINT) % 3 = {}){})"
    return base + f", everyone AS (SELECT * FROM {name}) " + " UNION ALL ".join(own.format(c, name, i, rest) for i, c in enumerate(CLIENTS))


def fea_10_clients(spark, sf):
    """Three clients in one job; value lists by ranges over many tasks."""
    state = GF.fit_features_by(_clients(X.cleaned(spark, sf)), few=0)
    return state.stats.select("client_id", "feature", "kind", F.round("impute_num", 6).alias("impute_num"), "impute_cat", "n_classes", F.round("min", 4).alias("min"), F.round("max", 4).alias("max"))


FEA_10_CLIENTS = for_clients(X.CLEANED_SQL, "cleaned", FEA_10[len(X.CLEANED_SQL) :])


def fea_11(spark, sf):
    return _features(spark, sf).select("customer_id", *[F.round(c, 9).alias(c) for c in _SCALED])


FEA_11 = X.CLEANED_SQL + FILLS_CTE + _scaled_sql(_SCALED)


def fea_12(spark, sf):
    return FE.class_balance(X.cleaned(spark, sf))


FEA_12 = X.CLEANED_SQL + f"""
SELECT count(churn_label) AS n, CAST(sum(churn_label) AS BIGINT) AS churned, CAST(count(churn_label) - sum(churn_label) AS BIGINT) AS stayed,
       {X.rounded('(CAST(sum(churn_label) AS DOUBLE) / count(churn_label))', 4)} AS churn_rate FROM cleaned"""

# --- split, weight, training -----------------------------------------------------------------------------------


def trn_1(spark, sf):
    return SP.stratified_split(X.cleaned(spark, sf).select("customer_id", "churn_label"))


TRN_1 = X.CLEANED_SQL + """,
ranked AS (
  SELECT customer_id, churn_label, row_number() OVER (PARTITION BY churn_label ORDER BY md5('42|' || customer_id)) AS r,
         count(*) OVER (PARTITION BY churn_label) AS n FROM cleaned)
SELECT customer_id, churn_label, CASE WHEN r <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
  WHEN r <= floor(n * 0.15::DOUBLE + 0.5) + floor(n * 0.15::DOUBLE + 0.5) THEN 'validation' ELSE 'train' END AS split FROM ranked"""


def trn_2(spark, sf):
    """Weight per payment method."""
    out = SP.positive_weight(X.cleaned(spark, sf), group=["payment_method"])
    return out.withColumn("weight", F.round("weight", 9))


TRN_2 = X.CLEANED_SQL + """
SELECT payment_method, count(churn_label) AS n, CAST(sum(churn_label) AS BIGINT) AS positives,
       round(CASE WHEN sum(churn_label) = 0 THEN NULL WHEN sum(churn_label) / count(churn_label) < 0.30 THEN CAST(count(churn_label) - sum(churn_label) AS DOUBLE) / sum(churn_label) ELSE 1 END, 9) AS weight
FROM cleaned GROUP BY payment_method"""


def training_table(spark, sf):
    """Features, label, split and weight of the cleaned table, staged once."""
    clean = stage(X.cleaned(spark, sf))
    state = FE.fit_features(clean)
    table = FE.apply_features(clean, state, vector="features")
    table = SP.stratified_split(table)
    weight = SP.positive_weight(clean).first()["weight"]
    return stage(SP.with_weights(table, weight)), state.names


SETTINGS = {"max_depth": 4}


def trn_3(spark, sf):
    """All rounds allowed, patience as ever. A row a test customer: score in range, trees within the limit, area within its own."""
    table, _ = training_table(spark, sf)
    model = T.fit_trees(table, SETTINGS)
    scored = stage(S.predict(model, table.filter("split = 'test'"), "p"))
    area = E.auc(scored.withColumnRenamed("churn_label", "y")).first()["auc"]
    return scored.select(
        "customer_id", F.col("p").between(0.0, 1.0).alias("score_in_range"),
        F.lit(1 <= model.getNumTrees <= T.MAX_ROUNDS).alias("trees_in_range"), F.lit(area is None or 0.0 <= area <= 1.0).alias("area_in_range"),
    )


TRN_3 = TRN_1.replace("SELECT customer_id, churn_label, CASE WHEN r", ", parted AS (SELECT customer_id, CASE WHEN r") + """)
SELECT customer_id, true AS score_in_range, true AS trees_in_range, true AS area_in_range FROM parted WHERE split = 'test'"""
TRIALS = 3


def trn_4(spark, sf):
    """All rounds allowed. One row a drawn setting: settings within their ranges, trees within the limit, areas falling from the first row on."""
    table, _ = training_table(spark, sf)
    done = T.tune_trees(table, T.draw_settings(TRIALS)).collect()
    rows = []
    for place, r in enumerate(done):
        inside = all(lo <= r[k] <= hi for k, (_, lo, hi) in T.SETTING_RANGES.items())
        falling = place == 0 or (r["auc"] or 0.0) <= (done[place - 1]["auc"] or 0.0)
        rows.append((place, inside, 1 <= r["trees"] <= T.MAX_ROUNDS, falling))
    return small_table(spark, rows, "place bigint, settings_in_range boolean, trees_in_range boolean, areas_fall boolean")


TRN_4 = f"SELECT CAST(unnest(range({TRIALS})) AS BIGINT) AS place, true AS settings_in_range, true AS trees_in_range, true AS areas_fall"

# --- evaluation ------------------------------------------------------------------------------------------------

GROUP = ["client_id", "model_id"]
AUC_CTE = """,
by_score AS (SELECT client_id, model_id, p, CAST(sum(y) AS HUGEINT) AS pos, CAST(sum(1 - y) AS HUGEINT) AS neg FROM scored GROUP BY ALL),
running AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY client_id, model_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score),
areas AS (
  SELECT client_id, model_id, CASE WHEN sum(pos) * sum(neg) > 0 THEN CAST(sum(pos * (below * 2 + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) END AS auc
  FROM running GROUP BY ALL),
confusion AS (
  SELECT client_id, model_id, count(*) AS rows, count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp,
         count(*) FILTER (p < 0.5 AND y = 1) AS fn, count(*) FILTER (p < 0.5 AND y = 0) AS tn FROM scored GROUP BY ALL),
metrics AS (
  SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
         coalesce(2 * CAST(tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM confusion),
evaluated AS (
  SELECT client_id, model_id, """ + X.rounded("auc", 4) + """ AS auc_roc, """ + X.rounded("f1", 4) + " AS f1_score, " + X.rounded("precision", 4) + """ AS precision,
         """ + X.rounded("recall", 4) + """ AS recall, coalesce(auc >= 0.7, false) AS passed, 0.7::DOUBLE AS threshold, rows FROM metrics JOIN areas USING (client_id, model_id))"""


def evl_1(spark, sf):
    """By ranges over many tasks, as large tables are ranked."""
    return E.auc(X.scored_labels(spark, sf), group=GROUP, small=0).withColumn("auc", F.round("auc", 9))


EVL_1 = X.SCORED_SQL + AUC_CTE + " SELECT client_id, model_id, round(auc, 9) AS auc FROM areas"


def evl_2(spark, sf):
    out = E.threshold_metrics(X.scored_labels(spark, sf), group=GROUP)
    return out.select(*GROUP, "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


EVL_2 = X.SCORED_SQL + AUC_CTE + " SELECT client_id, model_id, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM metrics"


def evl_3(spark, sf):
    """One model over all rows."""
    return E.evaluate(X.scored_labels(spark, sf))


_WHOLE = X.SCORED_SQL.replace("source AS client_id, lang AS model_id", "'all' AS client_id, 'm' AS model_id")
EVL_3 = _WHOLE + AUC_CTE + " SELECT auc_roc, f1_score, precision, recall, passed, threshold FROM evaluated"


def evl_4(spark, sf):
    return E.evaluate(X.scored_labels(spark, sf), group=GROUP)


EVL_4 = X.SCORED_SQL + AUC_CTE + " SELECT client_id, model_id, auc_roc, f1_score, precision, recall, passed, threshold FROM evaluated"


def evl_5(spark, sf):
    scored = X.scored_labels(spark, sf)
    sizes = scored.groupBy(*GROUP).agg(F.count("*").alias("dataset_rows"))
    evaluated = E.evaluate(scored, group=GROUP).join(sizes, GROUP)
    at = F.lit("2024-02-01 10:30:00").cast("timestamp")
    cards = E.model_cards(evaluated, X.FEATURE_NAMES, {"max_depth": 6, "eta": 0.1}, at=at)
    return cards.select(
        "model_id", "training_date", "client_id", "dataset_rows", "feature_count", F.concat_ws(",", "features_used").alias("features_used"),
        "metrics.*", F.col("hyperparameters")["eta"].alias("eta"), "evaluation_gate.*", "data_contract_version",
    )


EVL_5 = X.SCORED_SQL + AUC_CTE + f"""
SELECT model_id, '2024-02-01T10:30:00' AS training_date, client_id, rows AS dataset_rows, CAST(10 AS BIGINT) AS feature_count,
       '{','.join(X.FEATURE_NAMES)}' AS features_used, auc_roc, f1_score, precision, recall, '0.1' AS eta, passed, threshold,
       {X.rounded('(auc_roc - threshold)', 4)} AS margin, '1.0' AS data_contract_version FROM evaluated"""

# --- scoring ---------------------------------------------------------------------------------------------------


LINEAR = {"tenure_months": -2.0, "monthly_charges": 1.5, "support_tickets": 0.75, "contract_type": -0.5, "interaction_charges_x_tenure": 0.25}
INTERCEPT = 0.125


def scr_1(spark, sf):
    """A linear model of given weights over the scaled features."""
    table, names = training_table(spark, sf)
    model = T.linear_model(names, LINEAR, INTERCEPT)
    return S.predict(model, table).select("customer_id", F.round("churn_probability", 6).alias("churn_probability"))


_MARGIN = " + ".join(f"({w}::DOUBLE) * {c}" for c, w in LINEAR.items())
SCR_1 = X.CLEANED_SQL + FILLS_CTE + _scaled_sql(list(LINEAR), places=18)
SCR_1 = SCR_1.replace(" SELECT customer_id, round(", ", features AS (SELECT customer_id, round(") + f""")
SELECT customer_id, round(1 / (1 + exp(-({INTERCEPT}::DOUBLE + {_MARGIN}))), 6) AS churn_probability FROM features"""

# A tree written out: tenure up to 0.5 ends in 0.8; above it charges up to 0.3 end in -0.5, higher ones in 0.3.
_INF = float("inf")
TREE = [
    CO.Leaf(0.8, (0,), (-_INF,), (0.5,), (0.6,)),
    CO.Leaf(-0.5, (0, 1), (0.5, -_INF), (_INF, 0.3), (0.4, 0.25)),
    CO.Leaf(0.3, (0, 1), (0.5, 0.3), (_INF, _INF), (0.4, 0.75)),
]


def scr_2(spark, sf):
    """Contributions of a small given tree by value; those of trained models add up, with the bias, to each row's log-odds."""
    table, names = training_table(spark, sf)
    model = T.fit_trees(table, SETTINGS)
    leaves = CO.tree_leaves(model)
    margin = F.lit(2.0) * vector_to_array("rawPrediction")[1]
    rows = model.transform(table).select("customer_id", *names, margin.alias("margin"))
    trees = CO.tree_contributions(rows, leaves, names)
    total = F.aggregate("contributions", F.lit(CO.expected_margin(leaves)), lambda a, x: a + x)
    trees = CO.tree_contributions(trees, TREE, ["tenure_months", "monthly_charges"], "given")
    tree_ok = trees.select(
        "customer_id", (F.abs(total - F.col("margin")) < 1e-9).alias("trees_add_up"),
        F.round(F.col("given")[0], 9).alias("by_tenure"), F.round(F.col("given")[1], 9).alias("by_charges"),
    )
    linear = T.fit_linear(table)
    means = CO.feature_means(table, names)
    weights = [float(w) for w in linear.coefficients]
    base = linear.intercept + sum(w * m for w, m in zip(weights, means))
    parts = CO.linear_contributions(names, weights, means)
    margin = vector_to_array("rawPrediction")[1]
    added = F.aggregate(parts, F.lit(float(base)), lambda a, x: a + x)
    linear_ok = linear.transform(table).select("customer_id", (F.abs(added - margin) < 1e-9).alias("linear_adds_up"))
    return tree_ok.join(linear_ok, "customer_id")


SCR_2 = X.CLEANED_SQL + FILLS_CTE + _scaled_sql(["tenure_months", "monthly_charges"], places=18).replace(" SELECT customer_id, round(", ", features AS (SELECT customer_id, round(") + """),
signs AS (SELECT customer_id, CASE WHEN tenure_months <= 0.5 THEN 1.0::DOUBLE ELSE 0 END AS t, CASE WHEN monthly_charges <= 0.3 THEN 1.0::DOUBLE ELSE 0 END AS m FROM features)
SELECT customer_id, true AS trees_add_up, true AS linear_adds_up,
       round(0.8::DOUBLE * (t - 0.6::DOUBLE) - 0.5::DOUBLE * (0.6::DOUBLE - t) * (0.25::DOUBLE + m) / 2 + 0.3::DOUBLE * (0.6::DOUBLE - t) * (1.75::DOUBLE - m) / 2, 9) AS by_tenure,
       round(-0.5::DOUBLE * (m - 0.25::DOUBLE) * (1.4::DOUBLE - t) / 2 + 0.3::DOUBLE * (0.25::DOUBLE - m) * (1.4::DOUBLE - t) / 2, 9) AS by_charges FROM signs"""


def scr_3(spark, sf):
    return X.scored_vectors(spark, sf).select("customer_id", S.risk_tier(F.col("churn_probability")).alias("risk_tier"))


SCR_3 = X.VECTORS_SQL + f" SELECT customer_id, {X.TIER_SQL} AS risk_tier FROM vectors"


def scr_4(spark, sf):
    return X.scored_vectors(spark, sf).select("customer_id", F.posexplode(S.top_reasons(F.col("contributions"), X.VECTOR_NAMES)).alias("place", "reason"))


_NAMES = ", ".join(f"'{n}'" for n in X.VECTOR_NAMES)
REASONS_CTE = f""",
parts AS (SELECT customer_id, unnest(contributions) AS x, unnest(range(64)) AS i, unnest([{_NAMES}]) AS name FROM vectors),
placed AS (SELECT customer_id, name, x, row_number() OVER (PARTITION BY customer_id ORDER BY abs(x) DESC, i DESC) AS place FROM parts),
reasons AS (SELECT customer_id, place, name, x, name || ' (' || {X.signed('x')} || ')' AS reason FROM placed WHERE place <= 3)"""
SCR_4 = X.VECTORS_SQL + REASONS_CTE + " SELECT customer_id, CAST(place - 1 AS INTEGER) AS place, reason FROM reasons"


def scr_5(spark, sf):
    scored = X.scored_vectors(spark, sf)
    told = scored.withColumn("narrative", F.when(F.col("churn_probability") >= 0.7, F.concat(F.lit("call "), "customer_id")))
    return S.deliverable(told, X.VECTOR_NAMES)


DELIVERABLE_CTE = REASONS_CTE + f""",
deliverable AS (
  SELECT customer_id, {X.rounded('churn_probability', 4)} AS churn_probability, {X.TIER_SQL} AS risk_tier,
         (SELECT string_agg(reason, '; ' ORDER BY place) FROM reasons r WHERE r.customer_id = v.customer_id) AS top_3_reasons,
         CASE WHEN churn_probability >= 0.7 THEN 'call ' || customer_id ELSE 'N/A' END AS narrative_explanation FROM vectors v)"""
SCR_5 = X.VECTORS_SQL + DELIVERABLE_CTE + " SELECT * FROM deliverable"
SNK_3 = X.VECTORS_SQL + DELIVERABLE_CTE + " SELECT * REPLACE ('N/A' AS narrative_explanation) FROM deliverable"


FACTORS = {"north": 1.0, "south": 2.0, "west": -1.0}


def scr_5_clients(spark, sf):
    """Three clients with a model each in one job, from features to deliverable; every client is dealt into several groups."""
    clean = stage(_clients(X.cleaned(spark, sf)))
    table = GF.apply_features_by(clean, GF.fit_features_by(clean))
    names = ["tenure_months", "monthly_charges"]
    models = {c: (f"{c}-1", [leaf._replace(value=leaf.value * k) for leaf in TREE], names) for c, k in FACTORS.items()}
    path = new_folder(spark, "registry")
    CT.write_table(R.registry_of(spark, models), path)
    registry = spark.read.schema(R.REGISTRY_SCHEMA).parquet(path)
    scored = R.score_by_client(table, registry, names, group_rows=100)
    return S.deliverable(scored, names, keep=["client_id", "model_id"])


_SIGNS = SCR_2[len(X.CLEANED_SQL) : SCR_2.rindex("SELECT customer_id, true")]
_BY = SCR_2[SCR_2.rindex("linear_adds_up,") + 15 : SCR_2.rindex(" FROM signs")]
_FACTOR = "CASE client_id " + " ".join(f"WHEN '{c}' THEN {k}::DOUBLE" for c, k in FACTORS.items()) + " END"
SCR_5_CLIENTS = f"""
WITH one AS ({for_clients(X.CLEANED_SQL, "cleaned", _SIGNS + "SELECT customer_id, t, m," + _BY + " FROM signs")}),
scaled AS (SELECT client_id, customer_id, k * by_tenure AS bt, k * by_charges AS bc, 1 / (1 + exp(-k * CASE WHEN t = 1 THEN 0.8::DOUBLE WHEN m = 1 THEN -0.5::DOUBLE ELSE 0.3::DOUBLE END)) AS churn_probability
           FROM (SELECT *, {_FACTOR} AS k FROM one))
SELECT client_id, client_id || '-1' AS model_id, customer_id, {X.rounded('churn_probability', 4)} AS churn_probability, {X.TIER_SQL} AS risk_tier,
       CASE WHEN abs(bt) > abs(bc) THEN 'tenure_months (' || {X.signed('bt')} || '); monthly_charges (' || {X.signed('bc')} || ')'
            ELSE 'monthly_charges (' || {X.signed('bc')} || '); tenure_months (' || {X.signed('bt')} || ')' END AS top_3_reasons, 'N/A' AS narrative_explanation FROM scaled"""


def scr_6(spark, sf):
    return S.tier_counts(S.deliverable(X.scored_vectors(spark, sf), X.VECTOR_NAMES))


SCR_6 = X.VECTORS_SQL + f" SELECT {X.TIER_SQL} AS risk_tier, count(*) AS n FROM vectors GROUP BY 1"


def scr_7(spark, sf):
    return S.highest_risk(S.deliverable(X.scored_vectors(spark, sf), X.VECTOR_NAMES), 5)


SCR_7 = X.VECTORS_SQL + DELIVERABLE_CTE + " SELECT * REPLACE ('N/A' AS narrative_explanation) FROM deliverable ORDER BY churn_probability DESC, customer_id LIMIT 5"

_PREFIXES = ("fea_", "trn_", "evl_", "scr_")
QUERIES = {n: f for n, f in list(globals().items()) if n.startswith(_PREFIXES) and callable(f)}
SQL = {n.lower(): s for n, s in list(globals().items()) if n.lower().startswith((*_PREFIXES, "snk_")) and n.isupper() and isinstance(s, str)}
