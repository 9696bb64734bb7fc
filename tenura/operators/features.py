"""Learn feature statistics from a cleaned table, and apply stored ones.

What is learned stays in two tables: ``stats``, one row per feature, and ``codes``, one row per category value.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.contract import CATEGORY_FEATURES, NUMERIC_FEATURES
from tenura.functions import values as V
from tenura.functions.order import global_rank, numeric_summary
from tenura.session import broadcast_if_small, small_table, stage

INTERACTION = "interaction_charges_x_tenure"
STATS_SCHEMA = (
    "feature string, pos int, kind string, impute_num double, impute_cat string, n_classes bigint, min double, max double"
)
CODES_SCHEMA = "feature string, value string, n bigint, code bigint"

# A feature's codes become a literal map up to this many values, beyond it a join with the codes table.
LITERAL_CLASSES = 100
# Up to this many distinct values in all, each feature's list is ordered in one task; beyond it by a range partition.
FEW_VALUES = 100_000


class FeatureState(NamedTuple):
    """``rows``: per feature its position, fill, class count, least and greatest. ``codes``: value to code, a table.

    ``maps`` holds the codes of the features whose value list is short.
    """

    rows: list[dict]
    maps: dict[str, dict[str, int]]
    codes: DataFrame

    @property
    def stats(self) -> DataFrame:
        return small_table(self.codes.sparkSession, [tuple(r.values()) for r in self.rows], STATS_SCHEMA)

    @property
    def names(self) -> list[str]:
        return [r["feature"] for r in self.rows]


def state_of(rows: list[dict], codes: DataFrame) -> FeatureState:
    """State with the short code lists, at most ``LITERAL_CLASSES`` values a feature, brought to the driver."""
    rows = sorted(rows, key=lambda r: r["pos"])
    short = [r["feature"] for r in rows if r["kind"] == "category" and 0 < (r["n_classes"] or 0) <= LITERAL_CLASSES]
    maps: dict[str, dict[str, int]] = {c: {} for c in short}
    if short:
        for r in codes.filter(F.col("feature").isin(short)).collect():
            maps[r["feature"]][r["value"]] = r["code"]
    return FeatureState(rows, maps, codes)


def feature_columns(df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """FEA-1: numeric, category and interaction columns that ``df`` has, in contract order."""
    numeric = [c for c in NUMERIC_FEATURES if c in df.columns]
    category = [c for c in CATEGORY_FEATURES if c in df.columns]
    types = {f.name: f.dataType for f in df.schema}
    given = [c for c in df.columns if c.startswith("interaction_") and c != INTERACTION]
    for c in given:
        if not V.is_numeric(types[c]):
            raise TypeError(f"{c} must be numeric to be a feature")
    return numeric, category, given


def _typed(df: DataFrame) -> DataFrame:
    """Feature columns in their working types: numbers as double without NaN, categories as canonical text."""
    numeric, category, given = feature_columns(df)
    return df.select(
        *[
            V.to_number(F.col(f.name), f.dataType).alias(f.name)
            if f.name in numeric or f.name in given
            else V.to_text(F.col(f.name), f.dataType).alias(f.name)
            if f.name in category
            else F.col(f.name)
            for f in df.schema
        ]
    )


def category_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per (feature, value), nulls included; the base of FEA-3 and FEA-5. Tasks count before the shuffle."""
    columns = columns if columns is not None else feature_columns(df)[1]
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).groupBy("feature", "value").agg(F.count("*").alias("n"))


def category_fills(counts: DataFrame) -> DataFrame:
    """FEA-3: most frequent value per feature, the smallest on ties, ``unknown`` when there is none."""
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))))
    return counts.groupBy("feature").agg(F.coalesce(best["value"], F.lit("unknown")).alias("impute_cat"))


def category_codes(counts: DataFrame, fills: DataFrame, few: int = FEW_VALUES) -> DataFrame:
    """FEA-5: code of each value = its place, from 0, among the sorted distinct values after filling.

    ``counts`` is read several times; stage it.
    """
    filled = counts.join(F.broadcast(fills), "feature")  # one row per category feature
    filled = filled.select("feature", F.coalesce("value", "impute_cat").alias("value"), "n")
    values = filled.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    if counts.limit(few + 1).count() <= few:
        ranked = values.withColumn("code", F.row_number().over(Window.partitionBy("feature").orderBy("value")).cast("bigint"))
    else:
        ranked = global_rank(values, ["value"], ["feature"], "code", small=few)
    return ranked.select("feature", "value", "n", (F.col("code") - 1).alias("code"))


def class_balance(df: DataFrame, label: str = "churn_label", group: list[str] | None = None) -> DataFrame:
    """FEA-12: rows, churned, stayed and churn rate."""
    churned = F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0))
    return df.groupBy(*(group or [])).agg(
        F.count(label).alias("n"),
        churned.alias("churned"),
        (F.count(label) - churned).alias("stayed"),
        V.round_to(F.try_divide(churned.cast("double"), F.count(label).cast("double")), 4).alias("churn_rate"),
    )


def fit_features(df: DataFrame) -> FeatureState:
    """FEA-10: learn fills, codes and ranges; what reaches the driver is a few numbers per feature.

    Medians come from ``numeric_summary``, category counts from one aggregate, and one last aggregate gives the range
    of the interaction after filling.
    """
    spark = df.sparkSession
    numeric, category, given = feature_columns(df)
    # The passes below read one pruned copy instead of repeating the plan behind ``df``.
    work = stage(_typed(df).select(*numeric, *category, *given), "features")
    summary = numeric_summary(work, numeric)
    fills = {c: 0.0 if s["median"] is None else float(s["median"]) for c, s in summary.items()}
    rows = []
    for c in numeric:
        s = summary[c]
        least, most = (0.0, 0.0) if s["n"] == 0 else (float(s["min"]), float(s["max"]))
        rows.append((c, "numeric", fills[c], None, None, least, most))
    codes = small_table(spark, [], CODES_SCHEMA)
    if category:
        counts = stage(category_counts(work, category), "categories")
        cat_fills = category_fills(counts)
        codes = stage(category_codes(counts, cat_fills), "codes")
        sizes = codes.groupBy("feature").agg(F.count("*").alias("n"))
        known = {r["feature"]: r for r in cat_fills.join(sizes, "feature", "left").collect()}
        for c in category:
            fill, k = (known[c]["impute_cat"], known[c]["n"] or 0) if c in known else ("unknown", 0)
            rows.append((c, "category", None, fill, k, 0.0, float(max(k - 1, 0))))
    extra = list(given)
    parts = {c: F.col(c) for c in given}
    if {"monthly_charges", "tenure_months"} <= set(numeric):
        extra.append(INTERACTION)
        parts[INTERACTION] = interaction(fills["monthly_charges"], fills["tenure_months"])
    if extra:
        aggs = [f(V.number_or(parts[c]) if c in given else parts[c]).alias(f"{n}_{c}") for c in extra for n, f in (("lo", F.min), ("hi", F.max))]
        ends = work.agg(*aggs).first()
        for c in extra:
            rows.append((c, "interaction", None, None, None, ends[f"lo_{c}"] or 0.0, ends[f"hi_{c}"] or 0.0))
    columns = ["feature", "pos", "kind", "impute_num", "impute_cat", "n_classes", "min", "max"]
    return state_of([dict(zip(columns, (feature, pos, *rest))) for pos, (feature, *rest) in enumerate(rows)], codes)


def interaction(fill_charges: float, fill_tenure: float) -> Column:
    """FEA-7: monthly charges times tenure, after filling."""
    return V.number_or(F.col("monthly_charges"), fill_charges) * V.number_or(F.col("tenure_months"), fill_tenure)


def scaled(x: Column, least: float, most: float) -> Column:
    """FEA-9: min-max to [0, 1]; a constant feature has range 1; outside values are clipped, NaN is 0."""
    span = (most - least) or 1.0
    return F.coalesce(V.clip((x - F.lit(least)) / F.lit(span), F.lit(0.0), F.lit(1.0)), F.lit(0.0))


def fill_values(df: DataFrame, state: FeatureState) -> DataFrame:
    """FEA-4: feature columns with nulls filled; numbers are parsed again first."""
    rows = {r["feature"]: r for r in state.rows}
    work = _typed(df)

    def cell(c: str) -> Column:
        r = rows.get(c)
        if r is None or r["kind"] == "interaction":
            return F.col(c)
        if r["kind"] == "numeric":
            return V.number_or(F.col(c), r["impute_num"]).alias(c)
        return F.coalesce(F.col(c), F.lit(r["impute_cat"])).alias(c)

    return work.select(*[cell(c) for c in work.columns])


def encode_categories(df: DataFrame, state: FeatureState) -> DataFrame:
    """FEA-6: filled category columns to codes; an unseen value gets code 0, so does a column not seen in training."""
    sizes = {r["feature"]: r["n_classes"] for r in state.rows if r["kind"] == "category"}
    category = [c for c in CATEGORY_FEATURES if c in df.columns]
    for c in category:
        if c in state.maps:
            code = F.element_at(V.literal_map(state.maps[c]), F.col(c))
            df = df.withColumn(c, F.coalesce(code, F.lit(0)).cast("double"))
        elif c in sizes:
            df = _joined_codes(df, c, state.codes)
        else:
            df = df.withColumn(c, F.lit(0.0))
    return df


def _joined_codes(df: DataFrame, c: str, codes: DataFrame) -> DataFrame:
    """Codes of a long value list. Values that fill more than a thousandth of the training rows are broadcast, at most
    a thousand; the rest are spread evenly and go through a shuffle join, unless the whole list is small."""
    own = codes.filter(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"), "n")
    total = own.agg(F.sum("n")).first()[0] or 0
    hot = own.filter(F.col("n") * 1000 > total).select(F.col("_value").alias("_hot"), F.col("_code").alias("_hot_code"))
    hinted = df.join(F.broadcast(hot), F.col(c) == F.col("_hot"), "left")
    cold_key = F.when(F.col("_hot").isNull(), F.col(c))
    cold = broadcast_if_small(own.select("_value", "_code"))
    # A hot row needs no match; its key is a per-row salt that no value can equal.
    salt = F.xxhash64(*[f.name for f in df.schema if f.dataType.typeName() != "map"])
    salted = hinted.withColumn("_key", F.coalesce(F.concat(F.lit("v"), cold_key), F.concat(F.lit("s"), salt.cast("string"))))
    matched = salted.join(cold.withColumn("_value", F.concat(F.lit("v"), F.col("_value"))), F.col("_key") == F.col("_value"), "left")
    return matched.withColumn(c, F.coalesce("_hot_code", "_code", F.lit(0)).cast("double")).select(*df.columns)


def apply_features(df: DataFrame, state: FeatureState, vector: str | None = None) -> DataFrame:
    """FEA-11, FEA-8: every stored feature in stored order as a double in [0, 1], next to the other columns.

    A feature missing from ``df`` is 0 before scaling. One narrow projection while the category lists are short.
    """
    if state is None:
        raise ValueError("scoring needs the state learned in training; call fit_features first")
    rows = state.rows
    filled = encode_categories(fill_values(df, state), state)
    if {"monthly_charges", "tenure_months"} <= set(filled.columns):
        filled = filled.withColumn(INTERACTION, F.col("monthly_charges") * F.col("tenure_months"))
    names = state.names
    kept = [c for c in df.columns if c not in NUMERIC_FEATURES + CATEGORY_FEATURES + names]
    cells = [
        scaled(F.col(r["feature"]) if r["feature"] in filled.columns else F.lit(0.0), r["min"], r["max"]).alias(r["feature"]) for r in rows
    ]
    out = filled.select(*kept, *cells)
    return VectorAssembler(inputCols=names, outputCol=vector).transform(out) if vector else out


def write_state(state: FeatureState, path: str) -> None:
    """SNK-2."""
    state.stats.write.parquet(f"{path}/stats")
    state.codes.write.parquet(f"{path}/codes")


def read_state(spark: SparkSession, path: str) -> FeatureState:
    rows = [r.asDict() for r in spark.read.parquet(f"{path}/stats").collect()]
    return state_of(rows, spark.read.parquet(f"{path}/codes"))
