"""Feature statistics of many clients, learned and applied in one job.

What ``features`` keeps as numbers on the driver is here two tables keyed by client: ``stats``, one row per client and feature, and
``codes``, one row per client, category feature and value. No step depends on how many clients there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import values as V
from tenura.functions.order import global_rank, group_summary
from tenura.operators.features import FEW_VALUES, INTERACTION, FeatureState, _typed, category_counts, feature_columns, state_of
from tenura.session import stage

CLIENT = ["client_id"]


class GroupState(NamedTuple):
    """``stats``: (client, feature, pos, kind, impute_num, impute_cat, n_classes, min, max); ``codes``: (client, feature, value, n, code)."""

    stats: DataFrame
    codes: DataFrame
    names: list[str]
    group: list[str]

    def of(self, *client) -> FeatureState:
        """The state of one client, as ``features`` uses it."""
        own = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.lit(v)) for g, v in zip(self.group, client)])
        rows = [r.asDict() for r in self.stats.where(own).drop(*self.group).collect()]
        return state_of(rows, self.codes.where(own).drop(*self.group))


def _matching(group: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"{prefix}{g}")) for g in group])


def _keyed(df: DataFrame, group: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({g: f"{prefix}{g}" for g in group})


def fit_features_by(df: DataFrame, group: Sequence[str] = CLIENT, few: int = FEW_VALUES) -> GroupState:
    """FEA-10 for every client of ``df``: the statistics that ``fit_features`` gives for the client's rows alone.

    A client without any value of a feature has the fill 0 or ``unknown``. Medians are narrowed for all clients and columns together; a
    hot client is counted inside the tasks before anything is shuffled.
    """
    group = list(group)
    numeric, category, given = feature_columns(df)
    work = stage(_typed(df).select(*group, *numeric, *category, *given), "features")
    clients = work.select(*group).distinct()
    nothing = {"impute_num": "double", "impute_cat": "string", "n_classes": "bigint", "min": "double", "max": "double"}

    def rows(table: DataFrame, kind: str, **cells: Column) -> DataFrame:
        made = [(cells[n] if n in cells else F.lit(None)).cast(t).alias(n) for n, t in nothing.items()]
        return table.select(*group, "feature", F.lit(kind).alias("kind"), *made)

    def each(names: Sequence[str]) -> DataFrame:
        return clients.select(*group, F.explode(F.array(*[F.lit(c) for c in names])).alias("feature"))

    parts = []
    fills = None
    if numeric:
        found = _keyed(group_summary(work, numeric, group).withColumnRenamed("column", "_feature"), group, "_")
        met = each(numeric).join(found, _matching(group, "_") & (F.col("feature") == F.col("_feature")), "left")
        numbers = stage(met.select(*group, "feature", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("median", "min", "max")]), "numbers")
        parts.append(rows(numbers, "numeric", impute_num=F.col("median"), min=F.col("min"), max=F.col("max")))
        fills = numbers.groupBy(*group).agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_fill_{c}") for c in numeric])
    codes = _codes(work, category, group, few)
    if category:
        best = F.max(F.when(F.col("filled"), F.col("value")))
        known = codes.groupBy(*group, "feature").agg(best.alias("fill"), F.count("*").alias("k"))
        parts.append(rows(known, "category", impute_cat=F.col("fill"), n_classes=F.col("k"), min=F.lit(0.0), max=F.col("k") - 1))
    extra = list(given)
    cells = {c: V.number_or(F.col(c)) for c in given}
    if {"monthly_charges", "tenure_months"} <= set(numeric):
        extra.append(INTERACTION)
        filled = [F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in ("monthly_charges", "tenure_months")]
        cells[INTERACTION] = filled[0] * filled[1]
    if extra:
        met = work.join(_keyed(fills, group, "_of_"), _matching(group, "_of_")) if INTERACTION in extra else work
        ends = met.groupBy(*group).agg(*[f(cells[c]).alias(f"{n}_{c}") for c in extra for n, f in (("lo", F.min), ("hi", F.max))])
        pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in extra]
        ends = ends.select(*group, F.inline(F.array(*pairs)))
        parts.append(rows(ends, "interaction", min=F.coalesce("lo", F.lit(0.0)), max=F.coalesce("hi", F.lit(0.0))))
    names = [*numeric, *category, *extra]
    place = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("feature")) - 1
    stats = reduce(DataFrame.unionByName, parts).select(*group, "feature", place.cast("int").alias("pos"), "kind", *nothing)
    return GroupState(stage(stats, "stats"), codes.drop("filled"), names, group)


def _codes(work: DataFrame, category: Sequence[str], group: list[str], few: int) -> DataFrame:
    """FEA-3, FEA-5 by client: (client, feature, value, n, code, filled); ``filled`` marks the value that stands in for nulls."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in category]
    if not pairs:
        return work.limit(0).select(*group, *[F.lit(None).cast(t).alias(n) for n, t in (("feature", "string"), ("value", "string"), ("n", "bigint"), ("code", "bigint"), ("filled", "boolean"))])
    counts = stage(work.select(*group, F.inline(F.array(*pairs))).groupBy(*group, "feature", "value").agg(F.count("*").alias("n")), "categories")
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))))
    fills = _keyed(counts.groupBy(*group, "feature").agg(F.coalesce(best["value"], F.lit("unknown")).alias("fill")).withColumnRenamed("feature", "_feature"), group, "_")
    met = counts.join(fills, _matching(group, "_") & (F.col("feature") == F.col("_feature")))
    value = F.coalesce("value", "fill")
    values = met.groupBy(*group, "feature", value.alias("value")).agg(F.sum("n").alias("n"), F.bool_or(value == F.col("fill")).alias("filled"))
    ranked = global_rank(values, ["value"], [*group, "feature"], "code", small=few)
    return stage(ranked.select(*group, "feature", "value", "n", (F.col("code") - 1).alias("code"), "filled"), "codes")


def apply_features_by(df: DataFrame, state: GroupState, vector: str | None = None) -> DataFrame:
    """FEA-11 for many clients: each row is filled, coded and scaled by the statistics of its client.

    A client without statistics fails the job. Stats and code lists are joined; Spark broadcasts them while they are small.
    """
    group, names = state.group, state.names
    numeric, category, given = feature_columns(df)
    wanted = [(c, n) for c in names for n in ("impute_num", "impute_cat", "min", "max")]
    cells = [F.max(F.when(F.col("feature") == c, F.col(n))).alias(f"_{n}_{c}") for c, n in wanted]
    wide = stage(_keyed(state.stats.groupBy(*group).agg(*cells, F.lit(True).alias("_known")), group, "_of_"), "wide")
    met = _typed(df).join(wide, _matching(group, "_of_"), "left")
    told = F.concat_ws(", ", *[F.col(g).cast("string") for g in group])
    met = met.where(F.when(F.col("_known"), True).otherwise(F.raise_error(F.concat(F.lit("no features were learned for "), told)).cast("boolean")))
    filled = {c: F.coalesce(F.col(c), F.col(f"_impute_num_{c}")) for c in numeric if c in names}
    for i, c in enumerate(c for c in category if c in names):
        own = state.codes.where(F.col("feature") == c).select(*[F.col(g).alias(f"_c{i}_{g}") for g in group], F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}"))
        met = met.withColumn(c, F.coalesce(F.col(c), F.col(f"_impute_cat_{c}"))).join(own, _matching(group, f"_c{i}_") & (F.col(c) == F.col(f"_value{i}")), "left")
        filled[c] = F.coalesce(F.col(f"_code{i}"), F.lit(0)).cast("double")
    filled |= {c: F.col(c) for c in given if c in names}
    if INTERACTION in names:
        filled[INTERACTION] = filled.get("monthly_charges", F.lit(0.0)) * filled.get("tenure_months", F.lit(0.0))
    kept = [c for c in df.columns if c not in (*numeric, *category, *names)]
    out = met.select(*kept, *[_scaled(filled.get(c, F.lit(0.0)), F.col(f"_min_{c}"), F.col(f"_max_{c}")).alias(c) for c in names])
    return VectorAssembler(inputCols=names, outputCol=vector).transform(out) if vector else out


def _scaled(x: Column, least: Column, most: Column) -> Column:
    """FEA-9 with the range in columns."""
    span = F.when(most == least, F.lit(1.0)).otherwise(most - least)
    return F.coalesce(V.clip(V.number_or((x - least) / span), F.lit(0.0), F.lit(1.0)), F.lit(0.0))
