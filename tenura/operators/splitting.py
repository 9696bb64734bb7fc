"""Stratified split and class weight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.order import order_cuts, slot_counts
from tenura.session import stage


def stratified_split(
    df: DataFrame,
    label: str = "churn_label",
    key: str = "customer_id",
    train: float = 0.70,
    validation: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    group: Sequence[str] = (),
) -> DataFrame:
    """TRN-1: add ``split``; within each label the rows of least hash are the test set, the next the validation set.

    The exact hash at each boundary is found from counts, so no row is moved: the split itself is a comparison.
    ``key`` tells rows apart within a label. Rows without a label get no split.
    """
    if abs(train + validation + test - 1.0) > 0.01:
        raise ValueError(f"ratios must sum to 1, got {train + validation + test:.3f}")
    strata = [*group, label]
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))))
    # The boundaries are looked up in a copy of two narrow columns; ``df`` itself is read once more, for the result.
    narrow = stage(hashed.filter(F.col(label).isNotNull()).select(*strata, "_hash"), "hashes")
    slots = slot_counts(narrow, strata, "_hash")
    sizes = slots.groupBy(*strata).agg(F.sum("_n").alias("n"))
    if not group and sizes.limit(3).count() > 2:
        raise ValueError("labels must be binary")
    n_test = F.floor(F.col("n") * float(test) + 0.5).cast("bigint")
    n_held = n_test + F.floor(F.col("n") * float(validation) + 0.5).cast("bigint")
    ends = F.array(F.struct(F.lit("test").alias("name"), n_test.alias("cut")), F.struct(F.lit("held").alias("name"), n_held.alias("cut")))
    keys = order_cuts(narrow, slots, strata, "_hash", sizes.select(*strata, F.inline(ends)))
    # One row per stratum, also for those too small to have a boundary.
    named = [F.max(F.when(F.col("name") == name, F.col("cut_key"))).alias(f"_{name}_to") for name in ("test", "held")]
    bounds = stage(keys.groupBy(*strata).agg(*named), "bounds")
    split = (
        F.when(F.col(label).isNull(), F.lit(None))
        .when(F.col("_hash") <= F.col("_test_to"), "test")
        .when(F.col("_hash") <= F.col("_held_to"), "validation")
        .otherwise("train")
    )
    return hashed.join(bounds, strata, "left").select(*df.columns, split.alias("split"))


def positive_weight(df: DataFrame, label: str = "churn_label", group: Sequence[str] = ()) -> DataFrame:
    """TRN-2: stayed / churned when churners are under 30%, else 1.

    A table without churners is an error; in a grouped run such a group has no weight, and the others keep theirs.
    """
    counts = df.groupBy(*group).agg(F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("positives"), F.count(label).alias("n"))
    undefined = F.lit(None) if group else F.raise_error(F.lit("no positive samples: the class weight is undefined"))
    rare = F.try_divide(F.col("positives").cast("double"), F.col("n")) < 0.30
    ratio = F.try_divide((F.col("n") - F.col("positives")).cast("double"), F.col("positives"))
    weight = F.when(F.col("positives") == 0, undefined.cast("double")).when(rare, ratio).otherwise(1.0)
    return counts.select(*group, "n", "positives", weight.alias("weight"))


def with_weights(df: DataFrame, weight: float, label: str = "churn_label", name: str = "weight") -> DataFrame:
    """The weight as a column for ``weightCol``: on churners, 1 on the rest."""
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0))
