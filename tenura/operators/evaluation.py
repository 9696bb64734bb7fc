"""Exact AUC, threshold metrics, the quality gate and model cards, for one model or many."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.contract import CONTRACT_VERSION
from tenura.functions import values as V
from tenura.functions.order import running_totals

MIN_AUC = 0.70


def score_counts(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; tasks count before the shuffle, so ties cost nothing."""
    scored = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return scored.groupBy(*group, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def auc(df: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = (), **how) -> DataFrame:
    """EVL-1: exact area under the ROC curve, ties counted half; null where one class is missing."""
    return _auc_of_counts(score_counts(df, label, score, group), group, **how)


def _auc_of_counts(counts: DataFrame, group: Sequence[str], **how) -> DataFrame:
    ranked = running_totals(counts, ["score"], ["neg"], group, **how)
    # Twice the count of won pairs, exact in whole numbers of up to 38 digits.
    pos, neg, before = (F.col(c).cast("decimal(19,0)") for c in ("pos", "neg", "before_neg"))
    won = F.sum((pos * (before * F.lit(2).cast("decimal(1,0)") + neg)).cast("decimal(38,0)")).cast("double")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*group).agg(F.try_divide(won, pairs * 2.0).alias("auc"))


def threshold_metrics(df: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = (), cut: float = 0.5) -> DataFrame:
    """EVL-2: confusion counts at ``score >= cut``, precision, recall and F1, 0 where undefined."""
    said = V.number_or(F.col(score), float("-inf")) >= cut
    real = F.col(label) == 1
    counts = df.filter(F.col(label).isNotNull()).groupBy(*group).agg(
        F.count_if(said & real).alias("tp"),
        F.count_if(said & ~real).alias("fp"),
        F.count_if(~said & real).alias("fn"),
        F.count_if(~said & ~real).alias("tn"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))

    def ratio(a, b, name):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0)).alias(name)

    return counts.select(
        *group, "tp", "fp", "fn", "tn", ratio(tp, tp + fp, "precision"), ratio(tp, tp + fn, "recall"), ratio(tp * 2.0, tp * 2.0 + fp + fn, "f1")
    )


def evaluate(df: DataFrame, label: str = "y", score: str = "p", group: Sequence[str] = (), min_auc: float = MIN_AUC) -> DataFrame:
    """EVL-3, EVL-4: metrics rounded to 4 places per group; the gate compares the AUC before rounding, nothing else."""
    group = list(group)
    metrics = threshold_metrics(df, label, score, group)
    area = auc(df, label, score, group)
    if group:
        joined = metrics.join(area, group, "left")
    else:
        joined = metrics.withColumn("auc", area.scalar())
    return joined.select(
        *group,
        V.round_to(F.col("auc"), 4).alias("auc_roc"),
        *[V.round_to(F.col(c), 4).alias(a) for c, a in (("f1", "f1_score"), ("precision", "precision"), ("recall", "recall"))],
        F.coalesce(F.col("auc") >= min_auc, F.lit(False)).alias("passed"),
        F.lit(float(min_auc)).alias("threshold"),
    )


def model_cards(
    evaluated: DataFrame, features: Sequence[str], params: Mapping[str, object], client: str = "client_id", rows: str = "dataset_rows", at=None
) -> DataFrame:
    """EVL-5: one registry row per evaluated model.

    ``evaluated`` has the columns of ``evaluate`` plus, where known, the client, the row count and ``model_id``.
    ``at`` is the training time; now when left out.
    """
    at = F.current_timestamp() if at is None else at
    has = set(evaluated.columns)
    own_id = F.concat(F.lit("churn-gbt-"), F.date_format(at, "yyyyMMdd-HHmmss"))
    return evaluated.select(
        (F.coalesce(F.col("model_id"), own_id) if "model_id" in has else own_id).alias("model_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("training_date"),
        (F.coalesce(F.col(client), F.lit("unknown")) if client in has else F.lit("unknown")).alias("client_id"),
        (F.col(rows) if rows in has else F.lit(0).cast("bigint")).alias("dataset_rows"),
        F.lit(len(features)).cast("bigint").alias("feature_count"),
        F.array(*[F.lit(f) for f in features]).alias("features_used"),
        F.struct("auc_roc", "f1_score", "precision", "recall").alias("metrics"),
        F.create_map(*[F.lit(x) for k, v in params.items() for x in (k, str(v))]).alias("hyperparameters"),
        F.struct("passed", "threshold", V.round_to(F.col("auc_roc") - F.col("threshold"), 4).alias("margin")).alias("evaluation_gate"),
        F.lit(CONTRACT_VERSION).alias("data_contract_version"),
    )
