"""Train the churn classifier and search its settings with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from decimal import Decimal
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.functions.order import RANGE_ROWS
from tenura.operators.contributions import tree_nodes
from tenura.session import shared_folder, small_table

# Default settings of the boosted trees.
DEFAULTS = {"max_depth": 6, "eta": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 3}
MAX_ROUNDS = 200
PATIENCE = 20
# Rows, about, from which the ranges of margins are told.
CUT_ROWS = 5_000

# Type, least and greatest setting searched.
SETTING_RANGES = {
    "max_depth": ("integer", 3, 10),
    "eta": ("continuous", 0.01, 0.3),
    "subsample": ("continuous", 0.5, 1.0),
    "colsample_bytree": ("continuous", 0.5, 1.0),
    "min_child_weight": ("integer", 1, 10),
}


def tree_classifier(settings: Mapping[str, float] | None = None, rounds: int = MAX_ROUNDS, seed: int = 42, **columns) -> GBTClassifier:
    """Boosted trees with the usual setting names mapped to Spark's."""
    s = {**DEFAULTS, **(settings or {})}
    return GBTClassifier(
        featuresCol="features",
        lossType="logistic",
        maxIter=rounds,
        maxDepth=int(s["max_depth"]),
        stepSize=float(s["eta"]),
        subsamplingRate=float(s["subsample"]),
        featureSubsetStrategy=str(float(s["colsample_bytree"])),
        minInstancesPerNode=int(s["min_child_weight"]),
        checkpointInterval=10,
        seed=seed,
        **columns,
    )


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds to keep, and whether ``patience`` rounds without a better loss have passed since."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` rounds."""
    if n >= model.getNumTrees:
        return model
    gateway, java = SparkSession.active().sparkContext._gateway, model._java_obj
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:n], model.treeWeights)):
        trees[i], weights[i] = tree, float(weight)
    ml = gateway.jvm.org.apache.spark.ml
    cut = java.copyValues(ml.classification.GBTClassificationModel(model.uid, trees, weights), ml.param.ParamMap.empty())
    return GBTClassificationModel._from_java(cut)


def leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """Per tree what each leaf adds to the margin, leaves from left to right, as Spark numbers them."""
    nodes, out = tree_nodes(model), []
    for tree, weight in enumerate(model.treeWeights):
        own, todo = [], [0]
        while todo:
            node = nodes[tree][todo.pop()]
            if node["leftChild"] < 0:
                own.append(2.0 * weight * node["prediction"])
            else:
                todo += [node["rightChild"], node["leftChild"]]
        out.append(own)
    return out


def _leaf_table(model: GBTClassificationModel) -> np.ndarray:
    """``leaf_values`` as one table, a row a tree."""
    values = leaf_values(model)
    table = np.zeros((len(values), max(map(len, values))))
    for tree, own in enumerate(values):
        table[tree, : len(own)] = own
    return table


def _leaves(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    """``df`` with ``_leaves``, the number of the leaf in each tree."""
    return model.copy({model.leafCol: "_leaves"}).transform(df)


def _margins(leaves: pa.Array, table: np.ndarray) -> np.ndarray:
    """The margin of each row after each round: the running sum of the leaves that it falls in."""
    at = leaves.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(table)).astype(np.int64)
    return table[np.arange(len(table)), at].cumsum(axis=1)


def round_margins(model: GBTClassificationModel, df: DataFrame, name: str = "margins") -> DataFrame:
    """``df`` with the margin after each round, as one ``array<double>`` a row."""
    shared = df.sparkSession.sparkContext.broadcast(_leaf_table(model))

    @F.arrow_udf("array<double>")
    def summed(leaves: pa.Array) -> pa.Array:
        margins = _margins(leaves, shared.value)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(margins) + 1) * margins.shape[1], pa.int32()), pa.array(margins.ravel()))

    return _leaves(model, df).select(*df.columns, summed(vector_to_array("_leaves")).alias(name))


def round_aucs(model: GBTClassificationModel, df: DataFrame, label: str = "churn_label") -> list[float | None]:
    """The AUC of the model of the first 1, 2, ... rounds on ``df``, exact, ties counted half; null where one class is missing.

    Tasks count the rows of equal margins and send sorted runs, one a round and range of margins, as packed columns; a run of a range
    meets those of the same round and range, about ``RANGE_ROWS`` rows. The ranges of a round, one row each, are added up at the end.
    """
    spark = df.sparkSession
    used = df.filter(F.col(label).isNotNull()).select("features", F.col(label).cast("double").alias("_label"))
    shared = spark.sparkContext.broadcast(_leaf_table(model))
    cuts = spark.sparkContext.broadcast(_margin_cuts(model, used, shared))
    told = _leaves(model, used).select(vector_to_array("_leaves").alias("leaves"), "_label")

    def counted(batches):
        for batch in batches:
            margins = _margins(batch.column("leaves"), shared.value)
            label = batch.column("_label").to_numpy(zero_copy_only=False)
            rows = []
            for i, column in enumerate(np.ascontiguousarray(margins.T)):
                scores, pos, neg = _by_score(column, label == 1, label == 0)
                ends = [0, *np.searchsorted(scores, cuts.value[i], "right").tolist(), len(scores)]
                rows += [(i, k, *(x[a:b].tobytes() for x in (scores, pos.astype(np.int32), neg.astype(np.int32)))) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names, kinds = ["round", "span", "scores", "pos", "neg"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    runs = told.mapInArrow(counted, "round int, span int, scores binary, pos binary, neg binary")
    spans = runs.groupBy("round", "span").applyInArrow(_span_area, "round int, span int, won decimal(38,0), pos bigint, neg bigint")
    # Each positive row of a range wins against the negative rows of all earlier ranges too.
    earlier = Window.partitionBy("round").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumn("before", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    pos, before = (F.col(c).cast("decimal(18,0)") for c in ("pos", "before"))
    won = F.sum((F.col("won") + pos * before * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)")).cast("double")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    areas = {r["round"]: r["auc"] for r in placed.groupBy("round").agg(F.try_divide(won, pairs * 2.0).alias("auc")).collect()}
    return [areas.get(i) for i in range(model.getNumTrees)]


def _margin_cuts(model: GBTClassificationModel, used: DataFrame, shared) -> np.ndarray:
    """For each round the margins that part its rows into ranges, told from a sample; they only share out the work."""
    n = used.count()
    spans = -(-n // RANGE_ROWS)
    if spans <= 1:
        return np.zeros((len(shared.value), 0))
    leaves = _leaves(model, used.sample(min(1.0, CUT_ROWS / n), seed=1)).select(vector_to_array("_leaves").alias("leaves"))
    return np.quantile(_margins(leaves.toArrow().column("leaves").combine_chunks(), shared.value), np.arange(1, spans) / spans, axis=0, method="nearest").T


def _by_score(scores: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores in rising order, with the sums of ``pos`` and ``neg`` at each."""
    order = np.argsort(scores)
    scores = scores[order]
    first = np.flatnonzero(np.append(True, scores[1:] != scores[:-1]))
    return scores[first], *(np.add.reduceat(x[order].astype(np.int64), first) for x in (pos, neg))


def _span_area(key: tuple[pa.Scalar, ...], runs: pa.Table) -> pa.Table:
    """Twice the pairs won among the rows of one round and range, a tie half, and its rows by class."""
    scores, pos, neg = (np.frombuffer(b"".join(runs.column(c).to_pylist()), kind) for c, kind in (("scores", np.float64), ("pos", np.int32), ("neg", np.int32)))
    _, pos, neg = _by_score(scores, pos, neg)
    n_pos, n_neg = int(pos.sum()), int(neg.sum())
    if 2 * n_pos * n_neg >= 1 << 62:
        pos, neg = pos.astype(object), neg.astype(object)
    won = int((pos * (2 * (np.cumsum(neg) - neg) + neg)).sum())
    kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64(), pa.int64())
    row = (key[0].as_py(), key[1].as_py(), Decimal(won), n_pos, n_neg)
    return pa.table([pa.array([x], kind) for x, kind in zip(row, kinds)], ["round", "span", "won", "pos", "neg"])


def fit_trees(
    df: DataFrame,
    settings: Mapping[str, float] | None = None,
    rounds: int = MAX_ROUNDS,
    label: str = "churn_label",
    weight: str | None = "weight",
    split: str | None = "split",
    seed: int = 42,
    patience: int = PATIENCE,
) -> GBTClassificationModel:
    """TRN-3: fit on the train rows and keep the rounds up to the best AUC on the validation rows.

    The best is the one after which ``patience`` rounds bring no better one. Spark cannot go on from a fitted model, so all rounds are
    fitted, once, and the AUC of each is told from the margins after each round. Without validation rows of both classes all rounds
    stay. ``df`` has ``features``, the label and, where named, the weight and split columns. Rows are cached while training and worked
    out anew where a cached block is lost; long lineages are cut by Spark's checkpoints in the shared folder.
    """
    with _parts(df, label, weight, split) as (train, held):
        return _fit_parts(train, held, settings, rounds, label, weight, seed, patience)[0]


@contextmanager
def _parts(df: DataFrame, label: str, weight: str | None, split: str | None):
    """(train rows, validation rows or None), cached while in use."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    used = df.filter(F.col(label).isNotNull()).select("features", label, *[c for c in (weight, split) if c])
    train = (used.filter(F.col(split) == "train") if split else used).persist()
    held = used.filter(F.col(split) == "validation").persist() if split else None
    try:
        yield train, held
    finally:
        train.unpersist()
        if held is not None:
            held.unpersist()


def _fit_parts(train, held, settings, rounds, label, weight, seed, patience) -> tuple[GBTClassificationModel, float | None]:
    """The model of the rounds that stay, and its AUC on the validation rows."""
    columns = {"labelCol": label, **({"weightCol": weight} if weight else {})}
    model = tree_classifier(settings, rounds, seed, **columns).fit(train)
    areas = round_aucs(model, held, label) if held is not None else [None]
    if None in areas:
        return model, None
    keep, _ = best_round([-a for a in areas], patience)
    return first_trees(model, keep), areas[keep - 1]


def fit_linear(df: DataFrame, label: str = "churn_label", weight: str | None = "weight", split: str | None = "split", iterations: int = 50) -> LogisticRegressionModel:
    """A logistic regression on the same columns; its contributions need no Python."""
    used = df.filter(F.col(split) == "train") if split else df
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=iterations, regParam=1e-3, standardization=False)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(used)


def linear_model(names: Sequence[str], weights: Mapping[str, float], intercept: float) -> LogisticRegressionModel:
    """A logistic regression with given weights for the named features, 0 for the others."""
    jvm = SparkSession.active().sparkContext._jvm
    values = DenseVector([float(weights.get(n, 0.0)) for n in names])
    java = jvm.org.apache.spark.ml.classification.LogisticRegressionModel("given_weights", _py2java(SparkSession.active().sparkContext, values), float(intercept))
    return LogisticRegressionModel._from_java(java).setFeaturesCol("features")


def draw_settings(n: int, seed: int = 42) -> list[dict[str, float]]:
    """``n`` seeded draws from the ranges."""
    rng = random.Random(seed)
    pick = {"integer": lambda lo, hi: rng.randint(lo, hi), "continuous": lambda lo, hi: round(rng.uniform(lo, hi), 4)}
    return [{name: pick[kind](lo, hi) for name, (kind, lo, hi) in SETTING_RANGES.items()} for _ in range(n)]


def tune_trees(df: DataFrame, settings: list[dict[str, float]], rounds: int = MAX_ROUNDS, label: str = "churn_label", weight: str | None = "weight", parallelism: int = 3, seed: int = 42) -> DataFrame:
    """TRN-4: fit each setting on the train rows and report its AUC on the validation rows, best first."""
    spark = df.sparkSession
    with _parts(df, label, weight, "split") as (train, held):

        def run(item):
            i, s = item
            model, area = _fit_parts(train, held, s, rounds, label, weight, seed, PATIENCE)
            return (i, *[float(s[k]) for k in SETTING_RANGES], model.getNumTrees, area)

        with ThreadPool(parallelism) as pool:
            rows = pool.map(run, list(enumerate(settings)))
    names = ", ".join(f"{k} double" for k in SETTING_RANGES)
    return small_table(spark, rows, f"trial bigint, {names}, trees bigint, auc double").orderBy(F.desc_nulls_last("auc"), "trial")
