"""SCR-2: signed contribution of each feature to a prediction, on the log-odds scale, bias left out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import new_folder


def linear_contributions(names: Sequence[str], coefficients: Sequence[float], means: Sequence[float]) -> Column:
    """Linear model: ``coefficient * (x - mean)`` per feature; with the margin at the means they sum to the margin."""
    return F.array(*[F.lit(float(b)) * (F.col(c) - F.lit(float(m))) for c, b, m in zip(names, coefficients, means)])


def feature_means(df: DataFrame, names: Sequence[str]) -> list[float]:
    row = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    return [row[c] for c in names]


class Leaf(NamedTuple):
    """A leaf as its path: per distinct feature the open-closed range it asks for and the share of rows that meet it."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def tree_leaves(model) -> list[Leaf]:
    """All leaves of a fitted tree ensemble, values scaled to log-odds. As large as the model, not as the data."""
    nodes, leaves = tree_nodes(model), []
    for tree, weight in enumerate(model.treeWeights):
        leaves += _paths(nodes[tree], 2.0 * weight)
    return leaves


def tree_nodes(model) -> dict[int, dict[int, object]]:
    """The nodes of each tree by their number, 0 at the root. As large as the model, not as the data."""
    spark = SparkSession.active()
    path = new_folder(spark, "trees")
    model.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    return nodes


def _paths(tree: dict, scale: float) -> list[Leaf]:
    out, todo = [], [(0, {})]
    while todo:
        at, path = todo.pop()
        node = tree[at]
        if node["leftChild"] < 0:
            keys = sorted(path)
            low, high, share = zip(*[path[k] for k in keys]) if keys else ((), (), ())
            out.append(Leaf(scale * node["prediction"], tuple(keys), low, high, share))
            continue
        f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        low, high, share = path.get(f, (float("-inf"), float("inf"), 1.0))
        cover = node["impurityStats"][0]
        for child, ends in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
            part = tree[child]["impurityStats"][0] / cover
            todo.append((child, {**path, f: (*ends, share * part)}))
    return out


def expected_margin(leaves: Sequence[Leaf]) -> float:
    """The bias: the margin expected when no feature is known."""
    total = 0.0
    for leaf in leaves:
        reach = 1.0
        for s in leaf.share:
            reach *= s
        total += leaf.value * reach
    return total


@lru_cache
def _gauss(n: int):
    """Nodes and weights on 0 to 1."""
    import numpy as np

    nodes, weights = np.polynomial.legendre.leggauss(n)
    return (nodes + 1) / 2, weights / 2


def leaf_contributions(codes, share: Sequence[float], value: float):
    """Shapley values of one leaf for patterns, a bit a feature that says whether a row meets its range.

    A feature's weight over all subsets of the others is the integral over t from 0 to 1 of the product of their terms
    share * (1 - t) + met * t, which Gauss-Legendre nodes give exactly.
    """
    import numpy as np

    m = len(share)
    t, weights = _gauss((m + 1) // 2 or 1)
    met = ((codes[:, None] >> np.arange(m)) & 1).astype(float)
    share = np.array(share)
    terms = share[None, :, None] * (1 - t) + met[:, :, None] * t
    around = terms.prod(1, keepdims=True) / terms
    return value * (met - share) * (around @ weights)


class _Group(NamedTuple):
    """Neighbouring leaves. A row is told by which of the ``conditions`` it meets, a bit each; members name theirs by place."""

    conditions: tuple[tuple[int, float, float], ...]
    features: tuple[int, ...]
    members: tuple[tuple[float, tuple[float, ...], tuple[int, ...], tuple[int, ...]], ...]


# Conditions and leaves of a group. Neighbours share most of their path, so few of the patterns of so many bits occur.
_BITS, _LEAVES = 10, 4
# Bytes of worked-out patterns that a task keeps for its later batches.
_KEPT_BYTES = 128 << 20


def _grouped(leaves: Sequence[Leaf]) -> list[_Group]:
    out: list[_Group] = []
    held: list[Leaf] = []
    conditions: dict[tuple[int, float, float], int] = {}

    def close():
        features = sorted({f for leaf in held for f in leaf.features})
        members = tuple(
            (leaf.value, leaf.share, tuple(features.index(f) for f in leaf.features), tuple(conditions[c] for c in zip(leaf.features, leaf.low, leaf.high)))
            for leaf in held
        )
        out.append(_Group(tuple(conditions), tuple(features), members))

    for leaf in map(Leaf._make, leaves):
        if not leaf.features:
            continue
        own = list(zip(leaf.features, leaf.low, leaf.high))
        if held and (len(held) == _LEAVES or len({*conditions, *own}) > _BITS):
            close()
            held, conditions = [], {}
        held.append(leaf)
        for c in own:
            conditions.setdefault(c, len(conditions))
    if held:
        close()
    return out


class Explainer:
    """Contributions of one model to columns of features. It keeps the patterns it has worked out for later calls."""

    def __init__(self, leaves: Sequence[Leaf], width: int):
        self.groups, self.width = _grouped(leaves), width
        self.known: dict[int, tuple] = {}
        self.kept = 0

    def __call__(self, x):
        """``x`` and the result have a row for each feature. A missing feature meets no range."""
        import numpy as np

        rows = x.shape[1]
        total = np.zeros((self.width, rows))
        met: dict = {}
        for number, group in enumerate(self.groups if rows else ()):
            pattern = np.zeros(rows, np.uint32)
            for bit, condition in enumerate(group.conditions):
                if condition not in met:
                    if len(met) > 512:
                        met.clear()
                    f, low, high = condition
                    inside = x[f] <= high
                    if low > -np.inf:
                        inside &= x[f] > low
                    met[condition] = inside.astype(np.uint32)
                pattern |= met[condition] << np.uint32(bit)
            place, values = self.known.get(number) or (np.full(1 << len(group.conditions), -1, np.int32), np.empty((len(group.features), 0)))
            at = place[pattern]
            if at.min() < 0:
                place, values = self._with_new(group, place, values, np.flatnonzero(np.bincount(pattern[at < 0])))
                at = place[pattern]
                kept = self.kept + values.nbytes + (0 if number in self.known else place.nbytes)
                if kept <= _KEPT_BYTES:
                    self.known[number], self.kept = (place, values), kept
            for f, own in zip(group.features, values):
                total[f] += own[at]
        return total

    @staticmethod
    def _with_new(group: _Group, place, values, new):
        import numpy as np

        made = np.zeros((len(group.features), len(new)))
        for value, share, own, bits in group.members:
            codes = sum(((new >> b) & 1) << i for i, b in enumerate(bits))
            made[list(own)] += leaf_contributions(codes, share, value).T
        place = place.copy()
        place[new] = values.shape[1] + np.arange(len(new))
        return place, np.hstack([values, made])


def tree_contributions(df: DataFrame, leaves: Sequence[Leaf], names: Sequence[str], output: str = "contributions") -> DataFrame:
    """Path-dependent Shapley values per row, as ``array<double>`` in the order of ``names``.

    For a few neighbouring leaves only the pattern "which of their ranges does the row meet" matters. Patterns are found by counting,
    not by sorting, their values are worked out once a task, and a row looks its own up. Only the features go through Python. The
    leaves are the model and travel as a broadcast variable.
    """
    shared = df.sparkSession.sparkContext.broadcast(list(leaves))
    width = len(names)
    held: list[Explainer] = []

    @F.arrow_udf("array<double>")
    def explain(cells: pa.Array) -> pa.Array:
        import numpy as np

        if not held:
            held.append(Explainer(shared.value, width))
        x = np.ascontiguousarray(cells.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T)
        return pa.ListArray.from_arrays(pa.array(np.arange(x.shape[1] + 1) * width, pa.int32()), pa.array(held[0](x).T.ravel()))

    cells = [F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))) for n in names]
    return df.withColumn(output, explain(F.array(*cells)))
