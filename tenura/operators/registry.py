"""Models of many clients as one table, and scoring of all their rows in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenura.operators.contributions import Explainer, Leaf, expected_margin
from tenura.session import small_table, stage

REGISTRY_SCHEMA = (
    "client_id string, model_id string, names array<string>, bias double, "
    "leaves array<struct<value:double, features:array<int>, low:array<double>, high:array<double>, share:array<double>>>"
)
# Rows of one client that are scored as one group; a client with more is dealt into several.
GROUP_ROWS = 200_000


def registry_of(spark: SparkSession, models: Mapping[str, tuple[str, Sequence[Leaf], Sequence[str]]]) -> DataFrame:
    """One row a client from ``(model_id, leaves, feature names)``. The table can be written by ``write_table`` and read back."""
    rows = [(c, i, list(names), expected_margin([Leaf._make(x) for x in leaves]), [Leaf._make(x)._asdict() for x in leaves]) for c, (i, leaves, names) in models.items()]
    return small_table(spark, rows, REGISTRY_SCHEMA)


def score_by_client(df: DataFrame, registry: DataFrame, names: Sequence[str], key: str = "customer_id", client: str = "client_id", group_rows: int = GROUP_ROWS) -> DataFrame:
    """SCR-1, SCR-2 for many clients: ``df`` with ``model_id``, ``churn_probability`` and ``contributions``, by the model of each row's client.

    Rows and models meet by client. A client of more than ``group_rows`` rows is dealt into as many groups by ``key`` as keep them
    small, and its model goes to each. ``names`` are the feature columns; contributions come in their order, 0 for features that a model
    does not know. A feature that a model asks for and ``df`` lacks, and a row whose client has no model, fail the job. Columns of
    ``df`` with the names of the added ones are replaced.
    """
    added = ["model_id", "churn_probability", "contributions"]
    held = [c for c in df.columns if c not in (*added, "_part")]
    rows = df.select(held)
    parts = rows.groupBy(F.col(client).alias("_client")).agg(F.ceil(F.count("*") / group_rows).alias("_parts"))
    parts = stage(parts, "parts")
    met = rows.join(parts, F.col(client).eqNullSafe(F.col("_client"))).withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")))
    models = registry.withColumnsRenamed({"client_id": "_own"}).join(parts, F.col("_own") == F.col("_client"))
    models = models.select(F.col("_own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part"), "model_id", "names", "bias", "leaves")
    base = rows.select(held).schema
    schema = T.StructType([*base.fields, T.StructField("model_id", T.StringType()), T.StructField("churn_probability", T.DoubleType()), T.StructField("contributions", T.ArrayType(T.DoubleType()))])

    def score(group, own, model):
        import numpy as np

        if not own.num_rows:
            # A part of a client to which no row was dealt.
            return to_arrow_schema(schema).empty_table()
        if model.num_rows != 1:
            raise ValueError(f"client {group[0].as_py()} has {model.num_rows} models")
        (found,) = model.to_pylist()
        if missing := [n for n in found["names"] if n not in names]:
            raise ValueError(f"client {group[0].as_py()}: the model asks for {missing}")
        leaves = [Leaf(x["value"], tuple(x["features"]), tuple(x["low"]), tuple(x["high"]), tuple(x["share"])) for x in found["leaves"]]
        explain = Explainer(leaves, len(found["names"]))
        cells = [own.column(n).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False) for n in found["names"]]
        x = np.array(cells).reshape(len(found["names"]), own.num_rows)
        total = np.zeros((len(names), own.num_rows))
        for at in range(0, own.num_rows, 10_000):
            part = explain(x[:, at : at + 10_000])
            total[[list(names).index(n) for n in found["names"]], at : at + 10_000] = part
        margin = found["bias"] + total.sum(axis=0)
        ends = pa.array(np.arange(own.num_rows + 1) * len(names), pa.int32())
        columns = [own.column(c) for c in held]
        columns += [pa.repeat(pa.scalar(found["model_id"], pa.string()), own.num_rows), pa.array(1.0 / (1.0 + np.exp(-margin)))]
        return pa.Table.from_arrays([*columns, pa.ListArray.from_arrays(ends, pa.array(total.T.ravel()))], names=schema.names)

    return met.groupBy(client, "_part").cogroup(models.groupBy("_own", "_part")).applyInArrow(score, schema)
