"""What the operators of this subpackage share: whole tables, files in the shared folder, Arrow columns in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch that Python steps look at together; longer texts make smaller pieces.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the texts of one piece stay near ``PIECE_BYTES`` (one row at least)."""
    for batch in batches:
        column = batch.column(text)
        if batch.num_rows == 0:
            continue
        if column.nbytes <= PIECE_BYTES:
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that ``df`` has no such column (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lowered(column: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same(left: Column, right: Column) -> Column:
    """Equality under which null equals null."""
    return left.eqNullSafe(right)
