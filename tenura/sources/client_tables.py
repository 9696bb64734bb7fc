"""One table of many clients: a batch replaces the partitions it has rows for, as a whole, and leaves all others."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Folders and files that begin so are no part of the table to any reader.
_BATCH, _COMPLETE = "_batch-", "_complete"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("client_id", "run_date"), mode: str = "replace") -> None:
    """SNK-1, SNK-2, SNK-4: parquet under the client and the run date.

    With ``replace`` the partitions that ``df`` has rows for are written anew; a rerun of a client's day leaves what the last run gave,
    and other clients and days stay. With ``error`` the write fails if one of its partitions is there. Both are all or nothing: rows
    go to a folder that no reader sees, a marker says that they are all there, and only then are partitions exchanged one by one. A
    writer that dies before the marker has changed nothing; one that dies after it is completed by the next write, or by
    ``finish_writes``. Any other mode is Spark's own, as is a table without partition columns.
    """
    keys = [c for c in partition_by if c in df.columns]
    if mode not in ("replace", "error") or not keys:
        df.write.mode("overwrite" if mode == "replace" else mode).partitionBy(*keys).parquet(path)
        return
    spark = df.sparkSession
    finish_writes(spark, path)
    batch = f"{path}/{_BATCH}{uuid.uuid4().hex}"
    df.write.partitionBy(*keys).parquet(f"{batch}/rows")
    fs, folder = _folder(spark, path)
    if mode == "error":
        there = [p for p in _leaves(spark, f"{batch}/rows") if fs.exists(_folder(spark, f"{path}/{p}")[1])]
        if there:
            fs.delete(_folder(spark, batch)[1], True)
            raise FileExistsError(f"{path} has {there} already")
    fs.create(_folder(spark, f"{batch}/{_COMPLETE}")[1]).close()
    _publish(spark, path, batch)


def finish_writes(spark: SparkSession, path: str) -> int:
    """Complete the batches that a writer has left with their marker set; returns how many. It may be called at any time, by anyone."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    left = [f"{path}/{n}" for n in names if n.startswith(_BATCH) and fs.exists(_folder(spark, f"{path}/{n}/{_COMPLETE}")[1])]
    for batch in left:
        _publish(spark, path, batch)
    return len(left)


def drop_unfinished(spark: SparkSession, path: str) -> int:
    """Delete what writers that died before their marker have left; returns how many. Only while nobody writes."""
    finish_writes(spark, path)
    fs, folder = _folder(spark, path)
    left = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(_BATCH)] if fs.exists(folder) else []
    for batch in left:
        fs.delete(batch, True)
    return len(left)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder or file."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()), own


def _leaves(spark: SparkSession, path: str) -> list[str]:
    """The partitions below a folder, ``a=1/b=2`` each: as many as the batch has clients and days."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            below = _leaves(spark, f"{path}/{name}")
            out += [f"{name}/{p}" for p in below] or [name]
    return sorted(out)


def _publish(spark: SparkSession, path: str, batch: str) -> None:
    """Exchange each partition that is still in the batch. A partition that has left it is done, so this can be repeated."""
    fs, _ = _folder(spark, path)
    for partition in _leaves(spark, f"{batch}/rows"):
        new, old = (_folder(spark, f"{p}/{partition}")[1] for p in (f"{batch}/rows", path))
        if not fs.exists(new):
            continue
        fs.delete(old, True)
        fs.mkdirs(old.getParent())
        if not fs.rename(new, old) and fs.exists(new):
            raise OSError(f"could not move {new} to {old}")
    fs.delete(_folder(spark, batch)[1], True)
