"""Session defaults, and tables staged in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def get_session(master: str = "local[8]", app: str = "tenura", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The JVM never compiles methods above 8000 bytes of code; a wide projection then runs interpreted, several
        # times slower. Below this limit Spark splits such stages into small methods instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    require_shared_folder(spark.sparkContext.master)
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tenura-"))
    return spark.sparkContext.getCheckpointDir()


def require_shared_folder(master: str) -> None:
    """Executors on other machines do not see a temporary folder of this one."""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the master is {master}")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_STAGED: list[str] = []


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: later steps read one fixed copy, also after executors are lost.

    The copy's file size is known to the optimizer, so small staged tables are broadcast by Spark's own threshold.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_folder(spark: SparkSession, name: str) -> str:
    """A new folder that is cleared with the staged copies."""
    _STAGED.append(new_folder(spark, name))
    return _STAGED[-1]


def path_exists(spark: SparkSession, path: str) -> bool:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own)


def clear_staged(spark: SparkSession) -> int:
    """Delete the copies this process has staged, once nothing reads them any more; returns how many."""
    return _clear_down_to(spark, 0)


def _clear_down_to(spark: SparkSession, mark: int) -> int:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = len(_STAGED) - mark
    while len(_STAGED) > mark:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def stage_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """Stage what ``make`` gives and delete the copies that making it has left; they are deleted after an error too."""
    mark = len(_STAGED)
    try:
        done = stage(make(), name)
    except BaseException:
        _clear_down_to(spark, mark)
        raise
    own = _STAGED.pop()
    _clear_down_to(spark, mark)
    _STAGED.append(own)
    return done


def drop_staged(df: DataFrame) -> None:
    """Delete the staged copies that ``df`` reads; nothing else may read them any more."""
    spark, files = df.sparkSession, df.inputFiles()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in [p for p in _STAGED if any(_reads(f, p) for f in files)]:
        own = jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(conf).delete(own, True)
        _STAGED.remove(path)


def _reads(file: str, path: str) -> bool:
    return path.split(":", 1)[-1].lstrip("/") in file


@contextmanager
def staging(spark: SparkSession):
    """A scope whose staged copies are deleted at its end, also after an error; it gives a function that spares a table's copies.

    What else leaves the scope must not read them.
    """
    mark = len(_STAGED)

    def spare(df: DataFrame) -> None:
        files = df.inputFiles()
        _STAGED[mark:] = [p for p in _STAGED[mark:] if not any(_reads(f, p) for f in files)]

    try:
        yield spare
    finally:
        _clear_down_to(spark, mark)


def kept_here(df: DataFrame) -> DataFrame:
    """A small result (a report, a card, a few statistics) as a local table that reads no copy any more."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Driver-side rows (a contract, a config, a few statistics) as a local table whose size the optimizer knows."""
    struct = T.StructType.fromDDL(schema)
    records = [dict(zip(struct.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)), struct)


# Largest lookup table, in rows and in bytes of its cells as text, that may be sent whole to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when rows and bytes, counted over a bounded part, prove the table small; otherwise leave it to AQE.

    The count runs the plan behind ``df``: for config tables and the like, not for results over the data.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and total <= max_bytes else df
