"""Client CSV in, tables and deliverables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.sources.csv_records import csv_records, header_names, parse_records

# Text that a CSV cell may hold to say "nothing here"; empty cells count as well.
NULL_TOKENS = [
    "N/A", "NA", "null", "NULL", "NaN", "nan", "None", "n/a", "<NA>", "#N/A", "#NA", "#N/A N/A",
    "-NaN", "-nan", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
]


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text cells that hold a null token, or nothing, become null. A lone blank stays."""
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"} & set(columns or df.columns)
    cells = [
        F.when(~F.col(f"`{c}`").isin("", *NULL_TOKENS), F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`")
        for c in df.columns
    ]
    return df.select(*cells)


def read_client_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    order: str = "src_row",
    multi_line: bool = True,
    prefix: str | None = None,
) -> DataFrame:
    """SRC-1: every column as text, null tokens nulled, rows numbered in file order.

    Quotes are doubled inside quoted cells, and cells may hold line breaks; all the same large files are split among tasks
    (``csv_records``). A client whose cells have no line breaks can set ``multi_line=False``. Columns go by the names in the header:
    ``columns`` picks and orders them, and a name that is missing, or a second file with another header, is an error. Files without any
    record give no rows. With ``prefix`` a file outside the client's folder fails the job (SRC-5).

    ``order`` is 0, 1, 2 ... along the files in the order of their paths, whatever the splits. The lines are read when this is called, into a
    copy in the shared folder.
    """
    records = csv_records(spark, path, multi_line, prefix)
    names = header_names(records)
    if columns and (missing := [c for c in columns if c not in names]):
        raise ValueError(f"{path} has no columns {missing}")
    df = parse_records(records, names, order).select(*[F.col(f"`{c}`") for c in columns or names], F.col(f"`{order}`"))
    return null_tokens(df)


def sample_rows(raw: DataFrame, n: int = 5, order: str = "src_row", client: str = "client_id") -> DataFrame:
    """SRC-2: the first ``n`` rows of each client as ``(client_id, row_no, pos, column, value)``.

    ``raw`` has ``(client_id, src_row, raw map<string,string>)``. Spark keeps ``n`` rows per client in every task
    before the shuffle, so a large client costs no more than a small one.
    """
    first = Window.partitionBy(client).orderBy(order)
    top = raw.withColumn("row_no", F.row_number().over(first)).filter(F.col("row_no") <= n)
    return top.select(client, F.col("row_no").cast("bigint"), F.posexplode("raw").alias("pos", "column", "value"))


def raw_rows(df: DataFrame, client_id: str, order: str = "src_row") -> DataFrame:
    """Rows of one client in the shape shared by all clients: ``(client_id, src_row, raw map<string,string>)``."""
    names = [c for c in df.columns if c != order]
    cells = [x for c in names for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return df.select(F.lit(client_id).alias("client_id"), F.col(order), F.create_map(*cells).alias("raw"))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "error") -> None:
    """SNK-3 and the CSV form of SNK-1; blanks at the ends of a cell are kept, quotes inside a cell are doubled."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.partitionBy(*partition_by).csv(path)
