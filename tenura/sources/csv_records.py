"""CSV records, numbered in file order, from files that many tasks read, also where cells hold quotes and line breaks.

Files are read as lines, split after split. A line begins a record if the quotes before it in its file are even in number. A task
cannot know that for its split, so it counts for either case: quotes, records begun and the last of them. One row a split then goes
through running sums over the splits of a file, which say how each split really began and how many records come before it, over
files in the order of their paths. Lines that are whole records stay where they are; only the pieces of longer ones are shuffled.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.session import stage
from tenura.sources.paths import only_client_files

# Lines of one record at most; more mean a quote that nobody closes.
MAX_RECORD_LINES = 100_000

_LINE = "file string, block bigint, at bigint, quotes int, inside int, n0 bigint, n1 bigint, last0 bigint, last1 bigint, value string"


def _numbered(batches, quoted: bool):
    """Task step: lines in the order of their split to what is known of them within it.

    ``inside`` is the parity of the quotes before the line in its split. ``n0`` and ``n1`` count the records begun before it, ``last0`` and
    ``last1`` name the last line up to it that begins one: if the split begins outside of quotes, and inside.
    """
    own, at, inside, n, last = None, 0, 0, [0, 0], [-1, -1]
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        codes = files.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = (files.dictionary[int(codes[a])].as_py(), int(blocks[a]))
            if key != own:
                own, at, inside, n, last = key, 0, 0, [0, 0], [-1, -1]
            value = batch.column("value").slice(a, b - a)
            quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64) * quoted
            full = pc.invert(pc.is_in(value, pa.array(["", "\r"]))).to_numpy(zero_copy_only=False)
            rows = at + np.arange(b - a)
            parity = (inside + np.cumsum(quotes) - quotes) % 2
            counts, lasts = [], []
            for case in (0, 1):
                begins = (parity == case) & full
                counts.append(n[case] + np.cumsum(begins) - begins)
                lasts.append(np.maximum(np.maximum.accumulate(np.where(parity == case, rows, -1)), last[case]))
                n[case] += int(begins.sum())
                last[case] = int(lasts[case][-1])
            inside, at = int(inside + quotes.sum()) % 2, at + b - a
            made = [rows, (quotes % 2).astype(np.int32), parity.astype(np.int32), *counts, *lasts]
            columns = [batch.column("file").slice(a, b - a), batch.column("block").slice(a, b - a), *map(pa.array, made), value]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "at", "quotes", "inside", "n0", "n1", "last0", "last1", "value"])


def _blank() -> Column:
    return F.col("value").isin("", "\r")


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split: how it began, the record that runs into it, and its first record's number in the whole table."""
    begins = [F.count_if((F.col("inside") == case) & ~_blank()) for case in (0, 1)]
    own = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), *[b.alias(f"n{i}") for i, b in enumerate(begins)], *[F.max(f"last{i}").alias(f"last{i}") for i in (0, 1)]
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    began = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    own = own.select("file", "block", "quotes", began.cast("int").alias("began"), "n0", "n1", "last0", "last1")
    n = F.when(F.col("began") == 0, F.col("n0")).otherwise(F.col("n1"))
    last = F.when(F.col("began") == 0, F.col("last0")).otherwise(F.col("last1"))
    own = own.select("file", "block", "quotes", "began", n.alias("n"), F.when(last >= 0, F.struct("block", last.alias("at"))).alias("last"))
    whole = own.groupBy("file").agg((F.sum("n") - 1).alias("rows"), (F.sum("quotes") % 2).alias("open"))
    message = F.concat(F.lit("a quoted cell is not closed in "), F.col("file"))
    whole = whole.withColumn("rows", F.when(F.col("open") == 0, F.col("rows")).otherwise(F.raise_error(message).cast("bigint")))
    # One row a file in one task; a row is some bytes.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("file", F.coalesce(F.sum(F.greatest("rows", F.lit(0))).over(earlier), F.lit(0)).alias("file_row"))
    numbered = own.select(
        "file", "block", "began", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("split_row"), F.last("last", ignorenulls=True).over(before).alias("running")
    )
    return stage(numbered.join(whole, "file"), "splits")


def csv_records(spark: SparkSession, path: str, quoted: bool = True, prefix: str | None = None) -> DataFrame:
    """``(file, row, header, record)``: the text of every record that is not blank; ``row`` numbers those that are no header from 0.

    Files follow each other in the order of their paths, and rows do not depend on how files are split. With ``quoted`` a record may
    span lines; a quote that is not closed at the end of its file is an error. Without it every line is a record. Quotes inside an
    unquoted cell must come in pairs. Line breaks are ``\\n`` or ``\\r\\n``. With ``prefix`` a file outside of it is an error.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    if prefix:
        read = only_client_files(read, prefix)
    read = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # Splits depend on the cores at hand: this copy fixes them for all that follows.
    lines = stage(read.mapInArrow(lambda batches: _numbered(batches, quoted), _LINE), "lines")
    splits = _splits(lines)
    met = lines.join(splits, ["file", "block"])
    begins = F.col("inside") == F.col("began")
    n = F.when(F.col("began") == 0, F.col("n0")).otherwise(F.col("n1"))
    last = F.when(F.col("began") == 0, F.col("last0")).otherwise(F.col("last1"))
    place = F.when(last >= 0, F.struct("block", last.alias("at"))).otherwise(F.col("running"))
    header = (F.col("split_row") + n == 0) & begins
    row = F.col("file_row") + F.col("split_row") + n - 1
    marked = met.select("file", "block", "at", begins.alias("begins"), header.alias("header"), row.alias("row"), "value", "quotes", place.alias("place"))
    lone = F.col("begins") & (F.col("quotes") == 0)
    whole = marked.where(lone & ~_blank()).select("file", "row", "header", "value")
    if quoted:
        pieces = F.collect_list(F.struct("block", "at", "value"))
        many = F.raise_error(F.concat(F.lit("a record has too many lines in "), F.col("file"))).cast("array<struct<block:bigint,at:bigint,value:string>>")
        longer = marked.where(~lone).groupBy("file", "place").agg(
            F.max(F.when(F.col("begins"), F.col("row"))).alias("row"),
            F.max(F.when(F.col("begins"), F.col("header"))).alias("header"),
            F.when(F.count(F.lit(1)) <= MAX_RECORD_LINES, F.sort_array(pieces)).otherwise(many).alias("pieces"),
        )
        whole = whole.unionByName(longer.select("file", "row", "header", F.array_join("pieces.value", "\n").alias("value")))
    return whole.select("file", "row", "header", F.regexp_replace("value", "\r$", "").alias("record"))


def header_names(records: DataFrame) -> list[str]:
    """The column names that all files share; a file with other names is an error. An empty name is ``_c`` and its place, a repeated one has its place added."""
    found = {tuple(next(csv.reader([r["record"].removeprefix("\ufeff")], strict=False))) for r in records.where("header").select("record").distinct().limit(1000).collect()}
    if not found:
        return []
    if len(found) > 1:
        first, second = sorted(found)[:2]
        raise ValueError(f"files have different headers: {list(first)} and {list(second)}")
    names = list(found.pop())
    low = [x.lower() for x in names]
    return [f"_c{i}" if not x else f"{x}{i}" if low.count(x.lower()) > 1 else x for i, x in enumerate(names)]


def parse_records(records: DataFrame, names: list[str], order: str) -> DataFrame:
    """The cells of the records that are no headers, as text under ``names``, and ``order``."""
    if not names:
        return records.limit(0).select(F.col("row").alias(order))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"escape": '"', "nullValue": "", "emptyValue": "", "multiLine": "true", "maxCharsPerColumn": "-1"}
    cells = F.from_csv("record", schema, options)
    parsed = records.where(~F.col("header")).select(cells.alias("cells"), F.col("row").alias("own_row"))
    return parsed.select(*[F.col("cells").getField(n).alias(n) for n in names], F.col("own_row").alias(order))
