"""Boilerplate lines by their share of a site's pages.

For each site the pages that contain a line are counted, once a page, and divided by the site's pages. Lines above the ratio are
boilerplate and are dropped wherever they stand on that site. Everything is built-in functions: lines travel as 64-bit
hashes with their site, partial counts are made before the shuffle, and no text is moved but to meet its site's list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.tables import free_name, same
from tenura.session import stage

RATIO = 0.02
# A line must be on so many pages of a site at least; on sites of few pages every line has a large share.
LEAST_PAGES = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``(host, lines)``: hashes of each site's boilerplate. A site's list has at most (lines a page) / ratio entries."""
    host = F.col(host_col).alias("host")
    pages = docs.groupBy(host).agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(lines_of(F.col(text_col)), lambda x: F.trim(x) != ""), _key))
    counts = docs.select(host, F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    met = counts.join(pages.withColumnRenamed("host", "_host"), same(F.col("host"), F.col("_host")))
    return met.where(F.col("n") > F.lit(ratio) * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``docs`` with ``text_col`` rebuilt from the lines that stay, and ``n_lines`` and ``n_dropped``.

    Lines are compared without spaces at their ends; blank lines are never dropped. A null text stays null and has no lines. A null
    site is a site. Copies of a line on one page count once. Columns of the two names in ``docs`` are replaced.
    """
    lists = stage(boilerplate(docs, host_col, text_col, ratio, least), "boilerplate")
    held = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")])
    host, drop, kept = (free_name(docs, n) for n in ("_host", "_drop", "_stays"))
    met = held.join(lists.select(F.col("host").alias(host), F.col("lines").alias(drop)), same(F.col(host_col), F.col(host)), "left")
    every = lines_of(F.col(text_col))
    stays = F.when(F.col(drop).isNull(), every).otherwise(F.filter(every, lambda x: ~((F.trim(x) != "") & F.array_contains(drop, _key(x)))))
    n = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(every)).cast("bigint")
    met = met.withColumn("n_lines", n).withColumn(kept, stays)
    dropped = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size(kept)).cast("bigint")
    rebuilt = F.when(F.col(text_col).isNotNull(), F.array_join(kept, "\n"))
    return met.select(*[rebuilt.alias(c) if c == text_col else c for c in held.columns], "n_lines", dropped.alias("n_dropped"))
