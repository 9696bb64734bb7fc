"""Exact ranks, running totals and medians without a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tenura.session import stage


# Rows of one range, at which a larger table gets more ranges.
RANGE_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Sequence[str],
    group: Sequence[str] = (),
    partitions: int | None = None,
    small: int = 100_000,
) -> DataFrame:
    """Add ``before_<c>``: the sum of ``c`` over earlier rows of the same group, in the given order.

    A table of at most ``small`` rows takes a plain window. A larger one is range-partitioned on (group, order) and
    sorted there, and each task sums along its range as it is staged, so a group of any size spreads over many tasks and moves
    once. The sums of earlier ranges, one row per range, are added on reading. The order columns must tell the rows of a group apart.
    """
    group, order, totals = list(group), list(order), list(totals)
    spark = df.sparkSession
    df = stage(df, "totals")
    if df.limit(small + 1).count() <= small:
        prior = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*df.columns, *[F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(f"before_{c}") for c in totals])
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    told = df.select(*df.columns, F.to_json(F.struct(*group)).alias("_group") if group else F.lit("").alias("_group"))
    sorted_ = told.repartitionByRange(parts, *group, *order).sortWithinPartitions(*group, *order).withColumn("_range", F.spark_partition_id())
    schema = T.StructType([*sorted_.schema.fields, *[T.StructField(f"_in_{c}", T.DoubleType() if kinds[c] in ("double", "float") else T.LongType()) for c in totals]])
    ranged = stage(sorted_.mapInArrow(lambda batches: _summed_along(batches, totals), schema), "ranged")
    # At most one row per range plus one per group: a group only shares the first and last of its ranges.
    sums = ranged.groupBy("_group", "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_group").alias("_k_group"), F.col("_range").alias("_k_range"), *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_off_{c}") for c in totals])
    # Only ranges that go on with a group have something to add.
    offsets = stage(offsets.filter(" OR ".join(f"_off_{c} <> 0" for c in totals)), "offsets")
    joined = ranged.join(offsets, (F.col("_group") == F.col("_k_group")) & (F.col("_range") == F.col("_k_range")), "left")
    return joined.select(*df.columns, *[(F.coalesce(F.col(f"_off_{c}"), F.lit(0)) + F.col(f"_in_{c}")).alias(f"before_{c}") for c in totals])


def _summed_along(batches, totals: Sequence[str]):
    """Task step over sorted rows: ``_in_<c>``, the sum of ``c`` over the earlier rows of the group in this range. Nulls add nothing."""
    last, carried = None, [0] * len(totals)
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("_group").dictionary_encode()
        codes = names.indices.to_numpy()
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        first, made = names.dictionary[int(codes[0])].as_py(), []
        for i, c in enumerate(totals):
            column = pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False)
            kind = np.float64 if column.dtype.kind == "f" else np.int64
            values = column.astype(kind)
            before = np.cumsum(values) - values
            base = np.zeros(len(starts), kind)
            base[:] = before[starts]
            if first == last:
                base[0] -= carried[i]
            inside = before - np.repeat(base, np.diff(starts, append=len(values)))
            made.append(pa.array(inside))
            carried[i] = (inside[-1] + values[-1]).item()
        last = names.dictionary[int(codes[-1])].as_py()
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f"_in_{c}" for c in totals]])


def global_rank(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "rank", **how) -> DataFrame:
    """Exact 1-based position of each row in the given order, whole table or per group."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(ones, order, ["_one"], group, **how)
    return ranked.select(*df.columns, (F.col("before__one") + 1).alias(name))


# Slots per refinement pass of the median search; a pass returns at most this many rows per column.
SLOTS = 4096


def _scale_slot(x: Column) -> Column:
    """A slot that never falls as ``x`` grows: sign and power of two."""
    power = F.floor(F.least(F.greatest(F.log2(F.abs(x)), F.lit(-1080.0)), F.lit(1025.0))).cast("bigint")
    return F.when(x > 0, power + 2000).when(x < 0, -power - 2000).otherwise(F.lit(0))


def _stacked(df: DataFrame, columns: Sequence[str], slots: dict[str, Column]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), slots[c].alias("slot"), F.col(c).cast("double").alias("x")) for c in columns]
    return df.select(F.inline(F.array(*rows))).filter(F.col("x").isNotNull() & ~F.isnan("x"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Per column: count, least, greatest and exact interpolated median of the values that are not null or NaN.

    Each pass is one aggregate over the pruned columns that returns counts per slot, at most ``SLOTS`` rows a column.
    The slot holding the middle is narrowed until one value is left, so no task ever holds the values themselves.
    """
    columns = list(columns)
    out = {c: {"n": 0, "min": None, "max": None, "median": None} for c in columns}
    slots = {c: _scale_slot(F.col(c).cast("double")) for c in columns}
    skipped = dict.fromkeys(columns, 0)
    open_columns = columns
    first = True
    while open_columns:
        counts = _stacked(df, open_columns, slots).filter(F.col("slot").isNotNull())
        counts = counts.groupBy("column", "slot").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        found: dict[str, list] = {c: [] for c in open_columns}
        for row in counts.collect():
            found[row["column"]].append(row)
        still_open = []
        for c in open_columns:
            buckets = sorted(found[c], key=lambda r: r["slot"])
            if first and buckets:
                out[c].update(n=sum(b["n"] for b in buckets), min=buckets[0]["lo"], max=buckets[-1]["hi"])
            if not buckets:
                continue
            total = out[c]["n"]
            want_low, want_high = (total - 1) // 2, total // 2
            at = skipped[c]
            for i, b in enumerate(buckets):
                if want_low < at + b["n"]:
                    break
                at += b["n"]
            if want_high >= at + b["n"]:
                low, high = b["hi"], buckets[i + 1]["lo"]
            elif b["lo"] == b["hi"]:
                low = high = b["lo"]
            else:
                skipped[c] = at
                x, lo, hi = F.col(c).cast("double"), F.lit(b["lo"]), F.lit(b["hi"])
                share = (x - lo) / F.lit(b["hi"] - b["lo"])
                slots[c] = F.when((x >= lo) & (x <= hi), F.floor(share * float(SLOTS - 1)).cast("bigint"))
                still_open.append(c)
                continue
            out[c]["median"] = low if low == high else low + (high - low) * 0.5
        open_columns, first = still_open, False
    return out


def group_summary(df: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """``(group, column, n, min, max, median)`` of the values that are not null or NaN, for all groups together.

    As ``numeric_summary``, but the bounds of the slots are a table with a row per group and column that each pass joins, so that
    groups may be many. A pass returns at most ``SLOTS`` rows a group and column. Groups and columns without values have no row.
    """
    group = list(group)
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    stacked = df.select(*group, F.inline(F.array(*rows))).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    slotted = stacked.withColumn("slot", _scale_slot(F.col("x")))
    whole = Window.partitionBy(*group, "column")
    total = F.sum("n").over(whole)
    counts = _slot_counts(slotted, group).withColumns({"total": total, "skipped": F.lit(0).cast("bigint")})
    counts = counts.withColumns({"min": F.min("lo").over(whole), "max": F.max("hi").over(whole)})
    found, done = _middle(counts, group), []
    while True:
        found = stage(found, "medians")
        done.append(found.where("median IS NOT NULL"))
        still = found.where("median IS NULL")
        if not still.limit(1).count():
            break
        bounds = still.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("column").alias("_column"), "total", "skipped", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "min", "max")
        match = (F.col("column") == F.col("_column")) & (F.col("x") >= F.col("_lo")) & (F.col("x") <= F.col("_hi"))
        for g in group:
            match = match & F.col(g).eqNullSafe(F.col(f"_{g}"))
        share = (F.col("x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        inside = stacked.join(bounds, match).withColumn("slot", F.floor(share * float(SLOTS - 1)).cast("bigint"))
        found = _middle(_slot_counts(inside, group, ["total", "skipped", "min", "max"]), group)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*group, "column", F.col("total").alias("n"), "min", "max", "median")


def _slot_counts(slotted: DataFrame, group: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    return slotted.groupBy(*group, "column", "slot", *carried).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))


def _middle(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group and column the slot that holds the middle: with the median if it is told by now, else with the rows before the slot."""
    upto = Window.partitionBy(*group, "column").orderBy("slot")
    end = F.col("skipped") + F.sum("n").over(upto)
    placed = counts.withColumns({"_end": end, "_next": F.lead("lo").over(upto)})
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    held = placed.filter((F.col("_end") > low) & (F.col("_end") - F.col("n") <= low))
    between = F.col("hi") + (F.col("_next") - F.col("hi")) * 0.5
    median = F.when(high >= F.col("_end"), F.when(F.col("hi") == F.col("_next"), F.col("hi")).otherwise(between)).when(F.col("lo") == F.col("hi"), F.col("lo"))
    return held.select(*group, "column", "total", (F.col("_end") - F.col("n")).alias("skipped"), "lo", "hi", "min", "max", median.alias("median"))


def slot_counts(hashed: DataFrame, group: Sequence[str], key: str, prefix: int = 4) -> DataFrame:
    """Rows per (group, leading digits of the hex ``key``): at most 16**prefix rows a group, staged."""
    slot = F.substring(key, 1, prefix).alias("_slot")
    return stage(hashed.groupBy(*group, slot).agg(F.count("*").alias("_n")), "slots")


def order_cuts(hashed: DataFrame, slots: DataFrame, group: Sequence[str], key: str, cuts: DataFrame, prefix: int = 4) -> DataFrame:
    """``(group, name, cut_key)``: for every row ``(group, name, cut)`` of ``cuts`` the ``key`` of rank ``cut`` in its group.

    ``slots`` comes from ``slot_counts``, which says in which slot a rank lies; only the rows of those slots, one in
    16**prefix, are then shuffled and ordered. ``group`` holds no nulls, cuts below 1 have no key.
    """
    group = list(group)
    upto = Window.partitionBy(*group).orderBy("_slot")
    ranges = slots.withColumn("_end", F.sum("_n").over(upto))
    below = F.col("_end") - F.col("_n")
    held = ranges.join(cuts, group).filter((F.col("cut") <= F.col("_end")) & (F.col("cut") > below))
    # A slot is asked for as many ranks as there are cuts, a handful.
    wanted = held.groupBy(*group, "_slot").agg(F.collect_list(F.struct("name", (F.col("cut") - below).alias("at"))).alias("_asked"))
    slotted = hashed.select(*group, F.col(key).alias("cut_key"), F.substring(key, 1, prefix).alias("_slot"))
    hits = slotted.join(wanted.select(*group, "_slot"), [*group, "_slot"], "left_semi")
    # Equal keys count as one entry of that many ranks, so that a repeated key is no burden.
    entries = hits.groupBy(*group, "_slot", "cut_key").agg(F.count("*").alias("_n"))
    in_slot = Window.partitionBy(*group, "_slot").orderBy("cut_key")
    placed = entries.withColumn("_end", F.sum("_n").over(in_slot)).join(wanted, [*group, "_slot"])
    asked = placed.select(*group, "cut_key", "_n", "_end", F.inline("_asked"))
    return asked.filter((F.col("at") <= F.col("_end")) & (F.col("at") > F.col("_end") - F.col("_n"))).select(*group, "name", "cut_key")
