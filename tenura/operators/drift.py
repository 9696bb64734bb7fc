"""Population stability of later batches against the training distributions.

Values travel as ``(feature, value)`` rows; with ``group`` (such as ``client_id``) they carry those columns too, and every group
has its own ranges, counts and report in the same job. Every step aggregates per (feature, bin) inside the tasks first, so what is
shuffled is a handful of counts per feature and task, whatever the share of one feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.session import broadcast_if_small, stage

BINS = 10
FLOOR = 1e-6
THRESHOLD = 0.2
LEAST_VALUES = 10


def long_values(df: DataFrame, features: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Columns of a table as ``(feature, value)`` rows without nulls and NaN; features the table lacks are skipped."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features if c in df.columns]
    return clean_values(df.select(*group, F.inline(F.array(*pairs))))


def clean_values(values: DataFrame) -> DataFrame:
    return values.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def bin_edges(least: Column, most: Column, bins: int = BINS) -> Column:
    """DRF-1: the inner edges of equal-width bins; the first and last bin are open."""
    step = (most - least) / F.lit(float(bins))
    return F.array(*[least + F.lit(float(i)) * step for i in range(1, bins)])


def bin_of(value: Column, edges: Column, bins: int = BINS) -> Column:
    """DRF-2: 0-based bin, ``[a, b)``."""
    at = F.lit(0)
    for i in range(bins - 1):
        at = at + F.when(value >= edges[i], 1).otherwise(0)
    return at


def bin_ranges(values: DataFrame, bins: int = BINS, group: Sequence[str] = ()) -> DataFrame:
    """DRF-1 per feature: ``(feature, n, least, most, edges)``."""
    ends = values.groupBy(*group, "feature").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    return ends.withColumn("edges", bin_edges(F.col("least"), F.col("most"), bins))


def histogram(values: DataFrame, ranges: DataFrame, bins: int = BINS, group: Sequence[str] = ()) -> DataFrame:
    """DRF-2 per feature of ``ranges``: ``(feature, bin, n, least, most)``; features without a range drop out.

    ``ranges`` has one row per group and feature; it is broadcast while its counted size allows, as its few keys would
    make few and uneven partitions otherwise.
    """
    keys = [*group, "feature"]
    edges = broadcast_if_small(ranges.select(*keys, "edges"))
    binned = values.join(edges, keys).select(*keys, bin_of(F.col("value"), F.col("edges"), bins).alias("bin"), "value")
    return binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def _bin_counts(hist: DataFrame, bins: int, group: Sequence[str] = ()) -> DataFrame:
    """One row per group and feature: total, ends, and counts of all bins, empty ones as 0."""
    each = [F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(bins)]
    return hist.groupBy(*group, "feature").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.array(*each).alias("counts")
    )


def training_snapshot(values: DataFrame, bins: int = BINS, group: Sequence[str] = ()) -> DataFrame:
    """DRF-8: what later checks need of the training values: ``(feature, n, least, most, edges, counts)``, staged.

    Reads ``values`` twice: once for the ranges, once for the counts.
    """
    ranges = stage(bin_ranges(clean_values(values), bins, group), "ranges")
    counts = _bin_counts(histogram(clean_values(values), ranges, bins, group), bins, group)
    return stage(counts.withColumn("edges", bin_edges(F.col("least"), F.col("most"), bins)), "snapshot")


def psi(ref_counts: Column, ref_n: Column, cur_counts: Column, cur_n: Column) -> Column:
    """DRF-3: sum over bins of ``(c - r) * ln(c / r)`` with shares held above a small floor."""

    def share(counts: Column, n: Column) -> Column:
        return F.transform(counts, lambda k: F.greatest(k.cast("double") / n.cast("double"), F.lit(FLOOR)))

    terms = F.zip_with(share(ref_counts, ref_n), share(cur_counts, cur_n), lambda r, c: (c - r) * F.ln(c / r))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def psi_scores(snapshot: DataFrame, current: DataFrame, bins: int = BINS, group: Sequence[str] = ()) -> DataFrame:
    """DRF-3, DRF-4, DRF-5: PSI per feature found on both sides with enough values.

    A constant reference gives 0 when the current values are that constant, else 0.25.
    """
    now = _bin_counts(histogram(clean_values(current), snapshot, bins, group), bins, group)
    now = now.select(*group, "feature", *[F.col(c).alias(f"cur_{c}") for c in ("n", "least", "most", "counts")])
    both = snapshot.join(now, [*group, "feature"]).filter((F.col("n") >= LEAST_VALUES) & (F.col("cur_n") >= LEAST_VALUES))
    same = (F.col("cur_least") == F.col("least")) & (F.col("cur_most") == F.col("least"))
    constant = F.when(same, 0.0).otherwise(0.25)
    score = F.when(F.col("least") == F.col("most"), constant).otherwise(psi(F.col("counts"), F.col("n"), F.col("cur_counts"), F.col("cur_n")))
    return both.select(*group, "feature", F.col("n").alias("n_reference"), F.col("cur_n").alias("n_current"), score.alias("psi"))


def flagged(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """DRF-5: ``drifted`` when PSI is above the threshold, not at it."""
    return scores.withColumn("drifted", F.col("psi") > threshold)


def psi_band(score: Column) -> Column:
    """DRF-7: below 0.1 stable, up to and including 0.2 moderate, above it significant."""
    return F.when(score < 0.1, "stable").when(score <= THRESHOLD, "moderate").otherwise("significant")


def banded(scores: DataFrame) -> DataFrame:
    """DRF-7: with the band, worst first."""
    return scores.withColumn("band", psi_band(F.col("psi"))).orderBy(F.desc("psi"), "feature")


def drift_report(scores: DataFrame, run_date: str, threshold: float = THRESHOLD, group: Sequence[str] = ()) -> DataFrame:
    """DRF-6: one row, or one for each group; its lists are as long as the list of features."""
    marked = flagged(scores, threshold)
    return marked.groupBy(*group).agg(
        F.lit(run_date).alias("run_date"),
        F.count("*").alias("features_checked"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("features_drifted"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "psi")))).alias("psi_scores"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("alert_triggered"),
    )
