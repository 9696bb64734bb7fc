"""Repair a mapped table and report every change.

Order: repeats, numbers, categories, nulls. ``order`` names the column that says which row comes first; it is not
part of the comparison of rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tenura.contract import CATEGORY_SYNONYMS, ID_FIELD, NUMERIC_BOUNDS
from tenura.functions import values as V
from tenura.session import broadcast_if_small, stage

Bounds = dict[str, tuple[float, float]]

# The wording of the report's warnings. Names in braces are columns or texts filled in below.
EXACT_REPEATS = "{exact_repeats} exact duplicate rows"
ID_REPEATS = "{id_repeats} duplicate customer_ids (kept first occurrence)"
REPEATS_WARNING = "Removed {n} duplicates: {kinds} ({pct}% of dataset)."
CRITICAL_WARNING = "CRITICAL: Column '{column}' has {pct}% garbage values (examples: {shown}). This column may be unreliable."
GARBAGE_WARNING = (
    "Column '{column}': {n} values ({pct}%) couldn't be parsed as numbers (examples: {shown}). Converted to NaN — will be imputed later."
)
CAPPED_WARNING = "Column '{column}': {n} outlier values capped to {span} range."
NULLS_WARNING = "Total null values after cleaning: {n} ({pct}% of all cells). These will be filled by imputation in feature engineering."


def _filled(text: str, **cells: Column) -> Column:
    """A text whose names in braces are replaced by the given expressions, or by the columns of those names."""
    parts = [F.lit(x) if i % 2 == 0 else cells[x] if x in cells else F.col(x) for i, x in enumerate(re.split(r"[{}]", text))]
    return F.concat(*parts)


def _keys(df: DataFrame, keys: Sequence[str] | None) -> list[str]:
    """The columns that identify a customer: the id, and the client where the table holds several."""
    return list(keys) if keys is not None else [*(["client_id"] if "client_id" in df.columns else []), ID_FIELD]


# --- repeats ---------------------------------------------------------------------------------------------------


def drop_exact_repeats(df: DataFrame, order: str = "src_row") -> DataFrame:
    """CLN-1: one row, the earliest, of every set of equal rows. Copies collapse before the shuffle."""
    cells = [c for c in df.columns if c != order]
    return df.groupBy(*cells).agg(F.min(order).alias(order)).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str] | None = None, order: str = "src_row") -> DataFrame:
    """CLN-2: the earliest row per id, and per client where there is a ``client_id``; null ids count as one id. Without the id column nothing happens.

    Equal rows share their id, so this alone also does the work of CLN-1 on tables that have the id. Ids that repeat are counted
    first, on their column alone; rows of other ids stay where they are, and only rows of these are ordered. ``df`` is read twice.
    """
    keys = _keys(df, keys)
    if not set(keys) <= set(df.columns):
        return df
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    again = stage(counts.select(*[F.col(k).alias(f"_again_{i}") for i, k in enumerate(keys)]), "repeats")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_again_{i}")) for i, k in enumerate(keys)])
    # Each task keeps its own first row of an id before the shuffle, so a hot id is no burden.
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    kept = df.join(again, match, "left_semi").withColumn("_place", first).filter(F.col("_place") == 1).drop("_place")
    return df.join(again, match, "left_anti").unionByName(kept)


def remove_repeats(df: DataFrame, keys: Sequence[str] | None = None, order: str = "src_row") -> DataFrame:
    """CLN-1 then CLN-2, in one shuffle where the id column allows it."""
    keys = _keys(df, keys)
    return keep_first(df, keys, order) if set(keys) <= set(df.columns) else drop_exact_repeats(df, order)


def counted_repeats(df: DataFrame, keys: Sequence[str] | None = None, order: str = "src_row") -> DataFrame:
    """CLN-1, CLN-2 with the counts of CLN-3 in one pass: kept rows plus ``_rows`` and ``_distinct``, the number of
    rows and of distinct rows that each of them stands for."""
    keys = _keys(df, keys)
    cells = [c for c in df.columns if c != order]
    distinct_rows = df.groupBy(*cells).agg(F.min(order).alias(order), F.count("*").alias("_rows"))
    if not set(keys) <= set(df.columns):
        return distinct_rows.select(*df.columns, "_rows", F.lit(1).cast("bigint").alias("_distinct"))
    rest = [c for c in df.columns if c not in keys]
    kept = distinct_rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), order).alias("_row"), F.sum("_rows").alias("_rows"), F.count("*").alias("_distinct")
    )
    return kept.select(*keys, "_row.*", "_rows", "_distinct").select(*df.columns, "_rows", "_distinct")


def repeat_counts(df: DataFrame, keys: Sequence[str] | None = None, order: str = "src_row") -> DataFrame:
    """CLN-3: one row ``(rows_before, exact_repeats, id_repeats, repeats, pct_of_rows, rows_after)``."""
    keys = _keys(df, keys)
    cells = [c for c in df.columns if c != order]
    distinct_rows = df.groupBy(*cells).agg(F.count("*").alias("_rows"))
    if set(keys) <= set(df.columns):
        kept = distinct_rows.groupBy(*keys).agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_distinct"))
    else:
        kept = distinct_rows.withColumn("_distinct", F.lit(1).cast("bigint"))
    return repeat_totals(kept)


def repeat_totals(kept: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """CLN-3 from kept rows that carry ``_rows`` and ``_distinct``, in all or per group."""
    total = kept.groupBy(*group).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("_distinct"), F.lit(0)).alias("rows_distinct"),
        F.count("*").alias("rows_after"),
    )
    gone = F.col("rows_before") - F.col("rows_after")
    return total.select(
        *group,
        "rows_before",
        (F.col("rows_before") - F.col("rows_distinct")).alias("exact_repeats"),
        (F.col("rows_distinct") - F.col("rows_after")).alias("id_repeats"),
        gone.alias("repeats"),
        V.round_to(F.coalesce(V.percent(gone, F.col("rows_before")), F.lit(0.0)), 1).alias("pct_of_rows"),
        "rows_after",
    )


# --- numbers ---------------------------------------------------------------------------------------------------


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def parse_numbers(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_BOUNDS)) -> DataFrame:
    """CLN-4: the numeric fields as double, garbage as null."""
    return df.select(*[V.to_number(F.col(n), t).alias(n) if n in columns else F.col(n) for n, t in _types(df).items()])


def cap_numbers(df: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """CLN-7: numbers held to the bounds of their field; ``_lo_``/``_hi_`` columns, where present, take precedence."""
    bounds = NUMERIC_BOUNDS if bounds is None else bounds
    return df.select(*[capped(c, bounds, df.columns).alias(c) if c in bounds else F.col(c) for c in df.columns])


def capped(name: str, bounds: Bounds, columns: Sequence[str]) -> Column:
    return V.clip(F.col(name), *limits(name, bounds, columns))


def limits(name: str, bounds: Bounds, columns: Sequence[str]) -> tuple[Column, Column]:
    low, high = (F.lit(float(b)) for b in bounds[name])
    if f"_lo_{name}" in columns:
        low, high = F.coalesce(f"_lo_{name}", low), F.coalesce(f"_hi_{name}", high)
    return low, high


def with_client_bounds(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add each client's own limits (catalog rows of kind ``bound``) as ``_lo_``/``_hi_`` columns for CLN-7."""
    own = catalog.filter((F.col("kind") == "bound") & (F.col("status") == "approved"))
    per_client = own.groupBy("client_id").agg(
        *[
            F.max(F.when(F.col("field") == c, F.col(side).try_cast("double"))).alias(f"{tag}{c}")
            for c in NUMERIC_BOUNDS
            for side, tag in (("from_value", "_lo_"), ("to_value", "_hi_"))
        ]
    )
    return df.join(broadcast_if_small(per_client), "client_id", "left")


# --- categories ------------------------------------------------------------------------------------------------


def standard_category(c: Column, name: str) -> Column:
    """CLN-8 as an expression: a known spelling becomes its standard value, others stay, null stays."""
    return F.coalesce(V.lookup(V.strip_lower(c), CATEGORY_SYNONYMS[name]), c)


def normalize_categories(df: DataFrame) -> DataFrame:
    """CLN-8 on a table."""
    return df.select(*[standard_category(F.col(c).cast("string"), c).alias(c) if c in CATEGORY_SYNONYMS else F.col(c) for c in df.columns])


# --- issues ----------------------------------------------------------------------------------------------------


def issue_counts(
    df: DataFrame,
    cap: bool = True,
    categories: bool = True,
    bounds: Bounds | None = None,
    group: Sequence[str] = (),
    order: str = "src_row",
) -> DataFrame:
    """Everything the report needs: plain counts from one aggregate, values that were garbage or changed from another.

    ``(kind, column, value, new_value, n, first_row)`` with kinds ``row``, ``garbage`` (value), ``capped``,
    ``changed`` (value, new_value) and ``null`` (after cleaning). ``df`` has had its repeats removed. Tasks count
    before the shuffle, so a frequent value costs one row per task. The reports below each read this table; stage it.
    """
    bounds = NUMERIC_BOUNDS if bounds is None else bounds
    totals = {("row", ""): F.count("*")}
    values = []
    for name, dtype in _types(df).items():
        c = F.col(name)
        if name == order or name in group or name.startswith(("_lo_", "_hi_")):
            continue
        if name in bounds:
            number = V.to_number(c, dtype)
            totals["null", name] = F.count_if(number.isNull())
            if cap:
                low, high = limits(name, bounds, df.columns)
                totals["capped", name] = F.count_if((number < low) | (number > high))
            if not V.is_numeric(dtype):
                values.append(_found(c.isNotNull() & number.isNull(), name, V.to_text(c, dtype)))
            continue
        totals["null", name] = F.count_if(~V.present(c, dtype))
        if name in CATEGORY_SYNONYMS and categories:
            text = c.cast("string")
            values.append(_found(text != standard_category(text, name), name, text))
    none_text, none_row = F.lit(None).cast("string"), F.lit(None).cast(df.schema[order].dataType)
    wide = df.groupBy(*group).agg(*[n.alias(f"n{i}") for i, n in enumerate(totals.values())])
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n")) for i, (k, c) in enumerate(totals)]
    counts = wide.select(*group, F.inline(F.array(*rows))).filter((F.col("n") > 0) | (F.col("kind") == "row"))
    counts = counts.select(*group, "kind", "column", none_text.alias("value"), none_text.alias("new_value"), "n", none_row.alias("first_row"))
    if not values:
        return counts
    seen = df.select(*group, F.col(order).alias("_row"), F.explode(F.array(*values)).alias("v")).filter(F.col("v").isNotNull())
    seen = seen.select(*group, "_row", "v.*").groupBy(*group, "column", "value").agg(F.count("*").alias("n"), F.min("_row").alias("first_row"))
    kind = F.when(F.col("column").isin(list(bounds)), "garbage").otherwise("changed")
    new = none_text
    for name in CATEGORY_SYNONYMS:  # once per distinct spelling, not per row
        new = F.when(F.col("column") == name, standard_category(F.col("value"), name)).otherwise(new)
    return counts.unionByName(seen.select(*group, kind.alias("kind"), "column", "value", new.alias("new_value"), "n", "first_row"))


def _found(test: Column, column: str, value: Column) -> Column:
    return F.when(test, F.struct(F.lit(column).alias("column"), value.alias("value")))


def _with_rows(df: DataFrame, issues: DataFrame, group: Sequence[str]) -> DataFrame:
    totals = issues.filter(F.col("kind") == "row")
    if group:
        return df.join(totals.select(*group, F.col("n").alias("rows_left")), list(group))
    return df.withColumn("rows_left", totals.agg(F.sum("n")).scalar())


def garbage_profile(
    issues: DataFrame, max_garbage: float = 0.50, examples: int = 5, group: Sequence[str] = ()
) -> DataFrame:
    """CLN-5, CLN-6: per numeric column the count, share, first distinct examples and severity of its garbage."""
    group = list(group)
    garbage = issues.filter(F.col("kind") == "garbage")
    by_first = Window.partitionBy(*group, "column").orderBy("first_row")
    shown = garbage.withColumn("at", F.row_number().over(by_first)).filter(F.col("at") <= examples)
    shown = shown.groupBy(*group, "column").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("e"))
    counts = garbage.groupBy(*group, "column").agg(F.sum("n").alias("n"))
    pct = V.percent(F.col("n"), F.col("rows_left"))
    return _with_rows(counts, issues, group).join(shown, [*group, "column"]).select(
        *group,
        "column",
        "n",
        V.round_to(pct, 1).alias("pct"),
        F.transform("e", lambda x: x["value"]).alias("examples"),
        F.when(pct > max_garbage * 100, "CRITICAL").otherwise("NOTE").alias("severity"),
    )


def cap_counts(issues: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """CLN-7, the count: capped values per column."""
    return issues.filter(F.col("kind") == "capped").groupBy(*group, "column").agg(F.sum("n").alias("n"))


def category_changes(issues: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """CLN-9: which spelling became which value, and how often."""
    return issues.filter(F.col("kind") == "changed").select(*group, "column", "value", "new_value", "n")


def null_counts(issues: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """CLN-10: nulls per column after cleaning, columns without any left out, with their share of the rows."""
    nulls = issues.filter(F.col("kind") == "null").groupBy(*group, "column").agg(F.sum("n").alias("n"))
    return _with_rows(nulls, issues, group).select(*group, "column", "n", V.round_to(V.percent(F.col("n"), F.col("rows_left")), 1).alias("pct"))


def null_total(issues: DataFrame, n_columns: int, group: Sequence[str] = ()) -> DataFrame:
    """CLN-11: all nulls and their share of all cells."""
    is_null, is_row = F.col("kind") == "null", F.col("kind") == "row"
    totals = issues.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(is_null, F.col("n"))), F.lit(0)).alias("n"), F.sum(F.when(is_row, F.col("n"))).alias("rows_left")
    )
    cells = F.col("rows_left") * n_columns
    return totals.select(*group, "n", V.round_to(F.coalesce(V.percent(F.col("n"), cells), F.lit(0.0)), 1).alias("pct"))


# --- report ----------------------------------------------------------------------------------------------------


def _python_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, V.quoted), ", "), F.lit("]"))


def cleaning_report(
    repeats: DataFrame | None, issues: DataFrame, n_columns: int, max_garbage: float = 0.50, bounds: Bounds | None = None, group: Sequence[str] = ()
) -> DataFrame:
    """CLN-12, CLN-13: the whole report as ``(section, column, item, n, pct, message)``, led by the columns of ``group``.

    Sections ``repeats``, ``garbage``, ``capped``, ``changed``, ``nulls`` and ``total_nulls``. ``message`` holds the
    warning, where there is one.
    """
    bounds = NUMERIC_BOUNDS if bounds is None else bounds
    none_text, none_pct = F.lit(None).cast("string"), F.lit(None).cast("double")

    def rows(df: DataFrame, section: str, column="column", item=none_text, pct=none_pct, message=none_text) -> DataFrame:
        column = F.col(column) if isinstance(column, str) else column
        return df.select(
            *group, F.lit(section).alias("section"), column.alias("column"), item.alias("item"), F.col("n"), pct.alias("pct"), message.alias("message")
        )

    parts = []
    if repeats is not None:
        r = repeats.filter(F.col("repeats") > 0).withColumnRenamed("repeats", "n")
        exact = F.when(F.col("exact_repeats") > 0, _filled(EXACT_REPEATS))
        ids = F.when(F.col("id_repeats") > 0, _filled(ID_REPEATS))
        pct = V.fixed_text(V.percent(F.col("n"), F.col("rows_before")), 1)
        text = _filled(REPEATS_WARNING, kinds=F.concat_ws(", ", exact, ids), pct=pct)
        parts.append(rows(r, "repeats", F.lit("").alias("column"), pct=F.col("pct_of_rows"), message=text))
    g = garbage_profile(issues, max_garbage, group=group)
    shown, pct_text = _python_list(F.slice("examples", 1, 3)), V.fixed_text(F.col("pct"), 1)
    loud = _filled(CRITICAL_WARNING, pct=pct_text, shown=shown)
    quiet = _filled(GARBAGE_WARNING, pct=pct_text, shown=shown)
    message = F.when(F.col("severity") == "CRITICAL", loud).otherwise(quiet)
    parts.append(rows(g, "garbage", item=F.array_join("examples", " | "), pct=F.col("pct"), message=message))
    span = {c: f"[{_plain(lo)}, {_plain(hi)}]" for c, (lo, hi) in bounds.items()}
    text = _filled(CAPPED_WARNING, span=V.lookup(F.col("column"), span))
    parts.append(rows(cap_counts(issues, group), "capped", message=text))
    parts.append(rows(category_changes(issues, group), "changed", item=F.concat_ws(" -> ", "value", "new_value")))
    parts.append(rows(null_counts(issues, group), "nulls", pct=F.col("pct")))
    total = null_total(issues, n_columns, group).filter(F.col("n") > 0)
    text = _filled(NULLS_WARNING, pct=V.fixed_text(F.col("pct"), 1))
    parts.append(rows(total, "total_nulls", F.lit("").alias("column"), pct=F.col("pct"), message=text))
    return reduce(DataFrame.unionByName, parts)


def _plain(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def clean_values(df: DataFrame, cap: bool = True, categories: bool = True, bounds: Bounds | None = None) -> DataFrame:
    """CLN-4, CLN-7, CLN-8: the narrow part of cleaning."""
    bounds = NUMERIC_BOUNDS if bounds is None else bounds
    out = parse_numbers(df, tuple(bounds))
    if cap:
        out = cap_numbers(out, bounds)
    if categories:
        out = normalize_categories(out)
    return out.drop(*[c for c in out.columns if c.startswith(("_lo_", "_hi_"))])


def clean_table(
    df: DataFrame,
    repeats: bool = True,
    cap: bool = True,
    categories: bool = True,
    max_garbage: float = 0.50,
    bounds: Bounds | None = None,
    keys: Sequence[str] | None = None,
    order: str = "src_row",
    group: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """CLN-12: the cleaned table and its report; with ``group`` (such as ``client_id``) a report for each group in one job.

    ``df`` is read once: the rows left after the repeats are staged with their counts, the issues are counted from
    that copy and staged too, and the table is a projection of it. ``clean_rows`` gives the table without a report.
    """
    kept = stage(counted_repeats(df, keys, order) if repeats else df, "kept")
    left = kept.select(*df.columns)
    issues = stage(issue_counts(left, cap, categories, bounds, group, order), "issues")
    n_columns = len([c for c in df.columns if c != order and c not in group])
    report = cleaning_report(repeat_totals(kept, group) if repeats else None, issues, n_columns, max_garbage, bounds, group)
    return clean_values(left, cap, categories, bounds), report


def clean_rows(
    df: DataFrame,
    repeats: bool = True,
    cap: bool = True,
    categories: bool = True,
    bounds: Bounds | None = None,
    keys: Sequence[str] | None = None,
    order: str = "src_row",
) -> DataFrame:
    """CLN-12 without the report: lazy, one shuffle."""
    return clean_values(remove_repeats(df, keys, order) if repeats else df, cap, categories, bounds)
