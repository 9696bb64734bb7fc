"""Check tables against the contract: presence by tier, numeric text, allowed values, and the verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.contract import CONTRACT, REQUIRED, ContractField, contract_table
from tenura.functions import values as V


def field_presence(tables: DataFrame, fields: list[ContractField] | None = None, table: str = "table_name") -> DataFrame:
    """VAL-2 for many tables: ``tables`` is ``(table, column_name)``, a null column standing for a table without any.

    One row per table and contract field, with ``present``.
    """
    contract = contract_table(tables.sparkSession, fields)
    wanted = contract.select("pos", "field", "dtype", "tier", "allowed")
    fields_of = tables.groupBy(table, "column_name").agg(F.lit(1).alias("_one"))
    known = fields_of.join(F.broadcast(wanted.select("field")), F.col("column_name") == F.col("field"), "left")
    names = known.groupBy(table).agg(F.collect_set("field").alias("_have"))  # contract fields only
    every = names.select(table, "_have", F.inline(_literal_fields(fields)))
    return every.select(table, "pos", "field", "dtype", "tier", F.array_contains("_have", F.col("field")).alias("present"))


def _literal_fields(fields: list[ContractField] | None):
    rows = [
        F.struct(F.lit(i).alias("pos"), F.lit(c.field).alias("field"), F.lit(c.dtype).alias("dtype"), F.lit(c.tier).alias("tier"))
        for i, c in enumerate(fields or CONTRACT)
    ]
    return F.array(*rows)


def verdicts(presence: DataFrame, row_counts: DataFrame | None = None, table: str = "table_name") -> DataFrame:
    """VAL-3, VAL-4: a table is valid when it has rows and no required field is missing; types do not matter."""
    counted = presence
    if row_counts is not None:
        counted = presence.join(row_counts, table, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    else:
        counted = presence.withColumn("n_rows", F.lit(1).cast("bigint"))
    missing = (F.col("n_rows") == 0) | ~F.col("present")
    required = F.col("tier") == REQUIRED
    return counted.groupBy(table).agg(
        (F.count_if(missing & required) == 0).alias("is_valid"),
        F.count_if(missing & required).alias("n_required_missing"),
        F.count_if(missing).alias("n_missing"),
        F.max(F.when(F.col("n_rows") == 0, "DataFrame is empty (0 rows)")).alias("error"),
    )


def bad_number_counts(df: DataFrame, fields: list[ContractField] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """VAL-5: values per numeric field that are there but do not parse, from one aggregate; typed columns cannot fail."""
    types = {f.name: f.dataType for f in df.schema}
    checks = [c.field for c in fields or CONTRACT if c.dtype in ("int", "float") and c.field in types]
    counts = df.groupBy(*group).agg(
        *[F.count_if(V.present(F.col(c), types[c]) & V.to_number(F.col(c), types[c]).isNull()).alias(c) for c in checks]
    )
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).alias("n_bad")) for c in checks]
    return counts.select(*group, F.inline(F.array(*pairs)))


def bad_values(df: DataFrame, fields: list[ContractField] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """VAL-6: every distinct value outside a field's allowed list, with its count; counted before the shuffle."""
    checks = [c for c in fields or CONTRACT if c.dtype == "category" and c.allowed and c.field in df.columns]
    pairs = [
        F.when(
            F.col(c.field).isNotNull() & ~F.col(c.field).cast("string").isin(c.allowed),
            F.struct(F.lit(c.field).alias("field"), F.col(c.field).cast("string").alias("value")),
        )
        for c in checks
    ]
    if not pairs:
        return df.limit(0).select(*group, F.lit("").alias("field"), F.lit("").alias("value"), F.lit(0).cast("bigint").alias("n"))
    found = df.select(*group, F.explode(F.filter(F.array(*pairs), lambda x: x.isNotNull())).alias("b"))
    return found.select(*group, "b.*").groupBy(*group, "field", "value").agg(F.count("*").alias("n"))


def validation_report(df: DataFrame, fields: list[ContractField] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """VAL-7 for one table, or for each ``group`` of rows: a row per contract field ``(pos, field, tier, present, n_bad, n_bad_values, error)``.

    A last row with field ``*`` holds the verdict in ``present``: false when a required field is missing or there are
    no rows; without ``group`` it is there for an empty table too. The error text counts the bad values and names the first in text
    order; ``bad_values`` lists all of them, however many. The table is read once: each row gives what is wrong with it, and
    tasks count that before they shuffle.
    """
    contract = fields or CONTRACT
    have, group = set(df.columns), list(group)
    types = {f.name: f.dataType for f in df.schema}

    def entry(field: str, kind: str, value=None):
        return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), (F.lit(None) if value is None else value).cast("string").alias("value"))

    wrong = [entry("*", "rows")]
    for c in contract:
        if c.field not in have:
            continue
        cell, text = F.col(c.field), F.col(c.field).cast("string")
        if c.dtype in ("int", "float"):
            wrong.append(F.when(V.present(cell, types[c.field]) & V.to_number(cell, types[c.field]).isNull(), entry(c.field, "number")))
        if c.dtype == "category" and c.allowed:
            wrong.append(F.when(cell.isNotNull() & ~text.isin(c.allowed), entry(c.field, "value", text)))
    told = df.select(*group, F.inline(F.filter(F.array(*wrong), lambda x: x.isNotNull())))
    counted = told.groupBy(*group, "field", "kind", "value").agg(F.count("*").alias("n"))
    of = {kind: F.col("kind") == kind for kind in ("rows", "number", "value")}
    each = counted.groupBy(*group, "field").agg(
        F.sum(F.when(of["rows"], F.col("n"))).alias("n_rows"), F.sum(F.when(of["number"], F.col("n"))).alias("n_number_bad"),
        F.count_if(of["value"]).alias("n_bad_values"), F.sum(F.when(of["value"], F.col("n"))).alias("n_value_bad"), F.min("value").alias("first"),
    )
    # At most one entry per contract field.
    found = F.collect_list(F.struct("field", F.struct("n_rows", "n_number_bad", "n_bad_values", "n_value_bad", "first")))
    whole = each.groupBy(*group).agg(F.map_from_entries(found).alias("found"))
    rows = F.coalesce(F.col("found")["*"]["n_rows"], F.lit(0))
    required_there = all(c.field in have for c in contract if c.tier == REQUIRED)
    listed = [(i, c.field, c.dtype, c.tier, c.field in have, c.allowed or []) for i, c in enumerate(contract)]
    listed.append((len(contract), "*", "verdict", REQUIRED, required_there, []))
    lines = [
        F.struct(
            F.lit(pos).alias("pos"), F.lit(field).alias("field"), F.lit(dtype).alias("dtype"), F.lit(tier).alias("tier"), (F.lit(there) & (rows > 0)).alias("present"),
            F.array(*[F.lit(a) for a in allowed]).cast("array<string>").alias("allowed"),
        )
        for pos, field, dtype, tier, there, allowed in listed
    ]
    per_field = whole.select(*group, "found", rows.alias("n_rows"), F.inline(F.array(*lines)))
    own = F.col("found")[F.col("field")]
    joined = per_field.select(
        *group, "pos", "field", "dtype", "tier", "present", "allowed", "n_rows", F.coalesce(own["n_number_bad"], F.lit(0)).alias("n_number_bad"),
        F.coalesce(own["n_bad_values"], F.lit(0)).alias("n_bad_values"), F.coalesce(own["n_value_bad"], F.lit(0)).alias("n_value_bad"), own["first"].alias("first"),
    )
    quoted = lambda a: F.array_join(F.transform(a, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    number_error = F.concat(
        F.lit("Field '"), F.col("field"), F.lit("': expected "), F.col("dtype"), F.lit(", but "),
        F.col("n_number_bad"), F.lit(" values cannot be converted to numeric"),
    )
    value_error = F.concat(
        F.lit("Field '"), F.col("field"), F.lit("': found "), F.col("n_bad_values"), F.lit(" invalid values, the first of them '"), F.col("first"),
        F.lit("'. Allowed: ["), quoted(F.col("allowed")), F.lit("]"),
    )
    empty_error = F.when((F.col("field") == "*") & (F.col("n_rows") == 0), "DataFrame is empty (0 rows)")
    error = F.when(F.col("n_number_bad") > 0, number_error).when(F.col("n_bad_values") > 0, value_error).otherwise(empty_error)
    return joined.select(*group, "pos", "field", "tier", "present", (F.col("n_number_bad") + F.col("n_value_bad")).alias("n_bad"), "n_bad_values", error.alias("error"))


def is_valid(df: DataFrame, fields: list[ContractField] | None = None) -> bool:
    """VAL-3 as a driver decision: the gate before training."""
    required = {c.field for c in fields or CONTRACT if c.tier == REQUIRED}
    return required <= set(df.columns) and not df.isEmpty()
