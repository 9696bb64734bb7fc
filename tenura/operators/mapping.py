"""Raw client columns onto the contract: rename, replace values, coerce types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.contract import CONTRACT
from tenura.functions import values as V
from tenura.session import broadcast_if_small, small_table
from tenura.sources.catalog import Mapping

# Value lists up to this length become a literal map in the projection; longer ones a join with a lookup table. Both go by the
# text of the key, of which the last one counts.
LITERAL_ENTRIES = 200


def new_names(columns: list[str], renames: dict[str, str]) -> dict[str, str]:
    """Old to new name for every column; names match exactly, absent ones are ignored, the rest keep theirs."""
    names = {c: renames.get(c, c) for c in columns}
    taken: dict[str, str] = {}
    for old, new in names.items():
        if new in taken:
            raise ValueError(f"columns {taken[new]!r} and {old!r} both become {new!r}")
        taken[new] = old
    return names


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """MAP-1."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in new_names(df.columns, renames).items()])


def replaced(c: Column, dtype: T.DataType, pairs: dict[str, str]) -> Column:
    """MAP-2 as an expression: listed values are replaced, others stay; the result is text."""
    text = V.to_text(c, dtype)
    return F.coalesce(V.lookup(text, {str(a): str(b) for a, b in pairs.items()}), text)


def map_values(df: DataFrame, values: dict[str, dict[str, str]]) -> DataFrame:
    """MAP-2 on a table."""
    types = {f.name: f.dataType for f in df.schema}
    for name, given in values.items():
        if name not in types:
            continue
        pairs = {str(a): str(b) for a, b in given.items()}
        if len(pairs) <= LITERAL_ENTRIES:
            df = df.withColumn(name, replaced(F.col(name), types[name], pairs))
            continue
        table = small_table(df.sparkSession, list(pairs.items()), "_from string, _to string")
        text = V.to_text(F.col(name), types[name])
        joined = df.withColumn(name, text).join(table, F.col(name) == F.col("_from"), "left")
        df = joined.withColumn(name, F.coalesce("_to", name)).select(*df.columns)
    return df


def coerced(c: Column, dtype: T.DataType, target: str) -> Column:
    """MAP-3 as an expression: what cannot be converted is null, and null stays null."""
    if target == "float":
        return V.to_number(c, dtype)
    if target == "int":
        return V.to_whole(c, dtype)
    if target in ("string", "category"):
        return V.to_text(c, dtype)
    return c


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """MAP-3 on a table."""
    return df.select(
        *[coerced(F.col(f.name), f.dataType, types[f.name]).alias(f.name) if f.name in types else F.col(f.name) for f in df.schema]
    )


def apply_mapping(df: DataFrame, m: Mapping) -> DataFrame:
    """MAP-4: rename, then values, then types; one projection while the value lists are short."""
    return coerce_types(map_values(rename_columns(df, m.columns), m.values), m.types)


FIELDS = [c.field for c in CONTRACT]


def client_lookups(catalog: DataFrame) -> DataFrame:
    """One row per client with its approved mapping, as arrays in contract order: source columns, value maps, types.

    ``_problem`` says why a mapping cannot be used: two source columns for one field, or two targets for one value.
    """
    live = catalog.filter(F.col("status") == "approved")

    def of(kind: str, field: str) -> Column:
        return (F.col("kind") == kind) & (F.col("field") == field)

    def source(f: str) -> Column:
        return F.max(F.when(of("column", f), F.col("from_value")))

    def pairs(f: str) -> Column:
        pair = F.when(of("value", f), F.struct(F.col("from_value").alias("k"), F.col("to_value").alias("v")))
        return F.array_distinct(F.collect_list(pair))

    def problem(f: str) -> Column:
        keys = F.transform(pairs(f), lambda p: p["k"])
        twice = F.when(F.count_distinct(F.when(of("column", f), F.col("from_value"))) > 1, F.lit(f"two columns become {f}"))
        return F.coalesce(twice, F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.lit(f"a value of {f} has two targets")))

    taken = F.collect_set(F.when(F.col("kind") == "column", F.col("from_value")))
    found = live.groupBy("client_id").agg(
        F.coalesce(*[problem(f) for f in FIELDS]).alias("_problem"),
        taken.alias("_taken"),
        F.array(*[source(f) for f in FIELDS]).alias("_sources"),
        F.array(*[pairs(f) for f in FIELDS]).alias("_pairs"),
        F.array(*[F.max(F.when(of("type", f), F.col("to_value"))) for f in FIELDS]).alias("_types"),
    )
    values = F.when(F.col("_problem").isNull(), F.transform("_pairs", F.map_from_entries))
    # A raw column that bears a field's own name is that field, unless it is mapped to another one.
    own = F.array(*[F.when(~F.array_contains("_taken", F.lit(f)), F.lit(f)) for f in FIELDS])
    sources = F.zip_with("_sources", own, lambda s, o: F.coalesce(s, o))
    return found.select("client_id", "_problem", sources.alias("_sources"), values.alias("_values"), "_types")


def rejected_clients(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """MAP-5: ``(client_id, n_rows, reason)`` of clients whose rows ``apply_catalog`` cannot map."""
    counts = raw.groupBy("client_id").agg(F.count("*").alias("n_rows"))
    joined = counts.join(client_lookups(catalog), "client_id", "left")
    reason = F.when(F.col("_sources").isNull(), F.lit("no approved mapping")).otherwise(F.col("_problem"))
    return joined.select("client_id", "n_rows", reason.alias("reason")).filter(F.col("reason").isNotNull())


def apply_catalog(raw: DataFrame, catalog: DataFrame, order: str = "src_row", leave_out: bool = False) -> DataFrame:
    """MAP-5: many clients in one narrow projection, driven by catalog rows.

    ``raw`` is ``(client_id, src_row, raw map<string,string>)``. Every contract field comes out as text, ready for
    cleaning; under a numeric coercion text that is no number is null, and ``int`` drops the fraction. A raw column that has
    a field's name already needs no entry. Rows of a client without a usable approved mapping fail the job; with
    ``leave_out`` they are left out, and ``rejected_clients`` says which and how many.
    """
    joined = raw.join(broadcast_if_small(client_lookups(catalog)), "client_id", "left")
    usable = F.col("_values").isNotNull()
    if leave_out:
        joined = joined.filter(usable)
    else:
        reason = F.concat(F.lit("no usable mapping for client "), F.col("client_id"), F.coalesce(F.concat(F.lit(": "), F.col("_problem")), F.lit("")))
        joined = joined.filter(F.when(usable, True).otherwise(F.raise_error(reason).cast("boolean")))
    text = T.StringType()
    # What no client asks for is left out of the projection; the catalog is a config table.
    live = catalog.filter((F.col("status") == "approved") & F.col("field").isin(FIELDS))
    asked = {(r["kind"], r["field"], r["to_value"]) for r in live.filter("kind = 'type'").select("kind", "field", "to_value").distinct().collect()}
    mapped = {r["field"] for r in live.filter("kind = 'value'").select("field").distinct().collect()}

    def named(i: int, f: str) -> Column:
        return F.coalesce(F.element_at(F.col("_values")[i], F.col(f)), F.col(f)) if f in mapped else F.col(f)

    def typed(i: int, f: str) -> Column:
        target, value, out = F.col("_types")[i], F.col(f), F.col(f)
        if ("type", f, "float") in asked:
            out = F.when((target == "float") & V.to_number(value, text).isNull(), F.lit(None)).otherwise(out)
        if ("type", f, "int") in asked:
            out = F.when(target == "int", V.to_whole(value, text).cast("string")).otherwise(out)
        return out

    # One projection per step: the optimizer keeps them apart, because each value is used more than once.
    head, fields = ["client_id", order], list(enumerate(FIELDS))
    found = joined.select(*head, "_values", "_types", *[F.element_at("raw", F.col("_sources")[i]).alias(f) for i, f in fields])
    values = found.select(*head, "_types", *[named(i, f).alias(f) for i, f in fields])
    return values.select(*head, *[typed(i, f).alias(f) for i, f in fields])
