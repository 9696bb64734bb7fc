"""From probabilities and contributions to the client deliverable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import values as V

# Least probability of each risk tier, highest first.
RISK_TIERS = [("high", 0.7), ("medium", 0.4), ("low", 0.0)]
NO_NARRATIVE = "N/A"


def predict(model, df: DataFrame, name: str = "churn_probability") -> DataFrame:
    """SCR-1: probability of churn from a fitted classifier, next to the other columns."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def risk_tier(p: Column) -> Column:
    """SCR-3. A missing or NaN probability is ``low``."""
    value = F.nanvl(p.cast("double"), F.lit(None).cast("double"))
    tier = F.when(F.lit(False), "")
    for name, least in RISK_TIERS[:-1]:
        tier = tier.when(value >= least, name)
    return tier.otherwise(RISK_TIERS[-1][0])


def top_factors(contributions: Column, names: Sequence[str], n: int = 3) -> Column:
    """The ``n`` features of largest absolute contribution, as ``array<struct<feature, contribution>>``.

    On ties the later feature comes first. A list of another length than ``names`` fails the job.
    """
    names_array = F.array(*[F.lit(x) for x in names])
    sized = F.when(F.size(contributions) == len(names), contributions).otherwise(
        F.raise_error(F.concat(F.lit("contributions: "), F.size(contributions), F.lit(f", feature names: {len(names)}"))).cast("array<double>")
    )
    marked = F.transform(sized, lambda x, i: F.struct(F.abs(x).alias("size"), i.alias("i"), x.alias("x")))
    top = F.slice(F.sort_array(marked, asc=False), 1, n)
    return F.transform(top, lambda t: F.struct(F.element_at(names_array, t["i"] + 1).alias("feature"), t["x"].alias("contribution")))


def factor_text(factor: Column) -> Column:
    return F.concat(factor["feature"], F.lit(" ("), V.signed_text(factor["contribution"]), F.lit(")"))


def top_reasons(contributions: Column, names: Sequence[str], n: int = 3) -> Column:
    """SCR-4: ``name (+0.23)`` strings, largest absolute contribution first."""
    return F.transform(top_factors(contributions, names, n), factor_text)


def deliverable(
    df: DataFrame, names: Sequence[str], customer: str = "customer_id", p: str = "churn_probability", contributions: str = "contributions", keep: Sequence[str] = ()
) -> DataFrame:
    """SCR-5: id, probability, tier, top three reasons and the narrative of each row that has one."""
    narrative = F.col("narrative") if "narrative" in df.columns else F.lit(None).cast("string")
    return df.select(
        *keep,
        F.col(customer).alias("customer_id"),
        V.round_to(F.col(p), 4).alias("churn_probability"),
        risk_tier(F.col(p)).alias("risk_tier"),
        F.concat_ws("; ", top_reasons(F.col(contributions), names)).alias("top_3_reasons"),
        F.coalesce(narrative, F.lit(NO_NARRATIVE)).alias("narrative_explanation"),
    )


def tier_counts(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """SCR-6."""
    return df.groupBy(*group, "risk_tier").agg(F.count("*").alias("n"))


def highest_risk(df: DataFrame, k: int = 5, p: str = "churn_probability", tie: str = "customer_id") -> DataFrame:
    """SCR-7: the ``k`` rows of highest probability; each task keeps ``k``, ties go to the least ``tie``."""
    return df.orderBy(F.desc_nulls_last(p), F.asc(tie)).limit(k)
