"""The data contract: the standard fields, their types, tiers and allowed values."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import small_table

REQUIRED, ENGAGEMENT, DEMOGRAPHIC = 1, 2, 3


class ContractField(NamedTuple):
    field: str
    dtype: str
    tier: int
    description: str
    allowed: list[str] | None = None


# Names, types, tiers, descriptions (they appear word for word in mapping prompts) and allowed values.
CONTRACT = [
    ContractField("customer_id", "string", REQUIRED, "Unique customer identifier — who are we talking about?"),
    ContractField(
        "tenure_months",
        "int",
        REQUIRED,
        "How many months this person has been a customer. Longer tenure generally means lower churn risk.",
    ),
    ContractField(
        "monthly_charges",
        "float",
        REQUIRED,
        "What the customer pays each month. Higher charges can signal both value and price sensitivity.",
    ),
    ContractField(
        "total_charges",
        "float",
        REQUIRED,
        "Cumulative amount billed over the customer's lifetime. "
        "Roughly tenure × monthly_charges, but accounts for plan changes.",
    ),
    ContractField(
        "churn_label",
        "int",
        REQUIRED,
        "The answer we're trying to predict: 1 = customer left, "
        "0 = customer stayed. This is what the model learns from.",
    ),
    ContractField(
        "contract_type",
        "category",
        ENGAGEMENT,
        "Contract duration — month-to-month customers leave 3x more often than those locked into annual contracts.",
        ["month-to-month", "one_year", "two_year"],
    ),
    ContractField(
        "payment_method",
        "category",
        ENGAGEMENT,
        "How the customer pays. Auto-pay customers tend to be stickier (less friction to stay).",
    ),
    ContractField(
        "support_tickets",
        "int",
        ENGAGEMENT,
        "Number of support contacts. High ticket counts often signal frustration — a leading indicator of churn.",
    ),
    ContractField(
        "gender",
        "category",
        DEMOGRAPHIC,
        "Customer gender. Rarely a strong churn predictor on its own, but can interact with other features.",
    ),
    ContractField(
        "age_bucket",
        "category",
        DEMOGRAPHIC,
        "Age range bucket (e.g., 18-25, 26-35). Different age groups "
        "may have different switching costs and loyalty patterns.",
    ),
    ContractField(
        "partner_status",
        "category",
        DEMOGRAPHIC,
        "Whether the customer has a partner. Households with shared accounts tend to have higher switching costs.",
    ),
]

CONTRACT_VERSION = "1.0"

# Plausible range of each numeric field, smallest and largest.
NUMERIC_BOUNDS = {
    "tenure_months": (0.0, 120.0),
    "monthly_charges": (0.0, 500.0),
    "total_charges": (0.0, 50000.0),
    "support_tickets": (0.0, 100.0),
}

# The standard value of each spelling (trimmed, lower case).
CATEGORY_SYNONYMS = {
    "contract_type": {
        "month to month": "month-to-month",
        "month-to-month": "month-to-month",
        "m2m": "month-to-month",
        "mtm": "month-to-month",
        "monthly": "month-to-month",
        "one year": "one_year",
        "one_year": "one_year",
        "1 year": "one_year",
        "1year": "one_year",
        "12 months": "one_year",
        "annual": "one_year",
        "two year": "two_year",
        "two_year": "two_year",
        "2 year": "two_year",
        "2year": "two_year",
        "24 months": "two_year",
        "biennial": "two_year",
    },
    "payment_method": {
        "credit card": "credit_card",
        "credit_card": "credit_card",
        "cc": "credit_card",
        "visa": "credit_card",
        "mastercard": "credit_card",
        "bank transfer": "bank_transfer",
        "bank_transfer": "bank_transfer",
        "ach": "bank_transfer",
        "direct debit": "bank_transfer",
        "electronic check": "electronic_check",
        "electronic_check": "electronic_check",
        "e-check": "electronic_check",
        "echeck": "electronic_check",
        "mailed check": "mailed_check",
        "mailed_check": "mailed_check",
        "check": "mailed_check",
    },
    "gender": {
        "male": "Male",
        "m": "Male",
        "female": "Female",
        "f": "Female",
    },
}

ID_FIELD, LABEL_FIELD = "customer_id", "churn_label"
NUMERIC_FEATURES = [c.field for c in CONTRACT if c.dtype in ("int", "float") and c.field != LABEL_FIELD]
CATEGORY_FEATURES = [c.field for c in CONTRACT if c.dtype == "category"]


def fields_by_tier(tier: int) -> list[str]:
    """VAL-1: names of one tier's fields, in contract order."""
    return [c.field for c in CONTRACT if c.tier == tier]


def contract_table(spark: SparkSession, fields: list[ContractField] | None = None) -> DataFrame:
    """The contract as a table of one row per field."""
    rows = [(i, *c) for i, c in enumerate(fields or CONTRACT)]
    return small_table(spark, rows, "pos int, field string, dtype string, tier int, description string, allowed array<string>")


def contract_by_tier(spark: SparkSession, tier: int) -> DataFrame:
    return contract_table(spark).filter(F.col("tier") == tier)
