"""The whole flow in one query: raw client rows in, scored deliverable out."""

from __future__ import annotations

from checks import fixtures as X
from tenura.plans.runs import score_batch, train_client


def flagship(spark, sf):
    raw = X.churn_raw(spark, sf)
    trained = train_client(raw, X.RETAIL)
    return score_batch(raw, X.RETAIL, trained)
