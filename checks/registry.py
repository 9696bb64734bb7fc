"""All registered queries and their SQL."""

from __future__ import annotations

from checks import q_cleaning, q_models, q_sources, q_text
from checks.flagship import flagship

MODULES = [q_sources, q_cleaning, q_models, q_text]
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}

__all__ = ["QUERIES", "SQL", "flagship"]
