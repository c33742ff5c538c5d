"""All registered queries. Importing the plan modules fills the registry."""

from __future__ import annotations

from millrace.plans import (  # noqa: F401
    anomaly_plans,
    cleaning_plans,
    closed_forms,
    feature_plans,
    flows,
    model_plans,
    profiling_plans,
    series_plans,
    source_plans,
)
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
