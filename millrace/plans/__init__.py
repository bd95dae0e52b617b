"""Registered queries: one per operator, each with the SQL that must give the same rows where SQL can say it."""

from millrace.plans import (  # noqa: F401
    plan_columns,
    plan_discover,
    plan_filters,
    plan_fuzzy,
    plan_ingest,
    plan_quality,
    plan_runs,
    plan_shape,
    plan_sources,
    plan_streams,
    plan_usage,
)
from millrace.plans.registry import REGISTRY  # noqa: F401
