"""All registered queries of the library, and their SQL."""

from __future__ import annotations

from gristmill.plans import analytics, curation, export_queries, extensions, language, parsing, rollout_queries, sinks_queries, task_queries, verification  # noqa: F401
from gristmill.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
