"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from tierflow.plans import gold_queries, layer_queries, operator_queries, report_queries, volume_queries  # noqa: F401
from tierflow.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
