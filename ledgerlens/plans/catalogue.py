"""All queries on the driver tables, by name, with their SQL oracles."""

from __future__ import annotations

from ledgerlens.plans import evaluation_plans, forecast_plans, lookup_plans, pack_plans, quality_plans, reconcile_plans, retrieval_plans, signal_plans  # noqa: F401
from ledgerlens.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
