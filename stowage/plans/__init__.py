"""Registered queries: each runs an operator over whole tables, with the SQL to check it."""

from stowage.plans import saves, schemas, scans, selects  # noqa: F401  (they register themselves)
from stowage.plans.registry import REGISTERED

__all__ = ["REGISTERED"]
