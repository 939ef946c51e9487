"""Loading tables and SELECT results, saving frames as tables."""

from stowage.sources.spec import TableSpec
from stowage.sources.warehouse import Warehouse

__all__ = ["TableSpec", "Warehouse"]
