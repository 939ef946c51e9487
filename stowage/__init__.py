"""Warehouse tables for PySpark: load, select once, save; plus schema operators."""

from stowage.operators import conform, load_form, load_schema, merge_union, record_namespaces
from stowage.sources import TableSpec, Warehouse

__all__ = [
    "TableSpec",
    "Warehouse",
    "conform",
    "load_form",
    "load_schema",
    "merge_union",
    "record_namespaces",
]
