"""Schema-driven DataFrame operators: load form, conform, merge by union rule."""

from stowage.operators.conform import conform
from stowage.operators.load_form import load_form, load_schema, record_namespaces
from stowage.operators.merge_union import merge_union

__all__ = ["conform", "load_form", "load_schema", "merge_union", "record_namespaces"]
