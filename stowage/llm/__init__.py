"""Operators for training-data pipelines; their queries are in ``stowage.llm.queries``."""
