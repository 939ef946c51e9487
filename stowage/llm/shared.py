"""What all operators need of a session: tables on shared storage, and workers that find the code."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stowage.plans.registry import scratch_root

__all__ = ["find_package", "free_names", "scratch_root", "stored"]


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    It is for sessions on one machine. On a cluster the package is deployed to all
    executors (``--py-files``, or installed), and the path added here is of no effect.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there: computed once, and safe from lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns: like ``wanted``, but such as ``df`` has none of, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
