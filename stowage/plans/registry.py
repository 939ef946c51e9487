"""The register of queries, and what they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stowage import Warehouse
from stowage.errors import SchemaError, StowageError
from stowage.sources.files import delete_at_exit

CHECKPOINT_DIR = "spark.checkpoint.dir"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    check_sql: str


REGISTERED: dict[str, Query] = {}


def query(check_sql: str):
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        REGISTERED[run.__name__] = Query(run, check_sql)
        return run

    return register


def scratch_root(spark: SparkSession) -> str:
    """A new folder for what a query writes, removed when the session's JVM ends.

    It lies in the shared folder that the cluster names. Where none is named, a
    local session gets a temporary folder, and a cluster is refused one.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stowage-")
    root = f"{base.rstrip('/')}/stowage_{uuid.uuid4().hex}"
    delete_at_exit(spark, root)
    return root


def open_warehouse(
    spark: SparkSession, sf_dir: str, *tables: str, clock: Callable[[], int] | None = None
) -> Warehouse:
    """A warehouse of its own, with the given tables attached as dataset ``src``."""
    settings = {"clock": clock} if clock else {}
    wh = Warehouse(
        spark, scratch_root(spark), project=f"trial-{uuid.uuid4().hex[:12]}", **settings
    )
    for table in tables:
        wh.attach(f"src.{table}", f"{sf_dir}/{table}.parquet")
    return wh


def without_brackets(sql: str) -> str:
    """The same statement on the plain table names."""
    return sql.replace("[src.", "").replace("]", "")


def cents(amount: str) -> str:
    """SQL for an amount as whole cents. Their sums do not depend on the order of the rows."""
    return f"CAST(FLOOR({amount} * 100 + 0.5) AS BIGINT)"


def in_units(sum_of_cents: str) -> str:
    """SQL for a sum of cents as an amount."""
    return f"CAST({sum_of_cents} AS DOUBLE) / 100"


def exact_sum(amount: str) -> str:
    return in_units(f"SUM({cents(amount)})")


def refusal(call: Callable[[], object]) -> str:
    """How ``call`` was refused: the kind of error, and the path if it has one."""
    try:
        call()
    except SchemaError as e:
        return f"{type(e).__name__} at {e.path}"
    except StowageError as e:
        return type(e).__name__
    return "accepted"
