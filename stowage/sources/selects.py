"""SELECT results: run once into a staged table, reused by exact text until expiry.

Results are found again through the catalog, by a digest in the staged table's properties, so
other warehouses, sessions and drivers on it meet them too. The digest is over the exact text and
over what else decides its meaning: the session's settings of Spark SQL, catalog and schema. A
text that names one of the session's temporary views is met by this warehouse alone. Only one driver
runs a text at a time (``publishing.held``); the others wait and then load what it staged.

The result is a written table, so it survives lost executors and a repeated
statement costs one scan. It holds no row order; sort again after loading.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stowage.errors import TableNotFoundError, UnsupportedTypeError
from stowage.functions.types import dotted, require_unique_columns
from stowage.sources.catalog import EXPIRES_AT, PARTITION_COLUMN, Catalog, day_literal
from stowage.sources.files import delete_tree
from stowage.sources.publishing import held
from stowage.sources.spec import (
    TableSpec,
    escape,
    mentions,
    resolve_references,
    unescape,
    without_closing,
)

# How long a result lives, and how its table is named.
LIFETIME_MS = 86_400_000
STAGING_PREFIX = "stowage_staging_"
STAGING_COMMENT = "Staged query results"
RESULT_PREFIX = "result"
LOCATION = "stowage.location"
LIFETIME = "stowage.default_lifetime_ms"
DIGEST = "stowage.text_digest"
RUNNING = "__running"
# Settings that decide how a statement is run, not what it gives; fixed names.
EXECUTION_ONLY = (
    "spark.sql.adaptive.",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.files.",
    "spark.sql.shuffle.partitions",
)
TIME_FORMAT = "%Y%m%d%H%M%S"


@dataclass(frozen=True)
class StagedResult:
    spec: TableSpec
    expires_at_ms: int

    def expired(self, now_ms: int) -> bool:
        return self.expires_at_ms <= now_ms


class Selects:
    def __init__(
        self,
        catalog: Catalog,
        parse: Callable[[str], TableSpec],
        project: str,
        location: str,
        prefix: str = STAGING_PREFIX,
        dataset: str | None = None,
    ):
        self._catalog = catalog
        self._parse = parse
        self._location = location
        self._dataset = dataset or prefix + location.lower()
        self._project = project
        self._results: dict[str, StagedResult] = {}
        self._locks: dict[str, threading.Lock] = {}

    # -- staging area --------------------------------------------------------

    def ensure_staging(self) -> str:
        """Create the schema of the staged results if it is missing; its dataset name."""
        self._catalog.ensure_schema(
            self._spec("any"),
            STAGING_COMMENT,
            {LOCATION: self._location, LIFETIME: str(LIFETIME_MS)},
        )
        return self._dataset

    def staged(self) -> list[StagedResult]:
        """Every staged result in the catalog, also those of earlier sessions."""
        found = self._catalog.expiries(self._spec("any").schema_name)
        return [
            StagedResult(self._spec(unescape(name)), at)
            for name, at in found.items()
            if name.startswith(escape(f"{RESULT_PREFIX}_"))
        ]

    def expire(self, now_ms: int) -> list[TableSpec]:
        """Drop the staged results whose time is up, files included."""
        gone = [result.spec for result in self.staged() if result.expired(now_ms)]
        for spec in gone:
            self._catalog.drop(spec)
        for text, result in list(self._results.items()):
            if result.spec in gone:
                self._results.pop(text, None)
                self._locks.pop(text, None)
        return gone

    def _spec(self, table: str) -> TableSpec:
        return TableSpec(self._project, self._dataset, table)

    # -- running -------------------------------------------------------------

    def run(self, sql: str, now_ms: int) -> DataFrame:
        """The result of ``sql``, from the staged table of an earlier run if it still lives.

        Changes of the source within that time are not seen. Two threads with the
        same text run it once. A failed run leaves no entry.
        """
        with self._locks.setdefault(sql, threading.Lock()):
            known = self._results.get(sql)
            if known is None or known.expired(now_ms) or not self._catalog.exists(known.spec):
                self._results.pop(sql, None)
                known = self._results[sql] = self._shared(sql, now_ms)
        return self._catalog.spark.table(known.spec.catalog_name)

    def _shared(self, sql: str, now_ms: int) -> StagedResult:
        """The result that any driver has staged for this text, or a new one."""
        digest = self._digest(sql)
        if digest is None:
            return self._stage(sql, now_ms, None)
        found = self._staged_for(digest, now_ms)
        if found is None:
            running = f"{self._catalog.schema_folder(self._spec('any'))}{RUNNING}/{digest}"
            with held(self._catalog.spark, running):
                found = self._staged_for(digest, now_ms) or self._stage(sql, now_ms, digest)
        return found

    def _staged_for(self, digest: str, now_ms: int) -> StagedResult | None:
        named = self._catalog.marked(self._spec("any").schema_name, DIGEST, digest)
        alive = [r for r in self.staged() if r.spec.table_name in named and not r.expired(now_ms)]
        return max(alive, key=lambda r: r.expires_at_ms, default=None)

    def _digest(self, sql: str) -> str | None:
        """What the text means in this session; None if that hangs on a temporary view."""
        spark = self._catalog.spark
        said = sql.lower()
        if any(t.isTemporary and t.name.lower() in said for t in spark.catalog.listTables()):
            return None
        # Values in effect, so that a setting and its default count as the same.
        every = spark.sql("SET -v").toLocalIterator()
        settings = sorted((r.key, r.value) for r in every if not r.key.startswith(EXECUTION_ONLY))
        place = [spark.catalog.currentCatalog(), spark.catalog.currentDatabase()]
        return hashlib.sha256(json.dumps([sql, settings, place]).encode()).hexdigest()

    def _stage(self, sql: str, now_ms: int, digest: str | None) -> StagedResult:
        # As a subquery, so that a statement that changes something is refused: it would
        # run on the first call and not on the next.
        query = self.resolve(without_closing(sql))
        df = self._catalog.spark.sql(f"SELECT * FROM (\n{query}\n)")
        require_unique_columns(df.columns)
        _require_storable(df.schema)
        self.ensure_staging()
        stamp = dt.datetime.fromtimestamp(now_ms / 1000, dt.timezone.utc).strftime(TIME_FORMAT)
        spec = self._spec(f"{RESULT_PREFIX}_{stamp}_{random.randrange(2**31)}")
        result = StagedResult(spec, now_ms + LIFETIME_MS)
        writer = df.writeTo(spec.catalog_name).using("parquet")
        if digest is not None:
            writer = writer.tableProperty(DIGEST, digest)
        try:
            writer.tableProperty(EXPIRES_AT, str(result.expires_at_ms)).create()
        except BaseException:
            if not self._catalog.exists(spec):
                delete_tree(self._catalog.spark, f"{self._catalog.schema_folder(spec)}/{spec.table_name}")
            raise
        return result

    def resolve(self, sql: str) -> str:
        """``sql`` with each ``[spec]`` replaced by what Spark SQL can read.

        The partition column of a day-partitioned table stays out of ``*`` unless
        the statement names it.
        """
        show_day = mentions(sql, PARTITION_COLUMN)

        def relation(text: str) -> str:
            spec = self._parse(text)
            facts = self._catalog.facts(spec)
            if facts is None:
                raise TableNotFoundError(f"table {spec.whole} does not exist")
            spec.require_fits(facts.by_day)
            if not facts.by_day or (show_day and spec.day is None):
                return spec.catalog_name
            columns = "*" if show_day else f"* EXCEPT ({PARTITION_COLUMN})"
            where = f" WHERE {PARTITION_COLUMN} = {day_literal(spec.day)}" if spec.day else ""
            return f"(SELECT {columns} FROM {spec.catalog_name}{where})"

        return resolve_references(sql, relation)


# Parquet tables hold the two ANSI intervals, but not this one.
_INTERVALS = (T.CalendarIntervalType,)


def _require_storable(schema: T.StructType) -> None:
    """Refuse result types that a staged table cannot hold, before any job runs."""

    def walk(dt_: T.DataType, path: tuple[str, ...]) -> None:
        if isinstance(dt_, _INTERVALS):
            raise UnsupportedTypeError(
                f"a result cannot hold {dt_.simpleString()} at {dotted(path)}; cast it",
                dotted(path),
            )
        if isinstance(dt_, T.ArrayType):
            walk(dt_.elementType, path)
        elif isinstance(dt_, T.MapType):
            walk(dt_.keyType, path)
            walk(dt_.valueType, path)
        elif isinstance(dt_, T.StructType):
            for f in dt_.fields:
                walk(f.dataType, (*path, f.name))

    walk(schema, ())
