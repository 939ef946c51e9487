"""What the catalog knows of a table, and the few statements that change it.

Each save writes its files to a folder of its own and only then points the
catalog at it, or moves it into the table's, so a failed save changes nothing and a table
may be replaced by a query on itself. The files are written once: publishing is a catalog update.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage.errors import SpecError, TableExistsError
from stowage.functions.types import loosen
from stowage.sources.files import child_names, qualified
from stowage.sources.spec import TableSpec

# The hidden partition column and the table properties in use.
PARTITION_COLUMN = "_partition_day"
SAVED_HERE = "stowage.saved"
EXPIRES_AT = "stowage.expires_at_ms"
LINE = "stowage.line"
_EXPIRY = re.compile(rf"[\[ ]{re.escape(EXPIRES_AT)}=(\d+)[,\]]")
_FILES, _RECORD = "__files", "__record"


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day_literal(day: dt.date) -> str:
    return f"DATE'{day.isoformat()}'"


# Spark's names of the errors for a name in use.
_TAKEN = {"TABLE_OR_VIEW_ALREADY_EXISTS", "PARTITIONS_ALREADY_EXIST"}

# Appends are folders within a table's folder.
_NESTED = "recursiveFileLookup = 'true'"


def _mark(line: str) -> str:
    return f"TBLPROPERTIES ({literal(SAVED_HERE)} = 'true', {literal(LINE)} = {literal(line)})"


@dataclass(frozen=True)
class TableFacts:
    """One reading of a table's catalog entry. A view has no location."""

    name: str
    location: str | None
    by_day: bool
    writable: bool
    line: str | None


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = qualified(spark, root)

    # -- reading -------------------------------------------------------------

    def exists(self, spec: TableSpec) -> bool:
        return self.spark.catalog.tableExists(spec.catalog_name)

    def facts(self, spec: TableSpec) -> TableFacts | None:
        """The catalog entry of ``spec``'s table, or None.

        The session's memory of the table's files is dropped on the way, so that what
        other sessions have saved since is seen.
        """
        if not self.exists(spec):
            return None
        self.spark.catalog.refreshTable(spec.catalog_name)
        entry = self._describe(spec.catalog_name)
        properties = entry.get("table_properties", {})
        return TableFacts(
            spec.catalog_name,
            entry.get("location"),
            PARTITION_COLUMN in entry.get("partition_columns", []),
            properties.get(SAVED_HERE) == "true",
            properties.get(LINE),
        )

    def location(self, spec: TableSpec) -> str | None:
        """Where the files of the table, or of its day, are; None if there is no such."""
        if not self.exists(spec):
            return None
        if spec.day is None:
            return self._describe(spec.catalog_name).get("location")
        part = f"PARTITION ({PARTITION_COLUMN} = {day_literal(spec.day)})"
        if self.spark.sql(f"SHOW PARTITIONS {spec.catalog_name} {part}").isEmpty():
            return None
        return self._describe(f"{spec.catalog_name} {part}")["location"]

    def expiries(self, schema_name: str) -> dict[str, int]:
        """The time at which each table of a schema expires, of those that do; one statement."""
        if not self.spark.catalog.databaseExists(schema_name):
            return {}
        rows = self.spark.sql(f"SHOW TABLE EXTENDED IN {schema_name} LIKE '*'").toLocalIterator()
        found = {r.tableName: _EXPIRY.search(r.information) for r in rows if not r.isTemporary}
        return {name: int(at[1]) for name, at in sorted(found.items()) if at}

    def marked(self, schema_name: str, key: str, value: str) -> set[str]:
        """The tables of a schema that have this property, by one statement."""
        if not self.spark.catalog.databaseExists(schema_name):
            return set()
        rows = self.spark.sql(f"SHOW TABLE EXTENDED IN {schema_name} LIKE '*'").toLocalIterator()
        return {r.tableName for r in rows if not r.isTemporary and re.search(rf"[\[ ]{re.escape(key)}={re.escape(value)}[,\]]", r.information)}

    def _describe(self, what: str) -> dict:
        return json.loads(self.spark.sql(f"DESCRIBE TABLE EXTENDED {what} AS JSON").first()[0])

    # -- changing ------------------------------------------------------------

    def schema_folder(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.schema_name}"

    def table_folder(self, spec: TableSpec) -> str:
        """Where saves of this table put their folders; no table lies there by default."""
        return f"{self.schema_folder(spec)}/{spec.table_name}{_FILES}"

    def record_folder(self, spec: TableSpec) -> str:
        """Where the record of what was published of this table lies, a folder for each line."""
        return f"{self.schema_folder(spec)}/{spec.table_name}{_RECORD}"

    def saved_tables(self) -> Iterator[tuple[str, str]]:
        """The folder of the files and that of the record of every table that saves made here,
        whether this session's catalog knows it or not."""
        for schema in child_names(self.spark, self.root):
            for name in child_names(self.spark, f"{self.root}/{schema}"):
                if name.endswith(_FILES):
                    path = f"{self.root}/{schema}/{name}"
                    yield path, path.removesuffix(_FILES) + _RECORD

    def ensure_schema(
        self, spec: TableSpec, comment: str = "", properties: dict[str, str] | None = None
    ) -> None:
        props = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in (properties or {}).items())
        self.spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {spec.schema_name} COMMENT {literal(comment)} "
            f"LOCATION {literal(self.schema_folder(spec))}"
            + (f" WITH DBPROPERTIES ({props})" if props else "")
        )

    def create_over(self, spec: TableSpec, schema: T.StructType, folder: str, line: str) -> None:
        """A new table over files that are there already."""
        self._create(
            spec,
            f"({loosen(schema).toDDL()}) USING PARQUET OPTIONS ({_NESTED}) "
            f"LOCATION {literal(folder)} {_mark(line)}",
        )

    def create_by_day(self, spec: TableSpec, schema: T.StructType, folder: str, line: str) -> None:
        """A new table partitioned by day, with one day over files that are there already."""
        day = T.StructField(PARTITION_COLUMN, T.DateType())
        columns = T.StructType([*loosen(schema).fields, day]).toDDL()
        self._create(
            spec,
            f"({columns}) USING PARQUET PARTITIONED BY ({PARTITION_COLUMN}) "
            f"LOCATION {literal(self.table_folder(spec))} {_mark(line)}",
        )
        try:
            self.add_day(spec, folder)
        except TableExistsError:
            raise
        except BaseException:
            if self.spark.sql(f"SHOW PARTITIONS {spec.catalog_name}").isEmpty():
                self.drop(spec)
            raise

    def attach(self, spec: TableSpec, path: str, fmt: str) -> None:
        """A table over files that belong to someone else; saves refuse it."""
        if not re.fullmatch(r"[\w.]+", fmt):
            raise SpecError(f"not a format: {fmt!r}")
        self._create(spec, f"USING {fmt} LOCATION {literal(qualified(self.spark, path))}")
        if self._describe(spec.catalog_name).get("partition_columns"):
            self.spark.catalog.recoverPartitions(spec.catalog_name)

    def _create(self, spec: TableSpec, rest: str) -> None:
        self.ensure_schema(spec)
        self._run_unless_taken(spec.whole, f"CREATE TABLE {spec.catalog_name} {rest}")

    def _run_unless_taken(self, what: TableSpec, statement: str) -> None:
        try:
            self.spark.sql(statement)
        except AnalysisException as e:
            if e.getCondition() in _TAKEN:
                raise TableExistsError(f"{what} exists already") from e
            raise

    def point_at(self, spec: TableSpec, folder: str) -> None:
        """Make ``folder`` the contents of the table."""
        self.spark.sql(f"ALTER TABLE {spec.catalog_name} SET LOCATION {literal(folder)}")

    def add_day(self, spec: TableSpec, folder: str) -> None:
        """Make ``folder`` the contents of a day that the table does not have yet."""
        self._run_unless_taken(
            spec,
            f"ALTER TABLE {spec.catalog_name} ADD PARTITION "
            f"({PARTITION_COLUMN} = {day_literal(spec.day)}) LOCATION {literal(folder)}",
        )

    def point_day_at(self, spec: TableSpec, folder: str) -> None:
        """Make ``folder`` the contents of a day that the table has."""
        self.spark.sql(
            f"ALTER TABLE {spec.catalog_name} PARTITION "
            f"({PARTITION_COLUMN} = {day_literal(spec.day)}) SET LOCATION {literal(folder)}"
        )

    def drop(self, spec: TableSpec) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {spec.catalog_name}")

    # -- as a frame ----------------------------------------------------------

    def frame(self, facts: TableFacts, day: dt.date | None, with_day: bool = False) -> DataFrame:
        """The table, or one day of it; the partition column stays hidden unless asked for."""
        df = self.spark.table(facts.name)
        if not facts.by_day:
            return df
        if day is not None:
            df = df.filter(F.col(PARTITION_COLUMN) == F.lit(day))
        return df if with_day else df.drop(PARTITION_COLUMN)
