"""The one object a user works with."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from stowage.errors import TableNotFoundError
from stowage.sources.catalog import Catalog
from stowage.sources.saves import Saves
from stowage.sources.selects import LIFETIME_MS, STAGING_PREFIX, Selects, StagedResult
from stowage.sources.spec import TableSpec


# The size of files that compaction aims at.
COMPACT_BYTES = 256 << 20


def _system_clock_ms() -> int:
    return time.time_ns() // 1_000_000


class Warehouse:
    """Named tables on a Spark session.

    ``root`` is a folder that every executor can reach; tables live below it, as
    do files staged on the way in unless ``staging_root`` names another folder.
    Settings belong to the object and are fixed once it is made. ``clock`` gives
    the time in epoch milliseconds; results of SELECTs live 24 hours by it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        project: str,
        location: str = "US",
        staging_root: str | None = None,
        staging_prefix: str = STAGING_PREFIX,
        staging_dataset: str | None = None,
        clock: Callable[[], int] = _system_clock_ms,
    ):
        self.spark = spark
        self.project = project
        self.location = location
        self._clock = clock
        self._catalog = Catalog(spark, root)
        self._selects = Selects(
            self._catalog, self.spec, project, location, staging_prefix, staging_dataset
        )
        self._saves = Saves(
            self._catalog, staging_root or f"{self._catalog.root}/_staged_files", clock
        )

    @property
    def staging_root(self) -> str:
        """Folder of the files staged by saves."""
        return self._saves.staging_root

    def spec(self, table: TableSpec | str) -> TableSpec:
        """A table spec; text without a project gets this warehouse's."""
        return table if isinstance(table, TableSpec) else TableSpec.parse(table, self.project)

    def table_exists(self, table: TableSpec | str) -> bool:
        return self._catalog.exists(self.spec(table))

    # -- loading -------------------------------------------------------------

    def attach(self, table: TableSpec | str, path: str, fmt: str = "parquet") -> None:
        """Name files that exist already as a read-only table."""
        self._catalog.attach(self.spec(table).whole, path, fmt)

    def read_table(self, table: TableSpec | str, with_day: bool = False) -> DataFrame:
        """A table, or one day of it, as a lazy DataFrame.

        Filters and column choices made on it reach the file scan. An empty table
        loads with its schema. ``with_day`` shows the hidden partition column.
        """
        spec = self.spec(table)
        facts = self._catalog.facts(spec)
        if facts is None:
            raise TableNotFoundError(f"table {spec.whole} does not exist")
        spec.require_fits(facts.by_day)
        return self._catalog.frame(facts, spec.day, with_day)

    def run_select(self, sql: str, now_ms: int | None = None) -> DataFrame:
        """Run a SELECT to the end and load its staged result.

        Tables may be written as ``[project:dataset.table]``, also with a day.
        The same text gives the same result for 24 hours.
        """
        return self._selects.run(sql, self._clock() if now_ms is None else now_ms)

    def ensure_staging(self) -> str:
        """Create the dataset of staged results if it is missing; gives its name."""
        return self._selects.ensure_staging()

    def staged_results(self) -> list[StagedResult]:
        """The staged results in the catalog, with their expiry."""
        return self._selects.staged()

    def expire_staging(self, now_ms: int) -> list[TableSpec]:
        """Drop the staged results whose time is up at ``now_ms``; gives their specs."""
        return self._selects.expire(now_ms)

    # -- saving --------------------------------------------------------------

    def write_table(
        self,
        df: DataFrame,
        table: TableSpec | str,
        write: str | None = None,
        create: str | None = None,
        options: Mapping[str, str] | None = None,
        fmt: str = "parquet",
        types: str = "load",
        staged: bool | None = None,
        balance: bool = False,
    ) -> None:
        """Save ``df`` as a table, or as one day of it (``dataset.table$yyyymmdd``).

        ``write``: ``append`` (default), ``truncate``, or ``empty`` (refuse if there
        are rows). ``create``: ``if_needed`` (default) or ``never``. ``options`` go to
        the writer of the files. ``types``: ``load`` saves the load form, ``spark``
        keeps Spark's types. ``fmt`` is the format of staged files; other than
        ``parquet`` the files pass through the staging area, as they do with
        ``staged=True``, and are removed from it whatever happens.

        ``balance``: one shuffle before the write, after which adaptive execution joins small
        partitions and splits large ones, so that each file holds about
        ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of the shuffle's bytes, however many or
        uneven the frame's partitions are. What is split are shuffle partitions, so a frame of one huge
        partition needs ``spark.sql.shuffle.partitions`` to be at least the number of files it should
        become. Without ``balance`` there is no shuffle and each partition is a file.
        """
        self._saves.save(df, self.spec(table), write, create, options, fmt, types, staged, balance)

    def clean_up(self, now_ms: int, grace_ms: int = LIFETIME_MS) -> list[str]:
        """Remove what truncates and broken saves left behind; gives the folders removed.

        A folder goes once ``grace_ms`` have passed since it was replaced, or since it was made
        if it was never published. No query or save may last longer than the grace. What is
        live is read from the tables' own storage, so any session on this root may call this,
        also one whose catalog does not know the tables.
        """
        return self._saves.clean_up(now_ms, grace_ms)

    def load_staged(
        self,
        path: str,
        table: TableSpec | str,
        write: str | None = None,
        create: str | None = None,
        fmt: str = "parquet",
        types: str = "load",
        once: bool = False,
    ) -> int:
        """Load all ``*.fmt`` files of one folder into a table; the files stay. Gives their number.

        With ``once``, files that are in the table already are passed over, so a load can
        be repeated. Files are told apart by path, length and time of change, and are listed
        beside the rows loaded with ``once``: rows that a truncate replaces, or that
        never were published, are on no list.
        """
        return self._saves.load(path, self.spec(table), write, create, fmt, types, once)

    def compact(self, table: TableSpec | str, file_bytes: int = COMPACT_BYTES, options: Mapping[str, str] | None = None) -> bool:
        """Write the files of a table, or of one day of it, anew as files of about ``file_bytes``.

        Does nothing, and gives False, where they are not more than that takes. All rows of
        the table or day are written, without a shuffle; of one partitioned by day give a day. An append or
        other save meanwhile is kept: then this is refused with ``OverlappingSaveError``.
        """
        return self._saves.compact(self.spec(table), file_bytes, options)
