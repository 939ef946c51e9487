"""Saving frames as tables.

==================  =====================================================
destination         how the files get there
==================  =====================================================
missing             written to a fresh folder, then the table is created over it
truncate            written to a fresh folder, then the table or day is pointed at it
append, empty       written to a fresh folder, which is then moved whole into the table's
append to a day     the day's rows and the new ones are written to a fresh folder, then the
                    day is pointed at it
==================  =====================================================

Rows are written by the cluster's own committer, since nobody sees a fresh folder before it
is complete; a failed save leaves the destination as it was, and a table may be replaced by
a query on itself. The move of an append is one rename, which is one step on a file system;
on an object store, where it copies, readers may see a part of it. An append to a day writes
that day's rows anew, so that readers see all of it or nothing, on any store.
No save shuffles unless it is asked to balance its files: the frame's own partitions become the files. Where the staged files are not Parquet, or the
caller asks for it, the frame is written to the staging area first and loaded
from there.

Data is written first; then the save takes its turn (``publishing``), in which it compares what
there is with what it started from, and changes the catalog:

* a truncate finds any other change: it is refused, so no append that succeeded is lost;
* ``empty`` finds any other change: it looks again whether there are rows;
* an append finds the table or day replaced: it is refused. Appends to a table go one after
  the other; one to a day that finds another is written again over the new rows.

What was replaced stays for frames and queries that were planned before; ``clean_up`` removes it
later, by the record of what was published alone, so it may run in any session.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stowage.errors import (
    OverlappingSaveError,
    PartitioningError,
    ReadOnlyTableError,
    SchemaMismatchError,
    SpecError,
    TableExistsError,
    TableNotEmptyError,
    TableNotFoundError,
)
from stowage.functions.columns import column
from stowage.functions.types import require_unique_columns, same_type
from stowage.operators.load_form import load_form, refuse_nested_arrays, require_namespaces
from stowage.sources.catalog import PARTITION_COLUMN, Catalog, TableFacts
from stowage.sources.files import (
    child_names,
    create_new,
    delete_tree,
    files_below,
    files_in,
    fresh_name,
    made_at,
    move_in,
    qualified,
    read_text,
)
from stowage.sources.publishing import WHOLE, Record, Turn
from stowage.sources.spec import TableSpec

# Before the name of a folder that is to be moved into a table's; readers pass over it.
PENDING = "_adding_"
# How often a save looks anew that finds others' changes.
TRIES = 10
# The line of tables whose catalog entry names none; their folders are never cleaned up.
NO_LINE = "none"
# The list of the files that a folder's rows were loaded from; readers pass over it.
LOADED = "_loaded.json"

# The choices a caller has, and the codec of each staged format.
WRITES = ("truncate", "append", "empty")
CREATES = ("if_needed", "never")
TYPES = ("load", "spark")
CODECS = {"avro": "deflate", "orc": "zlib", "parquet": "zstd"}


class _MovedOn(Exception):
    """Others have changed the destination since it was looked at."""


@dataclass(frozen=True)
class _Found:
    """What a save starts from: the table, and the number of its last change."""

    facts: TableFacts
    record: Record
    number: int


def _unit(spec: TableSpec) -> str:
    return f"{spec.day:%Y%m%d}" if spec.day else WHOLE


class Saves:
    def __init__(self, catalog: Catalog, staging_root: str, clock: Callable[[], int]):
        self._catalog = catalog
        self._day_locks: dict[TableSpec, threading.Lock] = {}
        self._clock = clock
        self._spark = catalog.spark
        self.staging_root = qualified(self._spark, staging_root)

    # -- entry points --------------------------------------------------------

    def save(
        self,
        df: DataFrame,
        spec: TableSpec,
        write: str | None,
        create: str | None,
        options: Mapping[str, str] | None,
        fmt: str,
        types: str,
        staged: bool | None,
        balance: bool,
    ) -> None:
        write, create = _dispositions(write, create)
        _require_choice("format", fmt, CODECS)
        options = {"compression": CODECS[fmt], **(options or {})}
        out = _outgoing(df, types)
        if fmt == "avro":
            require_namespaces(out.schema, options.get("recordNamespace", ""))
        found = self._check(out.schema, spec, write, create)
        if staged is None:
            staged = fmt != "parquet"
        if not staged:
            self._publish(_balanced(out) if balance else out, spec, found, write, options)
            return
        path = f"{self.staging_root}/{fresh_name()}"
        try:
            _write(out, path, options, fmt)
            files = self._staged_files(path, fmt, out.schema)
            self._publish(_balanced(files) if balance else files, spec, found, write, _parquet_options())
        finally:
            delete_tree(self._spark, path)

    def load(
        self,
        path: str,
        spec: TableSpec,
        write: str | None,
        create: str | None,
        fmt: str,
        types: str,
        once: bool,
    ) -> int:
        """Load the files of one folder, which are left in place; gives their number."""
        write, create = _dispositions(write, create)
        _require_choice("format", fmt, CODECS)
        folder = qualified(self._spark, path)
        files = [f for f in files_in(self._spark, folder) if f[0].endswith(f".{fmt}")]
        out = _outgoing(self._staged_files(path, fmt, None), types)
        found = self._check(out.schema, spec, write, create)
        if not once:
            self._publish(out, spec, found, write, _parquet_options())
            return len(files)
        for _ in range(TRIES):
            known = {tuple(f) for f in self._loaded(spec)} if write != "truncate" else set()
            fresh = [f for f in files if f not in known]
            if not fresh:
                return 0
            part = self._spark.read.format(fmt).schema(self._staged_files(path, fmt, None).schema).load([f[0] for f in fresh])
            try:
                self._publish(_outgoing(part, types), spec, found, write, _parquet_options(), fresh)
                return len(fresh)
            except _MovedOn:
                # Someone else has saved meanwhile, and may have loaded some of these files.
                found = self._check(out.schema, spec, write, "never")
        raise _overlapping(spec)

    def _loaded(self, spec: TableSpec) -> list[list]:
        """What is on the lists of loaded files that lie with the rows that are there now."""
        current = self._catalog.location(spec)
        if current is None:
            return []
        folders = [current, *(f"{current}/{n}" for n in child_names(self._spark, current) if made_at(n))]
        lists = [f"{f}/{LOADED}" for f in folders if LOADED in child_names(self._spark, f)]
        return [entry for path in lists for entry in json.loads(read_text(self._spark, path))]

    def compact(self, spec: TableSpec, file_bytes: int, options: Mapping[str, str] | None) -> bool:
        """Write the files of the table or day anew, about ``file_bytes`` each; tells whether that was done."""
        facts = self._catalog.facts(spec)
        if facts is None:
            raise TableNotFoundError(f"table {spec.whole} does not exist")
        found = self._check(self._catalog.frame(facts, None).schema, spec, "truncate", "never")
        current = self._catalog.location(spec)
        if current is None:
            return False
        files = files_below(self._spark, current)
        wanted = max(1, -(-sum(size for _, size in files) // file_bytes))
        if len(files) <= wanted:
            return False
        # By path and not by the catalog, so that these are the rows of the number that was found.
        rows = self._spark.read.schema(self._catalog.frame(facts, None).schema).option("recursiveFileLookup", "true").parquet(current)
        point = self._catalog.point_day_at if spec.day else self._catalog.point_at
        self._fresh(rows.coalesce(wanted), spec, found, "truncate", {**_parquet_options(), **(options or {})}, point, self._loaded(spec))
        self._spark.catalog.refreshTable(spec.catalog_name)
        return True

    def _staged_files(self, path: str, fmt: str, schema: T.StructType | None) -> DataFrame:
        reader = self._spark.read.format(fmt).option("pathGlobFilter", f"*.{fmt}")
        return (reader.schema(schema) if schema is not None else reader).load(path)

    # -- checks, all before anything is written ------------------------------

    def _check(
        self, schema: T.StructType, spec: TableSpec, write: str, create: str
    ) -> _Found | None:
        facts = self._catalog.facts(spec)
        if facts is None:
            if create == "never":
                raise TableNotFoundError(f"table {spec.whole} does not exist and create is 'never'")
            return None
        if not facts.writable:
            raise ReadOnlyTableError(f"table {spec.whole} was not made by a save; it is read-only")
        spec.require_fits(facts.by_day)
        if facts.by_day and spec.day is None:
            raise PartitioningError(f"{spec} is partitioned by day; add $yyyymmdd")
        _require_same_columns(schema, self._catalog.frame(facts, None).schema, spec)
        record = self._record(spec, facts.line or NO_LINE)
        # Read before the rows are looked at: a change between the two is seen later.
        found = _Found(facts, record, record.last_done(_unit(spec)))
        if write == "empty" and not self._catalog.frame(facts, spec.day).isEmpty():
            raise TableNotEmptyError(f"{spec} holds rows and write is 'empty'")
        return found

    def _record(self, spec: TableSpec, line: str) -> Record:
        return Record(self._spark, f"{self._catalog.record_folder(spec)}/{line}", self._clock)

    # -- publishing ----------------------------------------------------------

    def _publish(
        self,
        df: DataFrame,
        spec: TableSpec,
        found: _Found | None,
        write: str,
        options: Mapping[str, str],
        loaded: list | None = None,
    ) -> None:
        """Publish ``df``. With ``loaded``, the list of the files it is from, an append too is
        right only for the state it was made for: ``_MovedOn`` goes to the caller."""
        for _ in range(TRIES):
            try:
                if found is None:
                    self._create(df, spec, options, loaded)
                else:
                    self._into_existing(df, spec, found, write, options, loaded)
                return
            except TableExistsError as e:
                # Someone else made the table or the day meanwhile: save into that.
                if write == "truncate":
                    raise _overlapping(spec) from e
                if loaded is not None:
                    raise _MovedOn from e
            except _MovedOn:
                if loaded is not None:
                    raise
            found = self._check(df.schema, spec, write, "never")
        raise _overlapping(spec)

    def _into_existing(
        self,
        df: DataFrame,
        spec: TableSpec,
        found: _Found,
        write: str,
        options: Mapping[str, str],
        loaded: list | None,
    ) -> None:
        df = df.select(*[column(n) for n in self._catalog.frame(found.facts, None).columns])
        if spec.day is None:
            if write == "truncate":
                self._fresh(df, spec, found, write, options, self._catalog.point_at, loaded)
            else:
                self._add(df, spec, found, write, options, loaded)
        else:
            self._into_day(df, spec, found, write, options, loaded)
        self._spark.catalog.refreshTable(spec.catalog_name)

    def _into_day(
        self, df: DataFrame, spec: TableSpec, found: _Found, write: str, options: Mapping[str, str], loaded: list | None
    ) -> None:
        if write != "append":
            there = self._catalog.location(spec) is not None
            publish = self._catalog.point_day_at if there else self._catalog.add_day
            self._fresh(df, spec, found, write, options, publish, loaded)
            return
        # Appends of one process to one day queue up, so that none is written again for another.
        with self._day_locks.setdefault(spec, threading.Lock()):
            if loaded is None and found.record.only_added_since(_unit(spec), found.number):
                found = _Found(found.facts, found.record, found.record.last_done(_unit(spec)))
            current = self._catalog.location(spec)
            if current is None:
                self._fresh(df, spec, found, write, options, self._catalog.add_day, loaded)
                return
            held = self._spark.read.schema(df.schema).parquet(current)
            every = [*self._loaded(spec), *(loaded or [])]
            self._fresh(held.unionByName(df), spec, found, write, options, self._catalog.point_day_at, every, loaded is not None)

    def _add(
        self, df: DataFrame, spec: TableSpec, found: _Found, write: str, options: Mapping[str, str], loaded: list | None
    ) -> None:
        """Write beside the table's folder, then move that into it."""
        current = found.facts.location
        pending = f"{self._catalog.table_folder(spec)}/{PENDING}{fresh_name()}"
        try:
            _write(df, pending, options)
            self._note_loaded(pending, loaded)
            moved = lambda: not child_names(self._spark, pending)
            with found.record.turn(WHOLE, _name(current), adds=True, changed=moved) as turn:
                if self._catalog.location(spec) != current:
                    raise _overlapping(spec)
                if (write == "empty" or loaded is not None) and turn.before != found.number:
                    raise _MovedOn
                turn.check()
                move_in(self._spark, pending, current)
        finally:
            delete_tree(self._spark, pending)

    def clean_up(self, now_ms: int, grace_ms: int) -> list[str]:
        """Remove folders that the record says were replaced, or does not know, once the grace is over.

        A table without a record, or with entries that cannot be read, is left alone.
        """
        gone = []
        for folder, records in self._catalog.saved_tables():
            names = child_names(self._spark, folder)  # before the record: what is published since is young
            lines = [Record(self._spark, f"{records}/{line}", self._clock) for line in child_names(self._spark, records)]
            if not lines or NO_LINE in child_names(self._spark, records):
                continue
            live, replaced = set(), {}
            try:
                for line in lines:
                    named, over = line.folders()
                    live |= named
                    replaced |= over
            except (ValueError, Py4JJavaError):
                continue
            for name in names:
                since = replaced.get(name, made_at(name))
                if name not in live and since is not None and since + grace_ms <= now_ms:
                    delete_tree(self._spark, f"{folder}/{name}")
                    gone.append(f"{folder}/{name}")
            there = set(child_names(self._spark, folder))
            for line in lines:
                line.forget(there)
        return gone

    def _note_loaded(self, folder: str, loaded: list | None) -> None:
        """Put the list of loaded files beside the rows, so that both are published, replaced and removed together."""
        if loaded:
            create_new(self._spark, f"{folder}/{LOADED}", json.dumps(loaded))

    def _create(self, df: DataFrame, spec: TableSpec, options: Mapping[str, str], loaded: list | None) -> None:
        line = fresh_name()
        make = self._catalog.create_by_day if spec.day else self._catalog.create_over
        facts = TableFacts(spec.catalog_name, None, spec.day is not None, True, line)
        self._fresh(
            df, spec, _Found(facts, self._record(spec, line), 0), "append", options,
            lambda spec, folder: make(spec, df.schema, folder, line), loaded,
        )

    def _fresh(
        self,
        df: DataFrame,
        spec: TableSpec,
        found: _Found,
        write: str,
        options: Mapping[str, str],
        publish: Callable[[TableSpec, str], None],
        loaded: list | None = None,
        strict: bool = False,
    ) -> None:
        """Write ``df`` to a folder of its own and publish that, or leave nothing.

        ``strict``: any change by others since is too much, additions as well.
        """
        day = f"{spec.day:%Y%m%d}_" if spec.day else ""
        name = f"{day}{fresh_name()}"
        folder = f"{self._catalog.table_folder(spec)}/{name}"
        published = lambda: _name(self._catalog.location(spec)) == name
        try:
            _write(df, folder, options)
            self._note_loaded(folder, loaded)
            with found.record.turn(_unit(spec), name, adds=write == "append", changed=published) as turn:
                if strict and turn.before != found.number:
                    raise _MovedOn
                _require_unchanged(spec, found, write, turn)
                turn.check()
                publish(spec, folder)
        except BaseException:
            # An update may have gone through although its answer was lost.
            if not published():
                delete_tree(self._spark, folder)
            raise


def _name(path: str | None) -> str:
    return (path or "").rstrip("/").rpartition("/")[2]


def _overlapping(spec: TableSpec) -> OverlappingSaveError:
    return OverlappingSaveError(f"{spec} was changed by another save meanwhile; this one changed nothing")


def _require_unchanged(spec: TableSpec, found: _Found, write: str, turn: Turn) -> None:
    """Compare what there is with what the save started from."""
    if turn.before == found.number:
        return
    if write == "truncate" or (write == "append" and not found.record.only_added_since(_unit(spec), found.number)):
        raise _overlapping(spec)
    raise _MovedOn


def _write(
    df: DataFrame,
    path: str,
    options: Mapping[str, str],
    fmt: str = "parquet",
) -> None:
    df.write.format(fmt).options(**options).save(path)


def _balanced(df: DataFrame) -> DataFrame:
    """Rows dealt anew to partitions of about the session's advisory size, small ones joined and large ones split."""
    return df.hint("rebalance")


def _parquet_options() -> dict[str, str]:
    return {"compression": CODECS["parquet"]}


def _require_choice(what: str, value: str, choices) -> None:
    if value not in choices:
        raise SpecError(f"{what} must be one of {', '.join(choices)}; got {value!r}")


def _dispositions(write: str | None, create: str | None) -> tuple[str, str]:
    """Both dispositions, with the defaults: append, and create if needed."""
    write, create = write or "append", create or "if_needed"
    _require_choice("write", write, WRITES)
    _require_choice("create", create, CREATES)
    return write, create


def _outgoing(df: DataFrame, types: str) -> DataFrame:
    """``df`` in the types to be saved; refuses what a table cannot take."""
    _require_choice("types", types, TYPES)
    require_unique_columns(df.columns)
    if PARTITION_COLUMN in (n.lower() for n in df.columns):
        raise SpecError(f"{PARTITION_COLUMN} is a reserved column name")
    refuse_nested_arrays(df.schema)
    return load_form(df) if types == "load" else df


def _require_same_columns(new: T.StructType, old: T.StructType, spec: TableSpec) -> None:
    have = {f.name.lower(): f.dataType for f in new.fields}
    want = {f.name.lower(): f.dataType for f in old.fields}
    if have.keys() != want.keys():
        odd = sorted(have.keys() ^ want.keys())
        raise SchemaMismatchError(f"columns differ from {spec.whole}: {', '.join(odd)}", odd[0])
    for name, dt in want.items():
        if not same_type(have[name], dt):
            raise SchemaMismatchError(
                f"column {name} is {have[name].simpleString()}, "
                f"but {dt.simpleString()} in {spec.whole}",
                name,
            )
