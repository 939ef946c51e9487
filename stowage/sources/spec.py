"""Table specs, catalog names, and table references inside SQL text.

A spec is ``[project:]dataset.table[$yyyymmdd]``. The project ends at the last
colon; the part after ``$`` names one day of a day-partitioned table.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

from stowage.errors import PartitioningError, SpecError

_SPEC = re.compile(
    r"(?:(?P<project>[\w.:-]+):)?(?P<dataset>[\w-]+)\.(?P<table>[\w-]+)(?:\$(?P<day>.*))?"
)
_DAY = re.compile(r"\d{8}")


@dataclass(frozen=True)
class TableSpec:
    """A table, or one day of it, named by project, dataset and table."""

    project: str
    dataset: str
    table: str
    day: dt.date | None = None

    def __post_init__(self) -> None:
        """A table id with ``$yyyymmdd`` names a day here too; empty parts are refused."""
        table, mark, day = self.table.partition("$")
        if mark:
            if self.day is not None:
                raise SpecError(f"{self.table!r} names a day, and day is given as well")
            object.__setattr__(self, "table", table)
            object.__setattr__(self, "day", _parse_day(day, f"{table}${day}"))
        for part, name in (("project", self.project), ("dataset", self.dataset), ("table", self.table)):
            if not name or not name.strip():
                raise SpecError(f"the {part} of a table has no name")

    @classmethod
    def parse(cls, text: str, default_project: str | None = None) -> TableSpec:
        m = _SPEC.fullmatch(text)
        if not m:
            raise SpecError(f"not a table spec: {text!r}; want [project:]dataset.table[$yyyymmdd]")
        project = m["project"] or default_project
        if not project:
            raise SpecError(f"no project in {text!r} and no default project is set")
        return cls(project, m["dataset"], m["table"], _parse_day(m["day"], text))

    @property
    def schema_name(self) -> str:
        """Catalog schema of the dataset; ``__`` can only be the separator in it."""
        return f"{escape(self.project)}__{escape(self.dataset)}"

    @property
    def table_name(self) -> str:
        return escape(self.table)

    @property
    def catalog_name(self) -> str:
        return f"{self.schema_name}.{self.table_name}"

    @property
    def whole(self) -> TableSpec:
        """The same table without the day."""
        return replace(self, day=None)

    def require_fits(self, by_day: bool) -> None:
        """A day can be named only where the table is partitioned by day."""
        if self.day is not None and not by_day:
            raise PartitioningError(f"{self.whole} is not partitioned by day; drop the $ part")

    def __str__(self) -> str:
        day = f"${self.day:%Y%m%d}" if self.day else ""
        return f"{self.project}:{self.dataset}.{self.table}{day}"


def _parse_day(text: str | None, spec: str) -> dt.date | None:
    if text is None:
        return None
    if not _DAY.fullmatch(text):
        raise SpecError(f"day {text!r} in {spec!r} is not yyyymmdd")
    try:
        return dt.datetime.strptime(text, "%Y%m%d").date()
    except ValueError as e:
        raise SpecError(f"day {text!r} in {spec!r} is no calendar day") from e


def escape(name: str) -> str:
    """A reversible catalog name: other characters become ``_`` and two hex digits per byte."""
    return re.sub(
        r"[^a-z0-9]", lambda m: "".join(f"_{b:02x}" for b in m[0].encode("utf-8")), name
    )


def unescape(name: str) -> str:
    return re.sub(
        r"(?:_[0-9a-f]{2})+", lambda m: bytes.fromhex(m[0].replace("_", "")).decode("utf-8"), name
    )


# The tokens of a statement as far as references need them. Quoted text and comments come
# first, so that nothing inside them is taken for anything else. A raw string knows no escapes.
_TOKENS = re.compile(
    r"""
      (?P<text>[rR](?:'[^']*'|"[^"]*") | '(?:[^'\\]|\\.)*' | "(?:[^"\\]|\\.)*")
    | (?P<quoted>`(?:[^`]|``)*`)
    | (?P<line>--[^\n]*)
    | (?P<block>/\*)
    | (?P<spec>\[[^\[\]\s]+\])
    | (?P<word>\w+)
    | (?P<space>\s+)
    | (?P<sign>.)
    """,
    re.VERBOSE | re.DOTALL,
)
_BLOCK_EDGE = re.compile(r"/\*|\*/")
_BEFORE_A_TABLE = {"FROM", "JOIN", "TABLE"}
_SILENT = {"line", "block", "space"}


def tokens(sql: str) -> Iterator[tuple[str, str]]:
    """The kind and text of each token of ``sql``; together they are all of it."""
    at = 0
    while at < len(sql):
        m = _TOKENS.match(sql, at)
        end = _end_of_block(sql, at) if m.lastgroup == "block" else m.end()
        yield m.lastgroup, sql[at:end]
        at = end


def _end_of_block(sql: str, start: int) -> int:
    """Where the comment that begins at ``start`` ends; comments may hold comments."""
    depth, at = 0, start
    while edge := _BLOCK_EDGE.search(sql, at):
        depth += 1 if edge[0] == "/*" else -1
        at = edge.end()
        if not depth:
            return at
    return len(sql)


def resolve_references(sql: str, relation: Callable[[str], str]) -> str:
    """Replace each ``[spec]`` by ``relation(spec)``.

    Brackets that index an array or a map are left alone: they follow a value,
    or do not hold a spec with a dot.
    """
    out, before = [], ("sign", "")
    for kind, text in tokens(sql):
        if kind == "spec" and _SPEC.fullmatch(text[1:-1]) and not _is_value(*before):
            out.append(relation(text[1:-1]))
        else:
            out.append(text)
        if kind not in _SILENT:
            before = (kind, text)
    return "".join(out)


def _is_value(kind: str, text: str) -> bool:
    """Whether a bracket after this token indexes a value."""
    if kind == "word":
        return text.upper() not in _BEFORE_A_TABLE
    return kind in ("text", "quoted", "spec") or text in (")", "]")


def mentions(sql: str, name: str) -> bool:
    """Whether ``name`` stands in ``sql`` outside of text and comments."""
    return any(
        (kind == "word" and text.lower() == name) or (kind == "quoted" and text[1:-1].lower() == name)
        for kind, text in tokens(sql)
    )


def without_closing(sql: str) -> str:
    """``sql`` without a semicolon at its end, whatever comments and space follow that."""
    parts = list(tokens(sql))
    last = max((i for i, (kind, _) in enumerate(parts) if kind not in _SILENT), default=-1)
    if last >= 0 and parts[last] == ("sign", ";"):
        del parts[last]
    return "".join(text for _, text in parts)
