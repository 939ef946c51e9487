import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st

from stowage.errors import PartitioningError, SpecError
from stowage.sources.spec import (
    TableSpec,
    escape,
    mentions,
    resolve_references,
    unescape,
    without_closing,
)


def test_parse_full():
    spec = TableSpec.parse("public-data:samples.plays")
    assert (spec.project, spec.dataset, spec.table, spec.day) == (
        "public-data",
        "samples",
        "plays",
        None,
    )


def test_parse_default_project_and_day():
    spec = TableSpec.parse("ds.t$20240103", "home")
    assert spec == TableSpec("home", "ds", "t", dt.date(2024, 1, 3))
    assert str(spec) == "home:ds.t$20240103"
    assert spec.whole == TableSpec("home", "ds", "t")


def test_project_ends_at_the_last_colon():
    assert TableSpec.parse("example.com:lab:ds.t").project == "example.com:lab"


@pytest.mark.parametrize(
    "text", ["", "t", "p:t", "a.b.c.d e", "p:ds.t$", "p:ds.t$2024", "p:ds.t$20241301", "p:ds.t$x"]
)
def test_parse_refuses(text):
    with pytest.raises(SpecError):
        TableSpec.parse(text, "home")


def test_parse_needs_a_project():
    with pytest.raises(SpecError):
        TableSpec.parse("ds.t")


def test_day_fits_only_where_there_are_days():
    spec = TableSpec.parse("p:ds.t$20240103")
    spec.require_fits(by_day=True)
    with pytest.raises(PartitioningError):
        spec.require_fits(by_day=False)


@given(st.text(min_size=1, max_size=20))
def test_escape_is_reversible(name):
    safe = escape(name)
    assert unescape(safe) == name
    assert all(c in "abcdefghijklmnopqrstuvwxyz0123456789_" for c in safe)
    assert "__" not in safe


@given(st.text("aB_-9", min_size=1, max_size=6), st.text("aB_-9", min_size=1, max_size=6))
def test_schema_name_separates_its_parts(project, dataset):
    left, _, right = TableSpec(project, dataset, "t").schema_name.partition("__")
    assert (unescape(left), unescape(right)) == (project, dataset)


def _mark(sql):
    return resolve_references(sql, lambda text: f"<{text}>")


@pytest.mark.parametrize(
    "sql, want",
    [
        ("SELECT * FROM [p:ds.t]", "SELECT * FROM <p:ds.t>"),
        ("SELECT * FROM[ds.t] x", "SELECT * FROM<ds.t> x"),
        ("FROM [ds.a], [ds.b$20240103]", "FROM <ds.a>, <ds.b$20240103>"),
        ("JOIN /* all */ [ds.t] USING (k)", "JOIN /* all */ <ds.t> USING (k)"),
        ("SELECT a[0], b[i], m['x.y'] FROM [ds.t]", "SELECT a[0], b[i], m['x.y'] FROM <ds.t>"),
        ("SELECT a[t.i], f(x) [t.i], a[0][t.i]", "SELECT a[t.i], f(x) [t.i], a[0][t.i]"),
        ("SELECT '[ds.t]', \"[ds.t]\", `[ds.t]`", "SELECT '[ds.t]', \"[ds.t]\", `[ds.t]`"),
        ("SELECT 'it\\'s [ds.t]'", "SELECT 'it\\'s [ds.t]'"),
        ("SELECT 1 -- [ds.t]\nFROM [ds.t]", "SELECT 1 -- [ds.t]\nFROM <ds.t>"),
        ("/* [ds.t]\n */ FROM [ds.t]", "/* [ds.t]\n */ FROM <ds.t>"),
        ("FROM -- all rows\n[ds.t]", "FROM -- all rows\n<ds.t>"),
        ("SELECT r'\\' s FROM [ds.t] WHERE 'a' = 'a'", "SELECT r'\\' s FROM <ds.t> WHERE 'a' = 'a'"),
        ('SELECT R"\\" s FROM [ds.t]', 'SELECT R"\\" s FROM <ds.t>'),
        ("/* a /* [ds.u] */ [ds.v] */ FROM [ds.t]", "/* a /* [ds.u] */ [ds.v] */ FROM <ds.t>"),
        ("SELECT a /* x */ [t.i], a -- y\n[t.i] FROM [ds.t]", "SELECT a /* x */ [t.i], a -- y\n[t.i] FROM <ds.t>"),
        ("FROM [ds.t] /* never closed [ds.u]", "FROM <ds.t> /* never closed [ds.u]"),
    ],
)
def test_references_in_sql(sql, want):
    assert _mark(sql) == want


@pytest.mark.parametrize("bad", ["t$2024", "t$20240230", "t$", "$20240103", "", " "])
def test_references_check_their_parts(bad):
    with pytest.raises(SpecError):
        TableSpec("p", "ds", bad)


def test_reference_with_a_day():
    assert TableSpec("p", "ds", "t$20240103") == TableSpec("p", "ds", "t", dt.date(2024, 1, 3))
    with pytest.raises(SpecError):
        TableSpec("p", "ds", "t$20240103", dt.date(2024, 1, 3))
    for names in (("", "ds"), ("p", "")):
        with pytest.raises(SpecError):
            TableSpec(*names, "t")


@pytest.mark.parametrize(
    "sql, want",
    [
        ("SELECT 1;", "SELECT 1"),
        ("SELECT 1; -- done", "SELECT 1 -- done"),
        ("SELECT ';' -- ;", "SELECT ';' -- ;"),
        ("SELECT 1 /* ; */", "SELECT 1 /* ; */"),
        ("", ""),
    ],
)
def test_closing_semicolon(sql, want):
    assert without_closing(sql) == want


def test_mentions_are_those_outside_text():
    assert mentions("SELECT A_b", "a_b") and mentions("SELECT `a_b`", "a_b")
    assert not any(mentions(s, "a_b") for s in ("SELECT 'a_b'", "SELECT 1 -- a_b", "/* a_b */ SELECT a_bc"))
