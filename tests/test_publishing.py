"""Saves that overlap, break or die, and cleaning up from any session."""

import json
import subprocess
import sys
import threading
import uuid
from pathlib import Path

import pytest

from stowage import Warehouse
from stowage.errors import OverlappingSaveError, TableNotEmptyError
from stowage.sources import publishing, saves
from stowage.sources.files import child_names, create_new, files_below, read_text
from stowage.sources.publishing import WHOLE, Record

DAY_MS = 86_400_000
PLACES = ["ds.t", "ds.d$20240101"]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")


@pytest.fixture
def short_lease(monkeypatch):
    monkeypatch.setattr(publishing, "LEASE_S", 1.0)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def folders(wh, table):
    return child_names(wh.spark, wh._catalog.table_folder(wh.spec(table)))


def record_names(wh, table):
    spec = wh.spec(table)
    root = wh._catalog.record_folder(spec)
    return [n for line in child_names(wh.spark, root) for n in child_names(wh.spark, f"{root}/{line}")]


def before_write(monkeypatch, act):
    """Run ``act`` once, when the next save is about to write its rows."""
    write = saves._write

    def first(*args, **how):
        monkeypatch.setattr(saves, "_write", write)
        act()
        return write(*args, **how)

    monkeypatch.setattr(saves, "_write", first)


# -- one step on storage -------------------------------------------------------


def test_a_file_is_made_once(spark, tmp_path):
    made = []

    def make(n):
        if create_new(spark, f"file:{tmp_path}/a b%20c/x", str(n)):
            made.append(n)

    threads = [threading.Thread(target=make, args=(n,)) for n in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 1
    assert read_text(spark, f"file:{tmp_path}/a b%20c/x") == str(made[0])
    assert child_names(spark, f"file:{tmp_path}/a b%20c") == ["x"]


def test_turns_go_one_after_the_other(spark, tmp_path):
    inside, most = [], []

    def take(n):
        record = Record(spark, str(tmp_path / "line"), lambda: n)
        for _ in range(4):
            with record.turn(WHOLE, f"f{n}", adds=False, changed=bool):
                inside.append(n)
                most.append(len(inside))
                inside.remove(n)

    threads = [threading.Thread(target=take, args=(n,)) for n in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert max(most) == 1 and len(most) == 20
    live, replaced = Record(spark, str(tmp_path / "line"), lambda: 0).folders()
    assert len(live) == 1 and live | replaced.keys() == {f"f{n}" for n in range(5)}


def test_a_turn_whose_owner_died_is_passed_over(spark, tmp_path, short_lease):
    record = Record(spark, str(tmp_path / "line"), lambda: 7)
    record._take(WHOLE, "lost", False)
    assert record.folders() == ({"lost"}, {})
    with record.turn(WHOLE, "next", adds=False, changed=bool) as turn:
        assert (turn.number, turn.before) == (2, 0)
        assert record.folders()[0] == {"lost", "next"}
    assert record.folders() == ({"next"}, {"lost": 7})


def test_an_owner_that_is_late_gives_up(spark, tmp_path, short_lease, monkeypatch):
    record = Record(spark, str(tmp_path / "line"), lambda: 7)
    now = publishing.time.monotonic()
    with pytest.raises(OverlappingSaveError), record.turn(WHOLE, "slow", adds=False, changed=bool) as turn:
        monkeypatch.setattr(publishing.time, "monotonic", lambda: now + 30)
        turn.check()
    assert record.last_done(WHOLE) == 0


# -- saves that overlap --------------------------------------------------------


@pytest.mark.parametrize("table", PLACES)
@pytest.mark.parametrize("exists", [False, True])
def test_of_two_empty_saves_at_once_one_is_refused(spark, warehouse, frame, monkeypatch, table, exists):
    if exists:
        warehouse.write_table(frame.limit(0), table)
    write, both = saves._write, threading.Barrier(2)

    def together(*args, **how):
        both.wait(timeout=60)
        return write(*args, **how)

    monkeypatch.setattr(saves, "_write", together)
    results = []

    def save():
        try:
            warehouse.write_table(frame, table, write="empty")
            results.append("saved")
        except TableNotEmptyError:
            results.append("refused")

    threads = [threading.Thread(target=save) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == ["refused", "saved"]
    assert rows(warehouse.read_table(table)) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("table", PLACES)
def test_a_truncate_loses_no_append_that_succeeded(warehouse, frame, monkeypatch, table):
    warehouse.write_table(frame, table)
    own = warehouse.read_table(table)
    before = len(folders(warehouse, table))
    before_write(monkeypatch, lambda: warehouse.write_table(frame, table))
    with pytest.raises(OverlappingSaveError):
        warehouse.write_table(own.limit(1), table, write="truncate")
    assert rows(warehouse.read_table(table)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    warehouse.clean_up(2**62)
    assert len(folders(warehouse, table)) == before
    warehouse.write_table(frame.limit(1), table, write="truncate")
    assert warehouse.read_table(table).count() == 1


@pytest.mark.parametrize("table", PLACES)
def test_of_two_first_truncates_one_is_refused(warehouse, frame, monkeypatch, table):
    before_write(monkeypatch, lambda: warehouse.write_table(frame, table, write="truncate"))
    with pytest.raises(OverlappingSaveError):
        warehouse.write_table(frame.limit(1), table, write="truncate")
    assert warehouse.read_table(table).count() == 2
    assert len(folders(warehouse, table)) == 1


@pytest.mark.parametrize("table", PLACES)
def test_an_append_that_meets_a_truncate_is_refused(warehouse, frame, monkeypatch, table):
    warehouse.write_table(frame, table)
    old = warehouse._catalog.location(warehouse.spec(table))
    held = child_names(warehouse.spark, old)
    before_write(monkeypatch, lambda: warehouse.write_table(frame.limit(1), table, write="truncate"))
    with pytest.raises(OverlappingSaveError):
        warehouse.write_table(frame, table)
    assert rows(warehouse.read_table(table)) == [(1, "a")]
    assert child_names(warehouse.spark, old) == held
    assert len(folders(warehouse, table)) == 2  # the table's, and the replaced one in its grace


def test_an_append_to_a_day_that_meets_another_is_written_over_it(spark, warehouse, frame, tmp_path, monkeypatch):
    """The other comes from another warehouse, whose appends do not queue up with these."""
    table = "ds.d$20240101"
    other = Warehouse(spark.newSession(), str(tmp_path), warehouse.project)
    warehouse.write_table(frame, table)
    before_write(monkeypatch, lambda: other.write_table(frame, table))
    warehouse.write_table(frame.limit(1), table)
    assert warehouse.read_table(table).count() == 5
    assert other.read_table(table).count() == 5


# -- saves that break ----------------------------------------------------------


def broken(*_, **__):
    raise RuntimeError("storage is away")


STEPS = {
    "write": lambda wh, m: m.setattr(saves, "_write", broken),
    "turn": lambda wh, m: m.setattr(Record, "_take", broken),
    "check": lambda wh, m: m.setattr(saves, "_require_unchanged", broken),
    "catalog": lambda wh, m: [m.setattr(wh._catalog, n, broken) for n in ("point_day_at", "point_at", "add_day")],
    "move": lambda wh, m: m.setattr(saves, "move_in", broken),
}


@pytest.mark.parametrize("table, step", [("ds.t", "write"), ("ds.t", "turn"), ("ds.t", "move"), *(("ds.d$20240101", s) for s in STEPS if s != "move")])
def test_an_append_that_breaks_anywhere_changes_nothing(spark, warehouse, frame, monkeypatch, table, step):
    warehouse.write_table(frame, table)
    before = folders(warehouse, table), files_below(spark, warehouse._catalog.location(warehouse.spec(table)))
    reader = warehouse.read_table(table)
    STEPS[step](warehouse, monkeypatch)
    with pytest.raises(RuntimeError, match="storage is away"):
        warehouse.write_table(frame, table)
    monkeypatch.undo()
    assert rows(reader) == rows(warehouse.read_table(table)) == [(1, "a"), (2, "b")]
    assert (folders(warehouse, table), files_below(spark, warehouse._catalog.location(warehouse.spec(table)))) == before
    warehouse.write_table(frame, table)
    assert warehouse.read_table(table).count() == 4
    assert child_names(spark, f"{warehouse._catalog.location(warehouse.spec(table))}/_temporary") == []


@pytest.mark.parametrize("table", PLACES)
def test_a_save_that_dies_after_its_change_is_there(warehouse, frame, monkeypatch, table, short_lease):
    """The turn stays open; the folder is kept, and the next save goes on after the lease."""
    warehouse.write_table(frame, table)
    monkeypatch.setattr(Record, "_end", broken)
    with pytest.raises(RuntimeError, match="storage is away"):
        warehouse.write_table(frame.limit(1), table, write="truncate")
    monkeypatch.undo()
    monkeypatch.setattr(publishing, "LEASE_S", 1.0)
    warehouse.clean_up(2**62)
    assert rows(warehouse.read_table(table)) == [(1, "a")]
    warehouse.write_table(frame.limit(1), table)
    assert warehouse.read_table(table).count() == 2


def test_a_day_is_appended_to_in_one_step(spark, warehouse, frame):
    """No file is moved: whoever planned before reads the old folder, whoever plans later the new one."""
    table = "ds.d$20240101"
    warehouse.write_table(frame, table)
    old = warehouse._catalog.location(warehouse.spec(table))
    held = files_below(spark, old)
    warehouse.write_table(frame, table)
    assert files_below(spark, old) == held
    new = warehouse._catalog.location(warehouse.spec(table))
    assert new != old and warehouse.read_table(table).count() == 4
    assert spark.read.parquet(new).count() == 4


# -- cleaning up ---------------------------------------------------------------

OTHER_PROCESS = """
import json, sys
from pyspark.sql import SparkSession
from stowage import Warehouse
root, project, now, warehouse_dir = sys.argv[1], sys.argv[2], int(sys.argv[3]), sys.argv[4]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.warehouse.dir", warehouse_dir).config("spark.sql.shuffle.partitions", "2").getOrCreate())
wh = Warehouse(spark, root, project)
first = wh.clean_up(now)
wh.write_table(spark.range(3), "ds.mine")
wh.write_table(spark.range(4), "ds.t")          # the same name, in a catalog of its own
wh.write_table(spark.range(5), "ds.t", write="truncate")
second = wh.clean_up(now)
print(json.dumps([first, second, wh.read_table("ds.t").count()]))
"""


def in_other_process(root, project, now, place):
    code = [sys.executable, "-c", OTHER_PROCESS, str(root), project, str(now), str(place)]
    run = subprocess.run(code, capture_output=True, text=True, cwd=Path(__file__).parents[1], timeout=300)
    assert run.returncode == 0, run.stderr
    return json.loads(run.stdout.splitlines()[-1])


def test_another_process_removes_nothing_that_is_live(spark, tmp_path, frame):
    """Its catalog is in memory and knows none of the tables."""
    now = 1_900_000_000_000
    root = tmp_path / "root"
    wh = Warehouse(spark, str(root), f"t-{uuid.uuid4().hex}", clock=lambda: now)
    for table in PLACES:
        wh.write_table(frame, table)
        wh.write_table(frame, table, write="truncate")
        wh.write_table(frame, table)
    mine = {t: folders(wh, t) for t in PLACES}
    assert [len(f) for f in mine.values()] == [2, 3]
    first, second, n = in_other_process(root, wh.project, now + DAY_MS - 1, tmp_path / "w1")
    assert (first, n) == ([], 5)
    assert [g for g in second if any(f in g for t in PLACES for f in mine[t])] == []
    first, second, n = in_other_process(root, wh.project, now + DAY_MS, tmp_path / "w2")
    assert len(first) >= 3 and second is not None  # what this process replaced, and the other's
    for table in PLACES:
        assert rows(wh.read_table(table)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
        live = wh._catalog.location(wh.spec(table)).rpartition("/")[2]
        assert set(mine[table]) & set(folders(wh, table)) == {live}


def test_the_record_stays_small(spark, warehouse, frame):
    for _ in range(6):
        warehouse.write_table(frame, "ds.t")
        warehouse.write_table(frame, "ds.d$20240101")
    assert len(record_names(warehouse, "ds.t")) == 2
    assert len(record_names(warehouse, "ds.d")) == 12
    for _ in range(3):
        warehouse.write_table(frame, "ds.t", write="truncate")
    warehouse.clean_up(2**62)
    assert len(record_names(warehouse, "ds.t")) == len(record_names(warehouse, "ds.d")) == 2
    assert warehouse.read_table("ds.t").count() == 2 and warehouse.read_table("ds.d").count() == 12


def test_appends_do_not_put_off_the_end_of_what_was_replaced(spark, tmp_path, frame):
    now = [10 * DAY_MS]
    wh = Warehouse(spark, str(tmp_path), f"t-{uuid.uuid4().hex}", clock=lambda: now[0])
    wh.write_table(frame, "ds.t")
    wh.write_table(frame, "ds.t", write="truncate")
    for _ in range(3):
        now[0] += DAY_MS // 2
        wh.write_table(frame, "ds.t")
    assert len(wh.clean_up(11 * DAY_MS - 1)) == 0
    assert len(wh.clean_up(11 * DAY_MS)) == 1
    assert wh.read_table("ds.t").count() == 8


def test_what_cannot_be_read_or_has_no_record_is_left_alone(spark, warehouse, frame):
    for table in ("ds.t", "ds.u"):
        warehouse.write_table(frame, table)
        warehouse.write_table(frame, table, write="truncate")
    root = warehouse._catalog.record_folder(warehouse.spec("ds.t"))
    line = child_names(spark, root)[0]
    create_new(spark, f"{root}/{line}/{WHOLE}-{9:010}", "")  # somebody is writing it just now
    record = Path(warehouse._catalog.record_folder(warehouse.spec("ds.u")).removeprefix("file:"))
    record.rename(record.with_name("elsewhere"))
    assert warehouse.clean_up(2**62) == []
    assert [len(folders(warehouse, t)) for t in ("ds.t", "ds.u")] == [2, 2]
